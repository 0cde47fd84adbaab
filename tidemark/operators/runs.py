"""Runs in ordered events: circuit breakers, stop rules, gaps, sessions, continuity."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, NumericType, TimestampNTZType, TimestampType

#: Fixed thresholds of the breakers: consecutive failures after which the rest of a scope is skipped.
THRESHOLDS = {"search": 3, "product": 5, "no_price": 10, "review": 3, "series": 5}


#: Rows that one range of the order holds on average; a key with more is counted in several tasks.
PER_RANGE = 1_000_000


def _cuts(of: DataFrame, by: str, per_range: int) -> list[float]:
    """Where the ranges of an order's first column begin, by its quantiles in ``of``; ranges grow in number with the rows.

    No cuts, which is a single range, for few rows or a column that is neither a number nor a time.
    """
    if not isinstance(of.schema[by].dataType, (NumericType, DateType, TimestampType, TimestampNTZType)):
        return []
    ranges = -(-of.count() // per_range)
    return sorted(set(of.select(_place(of, by).alias("v")).approxQuantile("v", [i / ranges for i in range(1, ranges)], 0.1 / ranges))) if ranges > 1 else []


def _place(df: DataFrame, by: str) -> Column:
    number = isinstance(df.schema[by].dataType, NumericType)
    return F.col(by).cast("double") if number else F.unix_micros(F.col(by).cast("timestamp")).cast("double")


def _ranged(df: DataFrame, by: str, cuts: list[float]) -> DataFrame:
    """Adds _range: which of the ranges a row falls into, nulls into the first."""
    if not cuts:
        return df.withColumn("_range", F.lit(0))
    bounds, value = F.array(*[F.lit(float(c)) for c in cuts]).cast("array<double>"), _place(df, by)
    return df.withColumn("_range", F.coalesce(F.size(F.filter(bounds, lambda c: c < value)), F.lit(0)))


def _runs(df: DataFrame, of: DataFrame, scope: list[str], order: list[str], bad: Column, per_range: int) -> DataFrame:
    """Adds run: how many bad rows in a row end here, within a scope.

    Runs are counted within ranges of the order, and those that open a range take over what the ranges before it end
    with, so that no task sorts a whole scope.
    """
    whole = Window.unboundedPreceding
    within = Window.partitionBy(*scope, "_range").orderBy(order).rowsBetween(whole, 0)
    cuts = _cuts(of, order[0], per_range)
    marked = _ranged(df, order[0], cuts).withColumn("_bad", F.coalesce(bad, F.lit(False)).cast("int"))
    marked = marked.withColumn("_island", F.sum(1 - F.col("_bad")).over(within))
    own = Window.partitionBy(*scope, "_range", "_island").orderBy(order).rowsBetween(whole, 0)
    marked = marked.withColumn("run", F.sum("_bad").over(own))
    if not cuts:
        return marked.select(*df.columns, "run")
    # The last run of a range is that of its last island; _good tells whether a range breaks the run that comes in.
    parts = marked.groupBy(*scope, "_range", "_island").agg(F.sum("_bad").alias("_n"))
    parts = parts.groupBy(*scope, "_range").agg(F.max_by("_n", "_island").alias("_tail"), F.max((F.col("_island") > 0).cast("int")).alias("_good"))
    ranges = Window.partitionBy(*scope).orderBy("_range")
    parts = parts.withColumn("_group", F.sum("_good").over(ranges.rowsBetween(whole, 0)))
    ends = F.sum("_tail").over(Window.partitionBy(*scope, "_group").orderBy("_range").rowsBetween(whole, 0))
    carried = parts.withColumn("_ends", ends).withColumn("_carry", F.coalesce(F.lag("_ends").over(ranges), F.lit(0)))
    carried = carried.filter("_carry > 0").select(*[F.col(c).alias(f"_s{i}") for i, c in enumerate(scope)], F.col("_range").alias("_r"), "_carry")
    on = F.col("_range") == F.col("_r")
    for i, c in enumerate(scope):
        on = on & F.col(c).eqNullSafe(F.col(f"_s{i}"))
    carry = F.when(F.col("_island") == 0, F.coalesce("_carry", F.lit(0))).otherwise(0)
    return marked.join(carried, on, "left").withColumn("run", F.col("run") + carry).select(*df.columns, "run")


def failure_runs(events: DataFrame, key: str, order: list[str], failed: Column, per_range: int = PER_RANGE) -> DataFrame:
    """Adds run: how many failures in a row end here; a success, or a row of which it is not known, sets it back to 0."""
    return _runs(events, events, [key], order, failed, per_range)


def trips(events: DataFrame, key: str, order: list[str], failed: Column, threshold: int, per_range: int = PER_RANGE) -> DataFrame:
    """The row of each key at which its breaker first trips, with its run."""
    hit = failure_runs(events, key, order, failed, per_range).filter(F.col("run") == threshold)
    first = hit.groupBy(F.col(key).alias("_key")).agg(F.min_by(F.struct(*hit.columns), F.struct(*order)).alias("_row"))
    return first.select("_row.*")


def survivors(events: DataFrame, key: str, order: list[str], failed: Column, threshold: int, per_range: int = PER_RANGE) -> DataFrame:
    """Rows up to the trip, with it."""
    ended = trips(events, key, order, failed, threshold, per_range).select(F.col(key).alias("_key"), F.struct(*order).alias("_end"))
    both = events.join(ended, F.col(key).eqNullSafe(F.col("_key")), "left")
    return both.filter(F.col("_end").isNull() | (F.struct(*order) <= F.col("_end"))).select(*events.columns)


#: What stops a stage, as (counter, stage, status that counts, statuses that it does not see, kind of the error row).
#: Blocked and failed pages do not tell whether there is a price, so they neither add to that counter nor reset it.
COUNTERS = (
    ("search", "search", ("blocked",), (), "circuit_break"),
    ("product", "product", ("blocked", "failed"), (), "circuit_break"),
    ("no_price", "product", ("no_price",), ("blocked", "failed"), "no_price_circuit"),
    ("review", "review", ("blocked",), (), "circuit_break"),
    ("series", "series", ("failed",), (), "circuit_break"),
)


def circuit_errors(visits: DataFrame, key: str, stage: str, status: str, order: list[str], thresholds: dict[str, int] | None = None, per_range: int = PER_RANGE) -> DataFrame:
    """The error row of each key and stage that a breaker stops: its last visit, kind, counter and run.

    Of two counters of one stage the one that trips first stops it; ``order`` must be unique within a key and stage.
    ``thresholds`` replaces fixed ones by counter. A null status is no failure and resets. For series, key is the brand.
    """
    limits = THRESHOLDS | (thresholds or {})
    found = []
    for counter, at, counts, unseen, kind in COUNTERS:
        seen = visits.filter((F.col(stage) == at) & ~F.coalesce(F.col(status).isin(*unseen), F.lit(False)))
        hit = trips(seen, key, order, F.col(status).isin(*counts), limits[counter], per_range)
        found.append(hit.withColumn("counter", F.lit(counter)).withColumn("kind", F.lit(kind)))
    hits = reduce(DataFrame.unionByName, found)
    first = hits.groupBy(F.col(key).alias("_key"), F.col(stage).alias("_stage")).agg(F.min_by(F.struct(*hits.columns), F.struct(*order)).alias("_row"))
    return first.select("_row.*")


def stop_after(pages: DataFrame, scope: list[str], page: str, key: list[str], quiet: int, per_range: int = PER_RANGE) -> DataFrame:
    """Per scope and page: new keys, and whether the page is read if reading stops after ``quiet`` pages without news."""
    firsts = pages.groupBy(*scope, *key).agg(F.min(page).alias(page)).groupBy(*scope, page).agg(F.count(F.lit(1)).alias("_new"))
    all_pages = pages.select(*scope, page).distinct()
    on = [F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}")) for c in [*scope, page]]
    by_page = all_pages.alias("a").join(firsts.alias("b"), reduce(Column.__and__, on), "left").select("a.*", F.coalesce("_new", F.lit(0)).alias("new_keys"))
    own = _runs(by_page, pages, scope, [page], F.col("new_keys") == 0, per_range)
    ends = own.filter(F.col("run") >= quiet).groupBy(*[F.col(c).alias(f"_s{i}") for i, c in enumerate(scope)]).agg(F.min(page).alias("_end"))
    same = reduce(Column.__and__, [F.col(c).eqNullSafe(F.col(f"_s{i}")) for i, c in enumerate(scope)], F.lit(True))
    # Without a scope there is one row of the end.
    both = own.join(ends, same, "left") if scope else own.crossJoin(F.broadcast(ends))
    return both.select(*scope, page, "new_keys", (F.col("_end").isNull() | (F.col(page) <= F.col("_end"))).alias("read"))


def _micros(time: str | Column) -> Column:
    return F.unix_micros((F.col(time) if isinstance(time, str) else time).cast("timestamp"))


def gaps(events: DataFrame, key: str, time: str, seconds: int, per_range: int = PER_RANGE, order: tuple[str, ...] = ()) -> DataFrame:
    """Rows that come more than ``seconds`` after the one before, with the gap in gap_us; of equal times the first by ``order`` has it.

    A key's rows are compared within ranges of time; the first row of each range is compared with the key's latest time
    in the ranges before it, so that no task sorts a key's whole history. Rows without a time have no gap.
    """
    cuts = _cuts(events, time, per_range)
    ranged = _ranged(events, time, cuts)
    w = Window.partitionBy(key, "_range").orderBy(time, *order)
    since = ranged.withColumn("gap_us", _micros(time) - _micros(F.lag(time).over(w)))
    if not cuts:
        return since.filter(F.col("gap_us") > seconds * 1_000_000).drop("_range")
    ends = ranged.groupBy(key, "_range").agg(F.min(time).alias("_first"), F.max(time).alias("_last"))
    before = F.max("_last").over(Window.partitionBy(key).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1))
    ends = ends.select(F.col(key).alias("_key"), F.col("_range").alias("_r"), "_first", (_micros("_first") - _micros(before)).alias("_gap")).filter(F.col("_gap") > seconds * 1_000_000)
    # The row that opens a range has its earliest time and none before it there; of equal times the others have a gap of 0.
    own = F.col(key).eqNullSafe(F.col("_key")) & (F.col("_range") == F.col("_r")) & (F.col(time) == F.col("_first")) & F.col("gap_us").isNull()
    late = since.join(ends, own, "left").withColumn("gap_us", F.coalesce("gap_us", "_gap"))
    return late.filter(F.col("gap_us") > seconds * 1_000_000).select(*events.columns, "gap_us")


def sessions(events: DataFrame, key: str, time: str, order: list[str], seconds: int, per_range: int = PER_RANGE) -> DataFrame:
    """Per key and session: first and last time, and rows; a session ends when nothing comes for ``seconds``.

    Sessions are counted within ranges of time, and a session that goes on in the next range is put together from its
    pieces, so that no task sorts a key's whole history. Each row without a time is a session of its own.
    """
    cuts = _cuts(events, time, per_range)
    w = Window.partitionBy(key, "_range").orderBy(time, *order)
    since = _micros(time) - _micros(F.lag(time).over(w))
    opens = F.when((F.row_number().over(w) > 1) & (since.isNull() | (since > seconds * 1_000_000)), 1).otherwise(0)
    local = _ranged(events, time, cuts).withColumn("_open", opens).withColumn("_local", F.sum("_open").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    sums = F.min(time).alias("started"), F.max(time).alias("ended"), F.count(F.lit(1)).alias("rows")
    if not cuts:
        return local.groupBy(key, (F.col("_local") + 1).alias("session")).agg(*sums)
    pieces = local.groupBy(key, "_range", "_local").agg(*sums)
    parts = pieces.groupBy(F.col(key).alias("_key"), F.col("_range").alias("_r")).agg(F.min_by("started", "_local").alias("_first"), F.max("ended").alias("_last"), F.max("_local").alias("_opens"))
    ranges = Window.partitionBy("_key").orderBy("_r").rowsBetween(Window.unboundedPreceding, -1)
    gap = _micros("_first") - _micros(F.max("_last").over(ranges))
    parts = parts.withColumn("_new", F.when(gap <= seconds * 1_000_000, 0).otherwise(1))
    parts = parts.withColumn("_base", F.coalesce(F.sum(F.col("_opens") + F.col("_new")).over(ranges), F.lit(0)) + F.col("_new"))
    both = pieces.join(parts, F.col(key).eqNullSafe(F.col("_key")) & (F.col("_range") == F.col("_r")))
    session = (F.col("_local") + F.col("_base")).alias("session")
    return both.groupBy(key, session).agg(F.min("started").alias("started"), F.max("ended").alias("ended"), F.sum("rows").alias("rows"))


def continuity(df: DataFrame, key: str, number: str) -> DataFrame:
    """Per key: rows, distinct numbers, duplicates, and numbers missing between the least and the greatest."""
    out = df.groupBy(key).agg(
        F.count(F.lit(1)).alias("rows"), F.count_distinct(number).alias("numbers"), F.min(number).cast("long").alias("lo"), F.max(number).cast("long").alias("hi")
    )
    return out.select(key, "rows", "numbers", (F.col("rows") - F.col("numbers")).alias("duplicates"), (F.col("hi") - F.col("lo") + 1 - F.col("numbers")).alias("missing"))
