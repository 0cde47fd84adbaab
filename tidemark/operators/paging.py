"""Pages of lists: their addresses by kind of pagination, and how far a list of stored pages is read."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Kinds of pagination (fixed values): the address of page n of a list, or rounds on one page that has no addresses of its own.
KINDS = ("none", "url_page", "query_param", "click_more", "js_snippet", "bv_api")
#: What ends a list, in the order in which it is looked at (fixed values).
STOPS = ("empty_page", "page_all_known", "max_reviews", "exhausted", "max_pages")


def page_addresses(lists: DataFrame, url: str, kind: str, total: str, page_size: int, max_pages: int, param: str = "start", most: int | None = None) -> DataFrame:
    """Each list with a row for each of its pages: page (from 1), start (rows before it) and address.

    ``kind`` and ``total`` are columns; a list has as many pages as its total asks for, one at least and at most
    ``max_pages``; a null total is one page. Of an API of reviews no more than ``most`` rows are asked for. An address
    that has a query already gets its parameter behind it. An unknown kind, or null, gives no page.
    """
    rows = F.coalesce(F.col(total), F.lit(0))
    if most is not None:
        rows = F.when(F.col(kind) == "bv_api", F.least(rows, F.lit(most))).otherwise(rows)
    pages = F.when(F.col(kind) == "none", 1).otherwise(F.least(F.greatest(F.ceil(rows / F.lit(page_size)), F.lit(1)), F.lit(max_pages)))
    steps = lists.filter(F.col(kind).isin(*KINDS)).withColumn("page", F.explode(F.sequence(F.lit(1).cast("long"), pages.cast("long"))))
    start = (F.col("page") - 1) * F.lit(page_size)
    own, joint = F.col(url), F.when(F.contains(F.col(url), F.lit("?")), "&").otherwise("?")
    address = (
        F.when(F.col(kind) == "url_page", F.concat(F.regexp_replace(own, "/$", ""), F.lit("/page/"), F.col("page").cast("string")))
        .when(F.col(kind) == "query_param", F.concat(own, joint, F.lit(f"{param}="), start.cast("string")))
        .when(F.col(kind) == "bv_api", F.concat(own, joint, F.lit("offset="), start.cast("string"), F.lit(f"&limit={page_size}")))
        .otherwise(own)
    )
    return steps.withColumns({"start": start, "address": address})


def read_pages(pages: DataFrame, scope: str, page: str, keys: str, total: str, page_size: int, max_pages: int, max_rows: int) -> DataFrame:
    """The stored pages of each scope that are read: scope, page, new_keys, taken and stop, which the last one has.

    pages: a row for each scope and page (from 0), with the array of its keys and the total that the list states.
    Pages are read in order until one is empty, brings no new key, fills ``max_rows`` new ones, is the last by the
    total, or the last allowed; several reasons give the first of STOPS. ``taken`` are the new keys up to
    ``max_rows``. A scope whose stored pages end before any of that has no stop. Null keys are not counted; a null
    array is an empty page, a null total never exhausts, a null scope is a scope. Pages beyond the allowed ones are
    not looked at, so a scope has at most ``max_pages`` rows in a window, and a key is new where it first stands.
    """
    allowed = pages.filter(F.col(page) < max_pages).select(F.col(scope).alias("scope"), F.col(page).alias("page"), F.col(total).alias("_total"), F.filter(F.coalesce(F.col(keys), F.array()), lambda k: k.isNotNull()).alias("_keys"))
    first = allowed.select("scope", "page", F.explode("_keys").alias("_key")).groupBy("scope", "_key").agg(F.min("page").alias("_at"))
    fresh = first.groupBy(F.col("scope").alias("_s"), "_at").agg(F.count(F.lit(1)).alias("_new"))
    own = allowed.withColumn("_n", F.size("_keys")).drop("_keys")
    both = own.join(fresh, F.col("scope").eqNullSafe(F.col("_s")) & (F.col("page") == F.col("_at")), "left").withColumn("new_keys", F.coalesce("_new", F.lit(0)))
    order = Window.partitionBy("scope").orderBy("page")
    seen = F.sum("new_keys").over(order.rowsBetween(Window.unboundedPreceding, 0))
    ends: list[Column] = [
        F.col("_n") == 0, F.col("new_keys") == 0, F.col("_seen") >= max_rows, (F.col("page") + 1) * page_size >= F.col("_total"), F.col("page") + 1 >= max_pages,
    ]
    stop = F.coalesce(*[F.when(end, F.lit(name)) for end, name in zip(ends, STOPS)])
    marked = both.withColumn("_seen", seen).withColumn("stop", stop)
    over = F.count("stop").over(order.rowsBetween(Window.unboundedPreceding, -1))
    taken = F.greatest(F.least(F.col("new_keys"), F.lit(max_rows) - (F.col("_seen") - F.col("new_keys"))), F.lit(0))
    return marked.withColumn("_over", over).filter("_over = 0").select("scope", "page", "new_keys", taken.alias("taken"), "stop")
