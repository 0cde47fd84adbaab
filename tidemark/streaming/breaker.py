"""Streaming forms of the stateful operators."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout


def breaker(events: DataFrame, threshold: int = 3) -> DataFrame:
    """The event at which each user's breaker trips, once: state is the run of failures and whether it has tripped.

    events: user_id, event_id, ts, failed. Events of one batch are taken in order of ts and event_id.
    """

    def run(key, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        run, tripped = state.get if state.exists else (0, False)
        rows = pd.concat(list(batches)).sort_values(["ts", "event_id"])
        for event, at, failed in zip(rows["event_id"], rows["ts"], rows["failed"]):
            run = run + 1 if failed else 0
            if run >= threshold and not tripped:
                tripped = True
                yield pd.DataFrame({"user_id": [key[0]], "event_id": [event], "ts": [at], "run": [run]})
        state.update((run, tripped))

    return events.groupBy("user_id").applyInPandasWithState(
        run, "user_id long, event_id long, ts timestamp, run long", "run long, tripped boolean", "append", GroupStateTimeout.NoTimeout
    )


def new_keys(rows: DataFrame, keys: list[str], time: str, late: str = "10 days") -> DataFrame:
    """Insert-or-ignore for a stream: the first row of each key, remembered while it can still be repeated."""
    return rows.withWatermark(time, late).dropDuplicatesWithinWatermark(keys)


def weekly_counts(events: DataFrame, time: str, by: list[str], late: str = "7 days") -> DataFrame:
    """Counts by week from Monday on, closed when the watermark has passed."""
    week = F.window(time, "7 days", "7 days", "4 days")
    return events.withWatermark(time, late).groupBy(week, *by).agg(F.count(F.lit(1)).alias("n"))


def stop_when_known(pages: DataFrame, quiet: int = 2) -> DataFrame:
    """Pages (scope, page, key) of which each is read until ``quiet`` pages in a row have brought no new key."""

    def run(scope, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        known, still = (set(state.get[0]), state.get[1]) if state.exists else (set(), 0)
        rows = pd.concat(list(batches))
        for page, keys in rows.groupby("page")["key"]:
            if still >= quiet:
                break
            fresh = set(keys) - known
            known |= fresh
            still = 0 if fresh else still + 1
            yield pd.DataFrame({"scope": [scope[0]], "page": [page], "new_keys": [len(fresh)]})
        state.update((sorted(known), still))

    return pages.groupBy("scope").applyInPandasWithState(
        run, "scope string, page long, new_keys long", "known array<string>, still int", "append", GroupStateTimeout.NoTimeout
    )
