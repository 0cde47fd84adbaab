"""Breakers and stop rules on keyed state: what a batch writes grows with the batch, not with what is known.

State lies in RocksDB as single values and as a map by key, with only the changes written at each batch. Of the rows that
a key has in one batch, a task holds four narrow columns, to take them in order; ``maxFilesPerTrigger`` or
``maxBytesPerTrigger`` of the source bounds them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from tidemark.operators.runs import COUNTERS, THRESHOLDS

PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def keyed_state(spark: SparkSession) -> None:
    """Settings that these operators need before a stream starts."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", PROVIDER)
    spark.conf.set("spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled", "true")


class Circuits(StatefulProcessor):
    """Each counter of a (key, stage) is one value: its run of failures; one more says that the stage has stopped."""

    def __init__(self, limits: dict[str, int], expiry_ms: int | None) -> None:
        self.limits, self.expiry_ms = limits, expiry_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.run = {c[0]: handle.getValueState(f"run_{c[0]}", "run long", self.expiry_ms) for c in COUNTERS}
        self.stopped = handle.getValueState("stopped", "stopped boolean", self.expiry_ms)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        site, stage = key
        held = [(r["seq"].to_numpy(), r["status"].to_numpy(dtype=object)) for r in rows]
        if self.stopped.exists():
            return
        mine = [c for c in COUNTERS if c[1] == stage]
        count = {c[0]: self.run[c[0]].get()[0] if self.run[c[0]].exists() else 0 for c in mine}
        seq, status = (np.concatenate(x) for x in zip(*held))
        for i in np.argsort(seq, kind="stable"):
            for counter, _, counts, unseen, kind in mine:
                if status[i] in unseen:
                    continue
                count[counter] = count[counter] + 1 if status[i] in counts else 0
                if count[counter] == self.limits[counter]:
                    self.stopped.update((True,))
                    yield pd.DataFrame({"site": [site], "stage": [stage], "seq": [seq[i]], "kind": [kind], "counter": [counter], "run": [count[counter]]})
                    return
        for counter, run in count.items():
            self.run[counter].update((run,))

    def close(self) -> None:
        pass


def circuits(visits: DataFrame, thresholds: dict[str, int] | None = None, expiry_ms: int | None = None) -> DataFrame:
    """The error row of each site and stage that one of its breakers stops: seq of the last visit, kind, counter and run.

    visits: site, stage, seq (a number that grows), status. A null status is no failure and resets. A site's stage is
    stopped once; with ``expiry_ms`` what is known of it is forgotten that long after its last change, and it starts anew.
    """
    keyed_state(visits.sparkSession)
    rows = visits.select(F.col("site").cast("long"), "stage", F.col("seq").cast("long"), F.coalesce("status", F.lit("")).alias("status"))
    return rows.groupBy("site", "stage").transformWithStateInPandas(
        statefulProcessor=Circuits(THRESHOLDS | (thresholds or {}), expiry_ms), outputStructType="site long, stage string, seq long, kind string, counter string, run long",
        outputMode="Append", timeMode="ProcessingTime" if expiry_ms else "None",
    )


class KnownPages(StatefulProcessor):
    """Known keys as a map, looked up and written one by one; how long nothing was new as a value."""

    def __init__(self, quiet: int) -> None:
        self.quiet = quiet

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.known = handle.getMapState("known", "key string", "page long")
        self.still = handle.getValueState("still", "pages long")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        (scope,) = key
        pages: dict[int, set[str]] = {}
        for part in rows:
            for page, own in part.groupby("page")["key"]:
                pages.setdefault(int(page), set()).update(own)
        still = self.still.get()[0] if self.still.exists() else 0
        for page in sorted(pages):
            if still >= self.quiet:
                break
            fresh = [k for k in pages[page] if not self.known.containsKey((k,))]
            for k in fresh:
                self.known.updateValue((k,), (page,))
            still = 0 if fresh else still + 1
            yield pd.DataFrame({"scope": [scope], "page": [page], "new_keys": [len(fresh)]})
        self.still.update((still,))

    def close(self) -> None:
        pass


def known_pages(pages: DataFrame, quiet: int = 2) -> DataFrame:
    """Pages (scope, page, key) of which each is read until ``quiet`` pages in a row have brought no new key: R2 is quiet = 1.

    A page is judged in the batch that brings it; its rows belong in one batch. A null key is one key.
    """
    keyed_state(pages.sparkSession)
    rows = pages.select(F.col("scope").cast("string"), F.col("page").cast("long"), F.coalesce(F.col("key").cast("string"), F.lit("")).alias("key"))
    return rows.groupBy("scope").transformWithStateInPandas(
        statefulProcessor=KnownPages(quiet), outputStructType="scope string, page long, new_keys long", outputMode="Append", timeMode="None"
    )
