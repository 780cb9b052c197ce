"""Groups of a stream released when they are complete, with expected sizes from a manifest and state that expires."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def keep_state_on_disk(spark: SparkSession) -> None:
    """State goes to a store on disk with changes in the checkpoint, as timers and several states a key need; set it before the query starts."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", PROVIDER)


class Release(StatefulProcessor):
    """A key's items until there are as many as expected; then a mark that it is done, until that expires too."""

    def __init__(self, must: bool):
        self.must = must

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.held = handle.getListState("held", "item string")
        self.known = handle.getValueState("known", "n long, expected long, done boolean")

    def _timer(self, at: int) -> None:
        for old in self.handle.listTimers():
            self.handle.deleteTimer(old)
        self.handle.registerTimer(at)

    def _row(self, key: tuple, items: list[str], status: str) -> pd.DataFrame:
        return pd.DataFrame({"key": [str(key[0])], "items": [items], "status": [status]})

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        n, expected, done = self.known.get() if self.known.exists() else (0, None, False)
        new, latest = [], 0
        for frame in rows:
            frame = frame.sort_values(["at", "item"], kind="stable")
            new += frame["item"].astype(str).tolist()
            latest = max(latest, int(frame["at"].max().timestamp() * 1000))
            said = frame["expected"].dropna()
            expected = int(said.iloc[0]) if len(said) else expected
        if done:
            yield self._row(key, new, "late")
        elif expected is not None and n + len(new) >= expected:
            items = [r[0] for r in self.held.get()] + new
            self.held.clear()
            self.known.update((n + len(new), expected, True))
            yield self._row(key, items[:expected], "complete")
            if items[expected:]:
                yield self._row(key, items[expected:], "late")
        else:
            self.held.appendList([(x,) for x in new])
            self.known.update((n + len(new), expected, False))
        self._timer(latest + 1)  # fires once the watermark, which is `wait` behind, has passed it

    def handleExpiredTimer(self, key: tuple, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        n, expected, done = self.known.get() if self.known.exists() else (0, None, True)
        if not done:
            if self.must:
                raise ValueError(f"group {key[0]} is incomplete: {n} of {expected}")
            yield self._row(key, [r[0] for r in self.held.get()], "incomplete")
        self.held.clear()
        self.known.clear()

    def close(self) -> None:
        pass


def released(rows: DataFrame, manifest: DataFrame, wait: str = "10 minutes", must: bool = False) -> DataFrame:
    """key, items, status of a stream of rows (key, item, at): each group as soon as it has as many items as the manifest (key, expected) says.

    status: complete; late (items behind the expected number, or after release); incomplete (what a group holds
    once `wait` of event time has gone by since its last item: the last flush; an error if groups `must` be
    complete).  A group's state leaves at its release but for a mark, and the mark `wait` after its last item.
    Keys that aren't in the manifest wait for their flush.  The manifest is read anew for each batch.  Items that come
    more than `wait` of event time behind the latest of all are beyond Spark's watermark, and dropped by it.
    """
    sized = rows.withWatermark("at", wait).join(manifest.select("key", F.col("expected").cast("long")), "key", "left")
    typed = sized.select(F.col("key").cast("string"), F.col("item").cast("string"), "at", "expected")
    return typed.groupBy("key").transformWithStateInPandas(Release(must), "key string, items array<string>, status string", "Append", "EventTime")
