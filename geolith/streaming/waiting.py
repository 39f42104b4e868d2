"""Waiting for inputs with a deadline: what does not come in time goes out with its fallback."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

#: Events: kind is ask (with the fallback as value) or input (with the input as value).
EVENTS = "tile STRING, kind STRING, value STRING, at TIMESTAMP"
SETTLED = "tile STRING, source STRING, value STRING"
#: State stores with timers are those of RocksDB.
STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class Waiting(StatefulProcessor):
    """Of each tile: the fallback and the deadline while it waits, the input while nobody asked, and whether it went out."""

    def __init__(self, patience_ms: int) -> None:
        self.patience_ms = patience_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("tile", "fallback STRING, input STRING, asked BOOLEAN, came BOOLEAN, done BOOLEAN")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        fallback, given, asked, came, done = self.state.get() if self.state.exists() else (None, None, False, False, False)
        for batch in rows:
            for row in batch.sort_values("at").itertuples():
                if done:
                    continue
                if row.kind == "ask" and not asked:
                    fallback, asked = row.value, True
                    if not came:
                        self.handle.registerTimer(int(row.at.timestamp() * 1000) + self.patience_ms)
                elif row.kind == "input" and not came:
                    given, came = row.value, True
        if asked and came and not done:
            done = True
            for timer in list(self.handle.listTimers()):
                self.handle.deleteTimer(timer)
            self.state.update((None, None, True, True, True))
            yield pd.DataFrame({"tile": [key[0]], "source": ["input"], "value": [given]})
        else:
            self.state.update((fallback, given, asked, came, done))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        fallback, _, _, _, done = self.state.get()
        self.state.update((None, None, True, True, True))
        if not done:
            yield pd.DataFrame({"tile": [key[0]], "source": ["fallback"], "value": [fallback]})

    def close(self) -> None:
        pass


def settled(events: DataFrame, patience_ms: int, delay: str = "0 seconds") -> DataFrame:
    """(tile, source, value) of each tile of a stream of EVENTS that was asked for, once: its input, before or after the asking, or its fallback once
    the watermark (the latest time less `delay`) has passed the asking by `patience_ms`. What comes later changes nothing; tiles that nobody asks for wait.
    """
    spark: SparkSession = events.sparkSession
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", STORE)
    return events.withWatermark("at", delay).groupBy("tile").transformWithStateInPandas(statefulProcessor=Waiting(patience_ms), outputStructType=SETTLED, outputMode="Append", timeMode="EventTime")
