"""The arrival gate: a batch is ready when all its sources have arrived (B6, B7 as a stream).

Every source writes a marker when its part of a batch is there. The stream keeps, for each
batch period, the set of sources whose marker has arrived, in a state store, so a restart
goes on where it was. A period is reported ``complete`` once, when no required source is
missing any more; markers that come again change nothing. While sources are missing a timer
runs from each marker on; a period that hears nothing for ``patience`` is reported
``incomplete`` with the sources it lacks, and may still be completed later.

Event time is the time at which a marker is read, so a marker of an old period is never
late and never dropped. A timer fires when the stream has moved past it, at the end of a
run of ``availableNow`` at the latest if ``patience`` is over by then.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ..operators.periods import arrived_markers, interval_micros

STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
EVENT = "batch_period string, status string, missing string"


def arrivals(spark: SparkSession, marker_base: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Markers as they arrive: files under ``marker_base`` with one JSON marker per line ->
    (batch_period, source). Lines that are no marker of a successful arrival are left out."""
    reader = spark.readStream
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return arrived_markers(reader.text(marker_base))


class ArrivalGate(StatefulProcessor):
    """The sources that have arrived, per batch period."""

    def __init__(self, required: list[str], patience_ms: int):
        self.required, self.patience_ms = sorted(set(required)), patience_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.arrived = handle.getMapState("arrived", "source string", "seen boolean")
        self.done = handle.getValueState("done", "done boolean")

    def _missing(self) -> list[str]:
        return [s for s in self.required if not self.arrived.containsKey((s,))]

    @staticmethod
    def _event(key, status: str, missing: list[str]) -> pd.DataFrame:
        return pd.DataFrame({"batch_period": [key[0]], "status": [status], "missing": [",".join(missing)]})

    def handleInputRows(self, key, rows, timerValues):
        latest = 0
        for pdf in rows:
            for source in pdf["source"].unique():
                self.arrived.updateValue((source,), (True,))
            latest = max(latest, int(pdf["arrived_at"].max().timestamp() * 1000))
        if self.done.exists():
            return
        for timer in list(self.handle.listTimers()):
            self.handle.deleteTimer(timer)
        missing = self._missing()
        if missing:
            self.handle.registerTimer(latest + self.patience_ms)
        else:
            self.done.update((True,))
            yield self._event(key, "complete", [])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        if not self.done.exists():
            yield self._event(key, "incomplete", self._missing())

    def close(self) -> None:
        pass


def gate(markers: DataFrame, required: list[str], patience: str = "1 hour") -> DataFrame:
    """A stream of (batch_period, source) -> (batch_period, status, missing)."""
    seen = markers.withColumn("arrived_at", F.current_timestamp()).withWatermark("arrived_at", "0 seconds")
    processor = ArrivalGate(required, interval_micros(patience) // 1000)
    return seen.groupBy("batch_period").transformWithStateInPandas(processor, EVENT, "Append", "EventTime")
