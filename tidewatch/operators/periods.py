"""Batch periods: filters, assignment, completeness."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.time import format_period, ntz_micros, time_of_day


def _ts(v):
    return F.to_timestamp_ntz(F.lit(v)) if isinstance(v, str) else v


def in_period(df: DataFrame, start, end, col: str = "post_time",
              closed: str = "left") -> DataFrame:
    """Rows whose time lies in the period (B3). ``closed='left'`` is [start, end),
    ``'both'`` is [start, end] (a boundary row then belongs to two batches)."""
    t, s, e = F.col(col), _ts(start), _ts(end)
    return df.filter((t >= s) & ((t <= e) if closed == "both" else (t < e)))


def in_time_of_day(df: DataFrame, start: str, end: str, col: str = "post_time") -> DataFrame:
    """Rows whose HH:mm is in [start, end); an end of 00:00 means 23:59.

    Only the time of day is compared; the date is ignored."""
    e = "23:59" if end == "00:00" else end
    hm = time_of_day(col)
    return df.filter((hm >= F.lit(start)) & (hm < F.lit(e)))


# interval units accepted by assign_period, in microseconds
_UNIT_US = {"microsecond": 1, "millisecond": 1_000, "second": 1_000_000, "minute": 60_000_000,
            "hour": 3_600_000_000, "day": 86_400_000_000, "week": 604_800_000_000}
_EPOCH = "1970-01-01 00:00:00"


def interval_micros(every: str) -> int:
    """'1 hour', '90 minutes', '1 hour 30 minutes' -> length in microseconds."""
    parts = every.split()
    if not parts or len(parts) % 2:
        raise ValueError(f"not an interval: {every!r}")
    total = 0
    for n, unit in zip(parts[::2], parts[1::2]):
        u = unit.lower().rstrip("s")
        if u not in _UNIT_US:
            raise ValueError(f"unsupported interval unit: {unit!r}")
        total += int(n) * _UNIT_US[u]
    if total <= 0:
        raise ValueError(f"interval must be positive: {every!r}")
    return total


def assign_period(df: DataFrame, every: str = "1 hour", col: str = "post_time") -> DataFrame:
    """Add ``period_start``, ``period_end`` and ``batch_period`` for each row.

    Tumbling periods aligned to the epoch, computed as plain arithmetic on the
    wall clock (no zone). A row without a time keeps NULL periods; no row is
    dropped."""
    step = interval_micros(every)
    epoch = F.to_timestamp_ntz(F.lit(_EPOCH))
    us = ntz_micros(F.col(col))
    start = F.timestamp_add("MICROSECOND", us - F.pmod(us, F.lit(step)), epoch)
    return (df.withColumn("period_start", start)
              .withColumn("period_end", F.timestamp_add("MICROSECOND", F.lit(step),
                                                        F.col("period_start")))
              .withColumn("batch_period", format_period("period_start", "period_end")))


def missing_sources(expected: DataFrame, arrived: DataFrame, on=("source",)) -> DataFrame:
    """Expected keys that have no arrival marker (B6). The batch is ready when empty."""
    return expected.join(arrived.select(*on).distinct(), list(on), "left_anti")


def expected_markers(periods: DataFrame, sources: list[str]) -> DataFrame:
    """Every batch period x every configured source (a literal-array generator)."""
    return periods.select("batch_period").distinct().withColumn(
        "source", F.explode(F.array(*[F.lit(s) for s in sources])))


MARKER_JSON = "source string, start_time string, end_time string, status string"


def period_from_marker(markers: DataFrame, col: str = "marker") -> DataFrame:
    """Marker JSON {source, start_time, end_time} -> ``batch_period``."""
    m = F.from_json(F.col(col), MARKER_JSON)
    return markers.select("*", m["source"].alias("marker_source"),
                          F.concat_ws("_", m["start_time"], m["end_time"]).alias("batch_period"))


def arrived_markers(lines: DataFrame) -> DataFrame:
    """Marker lines (``value``, a JSON text each) -> (batch_period, source) of the arrivals
    that succeeded (B7). Lines that are no such marker are left out."""
    m = period_from_marker(lines.select(F.col("value").alias("marker")))
    ok = ((F.get_json_object("marker", "$.status") == "success") & F.col("marker_source").isNotNull()
          & F.col("batch_period").rlike(r"^[0-9-]{19}_[0-9-]{19}$"))
    return m.filter(ok).select("batch_period", F.col("marker_source").alias("source"))


def ready_periods(arrived: DataFrame, sources: list[str]) -> DataFrame:
    """The batch periods of ``arrived`` (batch_period, source) that lack no source."""
    lacking = missing_sources(expected_markers(arrived, sources), arrived, on=("batch_period", "source"))
    return arrived.select("batch_period").distinct().join(lacking, "batch_period", "left_anti")


def sort_by_time(df: DataFrame, col: str = "post_time", tie: str | None = None) -> DataFrame:
    """Ascending sort by time (B8): a range-partitioned global sort.

    Rows with equal times are ordered by ``tie`` (``link`` when present, else a
    hash of the row). Besides making the order deterministic, this lets the
    range partitioner split a time shared by a large share of the rows over
    several tasks; equal sort keys would all land in one."""
    if tie is None:
        tie_col = F.col("link") if "link" in df.columns else F.xxhash64(*df.columns)
    else:
        tie_col = F.col(tie)
    return df.orderBy(F.col(col).asc(), tie_col.asc())
