"""Time column functions: batch periods and crawled local times.

All timestamps are TIMESTAMP_NTZ (wall clock, no zone)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..config import AM_MARKER, PERIOD_SEP, PM_MARKER

# Formats tried in order by parse_local_time, after the Korean AM/PM markers are
# replaced by AM/PM: a 12-hour form with marker, then 24-hour forms of the sources.
LOCAL_TIME_FORMATS = (
    "yyyy.M.d. a h:mm.",
    "yyyy.M.d. H:mm",
    "yyyy.M.d H:mm:ss",
    "yyyy.M.d H:mm",
    "yyyyMMdd HHmmss",
    "yyyy-M-d H:mm",
)


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def to_ntz(c) -> Column:
    """Cast to TIMESTAMP_NTZ (``date_trunc``/``window`` hand back zoned types)."""
    return _c(c).cast("timestamp_ntz")


def _parse(s: Column, fmt: str) -> Column:
    return F.try_to_timestamp(s, F.lit(fmt)).cast("timestamp_ntz")


def _period_part(c, i: int) -> Column:
    """Part ``i`` of a period string as NTZ: 'yyyy-MM-dd-HH-mm-ss' is rewritten
    as 'yyyy-MM-dd HH:mm:ss' and cast, so no session zone is involved; a part
    that is not in that form is NULL."""
    s = F.split_part(_c(c), F.lit(PERIOD_SEP), F.lit(i))
    ok = s.rlike(r"^\d{4}-\d{2}-\d{2}-\d{2}-\d{2}-\d{2}$")
    text = F.concat(F.substring(s, 1, 10), F.lit(" "), F.translate(F.substring(s, 12, 8), "-", ":"))
    return F.when(ok, text.try_cast("timestamp_ntz"))


def parse_period_start(c) -> Column:
    """Start of a ``start_end`` period string (B1)."""
    return _period_part(c, 1)


def parse_period_end(c) -> Column:
    """End of a ``start_end`` period string (B1)."""
    return _period_part(c, 2)


def _ntz_text(c) -> Column:
    """NTZ -> 'yyyy-MM-dd-HH-mm-ss' from its own fields (no zone involved). Text
    such as 'YYYY-MM-DDTHH:MM' is read as a wall-clock time (seconds become 00);
    text that is not a time gives NULL."""
    return F.translate(F.substring(_c(c).try_cast("timestamp_ntz").cast("string"), 1, 19),
                       " :", "--")


def format_period(start, end) -> Column:
    """Two timestamps -> ``start_end`` period string (B2); NULL if either is."""
    return F.concat(_ntz_text(start), F.lit(PERIOD_SEP), _ntz_text(end))


def month(period):
    """The month of a period string, as text: of a ``str`` or of a Column."""
    return period[:7] if isinstance(period, str) else F.substring(period, 1, 7)


def texts(values) -> Column:
    """Any number of texts without a line break as one array: a single literal in the plan."""
    return F.split(F.lit("\n".join(sorted(values))), "\n")


def ntz_micros(c) -> Column:
    """Microseconds from 1970-01-01 00:00:00 of an NTZ wall-clock time, from its
    fields, so no session zone (and no daylight-saving gap) is involved."""
    t = _c(c)
    days = F.datediff(F.to_date(t), F.to_date(F.lit("1970-01-01")))
    secs = F.hour(t) * 3600 + F.minute(t) * 60
    return (days.cast("bigint") * 86_400_000_000 + secs.cast("bigint") * 1_000_000
            + (F.date_part(F.lit("SECOND"), t) * 1_000_000).cast("bigint"))


def parse_local_time(c) -> Column:
    """Crawled date text in any of the sources' formats -> NTZ; junk -> NULL."""
    s = F.trim(F.replace(F.replace(_c(c), F.lit(AM_MARKER), F.lit("AM")),
                         F.lit(PM_MARKER), F.lit("PM")))
    return F.coalesce(*[_parse(s, f) for f in LOCAL_TIME_FORMATS])


def time_of_day(c) -> Column:
    """``HH:mm`` text of a timestamp, for time-of-day comparisons."""
    return F.date_format(_c(c), "HH:mm")
