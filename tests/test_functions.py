"""Column functions: golden cases and properties."""

import datetime as dt

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidewatch.config import CLEAN_PATTERN
from tidewatch.functions import (absolute_link, clean_text, collapse_ws, format_period,
                                 join_paragraphs, parse_count, parse_local_time,
                                 parse_period_end, parse_period_start, parse_score, piecewise,
                                 severity, strip_suffix, weighted_sum)
from tidewatch.functions.scoring import alert_color, alert_label


def one(spark, rows, schema, expr):
    return [r[0] for r in spark.createDataFrame(rows, schema).select(expr).collect()]


def test_clean_text_golden(spark):
    assert one(spark, [('a!b 가나 漢é"/z',)], "s string", clean_text("s")) == ["ab 가나 z"]


def test_clean_text_equals_rule_on_every_code_point(spark):
    # one row per block of 2048 code points, surrogates excluded
    cps = [c for c in range(0x110000) if not 0xD800 <= c <= 0xDFFF]
    rows = [("".join(map(chr, cps[i:i + 2048])),) for i in range(0, len(cps), 2048)]
    df = spark.createDataFrame(rows, "s string")
    diff = df.filter(F.regexp_replace("s", CLEAN_PATTERN, "") != clean_text("s")).count()
    assert diff == 0


def test_parse_period(spark):
    p = "2024-01-02-03-04-05_2024-01-02-04-04-05"
    got = spark.createDataFrame([(p,)], "p string").select(
        parse_period_start("p"), parse_period_end("p"),
        format_period(parse_period_start("p"), parse_period_end("p"))).first()
    assert got[0] == dt.datetime(2024, 1, 2, 3, 4, 5)
    assert got[1] == dt.datetime(2024, 1, 2, 4, 4, 5)
    assert got[2] == p
    # the scheduler's 'YYYY-MM-DDTHH:MM' text is accepted, seconds added as 00
    t = spark.createDataFrame([("2024-01-02T03:04", "2024-01-02T04:04", "x")],
                              "a string, b string, c string")
    assert t.select(format_period("a", "b"), format_period("a", "c")).first() == \
        ("2024-01-02-03-04-00_2024-01-02-04-04-00", None)


def test_periods_ignore_session_zone(spark):
    """Periods are wall-clock arithmetic: a zone with a daylight-saving gap
    (02:00-03:00 missing on 2024-03-10 in New York) changes nothing."""
    from tidewatch.operators.periods import assign_period
    times = ["2024-03-10 01:30:00", "2024-03-10 02:30:00", "2024-03-10 03:10:00",
             "1969-12-31 23:10:00", None]
    got = {}
    for tz in ("UTC", "America/New_York"):
        spark.conf.set("spark.sql.session.timeZone", tz)
        try:
            df = spark.createDataFrame([(t,) for t in times], "s string").select(
                F.to_timestamp_ntz("s").alias("post_time"))
            rows = assign_period(df, "1 hour").select(
                "batch_period", parse_period_start("batch_period").alias("ps")).collect()
            got[tz] = [tuple(r) for r in rows]
        finally:
            spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert got["UTC"] == got["America/New_York"]
    assert got["UTC"][1] == ("2024-03-10-02-00-00_2024-03-10-03-00-00",
                             dt.datetime(2024, 3, 10, 2, 0))
    assert got["UTC"][4] == (None, None)   # a row without a time is kept


def test_parse_local_time(spark):
    rows = [("2024.02.03. 오후 01:05.",), ("2024.02.03. 오후 12:30.",), ("2024.2.3. 오전 12:10.",),
            ("2024.02.03. 13:05",), ("junk",), ("20240203 130500",), ("2024.02.03 13:05:07",)]
    got = one(spark, rows, "s string", parse_local_time("s"))
    d = dt.datetime
    assert got == [d(2024, 2, 3, 13, 5), d(2024, 2, 3, 12, 30), d(2024, 2, 3, 0, 10),
                   d(2024, 2, 3, 13, 5), None, d(2024, 2, 3, 13, 5), d(2024, 2, 3, 13, 5, 7)]


def test_parse_count(spark):
    got = one(spark, [("1,234",), ("-",), (None,), (" 12 ",)], "s string", parse_count("s"))
    assert got == [1234, 0, 0, 12]


def test_parse_score(spark):
    rows = [(" 85 ",), ("85점",), ("85.5",), ("+7",), ("",), (None,), ("1_0",)]
    assert one(spark, rows, "s string", parse_score("s")) == [85, 0, 0, 7, 0, 0, 0]
    assert one(spark, rows, "s string", parse_score("s", None)) == [85, None, None, 7, None,
                                                                     None, None]


def test_text_helpers(spark):
    df = spark.createDataFrame([("  a \t b\n\n c ", "/x", "body - dc official App")],
                               "t string, l string, b string")
    r = df.select(collapse_ws("t"), absolute_link("l", "https://h"),
                  strip_suffix("b", "- dc official App"),
                  join_paragraphs(F.array(F.lit(" p1 "), F.lit("\tp2")), "\n")).first()
    assert tuple(r) == ("a b c", "https://h/x", "body", "p1\np2")


def test_piecewise_golden(spark):
    got = one(spark, [(50.0,), (62.5,), (75.0,), (99.0,), (100.0,), (None,)], "x double",
              F.round(piecewise("x", 50, 75, 100), 6))
    assert got == [0.0, 0.25, 0.5, 0.98, 1.0, None]


def test_issue_score_worked_example(spark):
    from tidewatch.operators.issue import issue_score_col
    df = spark.createDataFrame([(40.0, 62.5, 15, 3, 7)], "news_score double, comm_score double, "
                               "news_acc_count long, news_count long, comm_count long")
    assert round(df.select(issue_score_col(df)).first()[0], 6) == 0.415


def test_two_severity_boundaries(spark):
    rows = [(0.3,), (0.6,)]
    assert one(spark, rows, "x double", severity("x")) == ["주의", "긴급"]
    assert one(spark, rows, "x double", alert_label("x")) == ["관심 🟡", "주의 🟠"]
    assert one(spark, rows, "x double", alert_color("x")) == ["#FFD700", "#FFA500"]


def test_weighted_sum(spark):
    df = spark.createDataFrame([(1.0, 2.0)], "a double, b double")
    assert df.select(weighted_sum({"a": 0.5, "b": 0.25})).first()[0] == 1.0


@settings(max_examples=15, deadline=None)
@given(st.lists(st.floats(-1e6, 1e6, allow_nan=False), min_size=2, max_size=30))
def test_piecewise_monotone_and_bounded(spark, xs):
    xs = sorted(xs)
    got = one(spark, [(x,) for x in xs], "x double", piecewise("x", 10, 20, 30))
    assert all(0.0 <= g <= 1.0 for g in got)
    assert all(a <= b + 1e-12 for a, b in zip(got, got[1:]))


def test_interval_micros():
    import pytest
    from tidewatch.operators.periods import interval_micros
    assert interval_micros("1 hour") == 3_600_000_000
    assert interval_micros("90 minutes") == interval_micros("1 hour 30 minutes") == 5_400_000_000
    assert interval_micros("1 day") == 24 * interval_micros("1 hour")
    for bad in ("", "hour", "1 fortnight", "0 hours"):
        with pytest.raises(ValueError):
            interval_micros(bad)
