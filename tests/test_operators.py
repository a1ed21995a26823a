"""Operators: golden cases from FIXTURES.md and semantic edge cases."""

import datetime as dt
import json

from pyspark.sql import functions as F

from tidewatch.operators import aggregate as agg
from tidewatch.operators import issue, periods, state, tagging
from tidewatch.operators.alerts import alertable, render_alert
from tidewatch.schemas import NEWS_AGG, STATE
from tidewatch.sources import io, pages

D = dt.datetime


def test_tag_flat_dedupes_and_null_title_is_harmless(spark):
    df = spark.createDataFrame([(None, "has k1 only")], "title string, content string")
    t = tagging.tag_flat(df, ["k1", "k2", "k1"])
    assert t.first()["accident"] == ["k1", None]
    assert tagging.explode_tags(t).count() == 1


def test_tag_mapped_one_row_per_category(spark):
    df = spark.createDataFrame([("a k1 b", "k1 k2")], "title string, content string")
    t = tagging.explode_tags(tagging.tag_mapped(df, {"cat": ["k1", "k2"], "other": ["zz"]}))
    assert [r["accident"] for r in t.collect()] == ["cat"]


def test_tag_mapped_empty_map(spark):
    df = spark.createDataFrame([("a", "b")], "title string, content string")
    t = tagging.tag_mapped(df, {})
    assert t.schema["accident"].dataType.simpleString() == "array<string>"
    assert tagging.explode_tags(t).count() == 0


def test_expand_to_entities_broadcast_and_salted_agree(spark):
    posts = spark.createDataFrame([("p1", "fire"), ("p2", "fire"), ("p3", "rain")],
                                  "link string, accident string")
    issues = spark.createDataFrame([("M1", "fire"), ("M2", "fire")], "car_model string, accident string")
    a = tagging.expand_to_entities(posts, issues)
    b = tagging.expand_to_entities(posts, issues, max_broadcast_rows=0, salt_buckets=4)
    rows = sorted(tuple(r) for r in a.select("link", "car_model").collect())
    assert rows == [("p1", "M1"), ("p1", "M2"), ("p2", "M1"), ("p2", "M2"), ("p3", None)]
    assert sorted(tuple(r) for r in b.select("link", "car_model").collect()) == rows


def test_aggregate_posts_bands(spark):
    df = spark.createDataFrame([("M", "x", s) for s in (45, 46, 54, 55)],
                               "car_model string, accident string, comm_score int")
    r = agg.aggregate_posts(df).first()
    assert (r["comm_positive_count"], r["comm_negative_count"], r["count"],
            r["avg_comm_score"]) == (1, 1, 4, 50.0)


def test_top_k_ties_broken_by_link(spark):
    rows = [("M", "x", v, f"l{i}", f"c{i}") for i, v in enumerate([5, 9, 9, 9, 1, 9, 3])]
    df = spark.createDataFrame(rows, "car_model string, accident string, view_count long, "
                                     "link string, content string")
    top = agg.top_k_posts(df, 5).orderBy("rank").collect()
    assert [r["link"] for r in top] == ["l1", "l2", "l3", "l5", "l0"]
    packed = json.loads(agg.pack_posts(agg.top_k_posts(df, 5)).first()["top_comm"])
    assert [p["link"] for p in packed] == ["l1", "l2", "l3", "l5", "l0"]


def test_pack_drops_null_field(spark):
    df = spark.createDataFrame([("M", "x", 1, "l", None)], "car_model string, accident string, "
                               "view_count long, link string, content string")
    assert agg.pack_posts(agg.top_k_posts(df)).first()["top_comm"] == '[{"link":"l"}]'


def _state(spark, rows):
    full = []
    for r in rows:
        base = dict(car_model=None, accident=None, start_batch_time=None, last_batch_time=None,
                    news_acc_count=0, comm_acc_count=0, news_score=0.0, comm_score=0.0,
                    issue_score=0.0, is_issue=False, is_alert=False, dashboard_url="u")
        base.update(r)
        full.append(tuple(base[f] for f in STATE.fieldNames()))
    return spark.createDataFrame(full, STATE)


PERIOD = "2024-01-02-00-00-00_2024-01-02-01-00-00"


def test_fold_news_start_only_on_first(spark):
    s = _state(spark, [dict(car_model="A", accident="x"),
                       dict(car_model="A", accident="y", news_acc_count=4,
                            start_batch_time=D(2024, 1, 1))])
    news = spark.createDataFrame([("A", "x", 3, 50.0), ("A", "y", 2, 70.0), ("Z", "q", 9, 1.0)],
                                 NEWS_AGG)
    out = {(r.car_model, r.accident): r for r in state.fold_news(s, news, PERIOD).collect()}
    assert len(out) == 2
    assert (out["A", "x"].news_acc_count, out["A", "x"].start_batch_time) == (3, D(2024, 1, 2))
    assert (out["A", "y"].news_acc_count, out["A", "y"].start_batch_time) == (6, D(2024, 1, 1))
    assert out["A", "y"].last_batch_time == D(2024, 1, 2, 1) and out["A", "y"].news_score == 70.0


def test_open_issues_threshold(spark):
    s = _state(spark, [dict(car_model="A", accident=str(n), news_acc_count=n) for n in (9, 10, 11)])
    got = {r.accident: (r.is_issue, r.is_alert) for r in state.open_issues(s, 10).collect()}
    assert got == {"9": (False, False), "10": (True, True), "11": (True, True)}


def test_expire_issues_boundary(spark):
    now = "2024-01-01-00-00-00_2024-01-02-00-00-00"
    s = _state(spark, [dict(car_model="A", accident="kept", last_batch_time=D(2024, 1, 1),
                            news_acc_count=5, is_issue=True),
                       dict(car_model="A", accident="reset",
                            last_batch_time=D(2023, 12, 31, 23, 59, 59), news_acc_count=5,
                            is_issue=True)])
    got = {r.accident: (r.news_acc_count, r.is_issue) for r in
           state.expire_issues(s, now).collect()}
    assert got == {"kept": (5, True), "reset": (0, False)}


def test_alert_on_change(spark):
    s = _state(spark, [dict(car_model="A", accident="a", issue_score=0.29, is_issue=True),
                       dict(car_model="A", accident="b", issue_score=0.31, is_issue=True),
                       dict(car_model="A", accident="c", issue_score=0.5, is_issue=True,
                            is_alert=True)])
    scored = spark.createDataFrame([("A", "a", 0.31), ("A", "b", 0.59), ("A", "c", 0.5)],
                                   "car_model string, accident string, new_issue_score double")
    got = {r.accident: r.is_alert for r in issue.alert_on_change(s, scored).collect()}
    assert got == {"a": True, "b": False, "c": True}


def test_to_fact_needs_top_posts(spark):
    v = spark.createDataFrame(
        [("A", "x", 0.5, 1, 2, D(2024, 1, 1), None, 0, 0), ("A", "y", 0.5, 1, 2, D(2024, 1, 1),
                                                             "[]", 0, 0)],
        "car_model string, accident string, issue_score double, comm_count long, "
        "news_count long, start_batch_time timestamp_ntz, top_comm string, "
        "comm_positive_count long, comm_negative_count long")
    f = issue.to_fact(v, PERIOD).collect()
    assert [r.accident for r in f] == ["y"] and f[0].batch_time == D(2024, 1, 2, 1)


def test_alert_payload(spark):
    s = _state(spark, [dict(car_model="M1", accident="fire", issue_score=0.3, is_alert=True,
                            start_batch_time=D(2024, 1, 2, 3, 4, 5))])
    r = render_alert(alertable(s)).first()
    p = json.loads(r.payload)
    assert p["text"] == "\U0001F6A8 M1 fire (관심 🟡)\n\u200b"
    f = p["attachments"][0]["fields"]
    assert p["attachments"][0]["color"] == "#FFD700"
    assert [x["value"] for x in f] == ["관심 🟡", "M1 fire", "2024-01-02T03:04:05", "u"]
    assert all(x["short"] is False for x in f)


def test_missing_sources_and_periods(spark):
    exp = spark.createDataFrame([("a",), ("b",)], "source string")
    arr = spark.createDataFrame([("a",)], "source string")
    assert [r.source for r in periods.missing_sources(exp, arr).collect()] == ["b"]
    df = spark.createDataFrame([(D(2024, 1, 1, 11),)], "post_time timestamp_ntz")
    s, e = "2024-01-01 10:00:00", "2024-01-01 11:00:00"
    assert periods.in_period(df, s, e).count() == 0
    assert periods.in_period(df, s, e, closed="both").count() == 1


def test_explode_search(spark):
    ok = 'Search.SearchPreCallback({"KR_ARTICLE":{"result":[{"TITLE":"a"},{"TITLE":"b"}]}})'
    df = spark.createDataFrame([(ok,), ("bad",)], "response string")
    hits = pages.explode_search(df, "KR_ARTICLE struct<result: array<struct<TITLE: string>>>",
                                ["KR_ARTICLE", "result"])
    assert sorted(r.hit.TITLE for r in hits.collect()) == ["a", "b"]


def test_empty_inputs(spark, tmp_dir):
    raw = io.read_raw(spark, "news", tmp_dir, PERIOD)
    assert raw.count() == 0 and raw.schema.fieldNames()[0] == "post_time"
    assert io.issues_from_list(spark, []).count() == 0
    assert io.keywords_from_map(spark, {}).count() == 0
    assert io.read_state(spark, tmp_dir + "/none").count() == 0


def test_tagging_many_keywords_against_brute_force(spark):
    from tidewatch.sources import standins
    docs = standins.raw_posts(standins.table(spark, "/root/testdata/sf0.001", "documents"))
    words = [w for r in standins.table(spark, "/root/testdata/sf0.001", "benchmark").collect() for w in r.text.split()]
    kws = list(dict.fromkeys(words))[:700]
    mapping = {"even": kws[::2], "odd": kws[1::2], "dup": ["die", "die"]}
    rows = {r.link: (r.title or "", r.content or "") for r in docs.collect()}
    flat = {r.link: r.accident for r in tagging.tag_flat(docs, kws).select("link", "accident").collect()}
    assert flat == {k: [w if w in t or w in c else None for w in kws] for k, (t, c) in rows.items()}
    as_rows = spark.createDataFrame([(c, k) for c, ks in mapping.items() for k in ks], "accident string, keyword string")
    for m in (mapping, tagging.selected_pairs(as_rows)):
        got = {r.link: set(r.accident) - {None} for r in tagging.tag_mapped(docs, m).select("link", "accident").collect()}
        assert got == {k: {n for n, ks in mapping.items() if any(w in t or w in c for w in ks)}
                       for k, (t, c) in rows.items()}
    df = spark.createDataFrame([("ushers", None), (None, None)], "title string, content string")
    got = [r.accident for r in tagging.tag_mapped(df, {"x": ["she"], "y": ["he"], "z": ["q"]}).collect()]
    assert got == [["x", "y", None], [None]]


def test_link_forms(spark):
    html = """<a href='/1'>x</a> <A class=k HREF="/2">y</A> <a href=/3>z</a> <a href="//h/4">w</a>
      <li><a href="/5">p</a></li><li><a href='/6'>q</a><i>10:00</i></li>"""
    pages_df = spark.createDataFrame([(1, html)], "page_id bigint, html string")
    from tidewatch.sources import pages
    got = [r.link for r in pages.extract_links(pages_df, base="http://b").orderBy("pos").collect()]
    assert got == ["http://b/1", "http://b/2", "http://b/3", "//h/4", "http://b/5", "http://b/6"]
    got = pages.extract_links(pages_df, time_pattern="<i>(.*?)</i>", row_pattern="<li>.*?</li>").orderBy("pos").collect()
    assert [(r.link, r.time_text) for r in got] == [("/5", ""), ("/6", "10:00")]


def test_state_other_errors_are_raised(spark, tmp_dir):
    import pytest
    from pyspark.errors import AnalysisException
    from unittest.mock import patch
    with patch.object(type(spark.read), "parquet", side_effect=AnalysisException("no such column")):
        with pytest.raises(AnalysisException):
            io.read_state(spark, tmp_dir + "/any")


def test_sort_by_time_splits_a_hot_time(spark):
    """A third of the rows share one time; the sort stays ascending and those
    rows spread over several range partitions instead of one task."""
    from tidewatch.operators.periods import sort_by_time
    hot = "2024-01-01 00:00:00"
    rows = [(hot if i % 3 == 0 else f"2024-01-01 00:{i % 60:02d}:{i // 60 % 60:02d}",
             f"doc/{i}") for i in range(3000)]
    df = spark.createDataFrame(rows, "t string, link string").select(
        F.to_timestamp_ntz("t").alias("post_time"), "link")
    key = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(key, "false")
    try:
        out = sort_by_time(df).withColumn("pid", F.spark_partition_id()).collect()
    finally:
        spark.conf.set(key, "true")
    times = [r.post_time for r in out]
    assert times == sorted(times) and len(out) == 3000
    assert len({r.pid for r in out if str(r.post_time) == hot}) > 1


def _inside(text, name):
    """The arguments of every call of ``name`` in a plan's text."""
    at = text.find(name + "(")
    while at >= 0:
        depth, i = 0, at + len(name)
        while True:
            depth += {"(": 1, ")": -1}.get(text[i], 0)
            i += 1
            if not depth:
                break
        yield text[at:i]
        at = text.find(name + "(", at + 1)


def test_texts_are_cleaned_once_not_per_keyword(spark):
    from tidewatch.plans import community, news
    from tidewatch.sources import standins
    sf = "/root/testdata/sf0.001"
    docs = standins.table(spark, sf, "documents")
    kw = standins.keyword_table(spark)
    issues = spark.createDataFrame([("M1", "die")], "car_model string, accident string")
    mapped = tagging.tag_mapped(tagging.clean_columns(standins.raw_posts(docs), ("content", "title")), {"c": ["a", "b"]})
    plans = {"mapped": (mapped.select("link", "accident"), 2),
             "news": (news.tag_news(standins.raw_news(docs), ["a", "b", "c"]).select("link", "accident"), 1),
             "posts": (community.tag_posts(standins.raw_posts(docs), kw, issues).select("link", "accident"), 2)}
    for name, (df, most) in plans.items():
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        assert "lambdafunction" in plan, name
        assert not any("regexp_replace" in x for x in _inside(plan, "lambdafunction")), name
        assert plan.count("regexp_replace(") <= most, (name, plan)


def test_keyword_table_equals_brute_force(spark):
    """Short, overlapping, repeated, null and non-ASCII keywords; null texts; any join."""
    import random
    rng = random.Random(4)
    alphabet = "abcé가😀 "
    texts = ["".join(rng.choices(alphabet, k=rng.randrange(0, 40))) for _ in range(120)] + [None, ""]
    words = {"".join(rng.choices(alphabet, k=rng.randrange(1, 6))) for _ in range(300)}
    rows = [(i, t, texts[-1 - i]) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "id int, title string, content string").repartition(3)
    kw = spark.createDataFrame([(w, w[:1]) for w in sorted(words)] + [(None, "n"), ("", "e")], "keyword string, tag string")
    want = sorted((i, w, w[:1]) for i, t, c in rows for w in words if w in (t or "") or w in (c or ""))
    for opts in ({}, {"max_broadcast_rows": 0, "salt_buckets": 3}):
        got = tagging.match_keyword_table(df, kw, **opts).select("id", "keyword", "tag")
        assert sorted(tuple(r) for r in got.collect()) == want
    assert tagging.match_keyword_table(df, kw.limit(0)).collect() == []


def test_broadcast_bound_counts_rows_and_bytes(spark):
    from tidewatch.operators.joins import fits_broadcast, join_small
    df = spark.createDataFrame([(i, "x" * 100, None) for i in range(10)], "k int, `a.b` string, c array<int>")
    assert fits_broadcast(df, 10) and not fits_broadcast(df, 9)
    assert fits_broadcast(df, 10, 2000) and not fits_broadcast(df, 10, 999)
    assert fits_broadcast(df.limit(0), 0, 0)
    big = spark.range(20).selectExpr("cast(id % 10 AS int) AS k", "concat('l', id) AS link")
    plans = [join_small(big, df.select("k", "c"), "k", "inner", max_broadcast_rows=n) for n in (10, 9)]
    assert [p.count() for p in plans] == [20, 20]
