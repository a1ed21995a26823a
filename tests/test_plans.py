"""Composed jobs: idempotence, replay equivalence, skipped community stage."""

from pyspark.sql import functions as F

from tidewatch.config import NEWS_CATEGORIES
from tidewatch.operators import periods
from tidewatch.operators.scoring import ColumnScorer
from tidewatch.plans import community, news, replay
from tidewatch.sources import io, standins

SF = "/root/testdata/sf0.001"
P1 = "2024-01-01-00-00-00_2024-01-01-01-00-00"
P2 = "2024-01-01-01-00-00_2024-01-01-02-00-00"


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


def _setup(spark, base):
    docs = standins.table(spark, SF, "documents")
    raw = periods.assign_period(standins.raw_news(docs), "1 hour")
    io.write_records(raw.drop("period_start", "period_end", "batch_period").filter(
        F.col("post_time") < F.to_timestamp_ntz(F.lit("2024-01-01 01:00:00"))), f"{base}/raw", P1)
    io.write_records(raw.drop("period_start", "period_end", "batch_period").filter(
        F.col("post_time") >= F.to_timestamp_ntz(F.lit("2024-01-01 01:00:00")))
        .filter(F.col("post_time") < F.to_timestamp_ntz(F.lit("2024-01-01 02:00:00"))),
        f"{base}/raw", P2)
    return docs


def test_news_job_rerun_is_idempotent(spark, tmp_dir):
    docs = _setup(spark, tmp_dir)
    sc, seed = standins.label_scorer(standins.table(spark, SF, "labels")), standins.seed(docs)
    args = (spark, f"{tmp_dir}/raw", f"{tmp_dir}/out")
    news.run_news_job(*args, P1, NEWS_CATEGORIES, sc, seed)
    community.run_community_job(spark, f"{tmp_dir}/raw", f"{tmp_dir}/out", P1,
                                standins.keyword_table(spark), sc)
    first = _rows(news.run_news_job(*args, P2, NEWS_CATEGORIES, sc, seed).state)
    again = _rows(news.run_news_job(*args, P2, NEWS_CATEGORIES, sc, seed).state)
    assert first == again
    aggs = spark.read.parquet(f"{tmp_dir}/out/news")
    assert aggs.count() == aggs.select("car_model", "accident", "batch_period").distinct().count()


def test_replay_equals_batch_by_batch(spark):
    docs = standins.table(spark, SF, "documents")
    raw = standins.raw_news(docs)
    sc, seed = standins.label_scorer(standins.table(spark, SF, "labels")), standins.seed(docs)
    ps = sorted(r[0] for r in periods.assign_period(raw, "1 hour")
                .select("batch_period").distinct().collect())
    loop = replay.replay_batches(raw, None, ps, seed, NEWS_CATEGORIES, sc, threshold=3)
    once = replay.replay_news(raw, seed, NEWS_CATEGORIES, sc, threshold=3)
    r = lambda df: _rows(df.withColumn("news_score", F.round("news_score", 6)))
    assert r(loop) == r(once)
    assert once.filter("is_issue").count() > 0


def test_replay_with_community_loop(spark):
    docs = standins.table(spark, SF, "documents")
    sc, seed = standins.label_scorer(standins.table(spark, SF, "labels")), standins.seed(docs)
    ps = [P1, P2]
    out = replay.replay_batches(standins.raw_news(docs), standins.raw_posts(docs), ps, seed,
                                NEWS_CATEGORIES, sc, standins.keyword_table(spark), sc,
                                threshold=2)
    assert out.count() == seed.count()
    assert out.filter("is_issue").count() > 0
    assert out.filter("comm_acc_count > 0").count() > 0


def test_community_skipped_without_issues(spark):
    docs = standins.table(spark, SF, "documents")
    seed = standins.seed(docs)
    sc = standins.label_scorer(standins.table(spark, SF, "labels"))
    empty_news = io.empty(spark, io.AGG_SCHEMAS["news"])
    res = community.run_community(standins.raw_posts(docs), P1, seed,
                                  standins.keyword_table(spark), sc, empty_news)
    assert res.aggregate.count() == 0 and res.fact.count() == 0 and res.alerts.count() == 0
    assert _rows(res.state) == _rows(seed)


def _dense_periods(spark, raw, every_hours=1):
    import datetime as dt
    lo, hi = raw.agg(F.min("post_time"), F.max("post_time")).first()
    t = lo.replace(minute=0, second=0, microsecond=0)
    out = []
    while t <= hi:
        e = t + dt.timedelta(hours=every_hours)
        out.append(f"{t:%Y-%m-%d-%H-%M-%S}_{e:%Y-%m-%d-%H-%M-%S}")
        t = e
    return out


def test_replay_with_expiry_equals_batch_loop(spark):
    docs = standins.table(spark, SF, "documents")
    raw = standins.raw_news(docs)
    sc, seed = standins.label_scorer(standins.table(spark, SF, "labels")), standins.seed(docs)
    ps = _dense_periods(spark, raw)
    r = lambda df: _rows(df.withColumn("news_score", F.round("news_score", 6)))
    got = {}
    for ttl in ("1 hour", "90 minutes", None):
        loop = replay.replay_batches(raw, None, ps, seed, NEWS_CATEGORIES, sc, threshold=2,
                                     ttl=ttl)
        once = replay.replay_news(raw, seed, NEWS_CATEGORIES, sc, threshold=2, ttl=ttl)
        got[ttl] = r(once)
        assert r(loop) == got[ttl], ttl
    assert got["1 hour"] != got[None]   # expiry did reset some keys
    # a stale seed: state from the first hour, replayed over the rest
    first = replay.replay_news(raw.filter(F.hour("post_time") == 0), seed, NEWS_CATEGORIES, sc,
                               threshold=2)
    rest = raw.filter(F.hour("post_time") >= 2)
    loop = replay.replay_batches(rest, None, _dense_periods(spark, rest), first,
                                 NEWS_CATEGORIES, sc, threshold=2, ttl="1 hour")
    once = replay.replay_news(rest, first, NEWS_CATEGORIES, sc, threshold=2, ttl="1 hour")
    assert r(loop) == r(once)
    assert once.filter("news_acc_count = 0").count() > 0


class _PerRow:
    """Wraps a scorer and hides its inputs, so the plans score every exploded row."""

    costly, inputs = False, None

    def __init__(self, inner):
        self.inner = inner

    def reads_any(self, cols):
        return True

    def __call__(self, df, out):
        return self.inner(df, out)


def test_record_level_scoring_equals_per_row(spark):
    """A scorer that reads neither entity nor category scores each tagged record
    once, before the explode; the rows equal scoring every exploded row."""
    docs = standins.table(spark, SF, "documents")
    sc = standins.label_scorer(standins.table(spark, SF, "labels"))
    assert not sc.reads_any(["accident", "car_model"])
    raw = standins.raw_news(docs)
    once = news.score_news(raw, NEWS_CATEGORIES, sc).select("car_model", "accident", "link",
                                                            "news_score")
    each = news.score_news(raw, NEWS_CATEGORIES, _PerRow(sc)).select(
        "car_model", "accident", "link", "news_score")
    assert _rows(once) == _rows(each) and once.count() > 0
    state = news.run_news(raw, P1, standins.seed(docs), NEWS_CATEGORIES, sc, threshold=2,
                          evidence=False).state
    issues = state.filter("is_issue")
    posts, kw = standins.raw_posts(docs), standins.keyword_table(spark)
    a = community.score_posts(posts, kw, issues, sc)
    b = community.score_posts(posts, kw, issues, _PerRow(sc))
    assert "car_model" not in a.rows.columns and "car_model" in b.rows.columns  # per category, per entity
    for agg in (community.post_stats, community.top_posts, community.packed_posts, community.aggregate_batch):
        cols = agg(b).columns
        assert _rows(agg(a).select(cols)) == _rows(agg(b)) and agg(a).count() > 0


def test_stream_one_period_per_micro_batch_equals_replay(spark, tmp_dir):
    """The file stream, one hourly file per micro-batch, then a restart that
    picks up a later hour, ends in the state of one replay over all of it."""
    from tidewatch.streaming import stream_news
    docs = standins.table(spark, SF, "documents")
    sc, seed = standins.label_scorer(standins.table(spark, SF, "labels")), standins.seed(docs)
    raw = standins.raw_news(docs)
    timed = periods.assign_period(raw, "1 hour").drop("period_start", "period_end")
    cut = F.to_timestamp_ntz(F.lit("2024-01-01 02:00:00"))
    # one file per period, so a period never straddles two micro-batches
    early, late = timed.filter(F.col("post_time") < cut), timed.filter(F.col("post_time") >= cut)
    early.repartition("batch_period").write.partitionBy("batch_period").parquet(f"{tmp_dir}/raw")
    args = (spark, f"{tmp_dir}/raw", f"{tmp_dir}/out", f"{tmp_dir}/ckpt", NEWS_CATEGORIES, sc,
            seed)
    stream_news(*args, threshold=3, max_files_per_trigger=1).awaitTermination()
    late.repartition("batch_period").write.mode("append").partitionBy("batch_period") \
        .parquet(f"{tmp_dir}/raw")
    stream_news(*args, threshold=3, max_files_per_trigger=1).awaitTermination()
    got = io.read_state(spark, f"{tmp_dir}/out/state")
    want = replay.replay_news(raw, seed, NEWS_CATEGORIES, sc, threshold=3)
    r = lambda df: _rows(df.withColumn("news_score", F.round("news_score", 6)))
    assert r(got) == r(want)
    assert len(io.state_periods(spark, f"{tmp_dir}/out/state")) > 2   # one snapshot per micro-batch


def _stream_against_batches(spark, base, drops, seed, sc, threshold):
    """Files dropped one by one and streamed one per micro-batch, against G1 run once per
    period over the whole folders: every snapshot and every aggregate must agree."""
    from tidewatch.streaming import stream_news
    for period, df in drops:
        df.coalesce(1).withColumn("batch_period", F.lit(period)).write.mode("append") \
            .partitionBy("batch_period").parquet(f"{base}/raw")
        stream_news(spark, f"{base}/raw", f"{base}/out", f"{base}/ckpt", NEWS_CATEGORIES, sc,
                    seed, threshold=threshold, max_files_per_trigger=1).awaitTermination()
    r = lambda df, c: _rows(df.withColumn(c, F.round(c, 6)))
    state = seed
    for period in sorted({p for p, _ in drops}):
        raw = io.read_raw(spark, "news", f"{base}/raw", period)
        want = news.run_news(raw, period, state, NEWS_CATEGORIES, sc, threshold, evidence=False)
        state = want.state
        got = io.read_state(spark, f"{base}/out/state", period + "~", seed)
        assert r(got, "news_score") == r(state, "news_score"), period
        agg = io.read_batch(spark, want.aggregate.schema, f"{base}/out/news", period)
        assert r(agg, "avg_news_score") == r(want.aggregate, "avg_news_score"), period
    return state


def test_stream_split_late_and_outside_rows_equal_batches(spark, tmp_dir):
    """A period in two micro-batches, an older period that arrives last, and rows whose
    time is null or outside their folder's period."""
    docs = standins.table(spark, SF, "documents")
    sc, seed = standins.label_scorer(standins.table(spark, SF, "labels")), standins.seed(docs)
    raw = standins.raw_news(docs).select(*io.RAW_SCHEMAS["news"].fieldNames())
    n = F.pmod(F.xxhash64("link"), F.lit(4))
    untimed = raw.filter(n == 3).withColumn("post_time", F.lit(None).cast("timestamp_ntz"))
    p3 = "2024-01-01-02-00-00_2024-01-01-03-00-00"
    drops = [(P2, raw.filter(n == 0)), (p3, untimed), (P2, raw.filter(n == 1)),
             (P1, raw.filter(n == 2))]
    state = _stream_against_batches(spark, tmp_dir, drops, seed, sc, threshold=4)
    counted = state.agg(F.sum("news_acc_count")).first()[0]
    tags = news.tag_news(raw, NEWS_CATEGORIES)
    assert counted == tags.join(seed.select("car_model", "accident"), ["car_model", "accident"],
                                "left_semi").count() > 0
    assert 0 < state.filter("is_issue").count() < state.count()


def test_top_posts_keep_their_own_text(spark):
    """Posts that share a link, or have none, or have no text, keep their own content."""
    import json
    rows = [("same", "text A!", 9), ("same", "text B", 8), (None, "no link", 7), ("l", None, 6),
            (None, "other", 5), ("same", "text A!", 9)]
    raw = spark.createDataFrame([(*r, "t") for r in rows], "link string, content string, view_count bigint, "
                                "title string").repartition(3)
    keywords = spark.createDataFrame([("c", "t")], "accident string, keyword string")
    issues = spark.createDataFrame([("e", "c"), ("f", "c")], "car_model string, accident string")
    posts = community.score_posts(raw, keywords, issues, ColumnScorer(lambda df: F.lit(50), inputs=()), k=6)
    got = community.aggregate_batch(posts, 6).collect()
    assert sorted(r["car_model"] for r in got) == ["e", "f"]
    for r in got:
        assert json.loads(r["top_comm"]) == [
            {"content": "text A", "link": "same"}, {"content": "text A", "link": "same"},
            {"content": "text B", "link": "same"}, {"content": "no link"}, {"link": "l"}, {"content": "other"}]


def test_texts_are_kept_only_for_possible_top_posts(spark):
    """Among many posts few keep their text, and the first k always do, ties included."""
    from tidewatch.operators import aggregate as agg
    raw = spark.range(3000).selectExpr(
        "concat('l', id) AS link", "concat('text ', id) AS content", "(id * 7919) % 400 AS view_count",
        "concat('c', id % 3) AS accident").repartition(4)
    kept = agg.keep_top_texts(agg.with_post_id(raw), 5, ["accident"])
    rows = kept.collect()
    assert all((r["content"] is not None) == r["kept"] for r in rows) and sum(r["kept"] for r in rows) < 600
    plain = agg.top_k_posts(agg.with_post_id(raw), 5, keys=["accident"]).drop(agg.POST_ID)
    assert _rows(agg.top_k_posts(kept, 5, keys=["accident"]).select(plain.columns)) == _rows(plain)
