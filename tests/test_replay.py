"""Both stages replayed in one pass against the batch jobs run in order."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidewatch.config import NEWS_CATEGORIES
from tidewatch.functions.time import parse_period_end, parse_period_start
from tidewatch.operators.periods import in_period
from tidewatch.operators.scoring import ColumnScorer
from tidewatch.plans import community, news, replay
from tidewatch.sources import standins

SF = "/root/testdata/sf0.001"
SCORES = ["news_score", "comm_score", "issue_score"]


def _periods(first, n, minutes):
    t = dt.datetime.fromisoformat(first)
    step = dt.timedelta(minutes=minutes)
    return [f"{t + i * step:%Y-%m-%d-%H-%M-%S}_{t + (i + 1) * step:%Y-%m-%d-%H-%M-%S}" for i in range(n)]


def _rows(df, scores=SCORES):
    for c in scores:
        df = df.withColumn(c, F.round(c, 6))
    return sorted((tuple(r) for r in df.select(sorted(df.columns)).collect()), key=str)


def _loop(raw, posts, periods, state, scorer, kw, post_scorer, threshold, ttl):
    """State, facts and alerts of each batch, the batch jobs run one after another."""
    states, facts, alerts = [], [], []
    for p in periods:
        s, e = parse_period_start(F.lit(p)), parse_period_end(F.lit(p))
        nb = news.run_news(in_period(raw, s, e), p, state, NEWS_CATEGORIES, scorer, threshold, ttl, evidence=False)
        cb = community.run_community(in_period(posts, s, e), p, nb.state, kw, post_scorer, nb.aggregate)
        state = cb.state.checkpoint(eager=True)
        states += _rows(state.withColumn("batch_period", F.lit(p)))
        facts += _rows(cb.fact.withColumn("batch_period", F.lit(p)), ["issue_score"])
        alerts += _rows(cb.alerts.withColumn("batch_period", F.lit(p)), [])
    return [sorted(x, key=str) for x in (states, facts, alerts)]


@pytest.fixture(scope="module")
def inputs(spark):
    docs = standins.table(spark, SF, "documents")
    scorer = standins.label_scorer(standins.table(spark, SF, "labels"))
    # quiet hours, so that issues expire and open again
    minute = F.hour("post_time") * 60 + F.minute("post_time")
    busy = standins.raw_news(docs).filter((minute % 120 < 50) | F.col("link").isin("doc/71", "doc/100"))
    untimed = busy.limit(3).withColumn("post_time", F.lit(None).cast("timestamp_ntz"))
    return docs, scorer, busy.unionByName(untimed), standins.raw_posts(docs), standins.keyword_table(spark)


def _check(got, want):
    states, facts, alerts = want
    assert _rows(got.states) == states
    assert _rows(got.facts, ["issue_score"]) == facts
    assert _rows(got.alerts, []) == alerts


def test_replay_equals_the_batch_jobs_on_every_period(spark, inputs):
    docs, scorer, raw, posts, kw = inputs
    periods = _periods("2024-01-01 00:00:00", 7, 30)
    want = _loop(raw, posts, periods, standins.seed(docs), scorer, kw, scorer, 2, "30 minutes")
    got = replay.replay(raw, posts, standins.seed(docs), NEWS_CATEGORIES, scorer, kw, scorer, threshold=2,
                        every="30 minutes", ttl="30 minutes", periods=periods)
    _check(got, want)
    states = got.states.toPandas()
    by_key = states.sort_values("batch_period").groupby(["car_model", "accident"])["is_issue"]
    assert (by_key.apply(lambda x: ((x.shift() == True) & ~x).any())).any()  # noqa: E712  some issue expired
    assert got.facts.count() and got.alerts.count() and states["comm_acc_count"].max() > 0


def test_replay_from_a_stale_and_open_seed_with_an_entity_scorer(spark, inputs):
    docs, scorer, raw, posts, kw = inputs
    # half of the keys are open issues whose last batch lies a while back
    half = F.xxhash64("car_model", "accident") % 2 == 0
    ago = F.lit("2024-01-01 00:00:00").cast("timestamp_ntz") - F.expr("INTERVAL 20 MINUTES")
    seed = standins.seed(docs).withColumns({
        "is_issue": half, "news_acc_count": F.when(half, 5).otherwise(1).cast("bigint"),
        "last_batch_time": F.when(half, ago), "start_batch_time": F.when(half, ago),
        "issue_score": F.when(half, 0.7).otherwise(0.0), "comm_score": F.when(half, 60.0).otherwise(0.0),
        "comm_acc_count": F.when(half, 4).otherwise(0).cast("bigint")})
    by_entity = ColumnScorer(lambda df: F.pmod(F.xxhash64("link", "car_model", "accident"), F.lit(100)),
                             inputs=["link", "car_model", "accident"])
    periods = _periods("2024-01-01 00:00:00", 3, 60)
    want = _loop(raw, posts, periods, seed, scorer, kw, by_entity, 6, "1 hour")
    got = replay.replay(raw, posts, seed, NEWS_CATEGORIES, scorer, kw, by_entity, threshold=6, ttl="1 hour",
                        periods=periods)
    _check(got, want)


def test_replay_without_posts_or_issues(spark, inputs):
    docs, scorer, raw, posts, kw = inputs
    got = replay.replay(raw, posts, standins.seed(docs), NEWS_CATEGORIES, scorer, kw, scorer, threshold=10 ** 6)
    assert got.states.filter("is_issue OR is_alert").isEmpty() and got.facts.isEmpty() and got.alerts.isEmpty()
    last = got.states.agg(F.max("batch_period")).first()[0]
    final = replay.replay_news(raw, standins.seed(docs), NEWS_CATEGORIES, scorer, threshold=10 ** 6)
    schedule_end = got.states.filter(F.col("batch_period") == last).drop("batch_period")
    assert _rows(schedule_end) == _rows(final)
