"""Where the texts of posts go: not to Python, and not to every entity of a replay."""

import json

from pyspark.sql import functions as F

from tidewatch.operators import aggregate as agg


def test_texts_do_not_go_to_python(spark):
    raw = spark.range(300).selectExpr("concat('l', id) AS link", "concat('text ', id) AS content",
                                      "id % 40 AS view_count", "concat('c', id % 3) AS accident")
    kept = agg.keep_top_texts(agg.with_post_id(raw), 5, ["accident"])
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" not in plan
    call = plan[plan.index("ArrowEvalPython"):].splitlines()[0]
    assert "content" not in call[:call.index("]")] and "view_count" in call


def test_forgotten_groups_only_keep_more_texts(spark, monkeypatch):
    monkeypatch.setattr(agg, "GROUPS_AT_ONCE", 2)
    raw = agg.with_post_id(spark.range(400).selectExpr(
        "concat('l', id) AS link", "concat('text ', id) AS content", "(id * 37) % 101 AS view_count",
        "concat('c', id % 7) AS accident"))
    got = agg.top_k_posts(agg.keep_top_texts(raw, 3, ["accident"]), 3, keys=["accident"])
    want = agg.top_k_posts(raw, 3, keys=["accident"])
    assert sorted(got.select(want.columns).collect()) == sorted(want.collect())


def test_a_replay_carries_no_packed_texts_per_key(spark, monkeypatch):
    from tidewatch.operators.scoring import ColumnScorer
    from tidewatch.operators.state import seed_from
    from tidewatch.plans import replay
    made = {}
    real = replay.materialise
    monkeypatch.setattr(replay, "materialise", lambda df, name: made.setdefault(name, real(df, name)))
    row = ["timestamp_ntz'2024-01-01 00:30:00' AS post_time", "concat('l', id) AS link", "'t' AS title",
           "'a x' AS content", "'s' AS source"]
    news = spark.range(12).selectExpr(*row, "concat('e', id % 3) AS keyword")
    posts = spark.range(7).selectExpr(*row, "id AS view_count", "id AS like_count")
    seed = seed_from(news.select(F.col("keyword").alias("car_model")), ["x"])
    scorer = ColumnScorer(lambda df: F.lit(50), inputs=())
    keywords = spark.createDataFrame([("x", "x")], "accident string, keyword string")
    got = replay.replay(news, posts, seed, ["x"], scorer, keywords, scorer, threshold=2)
    facts = got.facts.collect()
    assert sorted(r["car_model"] for r in facts) == ["e0", "e1", "e2"]
    for r in facts:
        assert r["comm_count"] == 7 and [p["link"] for p in json.loads(r["top_comm"])] == ["l6", "l5", "l4", "l3", "l2"]
    assert "top_comm" not in made["replay-states"].columns
