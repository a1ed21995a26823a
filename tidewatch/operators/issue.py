"""Issue scoring and fact rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import (NEWS_SCORE_SCALE, RANGE_COMM_COUNT, RANGE_COMM_SCORE, RANGE_NEWS_ACC_COUNT,
                      RANGE_NEWS_COUNT, WEIGHTS)
from ..functions.scoring import piecewise, severity, weighted_sum
from ..functions.time import parse_period_end
from .state import KEYS, STATE_COLS, open_issue_rows

TOP_POSTS_TYPE = "array<struct<content:string,link:string>>"


def attach_batch_counts(issues: DataFrame, news: DataFrame, comm: DataFrame) -> DataFrame:
    """Issue rows + this batch's news_count and comm_count (0 when absent), and
    the community positives, negatives and top posts (NULL when absent) (E12).

    Both aggregates have one row per key, so the joins never multiply rows."""
    n = news.select(*KEYS, F.col("count").alias("news_count"))
    c = comm.select(*KEYS, F.col("count").alias("comm_count"), "comm_positive_count",
                    "comm_negative_count", "top_comm")
    return (issues.join(n, KEYS, "left").join(c, KEYS, "left")
            .withColumn("news_count", F.coalesce(F.col("news_count"), F.lit(0)).cast("bigint"))
            .withColumn("comm_count", F.coalesce(F.col("comm_count"), F.lit(0)).cast("bigint")))


def normalised(df: DataFrame) -> dict[str, Column]:
    """The five inputs of the issue score mapped to [0, 1]."""
    return {
        "news_score": F.col("news_score") / NEWS_SCORE_SCALE,
        "comm_score": piecewise("comm_score", *RANGE_COMM_SCORE),
        "news_count": piecewise("news_count", *RANGE_NEWS_COUNT),
        "news_acc_count": piecewise("news_acc_count", *RANGE_NEWS_ACC_COUNT),
        "comm_count": piecewise("comm_count", *RANGE_COMM_COUNT),
    }


def normalise(df: DataFrame) -> DataFrame:
    """Add ``n_<input>`` columns holding the normalised values."""
    return df.select("*", *[c.alias(f"n_{k}") for k, c in normalised(df).items()])


def issue_score_col(df: DataFrame, weights: dict[str, float] = WEIGHTS) -> Column:
    """Weighted sum of the normalised inputs; a missing input counts 0."""
    n = {k: F.coalesce(c, F.lit(0.0)) for k, c in normalised(df).items()}
    return weighted_sum(weights, n)


def score_issues(state: DataFrame, news: DataFrame, comm: DataFrame,
                 weights: dict[str, float] = WEIGHTS) -> DataFrame:
    """Open-issue rows with batch counts and ``new_issue_score`` (E8 -> E12 -> E13)."""
    rows = attach_batch_counts(open_issue_rows(state), news, comm)
    return rows.withColumn("new_issue_score", issue_score_col(rows, weights))


def alert_on_change(state: DataFrame, scored: DataFrame) -> DataFrame:
    """Set the new issue_score; is_alert stays true, or becomes true when the
    severity band of the old and new score differ (E15). Rows not scored are
    untouched."""
    s = scored.select(*KEYS, F.col("new_issue_score").alias("_new"), F.lit(True).alias("_m"))
    j = state.join(s, KEYS, "left")
    m = F.coalesce(F.col("_m"), F.lit(False))
    changed = severity(F.col("issue_score")) != severity(F.col("_new"))
    alert = F.when(F.col("is_alert") == F.lit(True), True).when(changed, True).otherwise(False)
    upd = {"is_alert": F.when(m, alert).otherwise(F.col("is_alert")),
           "issue_score": F.when(m, F.col("_new")).otherwise(F.col("issue_score"))}
    return j.select(*[upd[c].alias(c) if c in upd else F.col(c) for c in STATE_COLS])


def batch_view(scored: DataFrame) -> DataFrame:
    """Raw state values, batch counts and the new issue_score in one row."""
    cols = [c for c in STATE_COLS if c != "issue_score"]
    return scored.select(*cols, "news_count", "comm_count", "comm_positive_count",
                         "comm_negative_count", "top_comm",
                         F.col("new_issue_score").alias("issue_score"))


def to_fact(view: DataFrame, batch_period) -> DataFrame:
    """Fact rows: issues that had posts this batch, batch_time = period end."""
    p = F.lit(batch_period) if isinstance(batch_period, str) else batch_period
    return view.filter(F.col("top_comm").isNotNull()).select(
        "car_model", "accident", "issue_score", "comm_count", "news_count", "start_batch_time",
        parse_period_end(p).alias("batch_time"), "top_comm",
        F.col("comm_positive_count").cast("bigint").alias("comm_positive_count"),
        F.col("comm_negative_count").cast("bigint").alias("comm_negative_count"))


def parse_top_posts(c, as_variant: bool = False) -> Column:
    """Top-post JSON text -> array<struct<content, link>>, or a semi-structured
    VARIANT value when ``as_variant`` (E18)."""
    c = F.col(c) if isinstance(c, str) else c
    return F.try_parse_json(c) if as_variant else F.from_json(c, TOP_POSTS_TYPE)
