"""State folding and issue detection.

State is one row per (entity, category). Each batch produces a new state
DataFrame from the previous one with one join per step (never a row-by-row
update), so a batch is idempotent: rerunning it from the same previous
snapshot gives the same result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import ISSUE_THRESHOLD, ISSUE_TTL
from ..functions.time import parse_period_end, parse_period_start
from ..schemas import STATE
from .joins import join_small

KEYS = ["car_model", "accident"]
STATE_COLS = [f.name for f in STATE.fields]


def _period_bounds(batch_period) -> tuple[Column, Column]:
    p = F.lit(batch_period) if isinstance(batch_period, str) else batch_period
    return parse_period_start(p), parse_period_end(p)


def seed_state(keys: DataFrame, dashboard_url: str | None = None) -> DataFrame:
    """Zeroed state rows for the given (car_model, accident) keys."""
    return keys.select(
        "car_model", "accident",
        F.lit(None).cast("timestamp_ntz").alias("start_batch_time"),
        F.lit(None).cast("timestamp_ntz").alias("last_batch_time"),
        F.lit(0).cast("bigint").alias("news_acc_count"),
        F.lit(0).cast("bigint").alias("comm_acc_count"),
        F.lit(0.0).alias("news_score"), F.lit(0.0).alias("comm_score"),
        F.lit(0.0).alias("issue_score"),
        F.lit(False).alias("is_issue"), F.lit(False).alias("is_alert"),
        F.lit(dashboard_url).cast("string").alias("dashboard_url"))


def seed_from(entities: DataFrame, categories: list[str], entity_col: str = "car_model",
              dashboard_url: str | None = None) -> DataFrame:
    """Every entity of ``entities`` x every configured category.

    Categories are configuration, so the pairing is a generator over a literal
    array, not a join."""
    keys = (entities.select(F.col(entity_col).alias("car_model")).distinct()
            .withColumn("accident", F.explode(F.array(*[F.lit(c) for c in categories]))))
    return seed_state(keys, dashboard_url)


def fold_news(state: DataFrame, news: DataFrame, batch_period) -> DataFrame:
    """Fold one batch's news aggregate into state.

    Matched rows: count added, last_batch_time = period end, news_score replaced
    by the batch mean, start_batch_time set to the period start when the old
    count was 0. Batch rows without a state row are ignored; state rows without a
    batch row are untouched."""
    start, end = _period_bounds(batch_period)
    n = news.select(*KEYS, F.col("count").alias("_n"), F.col("avg_news_score").alias("_s"),
                    F.lit(True).alias("_m"))
    j = state.join(n, KEYS, "left")
    m = F.coalesce(F.col("_m"), F.lit(False))
    upd = {
        "start_batch_time": F.when(m & (F.col("news_acc_count") == 0), start)
                             .otherwise(F.col("start_batch_time")),
        "news_acc_count": F.when(m, F.col("news_acc_count") + F.col("_n"))
                           .otherwise(F.col("news_acc_count")),
        "last_batch_time": F.when(m, end).otherwise(F.col("last_batch_time")),
        "news_score": F.when(m, F.col("_s")).otherwise(F.col("news_score")),
    }
    return j.select(*[upd[c].alias(c) if c in upd else F.col(c) for c in STATE_COLS])


def clear_alerts(state: DataFrame) -> DataFrame:
    """Every row's is_alert <- false."""
    return state.withColumn("is_alert", F.lit(False))


def open_issues(state: DataFrame, threshold: int = ISSUE_THRESHOLD) -> DataFrame:
    """Rows whose accumulated count reached ``threshold`` and are not yet an issue
    become one, with an alert (E5)."""
    cross = (F.col("news_acc_count") >= threshold) & (F.col("is_issue") == F.lit(False))
    return (state.withColumn("is_alert", F.when(cross, True).otherwise(F.col("is_alert")))
                 .withColumn("is_issue", F.when(cross, True).otherwise(F.col("is_issue"))))


def expire_issues(state: DataFrame, now, ttl: str = ISSUE_TTL) -> DataFrame:
    """Reset rows whose last batch is older than ``ttl`` before ``now``.

    ``now`` is a batch period string (its end is used) or a Column."""
    now_c = _period_bounds(now)[1] if isinstance(now, str) else now
    stale = F.col("last_batch_time") < (now_c - F.expr(f"INTERVAL {ttl}"))
    reset = {"news_acc_count": F.lit(0).cast("bigint"), "comm_acc_count": F.lit(0).cast("bigint"),
             "is_issue": F.lit(False), "is_alert": F.lit(False),
             "start_batch_time": F.lit(None).cast("timestamp_ntz"),
             "last_batch_time": F.lit(None).cast("timestamp_ntz"),
             "news_score": F.lit(0.0), "comm_score": F.lit(0.0), "issue_score": F.lit(0.0)}
    return state.select(*[F.when(stale, reset[c]).otherwise(F.col(c)).alias(c) if c in reset
                          else F.col(c) for c in STATE_COLS])


def news_step(state: DataFrame, news: DataFrame, batch_period: str,
              threshold: int = ISSUE_THRESHOLD, ttl: str | None = None) -> DataFrame:
    """One news batch: E1/E2 fold, E4 clear alerts, optional E6 expiry, E5 open."""
    s = clear_alerts(fold_news(state, news, batch_period))
    if ttl:
        s = expire_issues(s, batch_period, ttl)
    return open_issues(s, threshold)


def fold_posts(state: DataFrame, comm: DataFrame) -> DataFrame:
    """comm_score <- batch mean, comm_acc_count <- coalesce(old, 0) + count."""
    c = comm.select(*KEYS, F.col("count").alias("_n"), F.col("avg_comm_score").alias("_s"),
                    F.lit(True).alias("_m"))
    j = state.join(c, KEYS, "left")
    m = F.coalesce(F.col("_m"), F.lit(False))
    upd = {
        "comm_score": F.when(m, F.col("_s")).otherwise(F.col("comm_score")),
        "comm_acc_count": F.when(m, F.coalesce(F.col("comm_acc_count"), F.lit(0)) + F.col("_n"))
                           .otherwise(F.col("comm_acc_count")),
    }
    return j.select(*[upd[c].alias(c) if c in upd else F.col(c) for c in STATE_COLS])


def open_issue_rows(state: DataFrame) -> DataFrame:
    """State rows that are open issues."""
    return state.filter(F.col("is_issue"))


def issue_list(state: DataFrame) -> DataFrame:
    """(car_model, accident) of open issues."""
    return open_issue_rows(state).select(*KEYS)


def distinct_entities(issues: DataFrame) -> DataFrame:
    """Unique entities among open issues."""
    return issues.select("car_model").distinct()


def append_evidence(evidence: DataFrame | None, batch: DataFrame, batch_period: str) -> DataFrame:
    """Append one batch's evidence rows to the accumulated evidence.

    Evidence is a long table keyed by (car_model, accident, batch_period); the
    original's ever-growing JSON array per state row becomes new rows."""
    b = batch.withColumn("batch_period", F.lit(batch_period))
    return b if evidence is None else evidence.unionByName(b)


def current_evidence(evidence: DataFrame, state: DataFrame, period: str | None = None) -> DataFrame:
    """The evidence behind a snapshot: of each key, the articles of its current run, from
    the batch in which the run started to the snapshot's ``period`` (E3 under E6).

    What an expired issue had gathered before is not part of it, though nothing is removed
    from the evidence: the snapshot's ``start_batch_time`` says where the run begins."""
    begun = state.filter(F.col("start_batch_time").isNotNull()).select(*KEYS, "start_batch_time")
    rows = evidence if period is None else evidence.filter(F.col("batch_period") <= period)
    # one row per key: broadcast after a check of its size, else salted
    return (join_small(rows, begun, KEYS, "inner")
            .filter(parse_period_start(F.col("batch_period")) >= F.col("start_batch_time"))
            .drop("start_batch_time"))
