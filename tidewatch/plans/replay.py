"""Replaying many batches.

``replay_news`` computes the news state after every period in one pass:
articles are aggregated to (key, period) grain, then running sums over each
key's periods (a window over a key's handful of periods, never over its
articles) give the accumulated count, the first and last batch, the last mean
score and the threshold crossing, with expiry (E6) as cuts between runs.

``replay`` gives every batch of both stages, each period's state, facts and alerts, in one
pass over each raw table. ``replay_batches`` runs the batch jobs in order instead; it is
what the single passes are tested against.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..config import ISSUE_THRESHOLD, TOP_K
from ..functions.scoring import severity
from ..functions.time import format_period, parse_period_end, parse_period_start
from ..operators.aggregate import with_post_id
from ..operators.alerts import alertable, render_alert
from ..operators.issue import issue_score_col
from ..operators.joins import join_small
from ..operators.periods import assign_period
from ..operators.scoring import Scorer, materialise
from ..operators.state import KEYS, STATE_COLS, expire_issues
from ..operators.tagging import clean_columns, selected_pairs, tag_mapped, with_tags
from .community import group_aggregates, run_community, score_tagged, spread_aggregates
from .news import run_news, score_news


def news_by_period(raw: DataFrame, categories, scorer: Scorer, every: str = "1 hour",
                   on_failure: int | None = 0) -> DataFrame:
    """Per (key, period): article count and mean score (D13 for every batch at once).

    A record without a post time falls in no batch, so it is left out here as the
    batch filter leaves it out."""
    timed = raw.filter(F.col("post_time").isNotNull())
    scored = assign_period(score_news(timed, categories, scorer, on_failure,
                                      keep=("post_time",)), every)
    return scored.groupBy(*KEYS, "period_start", "period_end", "batch_period").agg(
        F.count(F.lit(1)).alias("count"), F.avg("news_score").alias("avg_news_score"))


def replay_news(raw: DataFrame, seed: DataFrame, categories, scorer: Scorer,
                threshold: int = ISSUE_THRESHOLD, every: str = "1 hour",
                on_failure: int | None = 0, ttl: str | None = None,
                per: DataFrame | None = None) -> DataFrame:
    """State after folding every period of ``raw`` in time order.

    The schedule is one batch per period (``every``) from the period of the
    earliest record to that of the latest, empty ones included; alerts are those
    raised in the last batch. With ``ttl``, a key's issue expires (E6) when a
    batch runs more than ``ttl`` after its last article, which between two
    appearances of the key happens exactly when they are more than ``ttl`` +
    one period apart. Each key's periods are cut into runs at such gaps
    (gaps-and-islands: ``lag`` + running sum) and the sums restart per run.

    ``per`` is ``news_by_period`` of ``raw`` when the caller already has it
    (computed once and also written out); ``raw`` then only gives the schedule's
    bounds, a scan of its time column."""
    if per is None:
        per = news_by_period(raw, categories, scorer, every, on_failure)
    # the schedule's first batch end and last batch start: scalar subqueries
    bounds = assign_period(raw.agg(F.min("post_time").alias("post_time")), every)
    first_end = bounds.select("period_end").scalar()
    final = assign_period(raw.agg(F.max("post_time").alias("post_time")), every) \
        .select("period_start").scalar()
    step = F.expr(f"INTERVAL {every}")
    w = Window.partitionBy(*KEYS).orderBy("period_start")
    if ttl:
        ttl_c = F.expr(f"INTERVAL {ttl}")
        new_run = F.coalesce(F.col("period_end") > F.lag("period_end").over(w) + ttl_c + step,
                             F.lit(False))
        per = per.withColumn("_run", F.sum(new_run.cast("int")).over(
            w.rowsBetween(Window.unboundedPreceding, 0)))
    else:
        per = per.withColumn("_run", F.lit(0))
    in_run = Window.partitionBy(*KEYS, "_run")
    run = (per.withColumn("acc", F.sum("count").over(
                in_run.orderBy("period_start").rowsBetween(Window.unboundedPreceding, 0)))
              .withColumn("run_start", F.min("period_start").over(in_run))
              .withColumn("key_first_end", F.min("period_end").over(Window.partitionBy(*KEYS)))
              .withColumn("rn_desc", F.row_number().over(
                  Window.partitionBy(*KEYS).orderBy(F.desc("period_start")))))
    last = run.filter(F.col("rn_desc") == 1).select(
        *KEYS, "_run", F.col("run_start").alias("_start"),
        F.col("key_first_end").alias("_first_end"),
        F.col("period_start").alias("_last_start"), F.col("period_end").alias("_last"),
        F.col("acc").alias("_acc"), (F.col("acc") - F.col("count")).alias("_prev"),
        F.col("avg_news_score").alias("_score"))
    j = seed.join(last, KEYS, "left")
    m = F.col("_acc").isNotNull()
    final_end = final + step
    if ttl:
        seed_last = F.col("last_batch_time")
        # the seed expires in a batch before the key's first article (or at all)
        seed_reset = seed_last.isNotNull() & F.when(
            m, (F.col("_first_end") - step > seed_last + ttl_c)
            & (F.col("_first_end") - step >= first_end)).otherwise(final_end > seed_last + ttl_c)
        use_seed = ~F.coalesce(seed_reset, F.lit(False)) & (~m | (F.col("_run") == 0))
    else:
        use_seed = F.lit(True)

    def base(c, zero):
        return F.when(use_seed, F.col(c)).otherwise(zero)

    b_acc = base("news_acc_count", F.lit(0).cast("bigint"))
    b_issue = base("is_issue", F.lit(False))
    acc = F.when(m, b_acc + F.col("_acc")).otherwise(b_acc)
    prev = b_acc + F.col("_prev")
    crossed_last = m & (F.col("_last_start") == final) & (prev < threshold) \
        & (acc >= threshold) & ~b_issue
    upd = {
        "start_batch_time": F.when(m & (b_acc == 0), F.col("_start"))
                             .otherwise(base("start_batch_time", F.lit(None).cast("timestamp_ntz"))),
        "last_batch_time": F.when(m, F.col("_last"))
                            .otherwise(base("last_batch_time", F.lit(None).cast("timestamp_ntz"))),
        "news_acc_count": acc,
        "comm_acc_count": base("comm_acc_count", F.lit(0).cast("bigint")),
        "news_score": F.when(m, F.col("_score")).otherwise(base("news_score", F.lit(0.0))),
        "comm_score": base("comm_score", F.lit(0.0)),
        "issue_score": base("issue_score", F.lit(0.0)),
        "is_issue": b_issue | (acc >= threshold),
        "is_alert": F.coalesce(crossed_last, F.lit(False)),
    }
    out = j.select(*[upd[c].alias(c) if c in upd else F.col(c) for c in STATE_COLS])
    if ttl:   # expiry in the batches after the key's last article
        out = expire_issues(out, final_end, ttl)
    return out


@dataclass
class Replay:
    """Every batch of a replay; all tables have ``batch_period``."""

    states: DataFrame   # the state after each period, a row per key and period
    news: DataFrame     # T3
    posts: DataFrame    # T4
    facts: DataFrame    # T6
    alerts: DataFrame   # F3 payloads


def schedule(raws: list[DataFrame], every: str, periods: list[str] | None = None) -> Column:
    """The starts of a replay's batches, an array: of the given periods, or of every period
    from the earliest record to the latest."""
    if periods is not None:
        return F.transform(F.array(*[F.lit(p) for p in sorted(periods)]).cast("array<string>"), parse_period_start)
    times = raws[0].select("post_time")
    for r in raws[1:]:
        times = times.unionByName(r.select("post_time"))

    def bound(agg):
        return assign_period(times.agg(agg("post_time").alias("post_time")), every).select("period_start").scalar()

    return F.sequence(bound(F.min), bound(F.max), F.expr(f"INTERVAL {every}"))


def seeded(seed: DataFrame) -> DataFrame:
    """The keys with the state before the first batch as ``_seed_*``."""
    return seed.select(*KEYS, *[F.col(c).alias(f"_seed_{c}") for c in STATE_COLS if c not in KEYS])


def from_seed(col: str, zero: Column) -> Column:
    """The seed's value while the key has not expired since, else ``zero``."""
    return F.when(F.col("_run") == 0, F.col(f"_seed_{col}")).otherwise(zero)


def news_states(dense: DataFrame, per: DataFrame, threshold: int, ttl: str | None) -> DataFrame:
    """The state after the news stage of every batch (E1, E2, E4-E6), from ``dense``: a row
    per key (``seeded``) and batch (period_start, period_end, batch_period), and the batches'
    aggregates ``per``. Adds what the community stage needs: ``_run`` (how often the key has
    expired), ``_expired``, ``_opened`` and ``news_count``."""
    rows = dense.join(per.select(*KEYS, "batch_period", "count", "avg_news_score"), [*KEYS, "batch_period"], "left")
    w = Window.partitionBy(*KEYS).orderBy("period_start")
    so_far = w.rowsBetween(Window.unboundedPreceding, 0)
    has_news = F.col("count").isNotNull()
    # A key is stale while its last article lies further back than ttl; each stale
    # batch begins a new run, so everything before it is forgotten
    last_end = F.coalesce(F.last(F.when(has_news, F.col("period_end")), ignorenulls=True).over(so_far),
                          F.col("_seed_last_batch_time"))
    stale = F.coalesce(last_end < F.col("period_end") - F.expr(f"INTERVAL {ttl}"), F.lit(False)) if ttl else F.lit(False)
    rows = rows.withColumn("_expired", stale)
    rows = rows.withColumn("_run", F.sum(F.col("_expired").cast("int")).over(so_far))
    run = Window.partitionBy(*KEYS, "_run").orderBy("period_start").rowsBetween(Window.unboundedPreceding, 0)
    base = from_seed
    none = F.lit(None).cast("timestamp_ntz")
    before = base("news_acc_count", F.lit(0).cast("bigint"))
    first = F.first(F.when(has_news, F.col("period_start")), ignorenulls=True).over(run)
    latest = F.last(F.when(has_news, F.struct("period_end", "avg_news_score")), ignorenulls=True).over(run)
    acc = before + F.coalesce(F.sum("count").over(run), F.lit(0))
    rows = rows.withColumns({
        "start_batch_time": F.when((before == 0) & first.isNotNull(), first).otherwise(base("start_batch_time", none)),
        "last_batch_time": F.when(latest.isNotNull(), latest["period_end"]).otherwise(base("last_batch_time", none)),
        "news_acc_count": acc,
        "news_score": F.when(latest.isNotNull(), latest["avg_news_score"]).otherwise(base("news_score", F.lit(0.0))),
        "is_issue": base("is_issue", F.lit(False)) | (acc >= threshold),
        "news_count": F.coalesce("count", F.lit(0)).cast("bigint")})
    was = F.when(F.col("_expired"), False).otherwise(F.coalesce(F.lag("is_issue").over(w), F.col("_seed_is_issue")))
    return rows.withColumn("_opened", F.col("is_issue") & ~was).drop("count", "avg_news_score")


def _open_tags(raw: DataFrame, keywords: DataFrame, issues: DataFrame, every: str) -> DataFrame:
    """Posts with the tags that are open in their batch, in batches with an open issue only:
    posts meet the open intervals by their period (one array of categories per period)."""
    timed = assign_period(raw.filter(F.col("post_time").isNotNull()), every).drop("period_start", "period_end")
    by_period = issues.groupBy("batch_period").agg(F.collect_set("accident").alias("_open"))
    posts = join_small(with_post_id(timed), by_period, "batch_period", "inner")
    tagged = tag_mapped(clean_columns(posts, ("content", "title")), selected_pairs(keywords))
    return with_tags(tagged.withColumn("accident", F.array_intersect("accident", "_open")).drop("_open"))


def replay(raw_news: DataFrame, raw_posts: DataFrame, seed: DataFrame, categories, news_scorer: Scorer,
           keywords: DataFrame, post_scorer: Scorer, threshold: int = ISSUE_THRESHOLD, every: str = "1 hour",
           ttl: str | None = None, k: int = TOP_K, on_failure: int | None = 0,
           periods: list[str] | None = None) -> Replay:
    """G1 and G2 for every batch in one pass over each raw table.

    Articles are aggregated to (key, period). Running sums over a key's periods give the
    news state of every batch, so also the intervals in which an issue is open. Posts meet
    these by their period and category, are scored and aggregated per (category, period)
    and spread over the open entities, without the packed texts, which the fact rows take from
    their group. The issue score of each batch then needs that batch's
    counts, and an alert the score of the batch before (``lag``). Only rows per key and
    period are kept; windows partition by key, so a hot key costs one row per period.

    ``periods`` gives the schedule (of periods of length ``every``); by default it is every
    period from the earliest record to the latest."""
    starts = schedule([raw_news, raw_posts], every, periods)
    per = materialise(news_by_period(raw_news, categories, news_scorer, every, on_failure), "replay-per")
    dense = (seeded(seed).withColumn("_starts", starts).withColumn("period_start", F.explode("_starts"))
             .drop("_starts").withColumn("period_end", F.col("period_start") + F.expr(f"INTERVAL {every}"))
             .withColumn("batch_period", format_period("period_start", "period_end")))
    after_news = materialise(news_states(dense, per, threshold, ttl), "replay-news")
    issues = after_news.filter("is_issue").select(*KEYS, "batch_period")
    tagged = _open_tags(raw_posts, keywords, issues, every)
    scored = score_tagged(tagged, issues, post_scorer, on_failure, k=k, by=("batch_period",))
    # the packed texts of a group stand there once; a key's row meets them only in the facts
    grouped = materialise(group_aggregates(scored, k), "replay-posts")
    posts = spread_aggregates(scored, grouped)

    rows = after_news.join(posts.drop("top_comm").withColumnRenamed("count", "_n"), [*KEYS, "batch_period"], "left")
    w = Window.partitionBy(*KEYS).orderBy("period_start")
    run = Window.partitionBy(*KEYS, "_run").orderBy("period_start").rowsBetween(Window.unboundedPreceding, 0)
    base = from_seed
    latest = F.last(F.when(F.col("_n").isNotNull(), F.struct("avg_comm_score")), ignorenulls=True).over(run)
    counted, before = F.sum("_n").over(run), base("comm_acc_count", F.lit(0).cast("bigint"))
    rows = rows.withColumns({
        "comm_score": F.when(latest.isNotNull(), latest["avg_comm_score"]).otherwise(base("comm_score", F.lit(0.0))),
        "comm_acc_count": F.when(counted.isNotNull(), F.coalesce(before, F.lit(0)) + counted).otherwise(before),
        "comm_count": F.coalesce("_n", F.lit(0)).cast("bigint"),
        "dashboard_url": F.col("_seed_dashboard_url")})
    rows = rows.withColumn("issue_score", F.when(F.col("is_issue"), issue_score_col(rows))
                           .otherwise(base("issue_score", F.lit(0.0))))
    old = (F.when(F.col("_expired"), 0.0).when(F.row_number().over(w) == 1, F.col("_seed_issue_score"))
           .otherwise(F.lag("issue_score").over(w)))
    rows = rows.withColumn("_old", old)
    changed = severity(F.col("_old")) != severity(F.col("issue_score"))
    rows = rows.withColumn("is_alert", F.col("is_issue") & (F.col("_opened") | changed))
    rows = materialise(rows.select(*STATE_COLS, "batch_period", "period_end", "news_count", "comm_count",
                                   F.col("_n").isNotNull().alias("_has_posts"),
                                   "comm_positive_count", "comm_negative_count"), "replay-states")
    states = rows.select(*STATE_COLS, "batch_period")
    posted = rows.filter(F.col("is_issue") & F.col("_has_posts"))
    facts = posted.join(grouped.select(*scored.keys, "top_comm"), scored.keys).filter(F.col("top_comm").isNotNull()).select(
        *KEYS, "issue_score", "comm_count", "news_count", "start_batch_time", F.col("period_end").alias("batch_time"),
        "top_comm", "comm_positive_count", "comm_negative_count", "batch_period")
    news = per.select(*KEYS, "count", "avg_news_score", "batch_period")
    return Replay(states, news, posts, facts, render_alert(alertable(states, keep=("batch_period",)),
                                                           keep=("batch_period",)))


def replay_batches(raw_news: DataFrame, raw_posts: DataFrame | None, periods: list[str],
                   seed: DataFrame, categories, news_scorer: Scorer,
                   keywords: DataFrame | None = None, post_scorer: Scorer | None = None,
                   threshold: int = ISSUE_THRESHOLD, ttl: str | None = None, k: int = TOP_K,
                   checkpoint_every: int = 1) -> DataFrame:
    """Run G1 (and G2 when posts are given) for each period in order; returns
    the final state. ``periods`` is the schedule (a list of period strings),
    not data. The state's lineage is cut with a reliable checkpoint."""
    from ..operators.periods import in_period
    state = seed
    for i, p in enumerate(periods):
        s, e = (F.lit(p), F.lit(p))
        news_in = in_period(raw_news, parse_period_start(s), parse_period_end(e))
        nb = run_news(news_in, p, state, categories, news_scorer, threshold, ttl, evidence=False)
        state = nb.state
        if raw_posts is not None:
            posts_in = in_period(raw_posts, parse_period_start(s), parse_period_end(e))
            state = run_community(posts_in, p, state, keywords, post_scorer, nb.aggregate, k).state
        if checkpoint_every and (i + 1) % checkpoint_every == 0:
            state = state.checkpoint(eager=True)
    return state
