"""Community batch (G2): only when issues are open.

issues (E8) -> clean title and content (D1) -> tag with the open categories'
sub-keywords (D6, D4) -> explode (D5) -> attach entities (D7) -> score (D10) ->
statistics + top posts (D14-D17) -> fold (E7) -> score issues (E12, E13) ->
alert on change (E15) -> fact rows (E16, E17) -> alert payloads (F1-F3).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from ..config import TOP_K
from ..operators.aggregate import (POST_ID, aggregate_posts, join_aggregates, keep_top_texts,
                                   pack_posts, to_entities, top_k_posts, with_post_id)
from ..operators.alerts import alertable, render_alert
from ..operators.issue import alert_on_change, batch_view, score_issues, to_fact
from ..operators.joins import within_rows
from ..operators.scoring import Scorer, apply_scorer, materialise
from ..operators.state import fold_posts, issue_list
from ..operators.tagging import (clean_columns, expand_to_entities, explode_tags,
                                 select_keywords, selected_pairs, tag_mapped, with_tags)
from ..schemas import POST_AGG
from ..session import scratch_scope
from ..sources import io


@dataclass
class CommunityBatch:
    aggregate: DataFrame   # T4
    state: DataFrame       # state after the batch
    view: DataFrame        # E16
    fact: DataFrame        # T6 rows of this batch
    alerts: DataFrame      # F3 payloads


def _tag_arrays(raw: DataFrame, keywords: DataFrame, issues: DataFrame) -> DataFrame:
    """D1 (title and content) -> D6 + D4, one row per post with a tag."""
    kw = selected_pairs(select_keywords(keywords, issues))
    return with_tags(tag_mapped(clean_columns(with_post_id(raw), ("content", "title")), kw))


def tag_posts(raw: DataFrame, keywords: DataFrame, issues: DataFrame,
              require_mention: bool = False) -> DataFrame:
    """D1 -> D6 + D4 -> D5 -> D7: one row per (post, category, entity)."""
    return expand_to_entities(explode_tags(_tag_arrays(raw, keywords, issues)), issues,
                              require_mention)


@dataclass
class ScoredPosts:
    """Scored, tagged posts (materialised), a row per post and group ``keys``; texts only
    where a group's top posts may be. With ``issues`` the groups are still to be spread
    over the entities that have an open issue in them (``on``)."""

    rows: DataFrame
    keys: list[str]
    issues: DataFrame | None
    on: tuple[str, ...] = ("accident",)

    def spread(self, grouped: DataFrame) -> DataFrame:
        return grouped if self.issues is None else to_entities(grouped, self.issues, self.on)


def score_tagged(tagged: DataFrame, issues: DataFrame, scorer: Scorer, on_failure: int | None = 0,
                 require_mention: bool = False, k: int = TOP_K, by: tuple[str, ...] = ()) -> ScoredPosts:
    """Posts with their tag arrays -> scored rows per (post, category), or per (post,
    category, entity) if the score or the filter depends on the entity.

    ``by`` names further columns of the groups (a batch period), by which ``issues`` are
    matched too. A scorer that reads neither entity nor category sees every post once."""
    on = ("accident", *by)
    per_entity = require_mention or scorer.reads_any(["car_model"])

    def rows_of(posts):
        rows = explode_tags(posts)
        return expand_to_entities(rows, issues, require_mention, on=on) if per_entity else rows

    def scored_by(posts):
        return apply_scorer(posts, scorer, "comm_score", on_failure, materialise_costly=False)

    rows = (scored_by(rows_of(tagged)) if scorer.reads_any(["accident", "car_model"])
            else rows_of(scored_by(tagged)))
    keys = [*(["car_model"] if per_entity else []), *on]
    rows = rows.select(*keys, "link", "view_count", "comm_score", POST_ID, "content")
    rows = materialise(keep_top_texts(rows, k, keys), "scored-posts")
    return ScoredPosts(rows, keys, None if per_entity else issues, on)


def score_posts(raw: DataFrame, keywords: DataFrame, issues: DataFrame, scorer: Scorer,
                on_failure: int | None = 0, require_mention: bool = False,
                k: int = TOP_K) -> ScoredPosts:
    """Tagged, scored posts, materialised with the texts of possible top posts only: the
    text work (cleaning, keyword tests) and the scorer run once, and the two consumers
    (statistics, top-k) read a few small columns."""
    return score_tagged(_tag_arrays(raw, keywords, issues), issues, scorer, on_failure, require_mention, k)


def post_stats(posts: ScoredPosts) -> DataFrame:
    """D14 per (entity, category)."""
    return posts.spread(aggregate_posts(posts.rows, keys=posts.keys))


def top_posts(posts: ScoredPosts, k: int = TOP_K) -> DataFrame:
    """D15 per (entity, category), with the posts' cleaned texts."""
    return posts.spread(top_k_posts(posts.rows, k, keys=posts.keys))


def packed_posts(posts: ScoredPosts, k: int = TOP_K) -> DataFrame:
    """D16 per (entity, category)."""
    return posts.spread(pack_posts(top_k_posts(posts.rows, k, keys=posts.keys), posts.keys))


def group_aggregates(posts: ScoredPosts, k: int = TOP_K) -> DataFrame:
    """D14-D17 per group, not yet spread over the entities."""
    packed = pack_posts(top_k_posts(posts.rows, k, keys=posts.keys), posts.keys)
    return join_aggregates(packed, aggregate_posts(posts.rows, keys=posts.keys), posts.keys)


def spread_aggregates(posts: ScoredPosts, grouped: DataFrame) -> DataFrame:
    """T4 from the groups' aggregates."""
    more = [c for c in posts.on if c != "accident"]
    return posts.spread(grouped).select("car_model", "accident", *more, "top_comm", "avg_comm_score", "count",
                                        "comm_positive_count", "comm_negative_count")


def aggregate_batch(posts: ScoredPosts, k: int = TOP_K) -> DataFrame:
    """T4 (D14-D17): one row per (entity, category), aggregated per category first where
    the score allows it."""
    return materialise(spread_aggregates(posts, group_aggregates(posts, k)), "post-agg")


def run_community(raw: DataFrame, batch_period: str, state: DataFrame, keywords: DataFrame,
                  scorer: Scorer, news: DataFrame, k: int = TOP_K,
                  on_failure: int | None = 0, require_mention: bool = False) -> CommunityBatch:
    """One community batch as DataFrames."""
    spark = raw.sparkSession
    issues = issue_list(state)
    if within_rows(issues, 0):   # nothing open: the stage is skipped
        agg = io.empty(spark, POST_AGG)
        view = score_issues(state, news, agg)
        return CommunityBatch(agg, state, batch_view(view), to_fact(batch_view(view), batch_period),
                              render_alert(alertable(state)))
    posts = score_posts(raw, keywords, issues, scorer, on_failure, require_mention, k)
    agg = aggregate_batch(posts, k)   # one row per key
    folded = fold_posts(state, agg)
    scored_issues = score_issues(folded, news, agg)
    new_state = alert_on_change(folded, scored_issues)
    view = batch_view(scored_issues)
    return CommunityBatch(agg, new_state, view, to_fact(view, batch_period),
                          render_alert(alertable(new_state)))


def run_community_job(spark: SparkSession, raw_base: str, out_base: str, batch_period: str,
                      keywords: DataFrame, scorer: Scorer, k: int = TOP_K) -> CommunityBatch:
    """G2 over files. Reads the news stage's snapshot of this period
    (``state_news``) and writes the batch's final snapshot (``state``), T4 and
    the fact rows. With no open issue the state passes through unchanged. What is
    returned reads these outputs; scratch tables are deleted."""
    news = io.read_aggregate(spark, "news", f"{out_base}/news", batch_period)
    with scratch_scope(spark):
        raw = io.read_raw(spark, "posts", raw_base, batch_period)
        state = io.read_state(spark, f"{out_base}/state_news", batch_period + "~")
        res = run_community(raw, batch_period, state, keywords, scorer, news, k)
        io.write_aggregate(res.aggregate, f"{out_base}/posts", batch_period)
        io.append_fact(res.fact, f"{out_base}/fact", batch_period)
        io.write_state(res.state, f"{out_base}/state", batch_period)
    agg = io.read_aggregate(spark, "posts", f"{out_base}/posts", batch_period)
    state = io.read_state(spark, f"{out_base}/state", batch_period + "~")
    view = batch_view(score_issues(state, news, agg))
    return CommunityBatch(agg, state, view, to_fact(view, batch_period), render_alert(alertable(state)))
