"""DuckDB SQL equal to each registered query (the correctness oracle).

Written independently of the Spark code: plain SQL over the driver's views.
Regex classes spell out Java's ``\\s`` (which includes the vertical tab) since
RE2's ``\\s`` does not; ``regexp_replace`` gets the ``'g'`` flag.
"""

from __future__ import annotations

from ..config import (BATCH_A, BATCH_B, COMMUNITY_KEYWORDS, DASHBOARD_URL, EXPECTED_SOURCES,
                      EXPIRY_NOW, ISSUE_TTL, NEWS_CATEGORIES, ONE_BATCH, REPLAY_TTL)

CLEAN = r"[^가-힣a-zA-Z0-9 \t\n\x0B\f\r]"
WS = r"[\t\n\x0B\f\r \x1c-\x1f\x{85}\p{Z}]"
FMT = "%Y-%m-%d-%H-%M-%S"
ENTITY_WORDS = ["the", "und", "los", "les"]


def _values(rows, cols):
    body = ", ".join("(" + ", ".join(f"'{v}'" for v in r) + ")" for r in rows)
    return f"(SELECT * FROM (VALUES {body}) AS v({', '.join(cols)}))"


CATS = _values([(c,) for c in NEWS_CATEGORIES], ["accident"])
KW_ALL = _values([(c, k) for c, ks in COMMUNITY_KEYWORDS.items() for k in ks],
                 ["accident", "keyword"])


def _strip(x):
    return f"regexp_replace({x}, '^{WS}+|{WS}+$', '', 'g')"


def _pw(x, lo, mid, hi):
    x = f"CAST({x} AS DOUBLE)"
    return (f"(CASE WHEN {x} IS NULL THEN NULL WHEN {x} <= {lo} THEN 0.0::DOUBLE "
            f"WHEN {x} < {mid} THEN 0.5::DOUBLE * ({x} - {lo}) / {float(mid - lo)}::DOUBLE "
            f"WHEN {x} < {hi} THEN 0.5::DOUBLE + 0.5::DOUBLE * ({x} - {mid}) / "
            f"{float(hi - mid)}::DOUBLE ELSE 1.0::DOUBLE END)")


def _sev(x, op="<"):
    return f"(CASE WHEN {x} {op} 0.3 THEN 'a' WHEN {x} {op} 0.6 THEN 'b' ELSE 'c' END)"


def _period(ts, step):
    return (f"strftime(date_trunc('{step}', {ts}), '{FMT}') || '_' || "
            f"strftime(date_trunc('{step}', {ts}) + INTERVAL 1 {step}, '{FMT}')")


def _ts(period_part):
    return f"TIMESTAMP '{period_part}'"


BASE = f"""
news_raw AS (
  SELECT TIMESTAMP '2024-01-01 00:00:00' + to_minutes(doc_id) AS post_time,
         split_part(text, chr(10), 1) AS title, text AS content, lang AS source,
         'doc/' || CAST(doc_id AS VARCHAR) AS link, source AS keyword
  FROM documents),
scores AS (
  SELECT 'doc/' || CAST(doc_id AS VARCHAR) AS link,
         CASE WHEN toxic = 1 THEN 80 ELSE 20 END AS score FROM labels),
news_tagged AS (
  SELECT n.keyword AS car_model, n.title, n.cc AS content, n.link, n.post_time, c.accident
  FROM (SELECT *, regexp_replace(content, '{CLEAN}', '', 'g') AS cc FROM news_raw) n
  JOIN {CATS} c ON contains(n.title, c.accident) OR contains(n.cc, c.accident)),
news_scored AS (
  SELECT t.*, coalesce(s.score, 0) AS news_score
  FROM news_tagged t LEFT JOIN scores s USING (link)),
seed AS (
  SELECT e.car_model, c.accident, NULL::TIMESTAMP AS start_batch_time,
         NULL::TIMESTAMP AS last_batch_time, 0::BIGINT AS news_acc_count,
         0::BIGINT AS comm_acc_count, 0.0::DOUBLE AS news_score, 0.0::DOUBLE AS comm_score,
         0.0::DOUBLE AS issue_score, false AS is_issue, false AS is_alert,
         '{DASHBOARD_URL}' AS dashboard_url
  FROM (SELECT DISTINCT source AS car_model FROM documents) e, {CATS} c)"""


def _agg(name, where="TRUE"):
    return f"""{name} AS (
  SELECT car_model, accident, count(*) AS count, avg(news_score) AS avg_news_score
  FROM news_scored WHERE {where} GROUP BY car_model, accident)"""


def _step(name, prev, agg, start, end, clear_and_open=True):
    m = "a.count IS NOT NULL"
    acc = f"(s.news_acc_count + coalesce(a.count, 0))"
    if clear_and_open:
        issue = f"(s.is_issue OR ({acc} >= 10 AND s.is_issue = false))"
        alert = f"({acc} >= 10 AND s.is_issue = false)"
    else:
        issue, alert = "s.is_issue", "s.is_alert"
    return f"""{name} AS (
  SELECT s.car_model, s.accident,
         CASE WHEN {m} AND s.news_acc_count = 0 THEN {_ts(start)} ELSE s.start_batch_time END
           AS start_batch_time,
         CASE WHEN {m} THEN {_ts(end)} ELSE s.last_batch_time END AS last_batch_time,
         {acc} AS news_acc_count, s.comm_acc_count,
         CASE WHEN {m} THEN a.avg_news_score ELSE s.news_score END AS news_score,
         s.comm_score, s.issue_score, {issue} AS is_issue, {alert} AS is_alert, s.dashboard_url
  FROM {prev} s LEFT JOIN {agg} a USING (car_model, accident))"""


STATE_COLS = ("car_model, accident, start_batch_time, last_batch_time, news_acc_count, "
              "comm_acc_count, round(news_score, 6) AS news_score, "
              "round(comm_score, 6) AS comm_score, round(issue_score, 6) AS issue_score, "
              "is_issue, is_alert, dashboard_url")

def _bounds(period):
    """'yyyy-MM-dd-HH-mm-ss_yyyy-MM-dd-HH-mm-ss' -> two 'yyyy-MM-dd HH:mm:ss' strings."""
    return tuple(f"{x[:10]} {x[11:].replace('-', ':')}" for x in period.split("_"))


ONE, A, B = _bounds(ONE_BATCH), _bounds(BATCH_A), _bounds(BATCH_B)
IN_A = f"post_time >= {_ts(A[0])} AND post_time < {_ts(A[1])}"
IN_B = f"post_time >= {_ts(B[0])} AND post_time < {_ts(B[1])}"

NEWS_ONE = f"{BASE},\n{_agg('news_agg')},\n{_step('state_news', 'seed', 'news_agg', *ONE)}"

COMMUNITY = NEWS_ONE + f""",
issues AS (SELECT car_model, accident FROM state_news WHERE is_issue),
kw AS (SELECT * FROM {KW_ALL} WHERE accident IN (SELECT accident FROM issues)),
posts_clean AS (
  SELECT regexp_replace(split_part(text, chr(10), 1), '{CLEAN}', '', 'g') AS title,
         regexp_replace(text, '{CLEAN}', '', 'g') AS content, n_chars AS view_count,
         'doc/' || CAST(doc_id AS VARCHAR) AS link
  FROM documents),
posts_tagged AS (
  SELECT DISTINCT p.link, p.title, p.content, p.view_count, k.accident
  FROM posts_clean p JOIN kw k ON contains(p.title, k.keyword) OR contains(p.content, k.keyword)),
posts_ent AS (
  SELECT t.*, i.car_model FROM posts_tagged t
  LEFT JOIN (SELECT DISTINCT accident, car_model FROM issues) i USING (accident)),
posts_scored AS (
  SELECT p.*, coalesce(s.score, 0) AS comm_score FROM posts_ent p LEFT JOIN scores s USING (link)),
comm_stats AS (
  SELECT car_model, accident, avg(comm_score) AS avg_comm_score, count(*) AS count,
         count(*) FILTER (WHERE comm_score <= 45) AS comm_positive_count,
         count(*) FILTER (WHERE comm_score >= 55) AS comm_negative_count
  FROM posts_scored GROUP BY car_model, accident),
top AS (
  SELECT *, row_number() OVER (PARTITION BY car_model, accident
                               ORDER BY view_count DESC, link ASC) AS rank
  FROM posts_scored QUALIFY rank <= 5),
packed AS (
  SELECT car_model, accident,
         CAST(to_json(list({{'content': content, 'link': link}} ORDER BY rank)) AS VARCHAR)
           AS top_comm
  FROM top GROUP BY car_model, accident),
comm_agg AS (
  SELECT p.car_model, p.accident, p.top_comm, c.avg_comm_score, c.count,
         c.comm_positive_count, c.comm_negative_count
  FROM packed p LEFT JOIN comm_stats c USING (car_model, accident)),
state_comm AS (
  SELECT s.car_model, s.accident, s.start_batch_time, s.last_batch_time, s.news_acc_count,
         CASE WHEN c.count IS NOT NULL THEN coalesce(s.comm_acc_count, 0) + c.count
              ELSE s.comm_acc_count END AS comm_acc_count,
         s.news_score,
         CASE WHEN c.count IS NOT NULL THEN c.avg_comm_score ELSE s.comm_score END AS comm_score,
         s.issue_score, s.is_issue, s.is_alert, s.dashboard_url
  FROM state_news s LEFT JOIN comm_agg c USING (car_model, accident)),
si AS (
  SELECT s.*, coalesce(n.count, 0)::BIGINT AS news_count, coalesce(c.count, 0)::BIGINT AS comm_count,
         c.comm_positive_count, c.comm_negative_count, c.top_comm
  FROM state_comm s LEFT JOIN news_agg n USING (car_model, accident)
  LEFT JOIN comm_agg c USING (car_model, accident)
  WHERE s.is_issue),
si_norm AS (
  SELECT *, news_score / 100.0 AS n_news_score, {_pw('comm_score', 50, 75, 100)} AS n_comm_score,
         {_pw('news_count', 1, 5, 10)} AS n_news_count,
         {_pw('news_acc_count', 10, 20, 30)} AS n_news_acc_count,
         {_pw('comm_count', 1, 5, 10)} AS n_comm_count
  FROM si),
si_scored AS (
  SELECT *, coalesce(n_news_score, 0.0) * 0.2 + coalesce(n_comm_score, 0.0) * 0.2
            + coalesce(n_news_count, 0.0) * 0.1 + coalesce(n_news_acc_count, 0.0) * 0.2
            + coalesce(n_comm_count, 0.0) * 0.3 AS new_issue_score
  FROM si_norm),
state_final AS (
  SELECT s.car_model, s.accident, s.start_batch_time, s.last_batch_time, s.news_acc_count,
         s.comm_acc_count, s.news_score, s.comm_score,
         CASE WHEN x.new_issue_score IS NOT NULL THEN x.new_issue_score ELSE s.issue_score END
           AS issue_score,
         s.is_issue,
         CASE WHEN x.car_model IS NULL THEN s.is_alert
              WHEN s.is_alert = true THEN true
              WHEN {_sev('s.issue_score')} <> {_sev('x.new_issue_score')} THEN true
              ELSE false END AS is_alert,
         s.dashboard_url
  FROM state_comm s LEFT JOIN si_scored x USING (car_model, accident)),
fact AS (
  SELECT car_model, accident, round(new_issue_score, 6) AS issue_score, comm_count, news_count,
         start_batch_time, {_ts(ONE[1])} AS batch_time, top_comm, comm_positive_count,
         comm_negative_count
  FROM si_scored WHERE top_comm IS NOT NULL)"""

REPLAY = BASE + f""",
per AS (
  SELECT car_model, accident, date_trunc('hour', post_time) AS ps, count(*) AS cnt,
         avg(news_score) AS av
  FROM news_scored GROUP BY car_model, accident, date_trunc('hour', post_time)),
run AS (
  SELECT *, sum(cnt) OVER (PARTITION BY car_model, accident ORDER BY ps
                           ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS acc,
         row_number() OVER (PARTITION BY car_model, accident ORDER BY ps DESC) AS rn
  FROM per),
firsts AS (SELECT car_model, accident, min(ps) AS first_ps FROM run GROUP BY car_model, accident),
lasts AS (SELECT * FROM run WHERE rn = 1),
fin AS (SELECT date_trunc('hour', max(post_time)) AS f FROM news_raw),
replayed AS (
  SELECT s.car_model, s.accident,
         CASE WHEN l.acc IS NOT NULL THEN f.first_ps END AS start_batch_time,
         l.ps + INTERVAL 1 HOUR AS last_batch_time,
         coalesce(l.acc, 0)::BIGINT AS news_acc_count, s.comm_acc_count,
         coalesce(l.av, 0.0) AS news_score, s.comm_score, s.issue_score,
         coalesce(l.acc, 0) >= 10 AS is_issue,
         coalesce(l.ps = (SELECT f FROM fin) AND l.acc - l.cnt < 10 AND l.acc >= 10, false)
           AS is_alert,
         s.dashboard_url
  FROM seed s LEFT JOIN lasts l USING (car_model, accident)
  LEFT JOIN firsts f USING (car_model, accident))"""


# Replay with expiry after REPLAY_TTL: a key's hours are cut into runs where an
# hour follows the previous one by more than ttl + 1 hour; sums restart per run
# and the seed only counts for the first run. Rows whose last hour ended more
# than ttl before the end of the final hour are reset.
REPLAY_EXPIRY = BASE + f""",
per AS (
  SELECT car_model, accident, date_trunc('hour', post_time) AS ps, count(*) AS cnt,
         avg(news_score) AS av
  FROM news_scored GROUP BY car_model, accident, date_trunc('hour', post_time)),
cut AS (
  SELECT *, coalesce(ps > lag(ps) OVER (PARTITION BY car_model, accident ORDER BY ps)
                          + INTERVAL {REPLAY_TTL} + INTERVAL 1 HOUR, false)::INT AS brk
  FROM per),
runs AS (
  SELECT *, sum(brk) OVER (PARTITION BY car_model, accident ORDER BY ps
                           ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS r
  FROM cut),
run AS (
  SELECT *, sum(cnt) OVER (PARTITION BY car_model, accident, r ORDER BY ps
                           ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS acc,
         min(ps) OVER (PARTITION BY car_model, accident, r) AS run_ps,
         row_number() OVER (PARTITION BY car_model, accident ORDER BY ps DESC) AS rn
  FROM runs),
lasts AS (SELECT * FROM run WHERE rn = 1),
fin AS (SELECT date_trunc('hour', max(post_time)) AS f FROM news_raw),
folded AS (
  SELECT l.acc IS NOT NULL AS m, coalesce(l.r, 0) = 0 AS keep,
         l.run_ps, l.ps, l.acc, l.cnt, l.av, s.*
  FROM seed s LEFT JOIN lasts l USING (car_model, accident)),
stepped AS (
  SELECT car_model, accident,
         CASE WHEN m AND (CASE WHEN keep THEN news_acc_count ELSE 0 END) = 0 THEN run_ps
              WHEN keep THEN start_batch_time END AS start_batch_time,
         CASE WHEN m THEN ps + INTERVAL 1 HOUR WHEN keep THEN last_batch_time END
           AS last_batch_time,
         (CASE WHEN keep THEN news_acc_count ELSE 0 END + coalesce(acc, 0))::BIGINT
           AS news_acc_count,
         CASE WHEN keep THEN comm_acc_count ELSE 0 END::BIGINT AS comm_acc_count,
         CASE WHEN m THEN av WHEN keep THEN news_score ELSE 0.0 END AS news_score,
         CASE WHEN keep THEN comm_score ELSE 0.0 END AS comm_score,
         CASE WHEN keep THEN issue_score ELSE 0.0 END AS issue_score,
         (keep AND is_issue)
           OR CASE WHEN keep THEN news_acc_count ELSE 0 END + coalesce(acc, 0) >= 10 AS is_issue,
         coalesce(m AND ps = (SELECT f FROM fin) AND NOT (keep AND is_issue)
                  AND CASE WHEN keep THEN news_acc_count ELSE 0 END + acc - cnt < 10
                  AND CASE WHEN keep THEN news_acc_count ELSE 0 END + acc >= 10, false) AS is_alert,
         dashboard_url
  FROM folded),
replayed AS (
  SELECT car_model, accident,
         CASE WHEN stale THEN NULL ELSE start_batch_time END AS start_batch_time,
         CASE WHEN stale THEN NULL ELSE last_batch_time END AS last_batch_time,
         CASE WHEN stale THEN 0 ELSE news_acc_count END::BIGINT AS news_acc_count,
         CASE WHEN stale THEN 0 ELSE comm_acc_count END::BIGINT AS comm_acc_count,
         CASE WHEN stale THEN 0.0 ELSE news_score END AS news_score,
         CASE WHEN stale THEN 0.0 ELSE comm_score END AS comm_score,
         CASE WHEN stale THEN 0.0 ELSE issue_score END AS issue_score,
         NOT stale AND is_issue AS is_issue, NOT stale AND is_alert AS is_alert, dashboard_url
  FROM (SELECT *, coalesce(last_batch_time < (SELECT f FROM fin) + INTERVAL 1 HOUR
                                              - INTERVAL {REPLAY_TTL}, false) AS stale
        FROM stepped))"""

# Both stages batch by batch: one recursion step per hour from the state before, with the
# hour's article and post aggregates. Written as the batch jobs run, not as running sums.
STEPS = BASE + f""",
per AS (
  SELECT car_model, accident, date_trunc('hour', post_time) AS ps, count(*)::BIGINT AS n, avg(news_score) AS av
  FROM news_scored GROUP BY ALL),
posts AS (
  SELECT p.link, p.content, p.views, p.ps, k.accident, coalesce(s.score, 0) AS score
  FROM (SELECT 'doc/' || CAST(doc_id AS VARCHAR) AS link, n_chars AS views,
               date_trunc('hour', TIMESTAMP '2024-01-01 00:00:00' + to_minutes(doc_id)) AS ps,
               regexp_replace(split_part(text, chr(10), 1), '{CLEAN}', '', 'g') AS title,
               regexp_replace(text, '{CLEAN}', '', 'g') AS content FROM documents) p
  JOIN {KW_ALL} k ON contains(p.title, k.keyword) OR contains(p.content, k.keyword)
  LEFT JOIN scores s USING (link)
  GROUP BY ALL),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY accident, ps ORDER BY views DESC, link) AS r FROM posts),
comm AS (
  SELECT accident, ps, count(*)::BIGINT AS c, avg(score) AS cs, count(*) FILTER (WHERE score <= 45) AS pos,
         count(*) FILTER (WHERE score >= 55) AS neg,
         CAST(to_json(list({{'content': content, 'link': link}} ORDER BY r) FILTER (WHERE r <= 5)) AS VARCHAR) AS top
  FROM ranked GROUP BY accident, ps),
hours AS (
  SELECT unnest(generate_series(date_trunc('hour', min(post_time)), date_trunc('hour', max(post_time)),
                                INTERVAL 1 HOUR)) AS ps FROM news_raw),
steps AS (
  SELECT h.ps - INTERVAL 1 HOUR AS ps, s.car_model, s.accident, s.start_batch_time, s.last_batch_time,
         s.news_acc_count, s.comm_acc_count, s.news_score, s.comm_score, s.issue_score, s.is_issue, s.is_alert,
         s.dashboard_url, 0::BIGINT AS news_count, NULL::BIGINT AS c, NULL::BIGINT AS pos, NULL::BIGINT AS neg,
         NULL::VARCHAR AS top
  FROM seed s CROSS JOIN (SELECT min(ps) AS ps FROM hours) h
  UNION ALL
  SELECT ps, car_model, accident, start_batch_time, last_batch_time, acc, comm_acc, news_score, comm_score,
         CASE WHEN issue THEN score ELSE issue_score END, issue,
         issue AND (opened OR {_sev('issue_score')} <> {_sev('score')}), dashboard_url, n, c, pos, neg, top
  FROM (
    SELECT *, coalesce(news_score / 100.0, 0) * 0.2 + coalesce({_pw('comm_score', 50, 75, 100)}, 0) * 0.2
              + {_pw('n', 1, 5, 10)} * 0.1 + {_pw('acc', 10, 20, 30)} * 0.2
              + {_pw('coalesce(c, 0)', 1, 5, 10)} * 0.3 AS score
    FROM (
      SELECT f.* EXCLUDE (comm_score, comm_acc), f.issue AND x.c IS NOT NULL AS hit,
             CASE WHEN hit THEN x.cs ELSE f.comm_score END AS comm_score,
             f.comm_acc + CASE WHEN hit THEN x.c ELSE 0 END AS comm_acc,
             CASE WHEN hit THEN x.c END AS c, CASE WHEN hit THEN x.pos END AS pos,
             CASE WHEN hit THEN x.neg END AS neg, CASE WHEN hit THEN x.top END AS top
      FROM (
        SELECT ps, car_model, accident, dashboard_url, n,
               CASE WHEN NOT stale THEN s END AS start_batch_time, CASE WHEN NOT stale THEN l END AS last_batch_time,
               CASE WHEN stale THEN 0 ELSE a END AS acc, CASE WHEN stale THEN 0 ELSE comm_acc_count END AS comm_acc,
               CASE WHEN stale THEN 0.0 ELSE v END AS news_score,
               CASE WHEN stale THEN 0.0 ELSE comm_score END AS comm_score,
               CASE WHEN stale THEN 0.0 ELSE issue_score END AS issue_score,
               NOT (NOT stale AND is_issue) AND acc >= 10 AS opened, (NOT stale AND is_issue) OR acc >= 10 AS issue
        FROM (
          SELECT b.* EXCLUDE (ps, c, pos, neg, top), b.ps + INTERVAL 1 HOUR AS ps, coalesce(p.n, 0) AS n,
                 b.news_acc_count + coalesce(p.n, 0) AS a,
                 CASE WHEN p.n > 0 AND b.news_acc_count = 0 THEN b.ps + INTERVAL 1 HOUR ELSE b.start_batch_time END AS s,
                 CASE WHEN p.n > 0 THEN b.ps + INTERVAL 2 HOUR ELSE b.last_batch_time END AS l,
                 CASE WHEN p.n > 0 THEN p.av ELSE b.news_score END AS v,
                 coalesce(l < b.ps + INTERVAL 2 HOUR - INTERVAL {REPLAY_TTL}, false) AS stale
          FROM steps b JOIN hours h ON h.ps = b.ps + INTERVAL 1 HOUR
          LEFT JOIN per p ON p.ps = h.ps AND p.car_model = b.car_model AND p.accident = b.accident)) f
      LEFT JOIN comm x ON x.ps = f.ps AND x.accident = f.accident))),
batches AS (
  SELECT *, strftime(ps, '{FMT}') || '_' || strftime(ps + INTERVAL 1 HOUR, '{FMT}') AS batch_period
  FROM steps WHERE ps >= (SELECT min(ps) FROM hours))"""


def _with(ctes, select):
    return f"WITH {ctes}\n{select}"


def _events_hour():
    return (f"SELECT *, date_trunc('hour', ts) AS ps, {_period('ts', 'hour')} AS batch_period "
            "FROM events")


SQL: dict[str, str] = {}

# ------------------------------------------------------------------ A
SQL["a1_read_raw"] = _with(BASE, f"""SELECT post_time, title, content, source, link, keyword,
  {_period('post_time', 'day')} AS batch_period FROM news_raw""")
SQL["a2_read_aggregate"] = _with(
    BASE + ",\n" + _agg("agg_a", IN_A) + ",\n" + _agg("agg_b", IN_B),
    f"""SELECT car_model, accident, count, round(avg_news_score, 6) AS avg_news_score,
  '{BATCH_A}' AS batch_period FROM agg_a
UNION ALL
SELECT car_model, accident, count, round(avg_news_score, 6) AS avg_news_score,
  '{BATCH_B}' AS batch_period FROM agg_b""")
SQL["a3_write_aggregate"] = _with(COMMUNITY, """SELECT car_model, accident, top_comm,
  round(avg_comm_score, 6) AS avg_comm_score, count, comm_positive_count, comm_negative_count
  FROM comm_agg""")
_TWO = (BASE + ",\n" + _agg("agg_a", IN_A) + ",\n" + _agg("agg_b", IN_B) + ",\n"
        + _step("state_a", "seed", "agg_a", *A) + ",\n" + _step("state_b", "state_a", "agg_b", *B))
SQL["a4_write_records"] = _with(BASE, f"""SELECT post_time, title, content, source, link, keyword,
  '{BATCH_A}' AS batch_period FROM news_raw WHERE {IN_A}
UNION ALL
SELECT post_time, title, content, source, link, keyword, '{BATCH_B}' AS batch_period
  FROM news_raw WHERE {IN_B}""")
SQL["a7_config_tables"] = _with(BASE, f"""SELECT accident, keyword FROM {KW_ALL} k
  WHERE accident IN (SELECT accident FROM news_tagged)""")
SQL["a5_state_snapshots"] = _with(_TWO, f"SELECT {STATE_COLS} FROM state_b")
SQL["a6_append_fact"] = _with(COMMUNITY, "SELECT * FROM fact")
_HREF = r'<a\s[^>]*href="([^"]*)"'
SQL["a8_links_csv"] = f"SELECT unnest(regexp_extract_all(html, '{_HREF}', 1)) AS link FROM pages"
SQL["a9_union_sources"] = _with(BASE, """SELECT link, source, keyword FROM news_raw
  UNION ALL SELECT link, source, keyword FROM news_raw WHERE source = 'en'""")

# ------------------------------------------------------------------ B
SQL["b1_parse_period"] = f"""SELECT DISTINCT {_period('ts', 'hour')} AS batch_period,
  date_trunc('hour', ts) AS period_start, date_trunc('hour', ts) + INTERVAL 1 HOUR AS period_end
  FROM events"""
SQL["b2_format_period"] = f"""SELECT event_id, {_period('ts', 'hour')} AS batch_period,
  {_period('ts', 'day')} AS day_period FROM events"""
SQL["b3_in_period"] = """SELECT event_id, ts, event_type FROM events
  WHERE ts >= TIMESTAMP '2024-01-01 02:00:00' AND ts < TIMESTAMP '2024-01-01 09:00:00'"""
SQL["b3_in_period_closed"] = """SELECT event_id, ts FROM events
  WHERE ts >= (SELECT min(ts) FROM events)
    AND ts <= (SELECT min(ts) FROM events) + INTERVAL 3 HOUR"""
SQL["b4_in_time_of_day"] = """SELECT event_id, ts FROM events
  WHERE strftime(ts, '%H:%M') >= '09:00' AND strftime(ts, '%H:%M') < '17:30'"""
SQL["b5_assign_period"] = f"""SELECT batch_period, ps AS period_start, event_type, count(*) AS n,
  round(sum(value), 6) AS value FROM ({_events_hour()}) GROUP BY batch_period, ps, event_type"""
SQL["b6_missing_sources"] = f"""SELECT p.batch_period, s.source
  FROM (SELECT DISTINCT batch_period FROM ({_events_hour()})) p,
       {_values([(x,) for x in EXPECTED_SOURCES], ['source'])} s
  WHERE NOT EXISTS (SELECT 1 FROM ({_events_hour()}) e
                    WHERE e.batch_period = p.batch_period AND e.event_type = s.source)"""
SQL["b7_period_from_marker"] = f"""SELECT DISTINCT event_type AS source, batch_period
  FROM ({_events_hour()})"""
SQL["b8_sort_by_time"] = "SELECT event_id, ts, event_type FROM events"

# ------------------------------------------------------------------ C
def _unescape(x):
    """The character references that the pages have."""
    return f"regexp_replace(regexp_replace({x}, '&quot;?', '\"', 'g'), '&amp;?', '&', 'g')"


_ARTICLE = "regexp_extract(html, '(?s)<article>(.*)</article>', 1)"
_TEXT = _unescape(f"regexp_replace(regexp_replace({_ARTICLE}, '(?s)<h1>.*?</h1>', ''), '<[^>]*>', ' ', 'g')")
_CONTENT = f"trim(regexp_replace({_TEXT}, '{WS}+', ' ', 'g'))"
_H1 = _unescape("regexp_extract(html, '(?s)<h1>(.*?)</h1>', 1)")
_NAV = "regexp_extract(html, '(?s)<nav>(.*?)</nav>', 1)"
SQL["c1_extract_records"] = f"""SELECT TIMESTAMP '2024-01-01 00:00:00' AS post_time, {_H1} AS title,
  coalesce(nullif({_CONTENT}, ''), ' ') AS content,
  len(regexp_extract_all({_ARTICLE}, '<p>'))::BIGINT AS view_count,
  len(regexp_extract_all({_NAV}, '<a '))::BIGINT AS like_count,
  regexp_extract(html, 'lang="([^"]*)"', 1) AS source, url AS link FROM pages"""
SQL["c1_news_records"] = f"""SELECT h.t AS post_time, {_strip(_H1)} AS title,
  CASE WHEN ends_with(c, '.') THEN {_strip("left(c, length(c) - 1)")} ELSE c END AS content,
  'pages' AS source, p.url AS link, h.keyword
  FROM (SELECT url, html, {_CONTENT} AS c FROM pages) p
  JOIN (SELECT DISTINCT q.url, w.keyword, TIMESTAMP '2024-01-01 00:00:00' + to_minutes(page_id) AS t
        FROM pages q JOIN {_values([(x,) for x in ENTITY_WORDS], ['keyword'])} w
        ON contains(regexp_extract(html, '(?s)<title>(.*?)</title>', 1), w.keyword)) h USING (url)
  WHERE h.t >= TIMESTAMP '2024-01-01 01:00:00' AND h.t < TIMESTAMP '2024-01-09 00:00:00'"""
SQL["c2_drop_blocks"] = """SELECT page_id, regexp_replace(regexp_replace(regexp_replace(regexp_replace(html,
  '(?s)<div class="ad">.*?</div>', ''), '(?s)<nav>.*?</nav>', ''), '(?s)<footer>.*?</footer>', ''),
  '(?s)<b>.*</article>', '</article>') AS html FROM pages"""
SQL["c2_page_spans"] = """SELECT page_id, tag, CAST(depth AS INTEGER) AS depth, classes,
  strpos(html, o) - 1 AS "begin", strpos(html, o) - 1 + length(o) AS inner_begin,
  strpos(html, o) - 1 + strpos(substr(html, strpos(html, o)), c) - 1 AS inner_end,
  strpos(html, o) - 1 + strpos(substr(html, strpos(html, o)), c) - 1 + length(c) AS "end"
  FROM pages, (VALUES ('div', 2, 'ad', '<div class="ad">', '</div>'),
                      ('h1', 3, '', '<h1>', '</h1>')) v(tag, depth, classes, o, c)
  WHERE contains(html, o)"""
SQL["c8_fill_defaults"] = """SELECT 'doc/' || doc_id AS link,
  CASE WHEN lang <> 'en' THEN TIMESTAMP '2024-01-01 00:00:00' + to_minutes(doc_id)
       ELSE TIMESTAMP '2024-01-01 00:00:00' END AS post_time,
  CASE WHEN length(split_part(text, chr(10), 1)) < 40 THEN split_part(text, chr(10), 1) ELSE 'Untitled' END AS title,
  CASE WHEN n_chars > 200 AND text <> '' THEN text ELSE ' ' END AS content,
  CASE WHEN n_chars <> l THEN n_chars ELSE 0 END AS view_count,
  CASE WHEN l > 1 THEN l ELSE 0 END AS like_count
  FROM (SELECT *, len(string_split(text, chr(10)))::BIGINT AS l FROM documents)"""
SQL["c1_title_tag"] = r"""SELECT page_id,
  regexp_extract(html, '(?s)<title(?:\s[^>]*)?>(.*?)</title>', 1) AS title FROM pages"""
SQL["c3_join_paragraphs"] = f"""SELECT doc_id,
  array_to_string(list_transform(string_split(text, chr(10)), lambda x: {_strip('x')}), ' ') AS joined
  FROM documents"""
SQL["c4_collapse_ws"] = f"""SELECT doc_id,
  trim(regexp_replace(text, '{WS}+', ' ', 'g')) AS collapsed FROM documents"""
SQL["c5_strip_suffix"] = f"""SELECT doc_id,
  CASE WHEN ends_with(t, '.') THEN {_strip('left(t, length(t) - 1)')} ELSE t END AS stripped
  FROM (SELECT doc_id, text AS t FROM documents)"""
SQL["c6_parse_local_time"] = """SELECT event_id, date_trunc('minute', ts) AS p_marker,
  date_trunc('minute', ts) AS p_24, date_trunc('second', ts) AS p_compact,
  NULL::TIMESTAMP AS p_junk FROM events"""
SQL["c7_parse_count"] = """SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k,
  CAST(round(value * 1000) AS BIGINT) AS big, 0::BIGINT AS junk FROM events"""
SQL["c10_explode_search"] = """SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k
  FROM events UNION ALL SELECT event_id, user_id AS k FROM events"""
SQL["c11_extract_links"] = f"""SELECT page_id, CAST(pos - 1 AS INTEGER) AS pos,
  CASE WHEN starts_with(l, '/') THEN 'https://site.example' || l ELSE l END AS link
  FROM (SELECT page_id, unnest(regexp_extract_all(html, '{_HREF}', 1)) AS l,
               unnest(generate_series(1, len(regexp_extract_all(html, '{_HREF}', 1)))) AS pos
        FROM pages)"""
SQL["c11_select_links"] = f"""SELECT page_id, CAST(i - 1 AS INTEGER) AS pos, link[i] AS link, {_unescape("text[i]")} AS text
  FROM (SELECT page_id, unnest(generate_series(1, len(link))) AS i, link, text
        FROM (SELECT page_id, regexp_extract_all({_NAV}, '<li><a href="([^"]*)">([^<]*)</a></li>', 1) AS link,
                     regexp_extract_all({_NAV}, '<li><a href="([^"]*)">([^<]*)</a></li>', 2) AS text FROM pages))"""
SQL["c9_absolute_link"] = f"""SELECT page_id,
  CASE WHEN starts_with(l, '/') THEN 'https://m.example' || l ELSE l END AS link
  FROM (SELECT page_id, unnest(regexp_extract_all(html, '{_HREF}', 1)) AS l FROM pages)"""
SQL["c12_drop_failed"] = _with(BASE, """SELECT n.link, s.score FROM news_raw n
  JOIN scores s USING (link)""")
SQL["c13_match_entities"] = _with(BASE, f"""SELECT n.link, w.keyword FROM news_raw n
  JOIN {_values([(x,) for x in ENTITY_WORDS], ['keyword'])} w
  ON contains(n.title, w.keyword) OR contains(n.content, w.keyword)""")

SQL["c13_match_entity_table"] = _with(BASE, """SELECT n.link, w.entity FROM news_raw n
  JOIN (SELECT DISTINCT entity FROM (SELECT unnest(regexp_split_to_array(text, '[^a-zA-Z]+')) AS entity
        FROM benchmark) WHERE length(entity) >= 5) w
  ON contains(n.title, w.entity) OR contains(n.content, w.entity)""")

# ------------------------------------------------------------------ D
SQL["d1_clean_text"] = f"SELECT doc_id, regexp_replace(text, '{CLEAN}', '', 'g') AS cleaned FROM documents"
SQL["d2_project_news"] = _with(BASE, "SELECT keyword AS car_model, title, content, link FROM news_raw")
_flat = ", ".join(f"CASE WHEN contains(title, '{c}') OR contains(cc, '{c}') THEN '{c}' END"
                  for c in NEWS_CATEGORIES)
SQL["d3_tag_flat"] = _with(BASE, f"""SELECT link,
  array_to_string(list_transform([{_flat}], lambda x: coalesce(x, '-')), ',') AS tags
  FROM (SELECT *, regexp_replace(content, '{CLEAN}', '', 'g') AS cc FROM news_raw)""")
_mapped = ", ".join(f"CASE WHEN contains(t, '{k}') OR contains(c, '{k}') THEN '{cat}' END"
                    for cat, ks in COMMUNITY_KEYWORDS.items() for k in ks)
SQL["d4_tag_mapped"] = f"""SELECT link,
  array_to_string(list_sort(list_distinct(list_filter([{_mapped}], lambda x: x IS NOT NULL))), ',')
    AS tags
  FROM (SELECT 'doc/' || CAST(doc_id AS VARCHAR) AS link,
               regexp_replace(split_part(text, chr(10), 1), '{CLEAN}', '', 'g') AS t,
               regexp_replace(text, '{CLEAN}', '', 'g') AS c FROM documents)"""
SQL["d5_explode_tags"] = _with(BASE, "SELECT car_model, accident, link FROM news_tagged")
SQL["d6_select_keywords"] = _with(COMMUNITY, "SELECT accident, keyword FROM kw")
SQL["d7_expand_to_entities"] = _with(COMMUNITY, "SELECT link, accident, car_model FROM posts_ent")
SQL["d8_render_prompt"] = _with(BASE, """SELECT link, accident,
  printf('[%s / %s] %s :: %s', car_model, accident, title, content) AS prompt FROM news_tagged""")
SQL["d9_parse_score"] = """SELECT event_id,
  CAST(json_extract_string(props, '$.k') AS INTEGER) AS s_plain,
  CAST(json_extract_string(props, '$.k') AS INTEGER) AS s_padded, 0 AS s_decimal,
  CAST(json_extract_string(props, '$.k') AS INTEGER) AS s_signed, 0 AS s_suffixed,
  CAST(json_extract_string(props, '$.k') AS INTEGER) AS s_response, 0 AS s_malformed
  FROM events"""
SQL["d10_apply_scorer"] = _with(BASE, "SELECT car_model, accident, link, news_score FROM news_scored")
SQL["d11_fallback_score"] = _with(BASE, """SELECT t.car_model, t.accident, t.link,
  CAST(coalesce(s.score, least(length(t.title), 100)) AS INTEGER) AS news_score
  FROM news_tagged t LEFT JOIN scores s USING (link)""")
SQL["d12_materialise_scores"] = _with(BASE, """SELECT car_model, accident, link,
  CAST(least(length(content) // 50, 100) AS INTEGER) AS news_score FROM news_tagged""")
SQL["d12_cached_scores"] = _with(BASE, f"""SELECT car_model, accident, link,
  CAST(least(length(content) // 50, 100) AS INTEGER) AS news_score,
  CASE WHEN {IN_A} THEN '{BATCH_A}' ELSE '{BATCH_B}' END AS batch_period
  FROM news_tagged WHERE ({IN_A}) OR ({IN_B})""")
SQL["d13_aggregate_news"] = _with(NEWS_ONE, """SELECT car_model, accident, count,
  round(avg_news_score, 6) AS avg_news_score FROM news_agg""")
SQL["d13_news_evidence"] = _with(BASE, "SELECT car_model, accident, content, link FROM news_scored")
SQL["d13_packed_news"] = _with(BASE, """SELECT car_model, accident, 0 AS chunk,
  count(*) AS n_items,
  CAST(to_json(list({'content': content, 'link': link} ORDER BY link, content)) AS VARCHAR) AS news
  FROM news_scored GROUP BY car_model, accident""")
SQL["d14_aggregate_posts"] = _with(COMMUNITY, """SELECT car_model, accident,
  round(avg_comm_score, 6) AS avg_comm_score, count, comm_positive_count, comm_negative_count
  FROM comm_stats""")
SQL["d15_top_k_posts"] = _with(COMMUNITY, """SELECT car_model, accident, CAST(rank AS INTEGER) AS rank,
  link, view_count FROM top""")
SQL["d16_pack_posts"] = _with(COMMUNITY, "SELECT car_model, accident, top_comm FROM packed")
SQL["d17_join_aggregates"] = SQL["a3_write_aggregate"]

# ------------------------------------------------------------------ E
SQL["e1_fold_news"] = _with(BASE + ",\n" + _agg("news_agg") + ",\n"
                            + _step("folded", "seed", "news_agg", *ONE, clear_and_open=False),
                            f"SELECT {STATE_COLS} FROM folded")
SQL["e2_start_on_first"] = _with(_TWO, """SELECT car_model, accident, start_batch_time,
  last_batch_time, news_acc_count FROM state_b""")
SQL["e4_clear_alerts"] = _with(_TWO, "SELECT car_model, accident, is_issue, is_alert FROM state_b")
SQL["e3_append_evidence"] = _with(BASE, f"""
SELECT car_model, accident, content, link, '{BATCH_A}' AS batch_period
  FROM news_scored WHERE {IN_A}
UNION ALL
SELECT car_model, accident, content, link, '{BATCH_B}' AS batch_period
  FROM news_scored WHERE {IN_B}""")
SQL["e5_open_issues"] = _with(NEWS_ONE, f"SELECT {STATE_COLS} FROM state_news")
_STALE = (f"last_batch_time < {_ts(_bounds(EXPIRY_NOW)[1])} - INTERVAL {ISSUE_TTL}")
SQL["e6_expire_issues"] = _with(_TWO, f"""SELECT car_model, accident,
  CASE WHEN {_STALE} THEN NULL ELSE start_batch_time END AS start_batch_time,
  CASE WHEN {_STALE} THEN NULL ELSE last_batch_time END AS last_batch_time,
  CASE WHEN {_STALE} THEN 0 ELSE news_acc_count END AS news_acc_count,
  CASE WHEN {_STALE} THEN 0 ELSE comm_acc_count END AS comm_acc_count,
  round(CASE WHEN {_STALE} THEN 0.0 ELSE news_score END, 6) AS news_score,
  round(CASE WHEN {_STALE} THEN 0.0 ELSE comm_score END, 6) AS comm_score,
  round(CASE WHEN {_STALE} THEN 0.0 ELSE issue_score END, 6) AS issue_score,
  CASE WHEN {_STALE} THEN false ELSE is_issue END AS is_issue,
  CASE WHEN {_STALE} THEN false ELSE is_alert END AS is_alert, dashboard_url
  FROM state_b""")
SQL["e7_fold_posts"] = _with(COMMUNITY, f"SELECT {STATE_COLS} FROM state_comm")
SQL["e8_issue_list"] = _with(NEWS_ONE, "SELECT car_model, accident FROM state_news WHERE is_issue")
SQL["e9_distinct_entities"] = _with(NEWS_ONE, """SELECT DISTINCT car_model FROM state_news
  WHERE is_issue""")
SQL["e10_piecewise"] = f"SELECT event_id, round({_pw('value', 20, 50, 100)}, 6) AS p FROM events"
SQL["e11_normalise"] = _with(COMMUNITY, """SELECT car_model, accident,
  round(n_news_score, 6) AS n_news_score, round(n_comm_score, 6) AS n_comm_score,
  round(n_news_count, 6) AS n_news_count, round(n_news_acc_count, 6) AS n_news_acc_count,
  round(n_comm_count, 6) AS n_comm_count FROM si_norm""")
SQL["e12_attach_batch_counts"] = _with(COMMUNITY, """SELECT car_model, accident, news_count,
  comm_count, comm_positive_count, comm_negative_count, top_comm FROM si""")
SQL["e13_issue_score"] = _with(COMMUNITY, """SELECT car_model, accident,
  round(new_issue_score, 6) AS issue_score FROM si_scored""")
SQL["e14_severity"] = _with(COMMUNITY, f"""SELECT car_model, accident,
  {_sev('round(new_issue_score, 6)')} AS severity,
  {_sev('round(new_issue_score, 6)', '<=')} AS severity_inclusive FROM si_scored""").replace(
    "'a'", "'관심'").replace("'b'", "'주의'").replace("'c'", "'긴급'")
SQL["e15_alert_on_change"] = _with(COMMUNITY, f"SELECT {STATE_COLS} FROM state_final")
SQL["e16_batch_view"] = _with(COMMUNITY, """SELECT car_model, accident, start_batch_time,
  last_batch_time, news_acc_count, comm_acc_count, round(news_score, 6) AS news_score,
  round(comm_score, 6) AS comm_score, is_issue, is_alert, dashboard_url, news_count, comm_count,
  comm_positive_count, comm_negative_count, top_comm,
  round(new_issue_score, 6) AS issue_score FROM si_scored""")
SQL["e17_to_fact"] = SQL["a6_append_fact"]
SQL["e18_parse_top_posts"] = _with(COMMUNITY, """SELECT t.car_model, t.accident,
  CAST(t.rank - 1 AS INTEGER) AS pos, t.link FROM top t JOIN fact f USING (car_model, accident)""")
SQL["e19_seed_state"] = _with(BASE, f"SELECT {STATE_COLS} FROM seed")

# ------------------------------------------------------------------ F
SQL["f1_alertable"] = _with(COMMUNITY, """SELECT car_model, accident, start_batch_time,
  news_acc_count, comm_acc_count, round(issue_score, 6) AS issue_score, dashboard_url
  FROM state_final WHERE is_alert""")
_lvl = ("CASE WHEN x <= 0.3 THEN '관심 🟡' WHEN x <= 0.6 THEN '주의 🟠' ELSE '긴급 🚨' END")
_col = ("CASE WHEN x <= 0.3 THEN '#FFD700' WHEN x <= 0.6 THEN '#FFA500' ELSE '#FF0000' END")
SQL["f2_alert_level"] = _with(COMMUNITY, f"""SELECT car_model, accident,
  {_lvl.replace('x', 'round(new_issue_score, 6)')} AS level,
  {_col.replace('x', 'round(new_issue_score, 6)')} AS color FROM si_scored""")
_L, _C = _lvl.replace("x", "issue_score"), _col.replace("x", "issue_score")
SQL["f3_render_alert"] = _with(COMMUNITY, f"""SELECT car_model, accident, {_L} AS level,
  {_C} AS color,
  CAST(json_object(
    'text', '🚨 ' || car_model || ' ' || accident || ' (' || ({_L}) || ')' || chr(10) || chr(8203),
    'attachments', json_array(json_object(
      'color', {_C},
      'fields', json_array(
        json_object('title', '이슈 주의도', 'value', {_L}, 'short', false),
        json_object('title', '이슈 내용', 'value', car_model || ' ' || accident, 'short', false),
        json_object('title', '이슈 최초 발생',
                    'value', strftime(start_batch_time, '%Y-%m-%dT%H:%M:%S'), 'short', false),
        json_object('title', '대시보드 링크', 'value', dashboard_url, 'short', false))))
  ) AS VARCHAR) AS payload
  FROM state_final WHERE is_alert""")

# ------------------------------------------------------------------ G
SQL["g1_run_news"] = SQL["e5_open_issues"]
SQL["g2_run_community"] = SQL["e17_to_fact"]
SQL["g3_replay_news"] = _with(REPLAY, f"SELECT {STATE_COLS} FROM replayed")
SQL["g3_replay_news_expiry"] = _with(REPLAY_EXPIRY, f"SELECT {STATE_COLS} FROM replayed")
SQL["g3_replay_states"] = f"WITH RECURSIVE {STEPS}\nSELECT {STATE_COLS}, batch_period FROM batches"
SQL["g3_replay_facts"] = f"""WITH RECURSIVE {STEPS}
SELECT car_model, accident, round(issue_score, 6) AS issue_score, c AS comm_count, news_count, start_batch_time,
  ps + INTERVAL 1 HOUR AS batch_time, top AS top_comm, pos AS comm_positive_count, neg AS comm_negative_count,
  batch_period FROM batches WHERE is_issue AND top IS NOT NULL"""
SQL["g3_replay_alerts"] = f"""WITH RECURSIVE {STEPS}
SELECT car_model, accident, batch_period, {_lvl.replace('x', 'issue_score')} AS level,
  {_col.replace('x', 'issue_score')} AS color FROM batches WHERE is_alert"""
SQL["g4_stream_news"] = SQL["g3_replay_news"]
SQL["g4_stream_news_expiry"] = SQL["g3_replay_news_expiry"]
_COMPLETE = """
complete AS (
  SELECT ps FROM (SELECT date_trunc('hour', post_time) AS ps, source FROM news_raw
                  WHERE source IN ('de', 'en', 'es', 'fr') GROUP BY ALL HAVING count(*) >= 5)
  GROUP BY ps HAVING count(*) = 4),"""
_HOUR = "date_trunc('hour', post_time)"
_GATED = (REPLAY.replace("\nper AS (", _COMPLETE + "\nper AS (")
          .replace(f"FROM news_scored GROUP BY car_model, accident, {_HOUR}",
                   f"FROM news_scored WHERE {_HOUR} IN (SELECT ps FROM complete) GROUP BY car_model, accident, {_HOUR}")
          .replace("SELECT date_trunc('hour', max(post_time)) AS f FROM news_raw", "SELECT max(ps) AS f FROM complete"))
SQL["g4_complete_news"] = _with(_GATED, f"SELECT {STATE_COLS} FROM replayed")
SQL["a5_state_as_of"] = f"""WITH RECURSIVE {STEPS}
SELECT {STATE_COLS}, t.as_of FROM batches b JOIN (
  SELECT as_of, max(batch_period) AS p FROM batches,
         (VALUES ('2024-01-01-03-30-00'), ('2024-01-01-10-30-00'), ('2124')) v(as_of)
  WHERE batch_period < as_of GROUP BY as_of) t ON b.batch_period = t.p"""
SQL["e3_current_evidence"] = _with(REPLAY_EXPIRY, f"""SELECT n.car_model, n.accident, n.content, n.link,
  {_period('n.post_time', 'hour')} AS batch_period
  FROM news_scored n JOIN replayed r USING (car_model, accident)
  WHERE date_trunc('hour', n.post_time) >= r.start_batch_time""")
