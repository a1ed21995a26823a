"""Configuration values.

Two kinds live here: FIXED VALUES that must equal the monitored pipeline's own
for identical results, and the stand-in binding of the driver's generic tables
(documents, labels, events, pages) to the engine's inputs.
"""

from __future__ import annotations

# ---------------------------------------------------------------------------
# FIXED VALUES (must equal the original pipeline's for identical results)
# ---------------------------------------------------------------------------
# characters kept by text cleaning: Hangul syllables, ASCII letters, digits, whitespace
CLEAN_PATTERN = "[^가-힣a-zA-Z0-9\\s]"
# batch period: two timestamps in this format joined by "_"
PERIOD_FORMAT = "yyyy-MM-dd-HH-mm-ss"
PERIOD_SEP = "_"
# community sentiment bands: score <= 45 positive, score >= 55 negative
POSITIVE_MAX = 45
NEGATIVE_MIN = 55
# posts kept per (entity, category)
TOP_K = 5
# accumulated news count that opens an issue
ISSUE_THRESHOLD = 10
# expiry of a stale issue (documented intent; off by default)
ISSUE_TTL = "1 day"
# expiry used by the registered replay-with-expiry query
REPLAY_TTL = "2 hours"
# Batch periods of the registered queries. ONE_BATCH labels a single batch
# over every document (no filter). BATCH_A and BATCH_B are two consecutive
# batches that together cover every document: the first six hours, then all
# later post times. EXPIRY_NOW is a batch after both.
ONE_BATCH = "2024-01-01-00-00-00_2024-02-01-00-00-00"
BATCH_A = "2024-01-01-00-00-00_2024-01-01-06-00-00"
BATCH_B = "2024-01-01-06-00-00_2124-01-01-00-00-00"
EXPIRY_NOW = "2124-01-01-00-00-00_2124-01-01-12-00-00"
# issue score weights (sum to 1.0)
WEIGHTS = {"news_score": 0.2, "comm_score": 0.2, "news_count": 0.1,
           "news_acc_count": 0.2, "comm_count": 0.3}
# piecewise-linear normalisation ranges (lower, mid, upper)
RANGE_NEWS_ACC_COUNT = (10, 20, 30)
RANGE_COMM_SCORE = (50, 75, 100)
RANGE_NEWS_COUNT = (1, 5, 10)
RANGE_COMM_COUNT = (1, 5, 10)
NEWS_SCORE_SCALE = 100.0
# severity used for change detection: < 0.3, < 0.6, else
SEVERITY_BOUNDS = (0.3, 0.6)
SEVERITY_LABELS = ("관심", "주의", "긴급")
# alert level shown in the message: <= 0.3, <= 0.6, else
ALERT_LEVELS = (("관심 🟡", "#FFD700"), ("주의 🟠", "#FFA500"), ("긴급 🚨", "#FF0000"))
# alert message: text line and the four field titles
ALERT_TEXT = "🚨 {car_model} {accident} ({level})\n\u200b"
ALERT_FIELD_TITLES = ("이슈 주의도", "이슈 내용", "이슈 최초 발생", "대시보드 링크")
# extraction defaults and markers
DEFAULT_TITLE = "Untitled"
DEFAULT_BODY = " "
AM_MARKER, PM_MARKER = "오전", "오후"
JSONP_PATTERN = r"^Search\.SearchPreCallback\(|\)$"
# ---------------------------------------------------------------------------

# ---------------------------------------------------------------------------
# Stand-in binding for the driver's tables (ours, not the original's)
# ---------------------------------------------------------------------------
# documents -> raw news / posts: entity <- source, post_time <- BASE_TIME + doc_id minutes
BASE_TIME = "2024-01-01 00:00:00"
# news: each category name is itself the keyword searched for
NEWS_CATEGORIES = ["die", "eau", "que", "sch", "aux", "ción"]
# community: category -> sub-keywords
COMMUNITY_KEYWORDS = {
    "die": ["die", "den"],
    "eau": ["eau", "elle"],
    "que": ["que", "los"],
    "sch": ["sch", "ung"],
    "aux": ["aux", "oi"],
    "ción": ["ción", "para"],
}
# labels -> score: toxic 1 -> 80, toxic 0 -> 20, unlabeled -> NULL (failed)
SCORE_TOXIC, SCORE_CLEAN = 80, 20
# pages: blocks removed before reading text
PAGE_DROP_CLASSES = ["ad"]
# events -> arrival markers: every hour expects one marker per event type
EXPECTED_SOURCES = ["click", "error", "purchase", "signup", "view"]
DASHBOARD_URL = "https://dashboard.example/issues"
