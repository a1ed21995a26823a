"""Column expressions. Everything here returns a ``Column`` built from
built-in functions, so it stays inside whole-stage codegen."""

from .text import (absolute_link, clean_text, collapse_ws, join_paragraphs, parse_count,
                   parse_score, render_prompt, score_from_response, strip_suffix,
                   strip_ws)
from .time import (format_period, parse_local_time, parse_period_end, parse_period_start,
                   time_of_day, to_ntz)
from .scoring import alert_color, alert_label, piecewise, severity, weighted_sum

__all__ = [
    "absolute_link", "clean_text", "collapse_ws", "join_paragraphs", "parse_count",
    "parse_score", "render_prompt", "score_from_response", "strip_suffix", "strip_ws", "format_period",
    "parse_local_time", "parse_period_end", "parse_period_start", "time_of_day", "to_ntz",
    "alert_color", "alert_label", "piecewise", "severity", "weighted_sum",
]
