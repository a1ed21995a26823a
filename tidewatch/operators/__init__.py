"""DataFrame -> DataFrame operators."""

from . import aggregate, alerts, issue, joins, periods, scoring, state, tagging  # noqa: F401
