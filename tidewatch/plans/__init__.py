"""Composed batch jobs."""

from . import community, news, replay  # noqa: F401
