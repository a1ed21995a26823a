"""Readers, writers and record extraction."""

from . import io, pages, standins  # noqa: F401
