"""Numeric helpers shared by the views."""

from __future__ import annotations


def percentage(part: str, whole: str) -> str:
    """``part`` of ``whole`` in percent with two digits, half to even; NULL for nothing."""
    return f"bround({part} * 100.0D / nullif({whole}, 0), 2)"


def seconds_between(start: str, end: str) -> str:
    """Whole seconds from ``start`` to ``end``; NULL if either is missing."""
    return f"unix_seconds({end}) - unix_seconds({start})"
