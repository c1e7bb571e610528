"""Numeric expressions that do not raise under ANSI mode.

They take and give SQL text: one expression, one call from Python to the JVM.
"""

from __future__ import annotations


def pct_change(now: str, before: str) -> str:
    """Change in percent, two decimals; null where `before` is null or zero."""
    return f"round(try_divide({now} - {before}, {before}) * 100, 2)"


def present(name: str, sql_type: str) -> str:
    """Not null and, for floating columns, not NaN."""
    if sql_type in ("double", "float"):
        return f"`{name}` IS NOT NULL AND NOT isnan(`{name}`)"
    return f"`{name}` IS NOT NULL"
