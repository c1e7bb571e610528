"""What a run did."""

from __future__ import annotations

from dataclasses import dataclass, field


@dataclass(frozen=True)
class RunReport:
    """Paths written and row counts, by name, and the files written (with series, one or more a series)."""

    paths: dict[str, str] = field(default_factory=dict)
    counts: dict[str, int] = field(default_factory=dict)
    files: list[str] = field(default_factory=list)
