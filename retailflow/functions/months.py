"""Calendar rules decided in Python before a plan is built."""

from __future__ import annotations

from datetime import date


def _wrap(m: int) -> int:
    return (m - 1) % 12 + 1


def trailing_months(month: int, n: int = 3, include_current: bool = False) -> list[int]:
    """The ``n`` months before ``month`` on a 12-cycle (up to and with it when asked)."""
    last = month if include_current else month - 1
    return [_wrap(last - k) for k in range(n)][::-1]


def forward_months(month: int, n: int = 4) -> list[int]:
    """``month`` and the months after it on a 12-cycle."""
    return [_wrap(month + k) for k in range(n)]


def month_fraction(as_of: date) -> float:
    """Share of the running month that has passed, on a 31-day month."""
    return as_of.day / 31


def in_season_letter(month: int) -> str:
    return "F" if month in (9, 10, 11, 12, 1, 2) else "S"


def off_season_letter(month: int) -> str | None:
    """Season letter left out of deal suggestions; none in June and December."""
    if 1 <= month <= 5:
        return "S"
    if 7 <= month <= 11:
        return "F"
    return None
