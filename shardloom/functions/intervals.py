"""Lengths of intervals written as text."""

from __future__ import annotations

_MICROS = {
    "microsecond": 1,
    "millisecond": 1_000,
    "second": 1_000_000,
    "minute": 60_000_000,
    "hour": 3_600_000_000,
    "day": 86_400_000_000,
    "week": 604_800_000_000,
}


def micros_of(interval: str) -> int:
    """Microseconds of an interval such as ``"250 milliseconds"`` or ``"1 hour 30 minutes"``."""
    parts = interval.lower().removeprefix("interval ").split()
    if not parts or len(parts) % 2:
        raise ValueError(f"not an interval: {interval!r}")
    pairs = zip(parts[::2], parts[1::2])
    return sum(round(float(amount) * _MICROS[unit.removesuffix("s")]) for amount, unit in pairs)
