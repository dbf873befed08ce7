"""The business date ``ds`` (yyyyMMdd) that every job takes."""

from __future__ import annotations

import re
from datetime import date, datetime, timedelta

_DS = re.compile(r"[0-9]{8}")


def parse_ds(ds: str) -> date:
    """Return the date of a strict yyyyMMdd string, else raise ValueError."""
    if not isinstance(ds, str) or not _DS.fullmatch(ds):
        raise ValueError(f"ds must be 8 digits (yyyyMMdd), got {ds!r}")
    try:
        return datetime.strptime(ds, "%Y%m%d").date()
    except ValueError as exc:
        raise ValueError(f"ds is not a calendar date: {ds!r}") from exc


def day_bounds(ds: str) -> tuple[datetime, datetime]:
    """Half-open bounds [ds 00:00, next day 00:00)."""
    start = datetime.combine(parse_ds(ds), datetime.min.time())
    return start, start + timedelta(days=1)


def day_slices(ds: str, slices: int) -> list[tuple[datetime, datetime]]:
    """Cut the business day into equal half-open slices that cover it exactly."""
    if slices < 1:
        raise ValueError("slices must be at least 1")
    start, end = day_bounds(ds)
    edges = [start + (end - start) * i / slices for i in range(slices)] + [end]
    return list(zip(edges, edges[1:]))
