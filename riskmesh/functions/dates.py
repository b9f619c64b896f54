"""Date and partition helpers."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from riskmesh.functions.text import strip_ws
from riskmesh.specs import PARTITION_FLOOR


def to_instant(c: Column) -> Column:
    """String -> TIMESTAMP (instant; strings without offset are read as UTC)."""
    return c.cast("timestamp")


def event_date(ts: Column) -> Column:
    """UTC calendar day of an instant (session time zone is UTC)."""
    return F.to_date(ts)


def partition_date_text(c: Column) -> Column:
    """Partition value from a raw event text: first 10 characters of the
    stripped text when characters 5 and 8 are '-', else NULL (the caller
    rejects NULLs). Divergence, on purpose: an impossible calendar date such as
    ``2026-99-99`` is also NULL here instead of becoming a partition that no
    typed read can parse."""
    text = strip_ws(c)
    head = F.substring(text, 1, 10)
    shaped = (F.length(text) >= 10) & (F.substring(text, 5, 1) == "-") & (F.substring(text, 8, 1) == "-")
    return F.when(shaped, F.try_to_date(head, "yyyy-MM-dd"))


def partition_range(col: Column, as_of: _dt.date | str | None = None,
                    floor: str = PARTITION_FLOOR) -> Column:
    """`floor <= col <= as_of` (as_of defaults to today's UTC date). On a
    partition column this becomes a PartitionFilter: pruned before the scan."""
    lo = F.lit(floor).cast("date")
    hi = F.current_date() if as_of is None else F.lit(str(as_of)).cast("date")
    return (col >= lo) & (col <= hi)
