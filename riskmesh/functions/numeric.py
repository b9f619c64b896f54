"""Exact decimal arithmetic helpers.

Spark's decimal typing loses scale in two places the marts hit:
``decimal(38,9) / decimal(38,9)`` gives scale 6 and ``bigint * decimal(38,9)``
gives scale 6. The helpers below pick operand types whose result type is
exactly ``decimal(38,9)`` with a single HALF_UP rounding, matching NUMERIC
semantics.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

from riskmesh.specs import NUMERIC


def money(c: Column) -> Column:
    """Cast to NUMERIC, decimal(38,9)."""
    return c.cast(NUMERIC)


def as_bigint(c: Column) -> Column:
    return c.cast("bigint")


def guarded_ratio(num: Column, den: Column) -> Column:
    """num / den as decimal(38,9); NULL when den is 0 or NULL.

    decimal(38,18) / decimal(38,9) has 29 integer digits, so Spark adjusts
    the result scale to exactly 9: one rounding, half away from zero.
    """
    return F.try_divide(num.cast("decimal(38,18)"), F.nullif(den, F.lit(0)).cast(NUMERIC))


def count_ratio(num: Column, den: Column) -> Column:
    """bigint / bigint as double, NULL when den is 0 or NULL."""
    return F.try_divide(num.cast("double"), F.nullif(den, F.lit(0)).cast("double"))


def money_product(count: Column, value: Column) -> Column:
    """Count (of one row, below 10**9) * NUMERIC (below 10**19) without scale
    loss: decimal(9,0) * decimal(28,9) -> (38,9). Beyond that the cast fails."""
    return count.cast("decimal(9,0)") * value.cast("decimal(28,9)")


def scaled(value: Column, factor: Decimal) -> Column:
    """value * factor, exact: the value is narrowed so the product keeps all digits."""
    f = Decimal(factor)
    digits = len(f.as_tuple().digits)
    exp = -f.as_tuple().exponent if f.as_tuple().exponent < 0 else 0
    lit = F.lit(f).cast(f"decimal({max(digits, exp + 1)},{exp})")
    return value.cast("decimal(28,9)") * lit


def flag_count(*flags: Column) -> Column:
    """Number of TRUE flags (NULL counts as FALSE)."""
    total = None
    for flag in flags:
        term = F.coalesce(flag, F.lit(False)).cast("bigint")
        total = term if total is None else total + term
    return total
