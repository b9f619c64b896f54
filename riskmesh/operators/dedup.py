"""Latest-row deduplication (one row per key)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

_RN = "__rn"


def dedup_latest(df: DataFrame, key: str | Sequence[str], newest_first: Sequence[str],
                 tie_break: bool = True) -> DataFrame:
    """Keep, per key, the row with the greatest ``newest_first`` columns.

    Equivalent to ``QUALIFY ROW_NUMBER() OVER (PARTITION BY key ORDER BY
    c1 DESC, c2 DESC ...) = 1``. With ``tie_break`` the remaining columns are
    appended (ascending, NULLS LAST) so exact ties resolve deterministically.

    Physical plan: Catalyst turns ``row_number() = 1`` into a partial
    WindowGroupLimit *before* the shuffle, so each map task forwards at most
    one row per key: a key duplicated into a third of the input does not
    land whole on one reducer.
    """
    keys = [key] if isinstance(key, str) else list(key)
    order = [F.col(c).desc_nulls_last() for c in newest_first]
    if tie_break:
        rest = [c for c in df.columns if c not in keys and c not in newest_first]
        order += [F.col(c).asc_nulls_last() for c in rest]
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(_RN, F.row_number().over(w)).where(F.col(_RN) == 1).drop(_RN)


def latest_by_aggregate(df: DataFrame, key: str, newest_first: Sequence[str], values_of: str | None = None) -> DataFrame:
    """The rows of ``dedup_latest`` as an aggregate, which a stream can keep as
    state: per key the minimum of one struct that has the ``newest_first`` columns
    (dates and timestamps) negated and the others as they are, so state is one row a
    key. With ``values_of`` also ``all_values``: that column's distinct values over
    all rows of the key."""
    types = dict(df.dtypes)
    down = {"timestamp": lambda c: -F.unix_micros(c), "date": lambda c: -F.unix_date(c)}
    up = {"timestamp": lambda c: F.timestamp_micros(-c), "date": lambda c: F.date_from_unix_date(-c)}
    rest = [c for c in df.columns if c != key and c not in newest_first]
    order = []
    for i, c in enumerate([*newest_first, *rest]):
        order += [F.col(c).isNull().alias(f"null_{i}"), (down[types[c]](F.col(c)) if c in newest_first else F.col(c)).alias(f"value_{i}")]
    kept = [F.min(F.struct(*order)).alias("_first")]
    if values_of:
        kept.append(F.collect_set(values_of).alias("all_values"))
    out = df.groupBy(key).agg(*kept)
    columns = {c: F.col(f"_first.value_{i}") for i, c in enumerate([*newest_first, *rest])}
    columns |= {c: up[types[c]](columns[c]) for c in newest_first}
    return out.select(key, *[columns[c].alias(c) for c in df.columns if c != key], *(["all_values"] if values_of else []))
