"""Joins with a side that has one row per key, spread over salted keys where a
key is hot.

AQE cannot split a skewed partition of a join whose other side is an aggregate,
so a hot key would be one task. A mergeable frequent-items sketch over the keys of
the many-rows side (partial sketches a task, merged once) names the hot ones; only
their rows take a salt, and only their rows of the other side are repeated once
per salt. On even data nothing is hot and nothing is copied."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SALTS = 16
HOT_SHARE = 256          # a key with more than one in so many rows is hot: at most so many keys
TRACKED = 8192           # items the sketch keeps: its counts are off by less than 4 in 8192 of all rows
_FREE = 1 << 20          # rows without a key match nothing: spread them over many salts


def heavy_hitters(df: DataFrame, key: str, share: int = HOT_SHARE, tracked: int = TRACKED) -> DataFrame:
    """Keys of ``df`` (``key``, ``estimated_rows``) that hold more than one in
    ``share`` of its rows with a key: every one of them, perhaps some that are
    just below, and never more than 2 * ``share``."""
    some = df.where(F.col(key).isNotNull())
    sketch = some.agg(F.expr(f"approx_top_k(`{key}`, {2 * share}, {tracked})").alias("top"), F.count(F.lit(1)).alias("total"))
    top = sketch.select(F.explode("top").alias("hot"), "total")
    # an estimate may be short by the sketch's error; keys are only taken in more freely for it
    error = F.col("total") * F.lit(4.0 / tracked)
    return top.where((F.col("hot.count") + error) * share > F.col("total")).where("hot.count > 1") \
        .select(F.col("hot.item").alias(key), F.col("hot.count").alias("estimated_rows"))


def salted_sides(many: DataFrame, one: DataFrame, key: str, spread_by: list[str], salts: int = SALTS,
                 hot: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """Both sides with their ``_salt``. ``hot`` has the hot keys (default: by the
    sketch); it is at most a few hundred rows by construction and is broadcast."""
    hot = F.broadcast((heavy_hitters(many, key) if hot is None else hot).select(F.col(key).alias("_hot")))
    own = F.xxhash64(*[F.col(c) for c in spread_by])
    salt: Column = F.when(F.col(key).isNull(), F.pmod(own, F.lit(_FREE))).when(F.col("_hot").isNotNull(), F.pmod(own, F.lit(salts))).otherwise(0)
    left = many.join(hot, F.col(key) == F.col("_hot"), "left").withColumn("_salt", salt.cast("int")).drop("_hot")
    copies = F.when(F.col("_hot").isNotNull(), F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))
    right = one.where(F.col(key).isNotNull()).join(hot, F.col(key) == F.col("_hot"), "left").withColumn("_salt", F.explode(copies)).drop("_hot")
    return left, right


def salted_join(many: DataFrame, one: DataFrame, key: str, how: str, spread_by: list[str], salts: int = SALTS,
                hot: DataFrame | None = None) -> DataFrame:
    """``many`` joined with ``one`` (one row per ``key``) on ``key``. ``spread_by``:
    columns of ``many`` that differ between the rows of a hot key."""
    left, right = salted_sides(many, one, key, spread_by, salts, hot)
    return left.join(right, [key, "_salt"], how).drop("_salt")
