"""Exact sets of players per key as numbered positions, mergeable over days.

A player's number selects a bucket of 32768 positions. Per key and bucket a set is
either a short list of positions (``few``) or a bitmap of 4 KB (``bits``): most IPs
have one or two players, and a bitmap for each would be thousands of times their
size. Sets of several days are merged without the rows they came from: lists by
array union, bitmaps by ``bitmap_or_agg``; a list beside a bitmap adds the positions
the bitmap does not have. Everything is built-in functions; a set of one key and
bucket is bounded by its 32768 positions, so a key with a third of all players is
spread over its buckets."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

FEW = 64             # positions a list may hold
POSITIONS = 32768


def _has(bits: str, position: str) -> str:
    """SQL: whether a bitmap has a position (bit ``position % 8`` of byte ``position div 8``)."""
    byte = f"cast(conv(hex(substring({bits}, cast({position} div 8 as int) + 1, 1)), 16, 10) as int)"
    return f"shiftright({byte}, {position} % 8) & 1 = 1"


def player_sets(pairs: DataFrame, by: Sequence[str], number: str = "number") -> DataFrame:
    """Rows (``by``..., number >= 1; repeats allowed) as sets (``by``..., bucket,
    few, bits), one of the two filled. One shuffle, with partial sets."""
    n = F.col(number)
    lists = pairs.groupBy(*by, F.bitmap_bucket_number(n).alias("bucket")) \
        .agg(F.sort_array(F.collect_set(F.bitmap_bit_position(n).cast("int"))).alias("few"))
    none = F.lit(None)
    short = lists.where(F.size("few") <= FEW).withColumn("bits", none.cast("binary"))
    long = lists.where(F.size("few") > FEW).withColumn("position", F.explode("few")) \
        .groupBy(*by, "bucket").agg(F.bitmap_construct_agg(F.col("position").cast("long")).alias("bits")) \
        .withColumn("few", none.cast("array<int>"))
    return short.select(*by, "bucket", "few", "bits").unionByName(long.select(*by, "bucket", "few", "bits"))


def merged_sets(sets: DataFrame, by: Sequence[str]) -> DataFrame:
    """Sets of ``by`` over all rows of ``sets``: (``by``..., bucket, few, bits), where
    ``few`` has no position of ``bits``. Lists and bitmaps are added up apart, so
    that no bitmap is made for a key that has only lists."""
    on = [*by, "bucket"]
    lists = sets.where(F.col("few").isNotNull()).groupBy(*on).agg(F.array_distinct(F.flatten(F.collect_set("few"))).alias("few"))
    maps = sets.where(F.col("bits").isNotNull()).groupBy(*on).agg(F.bitmap_or_agg("bits").alias("bits"))
    both = lists.join(maps, on, "full")
    rest = F.expr(f"if(bits is null, few, filter(few, p -> not ({_has('bits', 'p')})))")
    return both.select(*on, rest.alias("few"), "bits")


def set_counts(merged: DataFrame, by: Sequence[str]) -> DataFrame:
    """(``by``..., player_count) of merged sets."""
    n = F.coalesce(F.size("few"), F.lit(0)) + F.coalesce(F.bitmap_count("bits"), F.lit(0))
    return merged.groupBy(*by).agg(F.sum(n).alias("player_count"))


def set_members(merged: DataFrame, by: Sequence[str]) -> DataFrame:
    """(``by``..., number) of merged sets: lists as they are, bitmaps byte by byte."""
    first = (F.col("bucket") - 1) * POSITIONS + 1
    lists = merged.where(F.size("few") > 0).select(*by, first.alias("first"), F.explode("few").alias("position"))
    byte = F.conv(F.hex(F.substring("bits", F.col("at") + 1, 1)), 16, 10).cast("int")
    bytes_ = merged.where(F.col("bits").isNotNull()).select(*by, first.alias("first"), "bits", F.explode(F.sequence(F.lit(0), F.lit(POSITIONS // 8 - 1))).alias("at")) \
        .select(*by, "first", "at", byte.alias("byte")).where("byte <> 0")
    bits = bytes_.select(*by, "first", "at", "byte", F.explode(F.sequence(F.lit(0), F.lit(7))).alias("bit")) \
        .where(F.expr("shiftright(byte, bit) & 1") == 1).select(*by, "first", (F.col("at") * 8 + F.col("bit")).alias("position"))
    return lists.unionByName(bits).select(*by, (F.col("first") + F.col("position")).cast("long").alias("number"))
