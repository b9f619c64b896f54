"""Mixing sources to target weights by hash thresholds.

Every document has a fixed 64-bit hash; a source takes the documents whose hash
lies below its threshold. Thresholds come from nested histograms: the tokens of
each source are summed by the top ``BITS`` bits of the hash, the bucket in which
the budget runs out is found, and only that bucket is summed again by its next
``BITS`` bits, ``LEVELS`` times: the last bucket is a 2**36-th of a source, which
is taken whole if that brings the sum closer. No rows are sorted, and each
level shuffles at most 2**BITS pre-aggregated rows a source and task. A source
whose budget exceeds its size takes every document once and those below the
threshold of the excess a second time.

Defined cases: a null text has size 0; null sources are one source, ordered
last; documents of size 0 are taken 0 times; rows that repeat a document's id
have one hash and are taken together (or not); an empty table gives no rows;
other columns of the input are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskmesh.llm.shared import written

BITS = 12
LEVELS = 3  # 36 bits of the hash


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).cast("long"), F.lit(0).cast("long"))


def ranked_sources(sources: DataFrame) -> DataFrame:
    """(source, source_size) plus ``rank`` from 0: by code point, null last.
    Sources are dealt by range and counted range by range, so no task holds
    them all. (Spark compares strings by UTF-8 bytes, which is code-point order.)"""
    dealt = written(sources.repartitionByRange(F.col("source").asc_nulls_last())
                    .withColumn("part", F.spark_partition_id()), "sources")
    upto = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # over one row a partition
    before = dealt.groupBy("part").count().select("part", F.coalesce(F.sum("count").over(upto), F.lit(0)).alias("before"))
    own = Window.partitionBy("part").orderBy(F.col("source").asc_nulls_last())
    return dealt.withColumn("own", F.row_number().over(own)).join(before, "part") \
        .select("source", "source_size", (F.col("own") - 1 + F.col("before")).alias("rank"))


def with_targets(sources: DataFrame, weights: list[float], share: float, most: float) -> DataFrame:
    """Adds ``target``: ``share`` of all sizes divided by cyclic ``weights``,
    none above ``most`` times its source's size; the excess of the capped is
    reshared by weight until none is above. Each round is one aggregate over
    the sources; rounds end when no further source is capped."""
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), (F.col("rank") % len(weights) + 1).cast("int"))
    table = written(ranked_sources(sources).withColumn("weight", w)
                    .withColumn("cap", F.lit(float(most)) * F.col("source_size")), "weights")
    budget = float((table.agg(F.sum("source_size")).first()[0] or 0) * share)
    rate, capped = 0.0, -1
    while True:
        over = F.col("cap") < F.lit(rate) * F.col("weight")
        r = table.agg(F.sum(F.when(over, F.col("cap")).otherwise(0.0)).alias("full"),
                      F.sum(F.when(over, 0.0).otherwise(F.col("weight"))).alias("open"),
                      F.count_if(over).alias("n")).first()
        if r["n"] == capped or not r["open"]:
            break
        capped, rate = r["n"], max(rate, (budget - r["full"]) / r["open"])
    return table.withColumn("target", F.least(F.col("cap"), F.lit(rate) * F.col("weight")))


def _hash(id_column: str) -> Column:
    return F.shiftrightunsigned(F.xxhash64(F.lit(7), id_column), 1)


def thresholds(sized: DataFrame, weights: list[float], share: float, most: float) -> DataFrame:
    """Per source of ``sized`` (source, size, hash; a written table): source_size,
    target, ``whole`` (1: every document once) and ``prefix``, the bound below
    which a document is taken (once more)."""
    sources = with_targets(sized.groupBy("source").agg(F.sum("size").alias("source_size")), weights, share, most)
    # the budget of the threshold: what exceeds taking everything once, or all of it
    whole = F.when(F.col("target") >= F.col("source_size"), 1).otherwise(0)
    state = sources.select("source", "source_size", "target", whole.alias("whole"),
                           (F.col("target") - whole * F.col("source_size")).alias("left"), F.lit(0).cast("long").alias("prefix"))
    for level in range(1, LEVELS + 1):
        shift = 63 - BITS * level
        bucket = F.shiftright("hash", shift)
        state = written(state, "thresholds")
        rows = sized.withColumn("bucket", bucket)
        if level > 1:  # only the boundary bucket of each source
            rows = rows.join(F.broadcast(state.select(F.col("source").alias("s"), "prefix")) if _few(state) else
                             state.select(F.col("source").alias("s"), "prefix"),
                             F.col("source").eqNullSafe(F.col("s")) & (F.shiftright("bucket", BITS) == F.col("prefix")))
        hist = rows.groupBy("source", "bucket").agg(F.sum("size").alias("tokens"))
        upto = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0)
        hist = hist.withColumn("upto", F.sum("tokens").over(upto)).select(F.col("source").alias("h"), "bucket", "tokens", "upto")
        # the first bucket that the budget does not cover; what lies below it is taken
        over = F.when(F.col("upto") > F.col("left"), F.struct("bucket", "tokens"))
        cut = state.join(hist, F.col("source").eqNullSafe(F.col("h")), "left") \
            .groupBy("source", "source_size", "target", "whole", "left", "prefix") \
            .agg(F.min(over).alias("edge"), F.max(F.when(F.col("upto") <= F.col("left"), F.col("upto"))).alias("below"))
        end = F.shiftleft(F.col("prefix") + 1, BITS) if level > 1 else F.lit(1 << BITS).cast("long")
        left = F.col("left") - F.coalesce("below", F.lit(0))
        prefix = F.coalesce("edge.bucket", end)
        if level == LEVELS:
            prefix = prefix + F.when(2 * left >= F.col("edge.tokens"), 1).otherwise(0)
        state = cut.select("source", "source_size", "target", "whole", left.alias("left"), prefix.alias("prefix"))
    state = written(state, "thresholds")
    return state.select("source", "source_size", "target", "whole", "prefix")


def _copies(docs: DataFrame, marks: DataFrame) -> DataFrame:
    """``docs`` (source, hash) with the marks of its source and how often it is taken."""
    marks = marks.select(F.col("source").alias("__mix_source"), F.col("source_size").alias("__mix_source_size"),
                         F.col("target").alias("__mix_target"), F.col("whole").alias("__mix_whole"), F.col("prefix").alias("__mix_prefix"))
    marks = F.broadcast(marks) if _few(marks) else marks
    below = F.when(F.shiftright("__mix_hash", 63 - BITS * LEVELS) < F.col("__mix_prefix"), 1).otherwise(0)
    return docs.join(marks, F.col("source").eqNullSafe(F.col("__mix_source"))).withColumn("__mix_copies", F.col("__mix_whole") + below)


def _sized(docs: DataFrame, id_column: str) -> DataFrame:
    return written(docs.select(F.col(id_column), "source", word_count(F.col("text")).alias("size"), _hash(id_column).alias("hash")), "sizes")


def mix(docs: DataFrame, weights: list[float], share: float = 1.5, most: float = 2.0, id_column: str = "doc_id") -> DataFrame:
    """Per row of ``docs`` (``id_column``, source, text): size, source_size,
    target and ``taken`` (0, 1 or 2 times size)."""
    sized = _sized(docs, id_column)
    marked = _copies(sized.withColumnRenamed("hash", "__mix_hash"), thresholds(sized, weights, share, most))
    return marked.select(id_column, "source", "size", F.col("__mix_source_size").alias("source_size"), F.col("__mix_target").alias("target"),
                         (F.col("__mix_copies") * F.col("size")).cast("long").alias("taken"))


def take(docs: DataFrame, weights: list[float], share: float = 1.5, most: float = 2.0, id_column: str = "doc_id") -> DataFrame:
    """The mix itself: the rows of ``docs`` (all columns), each as often as it is taken."""
    marks = thresholds(_sized(docs, id_column), weights, share, most)
    marked = _copies(docs.withColumn("__mix_hash", _hash(id_column)), marks)
    return marked.where((F.col("__mix_copies") > 0) & (word_count(F.col("text")) > 0)) \
        .withColumn("__mix_copy", F.explode(F.sequence(F.lit(1), F.col("__mix_copies")))).select(*docs.columns)


def _few(state: DataFrame, most: int = 200_000) -> bool:
    """Whether the per-source table is proven small enough to broadcast."""
    return state.limit(most + 1).count() <= most
