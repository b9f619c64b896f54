"""One query per operator, over the whole tables of a folder, and their SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskmesh.llm.oracle import ORACLE_SQL  # noqa: F401 - read by the entry point
from riskmesh.llm.shared import ship


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    from riskmesh.llm.quality_rules import language_references, quality
    docs = table(spark, sf_dir, "documents")
    return quality(docs, language_references(docs))


def bucket(of: int) -> Column:
    """crc32 of doc_id as text, modulo ``of`` (a null id counts as empty text)."""
    return F.crc32(F.encode(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), "UTF-8")) % of


def op2_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    from riskmesh.llm.lm_scoring import score
    return score(table(spark, sf_dir, "documents"), held_out=bucket(5) == 1)


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from riskmesh.llm.line_dedup import dedup_lines
    return dedup_lines(table(spark, sf_dir, "documents"))


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    from riskmesh.llm.decontamination import contaminated
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    from riskmesh.llm.language_id import identify, learn_dictionaries
    docs = table(spark, sf_dir, "documents")
    found = identify(docs, learn_dictionaries(docs.where(bucket(5) != 0)))
    return found.select("doc_id", (bucket(5) == 0).alias("held_out"), "lang_pred", "score", "accepted")


def op6_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    from riskmesh.llm.html_text import extract
    return extract(table(spark, sf_dir, "pages"))


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from riskmesh.llm.mixing import mix
    return mix(table(spark, sf_dir, "documents"), weights=[3, 1, 2], share=1.5, most=2.0) \
        .select("doc_id", "size", "source_size", "target", "taken")


def op8_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    from riskmesh.llm.ngram_join import similar
    return similar(table(spark, sf_dir, "documents"), n=3, percent=90)


def op9_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    from riskmesh.llm.sharding import shard
    return shard(table(spark, sf_dir, "documents"), shards=8)


def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from riskmesh.llm.substring_dedup import remove_repeats
    return remove_repeats(table(spark, sf_dir, "documents"), window=35)


def op11_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    from riskmesh.llm.fill_in_middle import fill_in_middle, restore
    cut = fill_in_middle(table(spark, sf_dir, "documents"))
    return cut.select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"),
                      F.sha2(restore(F.col("output"), F.col("form")), 256).alias("restored_sha256"))


def op12_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from riskmesh.llm.suffix_dedup import remove_repeats
    return remove_repeats(table(spark, sf_dir, "documents"), window=200) \
        .select("doc_id", "n_bytes", "n_removed", F.size("removed").cast("long").alias("n_spans"), "kept_sha256")


def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    from riskmesh.llm.vector_codes import compress
    return compress(table(spark, sf_dir, "embeddings"), parts=8, entries=16, rounds=6) \
        .select("vec_id", "code", "error", "label_error", "codebooks_sha256")


QUERIES = {f.__name__: f for f in (op1_quality_rules, op2_lm_scoring, op3_line_dedup, op4_decontamination, op5_language_id, op6_html_text,
                                   op7_mixing, op8_ngram_join, op9_sharding, op10_substring_dedup, op11_fill_in_middle, op12_suffix_dedup, op13_vector_codes)}

