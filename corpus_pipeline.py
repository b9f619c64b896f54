"""The corpus pipeline: five stages over ``documents``, each written as Parquet
and read again by the next. All but the last return the columns of documents."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskmesh.llm.decontamination import clean
from riskmesh.llm.mixing import take
from riskmesh.llm.ngram_join import similar
from riskmesh.llm.quality_rules import keep, language_references
from riskmesh.llm.sharding import shard
from riskmesh.llm.shared import bounded_broadcast, shared_dir, ship, written

BROADCAST_ROWS = 2_000_000


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the base rule or diverge from every language go."""
    ship(spark)
    return keep(docs, language_references(docs))


def ngram_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of rows whose sets of five-word shingles have a Jaccard
    similarity of 0.8 or more one row stays: the one with the smallest id (null
    last). Rows without words are in no group and all stay."""
    ship(spark)
    row = F.xxhash64(*docs.columns)
    rows = docs.select(F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", row.alias("row")).alias("id"), "text")
    groups = similar(rows, n=5, percent=80, id_column="id")
    stay = written(groups.where("n_shingles = 0 or component_id = id").select(F.col("id.row").alias("_row"), (F.col("n_shingles") > 0).alias("_words")), "stay")
    names = bounded_broadcast(stay.select("_row").distinct(), BROADCAST_ROWS)
    kept = docs.withColumn("_row", row).join(names, "_row", "left_semi")
    again = written(stay.where("_words").groupBy("_row").count().where("count > 1").select("_row"), "again")
    if again.limit(1).count():  # rows that are equal in all columns are one
        again = bounded_broadcast(again, BROADCAST_ROWS)
        kept = kept.join(again, "_row", "left_anti").unionByName(kept.join(again, "_row", "left_semi").dropDuplicates(["_row"]))
    return kept.select(*docs.columns)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain a benchmark item go."""
    ship(spark)
    return clean(docs, spark.read.parquet(f"{sf_dir.rstrip('/')}/benchmark.parquet"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources at weights 3, 1, 2, repeating, sharing 150% of all words; a
    document that is taken twice is there twice."""
    return take(docs, weights=[3, 1, 2], share=1.5, most=2.0)


def sharding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Eight shards of even counts, equal texts together where they fit."""
    return shard(docs, shards=8)


STAGES = [("quality rules", quality_rules), ("n-gram Jaccard join", ngram_join), ("benchmark decontamination", decontamination),
          ("mixing sources to target weights", mixing), ("sharding", sharding)]

# The stages hold models and graph iterations that SQL has no words for; tests compare each with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for name, stage in STAGES[:-1]:
        path = f"{shared_dir(spark)}/pipeline-{name.replace(' ', '-')}-{uuid.uuid4().hex}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
