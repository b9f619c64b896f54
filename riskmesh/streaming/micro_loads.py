"""Repeated micro-loads (hourly sessions / transactions, daily players) with
a file-source Structured Streaming query.

One run = two steps:
  1. ``trigger(availableNow=True)``: every landing file not yet recorded in
     the query's checkpoint is parsed, given its partition value and appended
     to the bronze dataset through Spark's Parquet file sink (exactly-once:
     readers only see files committed in the sink's log). A row without a
     valid partition value fails the query, like the batch ingest.
  2. the incremental silver build: bronze rows at or after the target's
     watermark (pruned to recent day partitions) are deduplicated and merged
     partition-locally into the silver table (idempotent on replay).
A rerun without new files appends nothing and merges nothing new.

``latest_load`` takes another second step: a stream over the new bronze files
keeps the latest row of every key in the state store (a native aggregate in update
mode), and each of its micro-batches replaces the rows of the keys it changed. Late
rows count too, whatever the watermark, bronze is never read again, and the table
equals the batch model over all bronze rows. State is one row a key; on a cluster
set ``spark.sql.streaming.stateStore.providerClass`` to the RocksDB provider, so
that it need not fit in executor memory.

The streaming dedup operators are not used on purpose: ``dropDuplicates*`` keeps
the *first* row of a key, while the silver models keep the *latest*.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskmesh.operators import silver
from riskmesh.operators.dedup import latest_by_aggregate
from riskmesh.plans.upsert import incremental_build, upsert
from riskmesh.session import ship
from riskmesh.sources.bronze import read_bronze
from riskmesh.sources.ingest import (
    CSV_OPTIONS, csv_columns, csv_schema, ingest, json_columns, normalize_format, with_partition,
)
from riskmesh.sources.records import json_objects
from riskmesh.specs import FEEDS, ROWS_PER_FILE, SILVER

MODELS = {
    "players": ("slv_players", silver.slv_players),
    "sessions": ("slv_sessions", silver.slv_sessions),
    "transactions": ("slv_transactions", silver.slv_transactions),
}

# the typed rows a stream keeps the latest of, and what the model does after the dedup
TYPED = {
    "players": (silver.typed_players, lambda df: df),
    "sessions": (silver.typed_sessions, lambda df: df),
    "transactions": (silver.typed_transactions, silver.transaction_measures),
}


def _stream(spark: SparkSession, landing_dir: str, feed: str, source_format: str | None) -> DataFrame:
    """The feed's columns and presence flags, by the parsers of the batch job.
    A CSV header other than the feed's columns in their order is refused. A file
    with a JSON array is read whole (landing files of micro-loads are small)."""
    spec = FEEDS[feed]
    fmt = normalize_format(source_format or spec.default_format)
    if fmt == "csv":
        raw = spark.readStream.options(**CSV_OPTIONS, multiLine=True).schema(csv_schema(spec.columns)).csv(landing_dir)
        return csv_columns(raw, spec, spec.columns)
    raw = spark.readStream.text(landing_dir, wholetext=fmt == "json")
    if fmt == "json":
        ship(spark)
        raw = raw.mapInArrow(json_objects, "value string")
    return json_columns(raw.where(F.trim("value") != ""), spec)


def land(spark: SparkSession, landing_dir: str, feed: str, bronze_path: str,
         checkpoint_location: str, source_format: str | None = None) -> int:
    """Append every new landing file to the bronze dataset; returns the number
    of rows appended by this run."""
    spec = FEEDS[feed]
    p = spec.partition_column
    rows = with_partition(_stream(spark, landing_dir, feed, source_format), spec)
    absent = F.filter(F.array(*[F.when(~F.col(f"_has_{c}"), F.lit(c)) for c in spec.columns]), lambda c: c.isNotNull())
    problem = F.when(F.size(absent) > 0, F.concat(F.lit("required columns are missing: "), F.array_join(absent, ", "))) \
        .when(F.col(p).isNull(), F.lit(f"no valid partition date in {spec.partition_source}"))
    checked = rows.withColumn(p, F.when(problem.isNull(), F.col(p)).otherwise(F.raise_error(problem).cast("date"))) \
        .select(*spec.columns, p)
    checked = checked.observe("landed", F.count(F.lit(1)).alias("rows"))
    query = (checked.writeStream.format("parquet")
             .partitionBy(p)
             .option("checkpointLocation", checkpoint_location)
             .trigger(availableNow=True)
             .start(bronze_path))
    query.awaitTermination()
    return sum(pr.observedMetrics["landed"]["rows"] for pr in query.recentProgress if "landed" in pr.observedMetrics)


def update_latest(spark: SparkSession, bronze_path: str, feed: str, target_path: str, checkpoint_location: str, as_of=None) -> int:
    """Stream the new files of a bronze dataset into the latest-row state and merge
    the changed keys into the silver table at ``target_path``. The state also has
    every date a key ever had, so only these partitions are rewritten and the target
    is not searched for older rows. A micro-batch that is repeated after a failure
    merges the same rows again. Returns the number of bronze rows read."""
    name, _ = MODELS[feed]
    typed, finish = TYPED[feed]
    spec = SILVER[name]
    new = spark.readStream.schema(FEEDS[feed].bronze_schema).parquet(bronze_path)
    latest = latest_by_aggregate(typed(new, as_of=as_of), spec.unique_key, silver.NEWEST[name], values_of=spec.date_column)

    def merge(changed: DataFrame, _: int) -> None:
        changed = changed.persist()
        try:
            days = [r[0] for r in changed.select(F.explode("all_values")).distinct().collect()]   # calendar days
            if days:
                upsert(changed.sparkSession, target_path, finish(changed.drop("all_values", "dt")), spec, partition_local=False, days=days)
        finally:
            changed.unpersist()

    query = latest.writeStream.outputMode("update").foreachBatch(merge) \
        .option("checkpointLocation", checkpoint_location).trigger(availableNow=True).start()
    query.awaitTermination()
    return sum(int(pr.get("numInputRows", 0)) for pr in query.recentProgress)


def latest_load(spark: SparkSession, landing_dir: str, feed: str, target_path: str, checkpoint_location: str,
                source_format: str | None = None, as_of=None, bronze_path: str | None = None) -> int:
    """Land the new files of ``feed`` and bring the latest row of every key they
    have into the silver table. Progress, state and bronze live under
    ``checkpoint_location``, which a later run must name again. Returns the number
    of landed rows."""
    base = checkpoint_location
    bronze_path = bronze_path or os.path.join(base, "bronze")
    landed = land(spark, landing_dir, feed, bronze_path, os.path.join(base, "checkpoint"), source_format)
    update_latest(spark, bronze_path, feed, target_path, os.path.join(base, "latest"), as_of)
    return landed


def micro_load(spark: SparkSession, landing_dir: str, feed: str, target_path: str,
               checkpoint_location: str, source_format: str | None = None, as_of=None, partition_local: bool = True, bronze_path: str | None = None) -> int:
    """Land the new files of ``feed`` and merge them into the silver table at
    ``target_path``. Progress and bronze live under ``checkpoint_location``,
    which a later run must name again. Returns the number of landed rows."""
    name, model = MODELS[feed]
    base = checkpoint_location
    bronze_path = bronze_path or os.path.join(base, "bronze")
    landed = land(spark, landing_dir, feed, bronze_path, os.path.join(base, "checkpoint"),
                  source_format)
    bronze = read_bronze(spark, bronze_path, feed, "1900-01-01", as_of or "9999-12-31")
    incremental_build(spark, target_path, bronze, SILVER[name], model, as_of=as_of,
                      partition_local=partition_local)
    return landed


def reload_affiliate(spark: SparkSession, source_uri: str, target_path: str, bronze_path: str,
                     source_format: str | None = None, ingest_date=None, as_of=None, rows_per_file: int = ROWS_PER_FILE) -> int:
    """The affiliate feed of a repeated run: it has no event date to load
    increments by, so each run replaces its bronze and rebuilds its silver
    table. An empty file changes nothing. Returns the number of landed rows."""
    report = ingest(spark, "affiliate_cpa_ftd", source_uri, bronze_path, source_format, rows_per_file, ingest_date=ingest_date)
    if report.rows_written:
        bronze = read_bronze(spark, bronze_path, "affiliate_cpa_ftd", "1900-01-01", as_of or "9999-12-31")
        silver.slv_affiliate_cpa_ftd(bronze, as_of=as_of).write.mode("overwrite").parquet(target_path)
    return report.rows_written
