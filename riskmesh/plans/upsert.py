"""Incremental silver builds: watermark, partition-local merge upsert,
schema sync and full refresh on Parquet datasets partitioned by date."""

from __future__ import annotations

import datetime as _dt
import json
import uuid
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskmesh.session import checkpoint_dir
from riskmesh.sources.tables import PENDING, read_note, read_table, set_table_columns, table_columns, write_note
from riskmesh.specs import WATERMARK_FLOOR, SilverSpec


_EPOCH = _dt.datetime(1970, 1, 1, tzinfo=_dt.timezone.utc)


def watermark_of(target: DataFrame, event_column: str, recent_from=None,
                 date_column: str | None = None):
    """``COALESCE(MAX(event), floor)`` of the target: one scalar (a single
    global aggregate row), used as a literal so it prunes the next scan.
    With ``recent_from`` (a day) only partitions from that day on are read.

    An instant leaves Spark as microseconds and comes back as a UTC datetime:
    a collected timestamp would be shifted by the driver's own time zone."""
    if recent_from is not None and date_column:
        target = target.where(F.col(date_column) >= F.lit(str(recent_from)).cast("date"))
    newest = F.max(event_column)
    if isinstance(target.schema[event_column].dataType, T.TimestampType):
        micros = target.agg(F.unix_micros(newest).alias("m")).first()["m"]
        return WATERMARK_FLOOR if micros is None else _EPOCH + _dt.timedelta(microseconds=micros)
    value = target.agg(newest.alias("m")).first()["m"]
    return value if value is not None else WATERMARK_FLOOR


def latest_partition(spark: SparkSession, path: str, date_column: str):
    """Newest ``date_column=YYYY-MM-DD`` folder of a dataset, from the
    directory listing alone (no data read; bounded by the number of days)."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    prefix = f"{date_column}="
    days = [st.getPath().getName()[len(prefix):] for st in fs.listStatus(p)
            if st.isDirectory() and st.getPath().getName().startswith(prefix)]
    days = [d for d in days if d and d != "__HIVE_DEFAULT_PARTITION__"]
    return _dt.date.fromisoformat(max(days)) if days else None


def target_watermark(spark: SparkSession, target_path: str, spec: SilverSpec):
    """Watermark of a silver target partitioned by the event's UTC date: the
    max event lies in the newest partition, so only the newest two days are
    scanned (one extra day of margin)."""
    target = read_table(spark, target_path)
    newest = latest_partition(spark, target_path, spec.date_column)
    start = newest - _dt.timedelta(days=1) if newest else None
    return watermark_of(target, spec.event_column, start, spec.date_column)


def merge_partition_local(target: DataFrame, batch: DataFrame, key: str, date_column: str,
                          partition_local: bool = True) -> DataFrame:
    """MERGE semantics as a relational expression.

    A target row is replaced when the batch has a row with the same key *and*
    the same date (``partition_local``, parity with a merge whose predicate
    includes date equality); otherwise batch rows are inserted. So a key whose
    date moved keeps its old row and gains a new one. With
    ``partition_local=False`` the key alone matches (no duplicates).
    Columns follow the batch (added columns NULL for old rows, removed dropped).
    """
    on = [key, date_column] if partition_local else [key]
    kept = target.join(batch.select(*on).distinct(), on, "left_anti")
    return (kept.unionByName(batch, allowMissingColumns=True)
            .select(*batch.columns))


@dataclass
class UpsertResult:
    path: str
    mode: str                 # full | incremental | noop
    batch_rows: int
    touched_partitions: int
    days: tuple | None = None  # the dates whose partitions were rewritten; None: all


def _exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def _delete(spark: SparkSession, path: str) -> None:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def _write(df: DataFrame, path: str, date_column: str, dynamic: bool) -> None:
    """Date-partitioned write, rebalanced by the date (see ``rebalanced_by``)."""
    from riskmesh.session import partitioned_write
    from riskmesh.sources.ingest import rebalanced_by
    with partitioned_write(df.sparkSession):
        (rebalanced_by(df, date_column).write.mode("overwrite")
         .option("partitionOverwriteMode", "dynamic" if dynamic else "static")
         .partitionBy(date_column).parquet(path))


def _pending(target_path: str) -> tuple[str, str]:
    """(folder, name) of the note of a swap: beside the table, as a rewrite of all
    partitions empties the table's own folder."""
    folder, _, table = target_path.rstrip("/").rpartition("/")
    return folder or ".", f"_{table}{PENDING}"


def finish_swap(spark: SparkSession, target_path: str, date_column: str) -> bool:
    """Carry out the swap that is noted beside the target, if there is one: the
    staged partitions replace the target's, emptied ones go, then the note and the
    stage. Every step can be repeated, so a run that failed in between is finished
    by the next one."""
    folder, name = _pending(target_path)
    note = read_note(spark, folder, name)
    if note is None:
        return False
    _write(spark.read.parquet(note["stage"]), target_path, date_column, dynamic=note["dynamic"])
    for day in note["gone"]:
        _delete(spark, f"{target_path.rstrip('/')}/{date_column}={'__HIVE_DEFAULT_PARTITION__' if day is None else day}")
    if note["columns"]:
        set_table_columns(spark, target_path, T.StructType.fromJson(note["columns"][0]), note["columns"][1])
    write_note(spark, folder, name, None)
    _delete(spark, note["stage"])
    return True


def _build(spark: SparkSession, df: DataFrame, path: str, date_column: str) -> None:
    """The whole table anew."""
    _write(df, path, date_column, dynamic=False)
    set_table_columns(spark, path, df.select(*[c for c in df.columns if c != date_column], date_column).schema, [])


def upsert(spark: SparkSession, target_path: str, batch: DataFrame, spec: SilverSpec,
           partition_local: bool = True, days=None) -> UpsertResult:
    """Merge ``batch`` into the dataset at ``target_path``.

    ``days``: with ``partition_local=False``, all dates under which the target may
    hold older rows of the batch's keys, if the caller knows them; otherwise the
    target's keys are searched for them.

    Only the partitions the batch touches are read and rewritten (dynamic
    partition overwrite). The merged partitions are first written to a
    staging folder under ``spark.checkpoint.dir`` and then swapped in, so the
    target is never read and overwritten by the same job. Columns that the batch
    adds or no longer has change the table's columns (``tables.py``), and no other
    partition is rewritten for it; only a column whose type changed, or that comes
    back after it was dropped (old files still hold its values), takes a rewrite of
    every partition. First build (no target): plain write.
    """
    key, date_col = spec.unique_key, spec.date_column
    finish_swap(spark, target_path, date_col)
    if not _exists(spark, target_path):
        _build(spark, batch, target_path, date_col)
        return UpsertResult(target_path, "full", -1, -1)
    # the batch (one load) is read twice: for the touched days and for the
    # merge; keep it for the duration of the upsert (lost blocks recompute)
    batch = batch.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        target = read_table(spark, target_path)
        dropped = set(table_columns(spark, target_path)[1]) | (set(target.columns) - set(batch.columns))
        types = dict(target.dtypes)
        schema_changed = any(types.get(c, t) != t or (c not in types and c in dropped) for c, t in batch.dtypes)
        new_columns = None
        if schema_changed or set(types) != set(batch.columns) or table_columns(spark, target_path)[0] is None:
            new_columns = batch.select(*[c for c in batch.columns if c != date_col], date_col).schema
        # touched dates: bounded by the number of calendar days in one batch
        dates = [r[0] for r in batch.select(date_col).distinct().collect()]
        if not dates and not schema_changed:
            if new_columns is not None:
                set_table_columns(spark, target_path, new_columns, sorted(dropped))
            return UpsertResult(target_path, "noop", 0, 0, ())
        if days is not None:
            dates = list({*dates, *days})
        elif not partition_local and not schema_changed:
            moved = target.join(batch.select(key).distinct(), key, "left_semi")
            dates = list({*dates, *(r[0] for r in moved.select(date_col).distinct().collect())})
        touched = F.col(date_col).isin([d for d in dates if d is not None])
        if None in dates:
            touched = touched | F.col(date_col).isNull()
        if schema_changed:
            now = dict(batch.dtypes)
            scope = target.select(*[F.col(c).cast(now.get(c, t)).alias(c) for c, t in target.dtypes])
        else:
            scope = target.where(touched)
        merged = merge_partition_local(scope, batch, key, date_col, partition_local)
        stage = f"{checkpoint_dir(spark).rstrip('/')}/riskmesh-upsert-{uuid.uuid4().hex}"
        _write(merged, stage, date_col, dynamic=False)
        # dynamic overwrite only replaces partitions present in the output: a touched
        # partition whose last row moved away must be removed explicitly
        kept_dates = {r[0] for r in spark.read.parquet(stage).select(date_col).distinct().collect()}
        gone = [] if schema_changed else [None if d is None else str(d) for d in set(dates) - kept_dates]
        columns = None if new_columns is None else [json.loads(new_columns.json()), [] if schema_changed else sorted(dropped)]
        write_note(spark, *_pending(target_path), {"stage": stage, "dynamic": not schema_changed, "gone": gone, "columns": columns})
        finish_swap(spark, target_path, date_col)
    finally:
        batch.unpersist()
    return UpsertResult(target_path, "incremental", -1, len(dates), None if schema_changed else tuple(dates))


def incremental_build(spark: SparkSession, target_path: str, bronze: DataFrame,
                      spec: SilverSpec, model, full_refresh: bool = False, as_of=None,
                      partition_local: bool = True, lookback=None) -> UpsertResult:
    """One run of an incremental silver model.

    First build (or ``full_refresh``): the whole bronze range, static
    overwrite. Later runs: only bronze rows at or after the target's max event
    (inclusive: rows equal to the max are merged again, idempotently; older
    late rows wait for a full refresh unless ``lookback`` widens the window).
    """
    finish_swap(spark, target_path, spec.date_column)    # of a run that failed
    if full_refresh or not _exists(spark, target_path):
        _build(spark, model(bronze, as_of=as_of), target_path, spec.date_column)
        return UpsertResult(target_path, "full", -1, -1)
    since = target_watermark(spark, target_path, spec)
    if lookback is not None and since != WATERMARK_FLOOR:
        since = since - lookback
    batch = model(bronze, as_of=as_of, since=since)
    return upsert(spark, target_path, batch, spec, partition_local)
