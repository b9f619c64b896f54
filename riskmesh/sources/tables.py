"""Silver tables as Parquet datasets with their current columns beside them.

``_columns.json`` in a table's folder holds the current schema (comments included)
and the names of columns that were dropped. Readers ask for that schema: a column
that an old file does not have is NULL, one that is no longer part of the table is
not read. So a changed column set needs no rewrite of old partitions."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

COLUMNS = "_columns.json"
PENDING = "_pending.json"    # a swap of partitions that has begun


def _file(spark: SparkSession, path: str, name: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}/{name}")
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def read_note(spark: SparkSession, path: str, name: str):
    """The JSON value of a small file in a table's folder, None without one."""
    fs, p = _file(spark, path, name)
    if not fs.exists(p):
        return None
    stream = fs.open(p)
    try:
        return json.loads(bytes(stream.readAllBytes()).decode("utf-8"))
    finally:
        stream.close()


def write_note(spark: SparkSession, path: str, name: str, value) -> None:
    """Write that file; ``None`` removes it."""
    fs, p = _file(spark, path, name)
    if value is None:
        fs.delete(p, False)
        return
    stream = fs.create(p, True)
    try:
        stream.write(json.dumps(value).encode("utf-8"))
    finally:
        stream.close()


def table_columns(spark: SparkSession, path: str) -> tuple[T.StructType | None, list[str]]:
    """(current schema, names of dropped columns) of a table; (None, []) if it has no such file."""
    held = read_note(spark, path, COLUMNS)
    return (T.StructType.fromJson(held["schema"]), held["dropped"]) if held else (None, [])


def set_table_columns(spark: SparkSession, path: str, schema: T.StructType, dropped: list[str]) -> None:
    write_note(spark, path, COLUMNS, {"schema": json.loads(schema.json()), "dropped": sorted(dropped)})


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """The table at ``path`` with its current columns."""
    schema, _ = table_columns(spark, path)
    return (spark.read if schema is None else spark.read.schema(schema)).parquet(path)
