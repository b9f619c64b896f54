"""Bronze scans: declared all-string schema + DATE partition column."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskmesh.specs import FEEDS


class PartitionFilterRequired(ValueError):
    """A bronze read without partition bounds is refused (it would scan every
    partition of a table that grows without limit)."""


def read_bronze(spark: SparkSession, path: str, feed: str, lo, hi) -> DataFrame:
    """Scan one bronze feed restricted to ``lo <= partition <= hi``.

    Both bounds are required. The partition column's type comes from the
    declared schema, so the predicate becomes a PartitionFilter and only the
    matching directories are listed and read.
    """
    if lo is None or hi is None:
        raise PartitionFilterRequired(
            f"bronze {feed}: a range on {FEEDS[feed].partition_column} is required")
    spec = FEEDS[feed]
    df = spark.read.schema(spec.bronze_schema).parquet(path)
    p = F.col(spec.partition_column)
    return df.where((p >= F.lit(str(lo)).cast("date")) & (p <= F.lit(str(hi)).cast("date")))
