"""Hand-written bronze rows for boundary tests."""

import datetime as dt

from riskmesh.specs import FEEDS


def bronze(spark, feed, rows):
    """rows: tuples in the feed's column order plus the partition value (str)."""
    spec = FEEDS[feed]
    fixed = [tuple(r[:-1]) + (dt.date.fromisoformat(r[-1]) if r[-1] else None,) for r in rows]
    return spark.createDataFrame(fixed, spec.bronze_schema)
