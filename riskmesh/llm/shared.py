"""Helpers the operators share: the shared folder, written intermediate tables
and connected components over an edge table."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


ARROW_ROWS = 2000


def shared_dir(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``. Only a local session may
    leave it unset (tests); a cluster without it is refused."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.conf.get("spark.master", "").split("[")[0] == "local":
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    folder = tempfile.mkdtemp(prefix="riskmesh-llm-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def ship(spark: SparkSession) -> None:
    """Give the Python workers this package (once a Spark context), so that
    executors need no copy of the repository, and keep Arrow batches of whole
    texts to a few megabytes."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", ARROW_ROWS)
    context = spark.sparkContext
    if getattr(context, "_riskmesh_shipped", False):
        return
    top = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    archive = os.path.join(tempfile.mkdtemp(prefix="riskmesh-ship-"), "riskmesh_package.zip")
    with zipfile.ZipFile(archive, "w") as z:
        for folder, _, names in os.walk(top):
            for name in names:
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    z.write(full, os.path.relpath(full, os.path.dirname(top)))
    context.addPyFile(archive)
    context._riskmesh_shipped = True


DROP_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def written(df: DataFrame, name: str, drop_shuffles: bool = False) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: the lineage ends in
    files that survive the loss of any executor, and work below runs once.
    ``drop_shuffles``: the write's shuffle files go when it ends."""
    conf, path = df.sparkSession.conf, f"{shared_dir(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    before = conf.get(DROP_SHUFFLES, "false")
    conf.set(DROP_SHUFFLES, str(drop_shuffles or before == "true").lower())
    try:
        df.write.parquet(path)
    finally:
        conf.set(DROP_SHUFFLES, before)
    table = df.sparkSession.read.schema(df.schema).parquet(path)
    table.written_to = path
    return table


def discard(*tables: DataFrame) -> None:
    """Delete the files of tables that ``written`` gave, when all that reads them
    is itself written."""
    for table in tables:
        context = table.sparkSession.sparkContext
        path = context._jvm.org.apache.hadoop.fs.Path(table.written_to)
        path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)


def bounded_broadcast(df: DataFrame, max_rows: int) -> DataFrame:
    """``df`` with a broadcast hint when it is proven to have at most
    ``max_rows`` rows (counted), otherwise unchanged (shuffle join). ``df``
    should be a written table of a few fixed-width columns."""
    few = df.limit(max_rows + 1).count() <= max_rows
    return F.broadcast(df) if few else df


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """Connected components of an undirected edge table of longs, as rows
    (``id``, ``root``) with ``root`` the smallest id of the component; every id
    of an edge appears once. Distributed union-find by alternating large-star
    and small-star steps: each round hangs all neighbours of a node under its
    smallest neighbour, so a hub with millions of leaves costs one row per leaf
    and rounds grow with the logarithm of the longest chain. Null ends and
    self-loops are dropped; no edges give no rows."""
    e = edges.select(F.col(a).cast("long").alias("u"), F.col(b).cast("long").alias("v")) \
        .where("u is not null and v is not null and u <> v") \
        .select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    e = written(e, "edges", drop_shuffles=True)
    seen = None
    while True:
        # large star: strictly larger neighbours join the smallest neighbour (or the node itself)
        both = e.union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where("u <> v").distinct()
        # small star: smaller neighbours and the node itself join the smallest one
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")) \
            .union(least.select("u", F.col("m").alias("v")))
        before, e = e, written(small.where("u <> v").distinct(), "edges", drop_shuffles=True)
        discard(before)
        state = e.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("s")).first()
        if (state["n"], state["s"]) == seen:
            break
        seen = (state["n"], state["s"])
    roots = e.select(F.col("v").alias("id")).distinct()
    return e.groupBy(F.col("u").alias("id")).agg(F.min("v").alias("root")) \
        .union(roots.select("id", F.col("id").alias("root")))
