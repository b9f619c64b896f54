"""Named relations: ``source(feed)`` for bronze and ``ref(model)`` for the
silver and gold models, resolved lazily and memoised per ``Layers`` object.

Two backends: feeds derived from the benchmark tables (``from_benchmark``), or
a warehouse folder with ``bronze/<feed>``, ``silver/<model>``, ``gold/<model>``
Parquet datasets (``from_warehouse``); a model that is not materialised is
computed from its inputs.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession

from riskmesh.operators import gold, silver
from riskmesh.session import checkpoint_dir
from riskmesh.sources.tables import read_table
from riskmesh.specs import FEEDS, THRESHOLDS, SignalThresholds

SILVER_MODELS = ("slv_players", "slv_sessions", "slv_transactions", "slv_affiliate_cpa_ftd")
GOLD_MODELS = ("gold_financial_signals", "gold_affiliate_metrics", "gold_fraud_overview")
# dependency order of the models
MODEL_ORDER = SILVER_MODELS + GOLD_MODELS


_SHARED: dict = {}


class Layers:
    def __init__(self, spark: SparkSession, bronze_loader: Callable[[str], DataFrame],
                 model_loader: Callable[[str], DataFrame | None] | None = None,
                 as_of=None, thresholds: SignalThresholds = THRESHOLDS):
        self.spark = spark
        self._bronze_loader = bronze_loader
        self._model_loader = model_loader or (lambda name: None)
        self.as_of = as_of
        self.thresholds = thresholds
        self._memo: dict[str, DataFrame] = {}

    # -- constructors
    @classmethod
    def from_benchmark(cls, spark: SparkSession, sf_dir: str, **kw) -> "Layers":
        from riskmesh.sources import testdata
        return cls(spark, lambda feed: testdata.bronze_feed(spark, sf_dir, feed), **kw)

    @classmethod
    def shared_benchmark(cls, spark: SparkSession, sf_dir: str) -> "Layers":
        """One memoised ``Layers`` per (session, directory): the lazily built
        plans of the feeds and models are shared by every query of a session
        (DataFrames are immutable, so sharing is safe)."""
        try:
            ident = spark._jsparkSession.hashCode()
        except Exception:  # noqa: BLE001 - no JVM handle (e.g. Spark Connect)
            ident = id(spark)
        key = (ident, sf_dir.rstrip("/"))
        if key not in _SHARED:
            _SHARED[key] = cls.from_benchmark(spark, sf_dir)
        return _SHARED[key]

    @classmethod
    def from_warehouse(cls, spark: SparkSession, root: str, as_of=None, lo="1900-01-01",
                       **kw) -> "Layers":
        from riskmesh.sources.bronze import read_bronze

        def bronze(feed: str) -> DataFrame:
            return read_bronze(spark, os.path.join(root, "bronze", feed), feed, lo,
                               as_of or "9999-12-31")

        def model(name: str) -> DataFrame | None:
            layer = "silver" if name.startswith("slv_") else "gold"
            path = os.path.join(root, layer, name)
            if not _exists(spark, path):
                return None
            return read_table(spark, path)

        return cls(spark, bronze, model, as_of=as_of, **kw)

    def written(self, names=MODEL_ORDER) -> "Layers":
        """The same relations with the models ``names`` computed once, for queries
        that read them several times: they are written to the shared folder and read
        from there. Models that do not depend on each other are written at the same
        time; feeds are plain projections and stay as they are."""
        base = f"{checkpoint_dir(self.spark).rstrip('/')}/riskmesh-layers-{uuid.uuid4().hex}"
        done: dict[str, DataFrame] = {}
        out = Layers(self.spark, self.source, done.get, as_of=self.as_of, thresholds=self.thresholds)

        def once(name: str) -> tuple[str, DataFrame]:
            df = out.build(name)
            df.write.parquet(f"{base}/{name}")
            return name, self.spark.read.schema(df.schema).parquet(f"{base}/{name}")

        for layer in (SILVER_MODELS, ("gold_financial_signals", "gold_affiliate_metrics"), ("gold_fraud_overview",)):
            with ThreadPoolExecutor(len(layer)) as pool:     # each thread only waits for its Spark job
                done.update(pool.map(once, [n for n in layer if n in names]))
        return out

    # -- relations
    def source(self, feed: str) -> DataFrame:
        if feed not in FEEDS:
            raise KeyError(f"unknown feed {feed!r}")
        key = f"bronze.{feed}"
        if key not in self._memo:
            self._memo[key] = self._bronze_loader(feed)
        return self._memo[key]

    def ref(self, name: str) -> DataFrame:
        if name not in self._memo:
            df = self._model_loader(name)
            self._memo[name] = df if df is not None else self.build(name)
        return self._memo[name]

    def build(self, name: str) -> DataFrame:
        """Compute a model from its inputs (ignores a materialised copy)."""
        t, as_of = self.thresholds, self.as_of
        if name == "slv_players":
            return silver.slv_players(self.source("players"), as_of=as_of)
        if name == "slv_sessions":
            return silver.slv_sessions(self.source("sessions"), as_of=as_of)
        if name == "slv_transactions":
            return silver.slv_transactions(self.source("transactions"), as_of=as_of)
        if name == "slv_affiliate_cpa_ftd":
            return silver.slv_affiliate_cpa_ftd(self.source("affiliate_cpa_ftd"), as_of=as_of)
        if name == "gold_financial_signals":
            return gold.gold_financial_signals(self.ref("slv_transactions"), t)
        if name == "gold_affiliate_metrics":
            return gold.gold_affiliate_metrics(self.ref("slv_affiliate_cpa_ftd"))
        if name == "gold_fraud_overview":
            return gold.gold_fraud_overview(self.ref("slv_players"), self.ref("slv_sessions"),
                                            self.ref("gold_financial_signals"),
                                            self.ref("slv_affiliate_cpa_ftd"), t)
        raise KeyError(f"unknown model {name!r}")

    def relation(self, name: str) -> DataFrame:
        """Feed or model by name (used by the quality summary)."""
        return self.source(name) if name in FEEDS else self.ref(name)


def _exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(conf).exists(p)
