"""Gold marts from stored partial aggregates per day.

Under one root: ``transactions`` (per player and day: counts, sums, last event),
``ips`` (per player, IP and day: sessions, last session) and ``devices`` (players'
devices of a day), each partitioned by day and mergeable. After a load only the
partials of the days it rewrote are taken anew from the silver tables; the marts are
then finished from the partials, which are one row a player and day instead of one an
event, and equal a full rebuild.

Which days are stale is read from the folders (a silver day that is newer than its
partials, or has none), so a run that failed between the silver load and the refresh
is caught up by the next one."""

from __future__ import annotations

import datetime as _dt
import os
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskmesh.operators import gold
from riskmesh.plans.upsert import _delete, _exists, _write
from riskmesh.sources.tables import read_table
from riskmesh.specs import THRESHOLDS, SignalThresholds

DAY = "day"
KINDS = {"transactions": "player_id string, transaction_count long, deposit_count long, withdraw_count long, bet_count long, "
                         "total_deposit_amount decimal(38,9), total_withdraw_amount decimal(38,9), total_bet_amount decimal(38,9), "
                         "last_transaction_at timestamp",
         "ips": "player_id string, ip string, sessions long, last_session_at timestamp",
         "devices": "player_id string, device string"}


def newest_files(spark: SparkSession, path: str, prefix: str) -> dict[str, int]:
    """Per ``prefix...`` folder of ``path`` the time of its newest file (one entry a day)."""
    if not _exists(spark, path):
        return {}
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    out = {}
    for folder in fs.listStatus(p):
        name = folder.getPath().getName()
        if folder.isDirectory() and name.startswith(prefix):
            out[name.removeprefix(prefix)] = max([f.getModificationTime() for f in fs.listStatus(folder.getPath())], default=0)
    return out


class GoldState:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def _path(self, kind: str) -> str:
        return f"{self.root}/{kind}"

    def _parts(self, kind: str) -> DataFrame:
        schema = f"{KINDS[kind]}, {DAY} date"
        if not _exists(self.spark, self._path(kind)):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(self._path(kind))

    def stale_days(self, kind: str, silver_path: str, date_column: str) -> list[_dt.date]:
        """Days whose silver partition is newer than its partials, or gone."""
        silver = newest_files(self.spark, silver_path, f"{date_column}=")
        have = newest_files(self.spark, self._path(kind), f"{DAY}=")
        days = {d for d, at in silver.items() if at >= have.get(d, -1)} | (have.keys() - silver.keys())
        return sorted(_dt.date.fromisoformat(d) for d in days if d != "__HIVE_DEFAULT_PARTITION__")

    def _replace(self, kind: str, parts: DataFrame, days: list[_dt.date] | None) -> None:
        _write(parts, self._path(kind), DAY, dynamic=days is not None)
        if days is not None:     # a day that has no rows any more is not in the output
            before = newest_files(self.spark, self._path(kind), f"{DAY}=")
            left = {str(r[0]) for r in parts.select(DAY).distinct().collect()}
            for day in {str(d) for d in days} - left:
                if day in before:
                    _delete(self.spark, f"{self._path(kind)}/{DAY}={day}")

    def refresh_transactions(self, transactions: DataFrame, days: Iterable[_dt.date] | None = None) -> None:
        """Partials of ``days`` (default: all) from slv_transactions; no other day is read."""
        days = None if days is None else sorted(set(days))
        if days == []:
            return
        if days is not None:
            transactions = transactions.where(F.col("transaction_date").isin(days))
        per_day = transactions.withColumnRenamed("transaction_date", DAY)
        self._replace("transactions", gold.financial_aggregates(per_day, DAY), days)

    def refresh_sessions(self, sessions: DataFrame, days: Iterable[_dt.date] | None = None) -> None:
        """Partials of ``days`` (default: all) from slv_sessions; no other day is read."""
        days = None if days is None else sorted(set(days))
        if days == []:
            return
        if days is not None:
            sessions = sessions.where(F.col("session_date").isin(days))
        per_day = sessions.withColumnRenamed("session_date", DAY)
        self._replace("devices", per_day.where("device is not null").select("player_id", "device", DAY).distinct(), days)
        self._replace("ips", gold.player_ip_pairs(per_day, DAY), days)

    def refresh(self, silver_root: str) -> dict[str, int]:
        """Bring the partials up to date with the silver tables under
        ``silver_root``; returns how many days were taken anew."""
        sessions, transactions = (os.path.join(silver_root, n) for n in ("slv_sessions", "slv_transactions"))
        out = {}
        if _exists(self.spark, transactions):
            days = self.stale_days("transactions", transactions, "transaction_date")
            self.refresh_transactions(read_table(self.spark, transactions), days)
            out["transactions"] = len(days)
        if _exists(self.spark, sessions):
            days = self.stale_days("ips", sessions, "session_date")
            self.refresh_sessions(read_table(self.spark, sessions), days)
            out["sessions"] = len(days)
        return out

    # -- marts
    def financial_signals(self, t: SignalThresholds = THRESHOLDS) -> DataFrame:
        return gold.financial_signals(gold.merged_financial(self._parts("transactions")), t)

    def fraud_overview(self, players: DataFrame, aff: DataFrame, financial: DataFrame | None = None,
                       t: SignalThresholds = THRESHOLDS) -> DataFrame:
        return gold.overview_of(players, gold.behaviour_of_pairs(gold.merged_pairs(self._parts("ips"))),
                                gold.devices_of_pairs(self._parts("devices")), financial or self.financial_signals(t), gold.affiliate_risk(aff), t)
