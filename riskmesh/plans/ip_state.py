"""Stored state of the shared-IP risk: which players used which IP on which day.

Two datasets under one root: ``players/first=N`` numbers the players (one folder a
load that brought new ones) and ``ip_days/session_date=D`` has the player sets of
each IP on that day (``operators/player_sets.py``). After an upsert of sessions
only the days it touched are read again and replaced, so replaced sessions leave
the sets as well; every other day is taken from its stored sets. Counts over any
range of days, and the risk per player, come from the sets alone and equal a full
recount of the sessions.

A load can be repeated: numbers are given once, and a day is replaced whole. A
numbering that did not end (no ``_SUCCESS``) is ignored and written over."""

from __future__ import annotations

import datetime as _dt
import uuid
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskmesh.operators.player_sets import merged_sets, player_sets, set_counts, set_members
from riskmesh.plans.upsert import _delete, _exists, _write
from riskmesh.session import checkpoint_dir

NUMBERS_PER_TASK = 1_000_000
DAY = "session_date"


def _folders(spark: SparkSession, path: str, prefix: str) -> list[str]:
    """Names of the ``prefix...`` folders of ``path`` that were written to the end."""
    if not _exists(spark, path):
        return []
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    names = [s.getPath().getName() for s in fs.listStatus(p) if s.isDirectory() and s.getPath().getName().startswith(prefix)]
    return [n for n in names if fs.exists(jvm.org.apache.hadoop.fs.Path(f"{path}/{n}/_SUCCESS"))]


class IpState:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, root = spark, root.rstrip("/")   # ``root``: a folder of this state alone
        self.players_path, self.days_path = f"{root}/players", f"{root}/ip_days"

    # -- players
    def _numbered(self) -> tuple[DataFrame | None, int]:
        """(player_id, number) of all loads so far, and the next free number."""
        firsts = sorted(int(n.removeprefix("first=")) for n in _folders(self.spark, self.players_path, "first="))
        if not firsts:
            return None, 1
        known = self.spark.read.schema("player_id string, number long").parquet(*[f"{self.players_path}/first={n}" for n in firsts])
        newest = self.spark.read.parquet(f"{self.players_path}/first={firsts[-1]}").count()
        return known, firsts[-1] + newest

    def number_players(self, players: DataFrame) -> DataFrame:
        """(player_id, number) with a number for every player of ``players``; new
        players get the next free ones, dense, each task a range of its own."""
        known, next_ = self._numbered()
        new = players.select("player_id").where("player_id is not null").distinct()
        if known is not None:
            new = new.join(known, "player_id", "left_anti")
        scratch = f"{checkpoint_dir(self.spark).rstrip('/')}/riskmesh-new-players-{uuid.uuid4().hex}"
        new.write.parquet(scratch)
        new = self.spark.read.schema("player_id string").parquet(scratch)
        total = new.count()
        if total:
            parts = -(-total // NUMBERS_PER_TASK)
            new = new.withColumn("part", F.pmod(F.xxhash64("player_id"), F.lit(parts)))
            sizes = {r["part"]: r["count"] for r in new.groupBy("part").count().collect()}   # one row a million new players
            first, starts = next_, []
            for part in sorted(sizes):
                starts.append((part, first))
                first += sizes[part]
            starts = F.broadcast(self.spark.createDataFrame(starts, "part long, start long"))
            rank = F.expr("row_number() over (partition by part order by player_id)")
            new.join(starts, "part").select("player_id", (F.col("start") + rank - 1).cast("long").alias("number")) \
                .write.mode("overwrite").parquet(f"{self.players_path}/first={next_}")
        _delete(self.spark, scratch)
        return self._numbered()[0]

    # -- days
    def refresh(self, sessions: DataFrame, days: Iterable[_dt.date] | None = None) -> None:
        """Take the sets of ``days`` (default: all) anew from ``sessions`` (player_id,
        ip, session_date). Of the sessions only these days are read."""
        days = None if days is None else sorted({d for d in days if d is not None})   # a session without a time has no day
        if days is not None:
            if not days:
                return
            sessions = sessions.where(F.col(DAY).isin(days))
        pairs = sessions.where("ip is not null and player_id is not null").select("ip", DAY, "player_id").distinct()
        numbered = self.number_players(pairs)
        if numbered is None:    # no player yet
            return
        sets = player_sets(pairs.join(numbered, "player_id"), ["ip", DAY])
        _write(sets, self.days_path, DAY, dynamic=days is not None)
        if days is not None:    # a day without an IP any more is not in the output
            left = {r[0] for r in pairs.select(DAY).distinct().collect()}
            for day in set(days) - left:
                _delete(self.spark, f"{self.days_path}/{DAY}={day}")

    def _sets(self, since: _dt.date | None = None, until: _dt.date | None = None) -> DataFrame:
        schema = f"ip string, bucket long, few array<int>, bits binary, {DAY} date"
        if not _exists(self.spark, self.days_path):
            return self.spark.createDataFrame([], schema)
        sets = self.spark.read.schema(schema).parquet(self.days_path)
        if since is not None:
            sets = sets.where(F.col(DAY) >= F.lit(since))
        if until is not None:
            sets = sets.where(F.col(DAY) <= F.lit(until))
        return sets

    # -- results
    def players_per_ip(self, since: _dt.date | None = None, until: _dt.date | None = None, every: str | None = None) -> DataFrame:
        """(ip, player_count): distinct players over the days from ``since`` to
        ``until``; with ``every`` ("week", "month") per (ip, that period)."""
        sets, by = self._sets(since, until), ["ip"]
        if every:
            sets, by = sets.withColumn(every, F.trunc(F.col(DAY), every)), ["ip", every]
        return set_counts(merged_sets(sets, by), by)

    def risk(self, since: _dt.date | None = None, until: _dt.date | None = None) -> DataFrame:
        """(player_id, max_players_on_same_ip) of every player with an IP."""
        merged = merged_sets(self._sets(since, until), ["ip"])
        counts = set_counts(merged, ["ip"])
        # the count goes to the sets, one row a key and bucket, before players are listed
        most = set_members(merged.join(counts, "ip"), ["player_count"]).groupBy("number").agg(F.max("player_count").alias("max_players_on_same_ip"))
        known = self._numbered()[0]
        if known is None:
            return self.spark.createDataFrame([], "player_id string, max_players_on_same_ip long")
        return most.join(known, "number").select("player_id", "max_players_on_same_ip")
