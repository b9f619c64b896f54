"""Gold marts from stored partials per day against full rebuilds."""

import os
import random

import pytest

from riskmesh.operators import gold
from riskmesh.plans.gold_state import GoldState
from riskmesh.plans.pipeline import run
from riskmesh.plans.upsert import _delete
from tests.conftest import rows

AS_OF = "2026-06-30"


def land(folder, name, header, records):
    os.makedirs(folder, exist_ok=True)
    path = os.path.join(folder, name)
    with open(path, "w") as f:
        f.write(header + "\n" + "".join(",".join(map(str, r)) + "\n" for r in records))
    return path


def feeds(folder, seed, days):
    rng = random.Random(seed)
    players = [(f"p{i}", f"p{i}@x.com", "rio", "2026-01-01") for i in range(12)]
    sessions = [(f"s{d}-{i}", f"p{rng.randrange(14)}", rng.choice(["a", "b", f"c{rng.randrange(5)}"]), rng.choice(["web", "tv", "ios", "pc"]), f"2026-01-{d:02d} 0{i % 9}:00:00")
                for d in days for i in range(15)]
    tx = [(f"t{d}-{i}", f"p{rng.randrange(14)}", rng.choice(["deposit", "withdraw", "bet"]), rng.randrange(1, 900) / 4, f"2026-01-{d:02d} 1{i % 9}:00:00") for d in days for i in range(15)]
    aff = [("a1", f"p{i}", "BR", 10, 12 if i % 4 == 0 else 5, 1, 3) for i in range(12)]
    return {"players": land(folder, "players.csv", "player_id,email,city,created_at", players),
            "sessions": land(folder, "sessions.csv", "session_id,player_id,ip,device,timestamp", sessions),
            "transactions": land(folder, "transactions.csv", "transaction_id,player_id,type,amount,timestamp", tx),
            "affiliate_cpa_ftd": land(folder, "aff.csv", "affiliate_id,player_id,country,clicks,registrations,ftd,cpa_value", aff)}


def rebuilt(spark, root):
    s = {n: spark.read.parquet(os.path.join(root, "silver", n)) for n in ("slv_players", "slv_sessions", "slv_transactions", "slv_affiliate_cpa_ftd")}
    fin = gold.gold_financial_signals(s["slv_transactions"])
    return rows(fin), rows(gold.gold_fraud_overview(s["slv_players"], s["slv_sessions"], fin, s["slv_affiliate_cpa_ftd"]))


def marts(spark, root):
    read = {n: spark.read.parquet(os.path.join(root, "gold", n)) for n in ("gold_financial_signals", "gold_fraud_overview")}
    return rows(read["gold_financial_signals"]), rows(read["gold_fraud_overview"])


def test_runs_read_changed_days_only_and_equal_rebuilds(spark, workdir):
    root, formats = os.path.join(workdir, "wh"), dict.fromkeys(("players", "sessions"), "csv")
    options = dict(as_of=AS_OF, formats=formats, incremental_gold=True, gate=False, splittable=True)
    rep = run(spark, root, feeds(f"{workdir}/one", 1, range(10, 14)), **options)
    assert rep.refreshed_days == {"transactions": 4, "sessions": 4} and marts(spark, root) == rebuilt(spark, root)
    # the second load has the watermark's day again, and two new ones
    rep = run(spark, root, feeds(f"{workdir}/two", 2, range(13, 16)), **options)
    assert rep.refreshed_days == {"transactions": 3, "sessions": 3} and marts(spark, root) == rebuilt(spark, root)
    # days that did not change are not read: their silver files could be gone
    days = {str(d) for d in GoldState(spark, f"{root}/state").stale_days("ips", f"{root}/silver/slv_sessions", "session_date")}
    assert days == set()
    rep = run(spark, root, None, **options)
    assert set(rep.refreshed_days.values()) <= {0, 1} and marts(spark, root) == rebuilt(spark, root)


def test_a_day_that_vanished_and_a_missed_refresh_are_caught_up(spark, workdir):
    silver, state = os.path.join(workdir, "silver"), GoldState(spark, os.path.join(workdir, "state"))
    tx = spark.createDataFrame([(f"t{i}", f"p{i % 3}", "bet", 1.0 * i, 0.0, 0.0, 1.0 * i, f"2026-01-0{1 + i % 4}") for i in range(40)],
                               "transaction_id string, player_id string, transaction_type string, amount double, d double, w double, b double, day string") \
        .selectExpr("transaction_id", "player_id", "transaction_type", "cast(amount as decimal(38,9)) amount", "cast(d as decimal(38,9)) deposit_amount",
                    "cast(w as decimal(38,9)) withdraw_amount", "cast(b as decimal(38,9)) bet_amount", "cast(day as timestamp) transaction_at", "cast(day as date) transaction_date")
    path = f"{silver}/slv_transactions"
    tx.write.partitionBy("transaction_date").parquet(path)
    assert state.refresh(silver) == {"transactions": 4}
    assert rows(state.financial_signals()) == rows(gold.gold_financial_signals(tx))
    assert state.refresh(silver) == {"transactions": 0}
    less = tx.where("transaction_date <> '2026-01-02' and transaction_id <> 't2'")     # one day goes, another one changes
    less.where("transaction_date = '2026-01-03'").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("transaction_date").parquet(path)
    _delete(spark, f"{path}/transaction_date=2026-01-02")
    assert state.refresh(silver) == {"transactions": 2}
    assert rows(state.financial_signals()) == rows(gold.gold_financial_signals(less))


def test_empty_state(spark, workdir):
    state = GoldState(spark, os.path.join(workdir, "none"))
    assert state.refresh(os.path.join(workdir, "silver")) == {} and state.financial_signals().count() == 0


def test_overview_query_computes_the_sessions_once(spark, monkeypatch):
    from riskmesh.plans.catalog import QUERIES
    from riskmesh.session import checkpoint_dir
    read, refresh = [], GoldState.refresh_sessions

    def spy(self, sessions, days=None):
        read.extend(sessions.inputFiles())
        return refresh(self, sessions, days)

    monkeypatch.setattr(GoldState, "refresh_sessions", spy)
    got = QUERIES["gold_overview_from_state"](spark, "/root/testdata/sf0.001")
    assert read and all(checkpoint_dir(spark).removeprefix("file://") in f for f in read)    # no stage over the feed
    assert rows(got) == rows(QUERIES["gold_fraud_overview"](spark, "/root/testdata/sf0.001").select(*got.columns))
