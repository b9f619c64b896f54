"""Stored player sets per IP and day against recounts of all sessions."""

import datetime as dt
import os
import random
from collections import defaultdict

import pytest

from riskmesh.operators.player_sets import merged_sets, player_sets, set_counts, set_members
from riskmesh.operators.silver import slv_sessions
from riskmesh.plans.ip_state import IpState
from riskmesh.plans.upsert import incremental_build
from riskmesh.specs import SILVER


def pairs(spark, rows):
    return spark.createDataFrame(rows, "ip string, day int, number long")


def test_sets_equal_plain_sets_for_lists_bitmaps_and_both(spark):
    rng = random.Random(3)
    rows = [("hot", d, rng.randrange(1, 100_000)) for d in range(3) for _ in range(4000)]          # bitmaps in 4 buckets
    rows += [("mixed", 0, n) for n in range(1, 200)] + [("mixed", 1, n) for n in (5, 300, 32768, 32769)]   # bitmap and lists
    rows += [("few", d, n) for d in range(2) for n in (1, 32768, 32769, 7 + d)] + [("edge", 0, n) for n in range(1, 65)] + [("over", 0, n) for n in range(1, 66)]
    rows += rows[:500]
    want = defaultdict(set)
    for ip, _, n in rows:
        want[ip].add(n)
    sets = player_sets(pairs(spark, rows), ["ip", "day"])
    by_ip = {(r.ip, r.day, r.bucket): r for r in sets.collect()}
    assert by_ip[("edge", 0, 1)].bits is None and len(by_ip[("edge", 0, 1)].few) == 64
    assert by_ip[("over", 0, 1)].few is None and len(by_ip[("over", 0, 1)].bits) == 4096
    merged = merged_sets(sets, ["ip"])
    assert {r.ip: r.player_count for r in set_counts(merged, ["ip"]).collect()} == {k: len(v) for k, v in want.items()}
    got = defaultdict(list)
    for r in set_members(merged, ["ip"]).collect():
        got[r.ip].append(r.number)
    assert {k: sorted(v) for k, v in got.items()} == {k: sorted(v) for k, v in want.items()}


def test_no_bitmap_is_made_for_keys_with_lists_only(spark):
    sets = player_sets(pairs(spark, [(f"ip{i % 50}", i % 3, i + 1) for i in range(300)]), ["ip", "day"])
    assert sets.where("bits is not null").count() == 0 and merged_sets(sets, ["ip"]).where("bits is not null").count() == 0


def sessions(spark, rows):
    """rows: (session, player, ip, time)"""
    return spark.createDataFrame([(s, p, ip, "web", t, t[:10]) for s, p, ip, t in rows],
                                 "session_id string, player_id string, ip string, device string, timestamp string, dt string") \
        .withColumn("dt", __import__("pyspark.sql.functions", fromlist=["col"]).col("dt").cast("date"))


def recount(rows):
    ips = defaultdict(set)
    for _, p, ip in rows:
        if ip is not None:
            ips[ip].add(p)
    risk = defaultdict(int)
    for players in ips.values():
        for p in players:
            risk[p] = max(risk[p], len(players))
    return {k: len(v) for k, v in ips.items()}, dict(risk)


def test_loads_equal_recounts_and_read_touched_days_only(spark, workdir):
    state, target = IpState(spark, os.path.join(workdir, "state")), os.path.join(workdir, "slv_sessions")
    rng = random.Random(8)
    rows = [(f"s{i}", f"p{rng.randrange(60)}", rng.choice(["a", "b", f"ip{rng.randrange(20)}", None]), f"2026-01-{10 + i % 5:02d} 0{i % 9}:00:00") for i in range(400)]
    second = [(f"t{i}", f"p{rng.randrange(90)}", rng.choice(["a", "c", None]), f"2026-01-14 1{i % 9}:00:00") for i in range(50)]
    second += [(rows[4][0], rows[4][1], "moved", "2026-01-14 20:00:00")]      # the newer version of a session has another IP
    third = [(f"u{i}", f"p{i}", "late", f"2026-01-2{i % 3} 10:00:00") for i in range(9)]
    everything = []
    for load, (new, days) in enumerate([(rows, None), (second, {dt.date(2026, 1, 14)}), (third, {dt.date(2026, 1, 20), dt.date(2026, 1, 21), dt.date(2026, 1, 22)}), ([], None)]):
        everything += new
        done = incremental_build(spark, target, sessions(spark, everything), SILVER["slv_sessions"], slv_sessions, as_of="2026-12-31")
        silver = spark.read.parquet(target)
        if load in (1, 2):
            assert days <= set(done.days) <= days | {dt.date(2026, 1, 14)}
            # sessions of other days are not read: without them the state is the same
            silver_seen = silver.where(silver.session_date.isin(list(done.days)))
            state.refresh(silver_seen, done.days)
        else:
            state.refresh(silver, done.days)
        counts, risk = recount([(r.session_id, r.player_id, r.ip) for r in silver.collect()])
        assert {r.ip: r.player_count for r in state.players_per_ip().collect()} == counts
        assert {r.player_id: r.max_players_on_same_ip for r in state.risk().collect()} == risk
    day = {r.ip: r.player_count for r in state.players_per_ip(dt.date(2026, 1, 20), dt.date(2026, 1, 21)).collect()}
    assert day == {"late": 6}
    numbers = [r.number for r in state._numbered()[0].collect()]
    assert sorted(numbers) == list(range(1, len(numbers) + 1))


def test_repeated_refresh_changes_nothing_and_vanished_days_go(spark, workdir):
    state = IpState(spark, os.path.join(workdir, "state"))
    one = spark.createDataFrame([("p1", "a", dt.date(2026, 1, 1)), ("p2", "a", dt.date(2026, 1, 2)), (None, "a", dt.date(2026, 1, 2)), ("p3", None, dt.date(2026, 1, 2))],
                                "player_id string, ip string, session_date date")
    for _ in range(2):
        state.refresh(one)
        assert [tuple(r) for r in state.players_per_ip().collect()] == [("a", 2)]
    state.refresh(one.where("player_id = 'p1' or ip is null"), [dt.date(2026, 1, 2)])
    assert [tuple(r) for r in state.players_per_ip().collect()] == [("a", 1)]
    state.refresh(one, [])
    assert state.risk().count() == 1


def test_an_unfinished_numbering_is_ignored(spark, workdir):
    state = IpState(spark, os.path.join(workdir, "state"))
    day = dt.date(2026, 1, 1)
    state.refresh(spark.createDataFrame([("p1", "a", day)], "player_id string, ip string, session_date date"))
    spark.createDataFrame([("p9", 2)], "player_id string, number long").write.parquet(f"{state.players_path}/first=2")
    os.remove(f"{state.players_path}/first=2/_SUCCESS")
    state.refresh(spark.createDataFrame([("p1", "a", day), ("p2", "a", day)], "player_id string, ip string, session_date date"))
    assert {r.player_id: r.number for r in state._numbered()[0].collect()} == {"p1": 1, "p2": 2}


def test_empty_state(spark, workdir):
    state = IpState(spark, os.path.join(workdir, "none"))
    assert state.players_per_ip().count() == 0 and state.risk().count() == 0
    state.refresh(spark.createDataFrame([], "player_id string, ip string, session_date date"))
    assert state.risk().count() == 0
