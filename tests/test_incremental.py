"""Multi-run behaviour of the incremental silver models."""

import datetime as dt
import json
import os
import time

import pytest
from pyspark.sql import functions as F

from riskmesh.operators import silver
from riskmesh.plans.upsert import incremental_build, merge_partition_local, upsert
from riskmesh.specs import SILVER
from tests.conftest import rows
from tests.fixtures import bronze

AS_OF = "2026-06-30"
SPEC = SILVER["slv_transactions"]


def tx(spark, data):
    return bronze(spark, "transactions", [
        (i, p, k, a, ts, ts[:10]) for i, p, k, a, ts in data])


def build(spark, path, data, **kw):
    return incremental_build(spark, path, tx(spark, data), SPEC, silver.slv_transactions,
                             as_of=AS_OF, **kw)


def table(spark, path):
    return rows(spark.read.parquet(path), "transaction_id", "transaction_type", "amount",
                "transaction_date")


def test_two_loads_late_row_and_equal_to_max(spark, workdir):
    path = os.path.join(workdir, "slv_transactions")
    first = [("t1", "p", "bet", "1", "2026-01-20 10:00:00"),
             ("t2", "p", "bet", "2", "2026-01-21 10:00:00")]
    assert build(spark, path, first).mode == "full"
    second = first + [
        ("t0", "p", "bet", "9", "2026-01-19 10:00:00"),          # late: older than max -> ignored
        ("t2", "p", "deposit", "3", "2026-01-21 10:00:00"),      # equal to max -> merged again
        ("t3", "p", "withdraw", "4", "2026-01-22 10:00:00"),     # new
    ]
    assert build(spark, path, second).mode == "incremental"
    got = {r[0]: r for r in table(spark, path)}
    assert set(got) == {"t1", "t2", "t3"}
    # t2 has two rows with the same (event, dt) in the batch: the tie-break keeps one
    assert len([r for r in table(spark, path) if r[0] == "t2"]) == 1
    # rerun without new rows: same table (idempotent)
    before = table(spark, path)
    build(spark, path, second)
    assert table(spark, path) == before
    # full refresh picks up the late row
    build(spark, path, second, full_refresh=True)
    assert "t0" in {r[0] for r in table(spark, path)}


def test_moved_date_duplicates_only_when_partition_local(spark, workdir):
    for local, expected in ((True, 2), (False, 1)):
        path = os.path.join(workdir, f"t_{local}")
        build(spark, path, [("t1", "p", "bet", "1", "2026-01-20 10:00:00")])
        build(spark, path, [("t1", "p", "bet", "5", "2026-01-21 10:00:00")], partition_local=local)
        assert len(table(spark, path)) == expected


def test_merge_expression_matches_key_and_date(spark):
    t = spark.createDataFrame([("a", "d1", 1), ("b", "d1", 1), ("c", "d2", 1)], "k string, d string, v int")
    b = spark.createDataFrame([("a", "d1", 2), ("c", "d3", 2)], "k string, d string, v int")
    assert rows(merge_partition_local(t, b, "k", "d")) == [
        ("a", "d1", 2), ("b", "d1", 1), ("c", "d2", 1), ("c", "d3", 2)]
    assert rows(merge_partition_local(t, b, "k", "d", partition_local=False)) == [
        ("a", "d1", 2), ("b", "d1", 1), ("c", "d3", 2)]


def small(spark, *data, columns):
    """rows of (id, day, values...)"""
    schema = "transaction_id string, day string, " + columns
    df = spark.createDataFrame(data, schema)
    return df.select("transaction_id", F.col("day").cast("date").alias("transaction_date"), *[c.split()[0] for c in columns.split(", ")])


def files_of(path):
    return {os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns for d, _, names in os.walk(path) for f in names if f.endswith(".parquet")}


def test_schema_sync_needs_no_rewrite_of_old_partitions(spark, workdir):
    from riskmesh.sources.tables import read_table
    path, spec = os.path.join(workdir, "s"), SILVER["slv_transactions"]
    upsert(spark, path, small(spark, ("t1", "2026-01-20", 1, 7), ("t3", "2026-01-21", 3, 9), columns="v int, z int"), spec)
    old = files_of(path)
    day20 = {f for f in old if "2026-01-20" in f}
    # w comes, v goes; the touched day is rewritten, the other one stays as it is
    upsert(spark, path, small(spark, ("t2", "2026-01-21", "x", 5), columns="w string, z int"), spec)
    assert {f: t for f, t in files_of(path).items() if f in day20} == {f: old[f] for f in day20}
    df = read_table(spark, path)
    assert sorted(df.columns) == ["transaction_date", "transaction_id", "w", "z"]
    assert rows(df, "transaction_id", "w", "z") == [("t1", None, 7), ("t2", "x", 5), ("t3", None, 9)]
    # an empty batch with another column changes the columns alone
    before = files_of(path)
    assert upsert(spark, path, small(spark, columns="w string, z int, k double"), spec).mode == "noop"
    assert files_of(path) == before and "k" in read_table(spark, path).columns
    # v comes back: old files still hold its values, so they are rewritten
    upsert(spark, path, small(spark, ("t4", "2026-01-22", 4), columns="v int"), spec)
    assert rows(read_table(spark, path), "transaction_id", "v") == [("t1", None), ("t2", None), ("t3", None), ("t4", 4)]
    assert not day20 & set(files_of(path))
    # another type is a rewrite too
    upsert(spark, path, small(spark, ("t5", "2026-01-22", "five"), columns="v string"), spec)
    assert rows(read_table(spark, path), "transaction_id", "v") == [("t1", None), ("t2", None), ("t3", None), ("t4", "4"), ("t5", "five")]


@pytest.mark.parametrize("fails_at", ["swap", "delete"])
def test_a_failed_swap_is_finished_by_the_next_run(spark, workdir, monkeypatch, fails_at):
    from riskmesh.plans import upsert as U
    path, spec = os.path.join(workdir, "s"), SILVER["slv_transactions"]
    upsert(spark, path, small(spark, ("t1", "2026-01-20", 1), ("t2", "2026-01-21", 2), columns="v int"), spec)
    write, delete, calls = U._write, U._delete, []

    def failing_write(df, where, *a, **k):
        calls.append(where)
        if fails_at == "swap" and where == path:
            raise OSError("lost")
        write(df, where, *a, **k)

    def failing_delete(session, where):
        if fails_at == "delete" and where.startswith(path):
            raise OSError("lost")
        delete(session, where)

    monkeypatch.setattr(U, "_write", failing_write)
    monkeypatch.setattr(U, "_delete", failing_delete)
    moved = small(spark, ("t1", "2026-01-22", 10), columns="v int")      # its old day is empty afterwards
    with pytest.raises(OSError):
        upsert(spark, path, moved, spec, partition_local=False)
    monkeypatch.undo()
    # a run with nothing new finishes it
    assert upsert(spark, path, small(spark, columns="v int"), spec).mode == "noop"
    assert rows(spark.read.parquet(path), "transaction_id", "v") == [("t1", 10), ("t2", 2)]
    assert not os.path.exists(f"{path}/transaction_date=2026-01-20") and not [f for f in os.listdir(workdir) if "pending" in f]


def test_tables_without_a_columns_file_still_work(spark, workdir):
    from riskmesh.sources.tables import read_table
    path, spec = os.path.join(workdir, "s"), SILVER["slv_transactions"]
    small(spark, ("t1", "2026-01-20", 1), columns="v int").write.partitionBy("transaction_date").parquet(path)
    assert rows(read_table(spark, path), "transaction_id", "v") == [("t1", 1)]
    upsert(spark, path, small(spark, ("t2", "2026-01-21", 2, 3), columns="v int, w int"), spec)
    assert rows(read_table(spark, path), "transaction_id", "v", "w") == [("t1", 1, None), ("t2", 2, 3)]


def test_streaming_micro_loads_process_only_new_files(spark, workdir):
    from riskmesh.streaming import micro_load
    landing = os.path.join(workdir, "landing")
    os.makedirs(landing)
    target = os.path.join(workdir, "slv_transactions")
    ckpt = os.path.join(workdir, "ckpt")
    header = "transaction_id,player_id,type,amount,timestamp\n"
    with open(os.path.join(landing, "h1.csv"), "w") as f:
        f.write(header + "t1,p,bet,1,2026-01-20 10:00:00\nt2,p,bet,2,2026-01-20 11:00:00\n")
    assert micro_load(spark, landing, "transactions", target, ckpt, as_of=AS_OF) == 2
    assert len(table(spark, target)) == 2
    before = table(spark, target)
    assert micro_load(spark, landing, "transactions", target, ckpt, as_of=AS_OF) == 0  # no new files
    assert table(spark, target) == before
    with open(os.path.join(landing, "h2.csv"), "w") as f:
        f.write(header + "t2,p,withdraw,5,2026-01-20 11:30:00\nt3,p,bet,3,2026-01-21 09:00:00\n")
    micro_load(spark, landing, "transactions", target, ckpt, as_of=AS_OF)
    got = {r[0]: r for r in table(spark, target)}
    assert set(got) == {"t1", "t2", "t3"} and got["t2"][1] == "withdraw"


def test_pipeline_end_to_end(spark, workdir):
    from riskmesh.plans.pipeline import run
    land = os.path.join(workdir, "landing")
    os.makedirs(land)

    def put(name, text):
        p = os.path.join(land, name)
        with open(p, "w") as f:
            f.write(text)
        return p

    players = put("players.json", json.dumps([
        {"player_id": "p1", "email": " A@X.COM", "city": "recife", "created_at": "2026-01-10"},
        {"player_id": "p2", "email": "b@y.com", "city": "rio-grande", "created_at": "2026-01-11"}]))
    sessions = put("sessions.json", json.dumps([
        {"session_id": "s1", "player_id": "p1", "ip": "1", "device": "web",
         "timestamp": "2026-01-20 10:00:00"}]))
    txs = put("transactions.csv", "transaction_id,player_id,type,amount,timestamp\n"
              "t1,p1,deposit,100,2026-01-20 10:00:00\nt2,p1,withdraw,600,2026-01-20 11:00:00\n")
    aff = put("affiliate_cpa_ftd.csv",
              "affiliate_id,player_id,country,clicks,registrations,ftd,cpa_value\n"
              "a1,p2,br,1,3,0,10\n")
    root = os.path.join(workdir, "wh")
    rep = run(spark, root, {"players": players, "sessions": sessions, "transactions": txs,
                            "affiliate_cpa_ftd": aff}, as_of=AS_OF,
              ingest_date=dt.date(2026, 1, 21))
    assert all(n == 0 for s in rep.checks.values() for (_, _, n) in s)
    ov = {r.player_id: r for r in spark.read.parquet(os.path.join(root, "gold", "gold_fraud_overview")).collect()}
    assert ov["p1"].has_high_withdraw_signal and ov["p1"].fraud_signal_count == 1
    assert ov["p2"].has_affiliate_funnel_anomaly and ov["p2"].city == "Rio-Grande"
    meta = spark.read.parquet(os.path.join(root, "gold", "gold_fraud_overview")).schema["fraud_signal_count"].metadata
    assert "comment" in meta
    # second run with no new landing data: incremental, nothing changes
    rep2 = run(spark, root, None, as_of=AS_OF)
    assert rep2.models["slv_transactions"] == "incremental"
    # optional freshness gate: data from January is stale by June
    import pytest
    from riskmesh.operators.quality import QualityGateError
    with pytest.raises(QualityGateError, match="freshness"):
        run(spark, root, None, as_of=AS_OF, freshness_max_age_days=30)


def test_lookback_admits_late_rows(spark, workdir):
    path = os.path.join(workdir, "lb")
    first = [("t1", "p", "bet", "1", "2026-01-21 10:00:00")]
    build(spark, path, first)
    late = first + [("t0", "p", "bet", "9", "2026-01-21 08:00:00")]   # 2 hours before the max
    build(spark, path, late)
    assert {r[0] for r in table(spark, path)} == {"t1"}                # default: ignored
    build(spark, path, late, lookback=dt.timedelta(hours=3))
    assert {r[0] for r in table(spark, path)} == {"t0", "t1"}


def test_watermark_reads_only_the_newest_partitions(spark, workdir):
    from riskmesh.plans.upsert import latest_partition, target_watermark
    path = os.path.join(workdir, "wm")
    build(spark, path, [("t1", "p", "bet", "1", "2026-01-20 10:00:00"),
                        ("t2", "p", "bet", "1", "2026-01-25 23:30:00")])
    assert latest_partition(spark, path, "transaction_date") == dt.date(2026, 1, 25)
    assert target_watermark(spark, path, SPEC) == dt.datetime(2026, 1, 25, 23, 30, tzinfo=dt.timezone.utc)


def test_pipeline_skips_feeds_never_landed(spark, workdir):
    from riskmesh.plans.pipeline import run
    p = os.path.join(workdir, "t.csv")
    with open(p, "w") as f:
        f.write("transaction_id,player_id,type,amount,timestamp\nt1,p1,deposit,100,2026-01-20 10:00:00\n")
    root = os.path.join(workdir, "wh")
    rep = run(spark, root, {"transactions": p}, as_of=AS_OF)
    assert rep.models["slv_transactions"] == "full"
    assert rep.models["gold_financial_signals"] == "full"
    assert rep.models["slv_players"].startswith("skipped")
    assert rep.models["gold_fraud_overview"].startswith("skipped")


@pytest.mark.parametrize("zone", ["UTC", "Asia/Tokyo", "America/Sao_Paulo"])
def test_second_load_does_not_depend_on_the_drivers_time_zone(spark, workdir, monkeypatch, zone):
    monkeypatch.setenv("TZ", zone)
    time.tzset()
    try:
        path = os.path.join(workdir, "slv_transactions")
        first = [("t1", "p", "bet", "1", "2026-01-20 10:00:00")]
        build(spark, path, first)
        second = first + [("t0", "p", "bet", "3", "2026-01-20 09:59:59"), ("t2", "p", "bet", "2", "2026-01-20 12:00:00")]
        build(spark, path, second)
        assert [r[0] for r in table(spark, path)] == ["t1", "t2"]
        build(spark, path, second, lookback=dt.timedelta(hours=3))
        assert [r[0] for r in table(spark, path)] == ["t0", "t1", "t2"]
    finally:
        monkeypatch.undo()
        time.tzset()


def test_future_dated_bronze_rows_are_checked(spark, workdir):
    from riskmesh.operators.quality import QualityGateError
    from riskmesh.plans.pipeline import run
    from riskmesh.sources.ingest import write_bronze
    rows_ = bronze(spark, "players", [("p1", "a@b.c", "x", "2026-01-01", "2026-01-01"), (None, "a@b.c", "x", "2999-01-01", "2999-01-01")])
    write_bronze(rows_, os.path.join(workdir, "bronze", "players"), "players")
    with pytest.raises(QualityGateError, match="not_null_players_player_id"):
        run(spark, workdir, as_of=AS_OF)


def test_pipeline_reads_formats_and_one_summary_a_layer(spark, workdir, monkeypatch):
    from riskmesh.operators import quality
    from riskmesh.plans.pipeline import run
    calls = []
    whole = quality.summary
    monkeypatch.setattr(quality, "summary", lambda checks, rel: calls.append(len(checks)) or whole(checks, rel))
    path = os.path.join(workdir, "players.csv")
    with open(path, "w") as f:
        f.write("player_id,email,city,created_at\n" + "".join(f"p{i},a@b.c,x,2026-01-01\n" for i in range(50)))
    rep = run(spark, workdir, {"players": path}, as_of=AS_OF, formats={"players": "csv"}, splittable=True, rows_per_file=10)
    assert rep.loads["players"].files_written >= 5 and rep.models["slv_players"] == "full"
    assert len(calls) == 2  # bronze and silver; no gold model can be built


def test_shared_folder_is_mandatory_off_local_masters(spark):
    from riskmesh.session import checkpoint_dir

    class Session:
        class conf:
            get = staticmethod(lambda key, default=None: {"spark.master": "spark://host:7077"}.get(key, default))
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        checkpoint_dir(Session)


def test_affiliate_feed_is_reloaded_whole(spark, workdir):
    from riskmesh.streaming.micro_loads import reload_affiliate
    src, silver_path, bronze_path = (os.path.join(workdir, x) for x in ("a.csv", "silver", "bronze"))
    header = "affiliate_id,player_id,country,clicks,registrations,ftd,cpa_value\n"

    def load(text):
        with open(src, "w") as f:
            f.write(header + text)
        return reload_affiliate(spark, src, silver_path, bronze_path, ingest_date=dt.date(2026, 1, 1), as_of=AS_OF)

    assert load("north,kim,cl,250,31,4,17.5\nnorth,lee,cl,9,1,0,17.5\n") == 2
    assert load("north,kim,cl,10,2,1,3\n") == 1
    assert [tuple(r) for r in spark.read.parquet(silver_path).select("player_id", "country", "clicks").collect()] == [("kim", "CL", 10)]
    assert load("") == 0 and spark.read.parquet(silver_path).count() == 1
