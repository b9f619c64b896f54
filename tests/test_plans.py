"""Physical-plan properties the design relies on at scale."""

import os

from riskmesh.operators import gold, silver
from riskmesh.sources.ingest import write_bronze
from riskmesh.sources.bronze import read_bronze
from tests.fixtures import bronze


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def sessions(spark):
    return bronze(spark, "sessions", [
        (f"s{i}", f"p{i % 3}", f"ip{i % 2}", "web", f"2026-01-2{i % 3} 10:00:00", f"2026-01-2{i % 3}")
        for i in range(12)])


def test_dedup_limits_rows_before_the_shuffle(spark):
    p = plan(silver.slv_sessions(sessions(spark), as_of="2026-06-30"))
    assert p.count("WindowGroupLimit") >= 2          # partial (map side) + final
    partial = p.index("Exchange hashpartitioning(session_id")
    assert "WindowGroupLimit" in p[partial:]          # a limit below the exchange


def only_hot_keys_are_broadcast(p):
    """Every broadcast is the sketch's few hundred keys at most (``salting.py``)."""
    lines = p.splitlines()
    for i, line in enumerate(lines):
        if "BroadcastExchange" in line:
            depth = line.index("BroadcastExchange")
            below = []
            for x in lines[i + 1:]:
                if len(x) - len(x.lstrip(" :+-*()0123456789")) <= depth:
                    break
                below.append(x)
            assert any("explode(top" in x for x in below) and any("approx_top_k" in x for x in below), line


def test_session_behaviour_pre_aggregates_before_shuffles(spark):
    s = silver.slv_sessions(sessions(spark), as_of="2026-06-30")
    p = plan(gold.session_behaviour(s))
    assert "partial_count" in p and "partial_max" in p
    only_hot_keys_are_broadcast(p)                    # nothing on static estimates


def test_overview_has_no_static_broadcast(spark):
    s = silver.slv_sessions(sessions(spark), as_of="2026-06-30")
    players = silver.slv_players(bronze(spark, "players", [
        ("p0", "a@b.c", "x", "2026-01-01", "2026-01-01")]), as_of="2026-06-30")
    tx = silver.slv_transactions(bronze(spark, "transactions", [
        ("t", "p0", "bet", "1", "2026-01-20 10:00:00", "2026-01-20")]), as_of="2026-06-30")
    aff = silver.slv_affiliate_cpa_ftd(bronze(spark, "affiliate_cpa_ftd", [
        ("a", "p0", "BR", "1", "1", "1", "1", "2026-01-20")]), as_of="2026-06-30")
    ov = gold.gold_fraud_overview(players, s, gold.gold_financial_signals(tx), aff)
    p = ov._jdf.queryExecution().executedPlan().toString()
    only_hot_keys_are_broadcast(p)
    assert "SortMergeJoin" in p


def test_bronze_scan_prunes_partitions_and_columns(spark, workdir):
    path = os.path.join(workdir, "sessions")
    write_bronze(sessions(spark), path, "sessions")
    b = read_bronze(spark, path, "sessions", "1900-01-01", "2026-06-30")
    inc = silver.slv_sessions(b, as_of="2026-06-30", since="2026-01-22 00:00:00")
    p = plan(inc.select("session_id"))
    assert "PartitionFilters: [isnotnull(dt" in p and "dt#" in p
    assert "2026-01-21" in p                          # watermark - 1 day on the partition column
    counts = plan(b.groupBy("dt").count())
    assert "ReadSchema: struct<>" in counts           # no data column read for a count per day


def test_catalog_plans_do_not_depend_on_table_size(spark):
    from riskmesh.plans.catalog import QUERIES
    for name in ("slv_sessions", "slv_affiliate_cpa_ftd", "gold_fraud_overview", "bronze_partition_date"):
        df = QUERIES[name](spark, "/root/testdata/sf0.001")
        assert "REPARTITION_BY_NUM" not in plan(df)


def test_overview_pages_are_one_pass(spark):
    from riskmesh.operators import reports
    from riskmesh.operators.quality import SIGNAL_FLAGS
    from tests.conftest import rows
    data = [(i % 3, None if i % 5 == 0 else f"c{i % 2}", *[i % (k + 2) == 0 for k in range(len(SIGNAL_FLAGS))], i, i) for i in range(40)]
    df = spark.createDataFrame(data, ", ".join(["fraud_signal_count long, city string", *[f"{f} boolean" for f in SIGNAL_FLAGS],
                                                "distinct_device_count long, max_players_on_same_ip long"]))
    pages = reports.overview_pages(df)
    plan = pages._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Expand") == 1 and plan.count("Aggregate") == 1
    by_city = pages.where("page = 'city'").drop("page", "fraud_signal_count")
    assert rows(by_city, *reports.risk_by_city(df).columns) == rows(reports.risk_by_city(df))
    assert rows(pages.where("page = 'score'"), "fraud_signal_count", "players") == rows(reports.risk_by_score(df))
    assert pages.where("page = 'total'").first()["players"] == 40


def test_coalesced_partitions_bound_the_memory_of_a_task(spark):
    from riskmesh.session import ADAPTIVE_CONF
    assert int(ADAPTIVE_CONF["spark.sql.adaptive.advisoryPartitionSizeInBytes"].removesuffix("MB")) * 15 <= 1000   # MB of aggregate rows
