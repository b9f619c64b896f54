from decimal import Decimal

from riskmesh.operators import gold, silver
from tests.conftest import rows
from tests.fixtures import bronze

AS_OF = "2026-06-30"


def tx(spark, data):
    """data: (player, type, amount) -> silver transactions."""
    raw = [(f"t{i}", p, k, a, "2026-01-20 10:00:00", "2026-01-20") for i, (p, k, a) in enumerate(data)]
    return silver.slv_transactions(bronze(spark, "transactions", raw), as_of=AS_OF)


def test_financial_thresholds(spark):
    t = tx(spark, [
        ("eq", "deposit", "400"), ("eq", "withdraw", "600"),          # = 1.5x -> false
        ("above", "deposit", "400"), ("above", "withdraw", "600.01"),  # just above -> true
        ("small", "deposit", "100"), ("small", "withdraw", "499.99"),  # < 500 -> false
        ("five", "deposit", "200"), ("five", "bet", "1000"),            # = 5x and 1000 -> true
        ("under", "deposit", "100"), ("under", "bet", "999.99"),        # < 1000 -> false
        ("nodep", "withdraw", "800"),                                   # zero deposits
    ])
    f = {r.player_id: r for r in gold.gold_financial_signals(t).collect()}
    assert f["eq"].has_high_withdraw_signal is False
    assert f["above"].has_high_withdraw_signal is True
    assert f["small"].has_high_withdraw_signal is False
    assert f["five"].has_high_bet_velocity_signal is True
    assert f["under"].has_high_bet_velocity_signal is False
    assert f["nodep"].withdraw_to_deposit_ratio is None
    assert f["nodep"].has_high_withdraw_signal is True
    assert f["eq"].withdraw_to_deposit_ratio == Decimal("1.500000000")
    assert (f["eq"].transaction_count, f["eq"].deposit_count, f["eq"].withdraw_count) == (2, 1, 1)


def test_overview_signals_and_star_join(spark):
    players = silver.slv_players(bronze(spark, "players", [
        (p, f"{p}@x.com", "c", "2026-01-01", "2026-01-01")
        for p in ["p1", "p2", "p3", "p4", "p5", "p6", "nodep"]]), as_of=AS_OF)
    sess = []
    for i, p in enumerate(["p1", "p2", "p3", "p4", "p5"]):        # 5 players on ip A
        sess.append((f"a{i}", p, "A", "web", "2026-01-20 10:00:00", "2026-01-20"))
    for i, p in enumerate(["p1", "p2", "p3", "p4"]):              # 4 players on ip B
        sess.append((f"b{i}", p, "B", "web", "2026-01-20 10:00:00", "2026-01-20"))
    sess.append(("b9", "p6", "B", "web", "2026-01-20 10:00:00", "2026-01-20"))
    for i, d in enumerate(["web", "mobile", "tablet", "tv"]):     # p1: 4 devices
        sess.append((f"d{i}", "p1", None, d, "2026-01-21 10:00:00", "2026-01-21"))
    for i, d in enumerate(["web", "mobile", "tablet"]):           # p2: 3 devices
        sess.append((f"e{i}", "p2", None, d, "2026-01-21 10:00:00", "2026-01-21"))
    sess.append(("x1", "ghost", "A", "web", "2026-01-20 10:00:00", "2026-01-20"))  # not a player
    sessions = silver.slv_sessions(bronze(spark, "sessions", sess), as_of=AS_OF)
    fin = gold.gold_financial_signals(tx(spark, [("nodep", "withdraw", "800")]))
    aff = silver.slv_affiliate_cpa_ftd(bronze(spark, "affiliate_cpa_ftd", [
        ("a1", "p3", "BR", "1", "2", "0", "5", "2026-01-20"),
        ("a1", "p4", "BR", None, "1", "0", "5", "2026-01-20")]), as_of=AS_OF)
    ov = {r.player_id: r for r in gold.gold_fraud_overview(players, sessions, fin, aff).collect()}
    assert set(ov) == {"p1", "p2", "p3", "p4", "p5", "p6", "nodep"}   # ghost dropped
    assert ov["p1"].max_players_on_same_ip == 6                      # ip A: p1..p5 + ghost
    assert ov["p6"].max_players_on_same_ip == 5 and ov["p6"].has_shared_ip_signal is True
    assert ov["p1"].has_many_devices_signal is True and ov["p2"].has_many_devices_signal is False
    assert ov["p1"].distinct_ip_count == 2 and ov["p1"].session_count == 6
    assert ov["p3"].has_affiliate_funnel_anomaly is True
    assert ov["p4"].has_affiliate_funnel_anomaly is False              # NULL flags -> FALSE
    n = ov["nodep"]
    assert n.withdraw_to_deposit_ratio == Decimal("0E-9") and n.has_high_withdraw_signal is True
    assert n.session_count == 0 and n.last_session_at is None
    assert ov["p1"].fraud_signal_count == 2                          # shared ip + devices
    assert all(0 <= r.fraud_signal_count <= 5 for r in ov.values())


def test_affiliate_metrics_recompute_rates(spark):
    aff = silver.slv_affiliate_cpa_ftd(bronze(spark, "affiliate_cpa_ftd", [
        ("a1", "p1", "br", "10", "2", "1", "40", "2026-01-20"),
        ("a1", "p1", "BR", "5", "6", "1", "40", "2026-01-20"),
        ("a1", "p2", "BR", None, "1", "0", "40", "2026-01-20"),
    ]), as_of=AS_OF)
    m = gold.gold_affiliate_metrics(aff).collect()
    assert len(m) == 1
    r = m[0]
    assert (r.attributed_players, r.clicks, r.registrations, r.ftd) == (2, 15, 9, 2)
    assert r.registration_rate == 9 / 15 and r.ftd_rate == 2 / 9
    assert (r.registration_over_click_rows, r.has_funnel_anomaly) == (1, True)
    assert r.estimated_cpa_cost == Decimal("80.000000000")


def test_top_risk_players_orders_by_score_then_id(spark):
    df = spark.createDataFrame([("b", 2), ("a", 2), ("c", 5), ("d", 0)],
                               "player_id string, fraud_signal_count bigint")
    assert rows(gold.top_risk_players(df, 2)) == [("a", 2), ("c", 5)]
