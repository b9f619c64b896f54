from decimal import Decimal

from riskmesh.operators import reports
from riskmesh.operators.quality import SIGNAL_FLAGS
from tests.conftest import rows


def overview(spark):
    schema = ("player_id string, city string, fraud_signal_count bigint, distinct_device_count bigint, "
              "max_players_on_same_ip bigint, " + ", ".join(f"{f} boolean" for f in SIGNAL_FLAGS))
    return spark.createDataFrame([
        ("p1", "A", 2, 4, 6, True, True, False, False, False),
        ("p2", "A", 0, 1, 1, False, False, False, False, False),
        ("p3", "B", 1, 2, 1, False, False, True, False, False),
    ], schema)


def test_layer_counts_and_duplicates(spark):
    a = spark.createDataFrame([("x",), ("x",), ("y",)], "k string")
    got = rows(reports.layer_row_counts({("silver", "a"): a, ("gold", "b"): a.limit(1)}))
    assert got == [("gold", "b", 1), ("silver", "a", 3)]
    assert rows(reports.duplicate_keys(a, "k")) == [("x", 2)]


def test_risk_pages(spark):
    ov = overview(spark)
    assert rows(reports.risk_by_score(ov)) == [(0, 1), (1, 1), (2, 1)]
    city = {r.city: r for r in reports.risk_by_city(ov).collect()}
    assert (city["A"].players, city["A"].flagged_players, city["A"].total_signals) == (2, 1, 2)
    assert city["A"].max_players_on_same_ip == 6 and city["B"].total_devices == 2


def test_validation_counts(spark):
    ov = overview(spark)
    aff = spark.createDataFrame([(True, False), (None, True), (False, False)],
                                "has_registration_over_click_anomaly boolean, "
                                "has_ftd_over_registration_anomaly boolean")
    got = dict(rows(reports.signal_validation_counts(ov, ov, aff, ov)))
    assert got["players"] == 3 and got["affiliate_rows"] == 3
    assert got["funnel_anomaly_rows"] == 2 and got["players_with_1plus_signals"] == 2
    assert got["players_with_2plus_signals"] == 1 and got["players_has_shared_ip_signal"] == 1


def test_financial_and_affiliate_pages(spark):
    import datetime as dt
    tx = spark.createDataFrame(
        [("p1", dt.date(2024, 1, 1), Decimal("3"), Decimal("1"), Decimal("0")),
         ("p2", dt.date(2024, 5, 1), Decimal("0"), Decimal("2"), Decimal("9"))],
        "player_id string, transaction_date date, deposit_amount decimal(38,9), "
        "withdraw_amount decimal(38,9), bet_amount decimal(38,9)")
    r = reports.financial_page(tx).first()
    assert (r.year, r.transactions, r.players) == (2024, 2, 2)
    assert r.withdraw_to_deposit_ratio == Decimal("1.000000000")
    m = spark.createDataFrame([("a", "BR", 10, 5, 1, Decimal("4"), 1, 0, True),
                               ("b", "BR", 0, 0, 0, Decimal("0"), 0, 0, False)],
                              "affiliate_id string, country string, clicks bigint, registrations bigint, "
                              "ftd bigint, estimated_cpa_cost decimal(38,9), "
                              "registration_over_click_rows bigint, ftd_over_registration_rows bigint, "
                              "has_funnel_anomaly boolean")
    p = reports.affiliates_page(m).first()
    assert (p.affiliates, p.clicks, p.affiliates_with_anomaly) == (2, 10, 1)
    assert p.registration_rate == 0.5 and p.click_to_ftd_rate == 0.1
