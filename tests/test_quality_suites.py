"""Every declared check of the bronze / silver / gold suites reports a
planted violation, and reports nothing on clean rows."""

import datetime as dt

from riskmesh.operators import quality as q

D = dt.date(2026, 1, 20)
T = dt.datetime(2026, 1, 20, 10, 0, 0)


def bad_tables(spark):
    c = spark.createDataFrame
    return {
        "players": c([(None, D), ("p", None)], "player_id string, dt date"),
        "sessions": c([(None, D), ("s", None)], "session_id string, dt date"),
        "transactions": c([(None, D), ("t", None)], "transaction_id string, dt date"),
        "affiliate_cpa_ftd": c([(None, D), ("a", None)], "affiliate_id string, ingest_date date"),
        "slv_players": c([("p1", "e"), ("p1", None), (None, "e")], "player_id string, email string"),
        "slv_sessions": c([("s1", "p1", D), ("s1", "ghost", None), (None, None, D)],
                          "session_id string, player_id string, session_date date"),
        "slv_transactions": c(
            [("t1", "p1", "deposit", 1.0, D), ("t1", "ghost", "bonus", -1.0, None),
             (None, None, "bet", None, D)],
            "transaction_id string, player_id string, transaction_type string, amount double, "
            "transaction_date date"),
        "slv_affiliate_cpa_ftd": c(
            [("k1", "p1", "BR", 1, 1, 1, 5.0, False, False),
             ("k1", "ghost", "br", -1, 0, 0, 1.0, True, False),
             (None, None, None, 1, 2, 1, 1.0, False, False)],
            "affiliate_player_country_key string, player_id string, country string, clicks bigint, "
            "registrations bigint, ftd bigint, cpa_value double, "
            "has_registration_over_click_anomaly boolean, has_ftd_over_registration_anomaly boolean"),
        "gold_financial_signals": c(
            [("p1", 1, 1, 0, 0, 1.0, 0.0, 0.0, 0.0, 0.0), ("p1", -1, 0, 0, 0, 0.0, 0.0, 0.0, 0.0, 0.0),
             (None, 0, 0, 0, 0, 0.0, 0.0, 0.0, 0.0, 0.0)],
            "player_id string, transaction_count bigint, deposit_count bigint, withdraw_count bigint, "
            "bet_count bigint, total_deposit_amount double, total_withdraw_amount double, "
            "total_bet_amount double, withdraw_to_deposit_ratio double, bet_to_deposit_ratio double"),
        "gold_affiliate_metrics": c([("a1", "BR"), ("a1", "BR"), (None, None)],
                                    "affiliate_id string, country string"),
        "gold_fraud_overview": c(
            [("p1", 1, True, False, False, False, False), ("p1", 3, True, False, False, False, False),
             (None, None, False, False, False, False, False)],
            "player_id string, fraud_signal_count bigint, " + ", ".join(
                f"{f} boolean" for f in q.SIGNAL_FLAGS)),
    }


def test_every_declared_check_reports_a_planted_violation(spark):
    tables = bad_tables(spark)
    checks = q.bronze_checks() + q.silver_checks() + q.gold_checks()
    got = {r.check_name: r.failing_rows for r in q.summary(checks, tables.__getitem__).collect()}
    assert len(got) == len(checks) == 42
    # The bronze partition-column checks are scoped by a range on that same
    # column (as declared), so a NULL partition is out of scope: they cannot fail.
    vacuous = {"not_null_players_dt", "not_null_sessions_dt", "not_null_transactions_dt",
               "not_null_affiliate_cpa_ftd_ingest_date"}
    assert [name for name, n in got.items() if n == 0] == sorted(vacuous, key=list(got).index)


def test_clean_rows_pass_every_check(spark):
    c = spark.createDataFrame
    tables = bad_tables(spark)
    clean = {
        "players": c([("p1", D)], "player_id string, dt date"),
        "sessions": c([("s1", D)], "session_id string, dt date"),
        "transactions": c([("t1", D)], "transaction_id string, dt date"),
        "affiliate_cpa_ftd": c([("a1", D)], "affiliate_id string, ingest_date date"),
    }
    for name, df in tables.items():
        if name not in clean:
            first = df.limit(1)        # the first planted row of every table is valid
            clean[name] = first
    checks = q.bronze_checks() + q.silver_checks() + q.gold_checks()
    got = {r.check_name: r.failing_rows for r in q.summary(checks, clean.__getitem__).collect()}
    assert {n for n, k in got.items() if k} == set()
