import datetime as dt
from decimal import Decimal

from riskmesh.operators import silver
from tests.conftest import rows
from tests.fixtures import bronze

AS_OF = "2026-06-30"


def test_players_normalise_and_keep_latest(spark):
    b = bronze(spark, "players", [
        ("p1", "\t USER@Mail.com ", " são paulo ", "2026-01-20", "2026-01-20"),
        ("p1", "old@mail.com", "old", "2026-01-19", "2026-01-19"),     # older copy loses
        ("p2", "no-at-sign", "rio-grande do sul/norte", "2026-01-21", "2026-01-21"),
        ("p3", "a@b@c.com", "x", "2026-01-21", "2026-01-21"),
        (None, "x@y.com", "x", "2026-01-21", "2026-01-21"),               # dropped: null key
        ("p4", "f@u.com", "x", "2030-01-01", "2030-01-01"),               # future partition
    ])
    out = silver.slv_players(b, as_of=AS_OF)
    assert rows(out) == [
        ("p1", "user@mail.com", "mail.com", "São Paulo", dt.date(2026, 1, 20)),
        ("p2", "no-at-sign", None, "Rio-Grande Do Sul/Norte", dt.date(2026, 1, 21)),
        ("p3", "a@b@c.com", "b@c.com", "X", dt.date(2026, 1, 21)),
    ]


def test_players_exact_tie_is_deterministic(spark):
    b = bronze(spark, "players", [
        ("p1", "b@x.com", "b", "2026-01-20", "2026-01-20"),
        ("p1", "a@x.com", "a", "2026-01-20", "2026-01-20"),
    ])
    got = [rows(silver.slv_players(b, as_of=AS_OF)) for _ in range(2)]
    assert got[0] == got[1] and got[0][0][1] == "a@x.com"


def test_sessions_utc_date_and_dedup(spark):
    b = bronze(spark, "sessions", [
        ("s1", "p1", None, " MOBILE ", "2026-01-20 23:00:00-03:00", "2026-01-20"),
        ("s1", "p1", "1.1.1.1", "web", "2026-01-20 10:00:00", "2026-01-20"),   # older copy
        ("s2", None, "1.1.1.1", "web", "2026-01-20 10:00:00", "2026-01-20"),   # null player
    ])
    out = silver.slv_sessions(b, as_of=AS_OF)
    r = rows(out)
    assert len(r) == 1
    sid, pid, ip, device, at, day = r[0]
    assert (sid, pid, ip, device) == ("s1", "p1", None, "mobile")
    assert day == dt.date(2026, 1, 21)     # UTC date, not the partition date


def test_transactions_filters_before_dedup(spark):
    b = bronze(spark, "transactions", [
        ("t1", "p1", " deposit", "10", "2026-01-20 10:00:00", "2026-01-20"),   # not trimmed: dropped
        ("t2", "p1", "DEPOSIT", "0", "2026-01-20 10:00:00", "2026-01-20"),     # upper-case, zero: kept
        ("t3", "p1", "bet", "-1", "2026-01-20 10:00:00", "2026-01-20"),        # negative: dropped
        ("t4", "p1", "bet", None, "2026-01-20 10:00:00", "2026-01-20"),        # null amount: dropped
        ("t5", "p1", "withdraw", "7.5", "2026-01-20 10:00:00", "2026-01-20"),  # older valid
        ("t5", "p1", "bonus", "9", "2026-01-20 11:00:00", "2026-01-20"),       # newer invalid
    ])
    out = silver.slv_transactions(b, as_of=AS_OF)
    got = rows(out, "transaction_id", "transaction_type", "amount", "deposit_amount",
               "withdraw_amount", "bet_amount")
    z = Decimal("0E-9")
    assert got == [
        ("t2", "deposit", z, z, z, z),
        ("t5", "withdraw", Decimal("7.500000000"), z, Decimal("7.500000000"), z),
    ]


def test_affiliate_raw_country_grain_and_costs(spark):
    b = bronze(spark, "affiliate_cpa_ftd", [
        ("a1", "p1", "br", "10", "2", "1", "40", "2026-01-20"),
        ("a1", "p1", "BR", "5", "1", "1", "40", "2026-01-20"),
        ("a1", "p2", "CL", "4", "2", "1", "10", "2026-01-20"),
        ("a1", "p2", "CL", "6", "2", "2", "30", "2026-01-21"),     # differing CPA in a group
        ("a2", "p3", "MX", "0", "0", "0", "5", "2026-01-20"),      # zero clicks
        ("a3", "p4", "AR", None, "1", "0", "5", "2026-01-20"),     # all-null clicks
        ("a4", None, "AR", "1", "1", "1", "5", "2026-01-20"),      # null player: dropped
    ])
    out = silver.slv_affiliate_cpa_ftd(b, as_of=AS_OF)
    got = {(r.affiliate_id, r.player_id, r.country, r.clicks): r for r in out.collect()}
    assert len(got) == 5                                   # br and BR stay separate
    assert {k[2] for k in got if k[1] == "p1"} == {"BR"}
    cl = got[("a1", "p2", "CL", 10)]
    assert cl.cpa_value == Decimal("30.000000000")
    assert cl.estimated_cpa_cost == Decimal("70.000000000")   # 1*10 + 2*30, not ftd * max(cpa)
    assert cl.registration_rate == 0.4 and cl.ftd_rate == 0.75
    mx = got[("a2", "p3", "MX", 0)]
    assert mx.registration_rate is None and mx.ftd_rate is None
    ar = got[("a3", "p4", "AR", None)]
    assert ar.has_registration_over_click_anomaly is None
    assert ar.has_ftd_over_registration_anomaly is False


def test_incremental_watermark_is_inclusive_and_prunes(spark):
    b = bronze(spark, "transactions", [
        ("t1", "p1", "bet", "1", "2026-01-20 10:00:00", "2026-01-20"),
        ("t2", "p1", "bet", "1", "2026-01-21 10:00:00", "2026-01-21"),
        ("t3", "p1", "bet", "1", "2026-01-21 12:00:00", "2026-01-21"),
    ])
    out = silver.slv_transactions(b, as_of=AS_OF, since="2026-01-21 10:00:00")
    assert [r[0] for r in rows(out, "transaction_id")] == ["t2", "t3"]


def test_bad_values_fail_strict_and_are_quarantined_otherwise(spark):
    import pytest
    from riskmesh.operators import quality
    b = bronze(spark, "transactions", [
        ("t1", "p1", "bet", "1.5", "2026-01-20 10:00:00", "2026-01-20"),
        ("t2", "p1", "bet", "abc", "2026-01-20 10:00:00", "2026-01-20"),
        ("t3", "p1", "bet", "2", "not a time", "2026-01-20"),
    ])
    with pytest.raises(Exception):
        silver.slv_transactions(b, as_of=AS_OF).collect()
    kept = silver.slv_transactions(b, as_of=AS_OF, strict=False)
    assert [r[0] for r in rows(kept, "transaction_id")] == ["t1"]
    q = {r.transaction_id: r.failed_columns for r in quality.cast_failures(b, "transactions").collect()}
    assert q == {"t2": ["amount"], "t3": ["timestamp"]}
