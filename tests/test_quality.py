import pytest
from pyspark.sql import functions as F

from riskmesh.operators import quality as q


def test_generic_checks_find_planted_rows(spark):
    df = spark.createDataFrame([("a", "deposit"), ("a", "bet"), (None, "bonus"), ("b", None)],
                               "k string, t string")
    assert q.not_null(df, "k").count() == 1
    assert q.not_null(df, "k", where="t = 'bet'").count() == 0
    assert [tuple(r) for r in q.unique(df, "k").collect()] == [("a", 2)]
    assert [tuple(r) for r in q.accepted_values(df, "t", ("deposit", "bet")).collect()] == [("bonus", 1)]
    assert q.unique_combination(df, ("k", "t")).count() == 0
    parent = spark.createDataFrame([("a",)], "k string")
    assert [r.k for r in q.relationships(df, "k", parent).collect()] == ["b"]   # null passes


def test_singular_checks(spark):
    aff = spark.createDataFrame(
        [(1, 2, 1, 5.0, True, False), (5, 2, 1, 5.0, True, False), (-1, 0, 0, 1.0, True, False),
         (None, 1, 0, 1.0, None, False)],
        "clicks bigint, registrations bigint, ftd bigint, cpa_value double, "
        "has_registration_over_click_anomaly boolean, has_ftd_over_registration_anomaly boolean")
    assert q.affiliate_flags_mismatch(aff).count() == 1        # the 5 > 2 row; NULL not reported
    assert q.affiliate_negative_metrics(aff).count() == 1
    ov = spark.createDataFrame([(1, True, False, False, False, False), (3, True, False, False, False, False)],
                               "fraud_signal_count bigint, " + ", ".join(f"{f} boolean" for f in q.SIGNAL_FLAGS))
    assert q.signal_count_inconsistent(ov).count() == 1
    tx = spark.createDataFrame([(-1.0,), (0.0,)], "amount double")
    assert q.negative_amounts(tx).count() == 1


def test_summary_single_pass_and_gate(spark):
    tables = {
        "t": spark.createDataFrame([("a", 1), ("a", -1), (None, 2)], "k string, amount int"),
        "p": spark.createDataFrame([("a",)], "k string"),
    }
    checks = [
        q.Check("nn", "t", "not_null", "k"),
        q.Check("neg", "t", "row_filter", predicate="amount < 0"),
        q.Check("uq", "t", "unique", "k"),
        q.Check("rel", "t", "relationships", "k", parent="p"),
        q.Check("ok", "p", "not_null", "k"),
    ]
    s = {r.check_name: r.failing_rows for r in q.summary(checks, tables.__getitem__).collect()}
    assert s == {"nn": 1, "neg": 1, "uq": 1, "rel": 0, "ok": 0}
    with pytest.raises(q.QualityGateError):
        q.gate(q.summary(checks, tables.__getitem__))
    assert q.gate(q.summary([checks[-1]], tables.__getitem__)) == []


def test_freshness(spark):
    df = spark.createDataFrame([("2024-01-01",)], "d string").select(F.col("d").cast("date").alias("d"))
    r = q.freshness(df, "d", "2024-02-15", 30, "t").first()
    assert (r.age_days, r.is_stale) == (45, True)


def test_group_checks_read_plain_columns_and_keep_combinations_apart(spark):
    t = spark.createDataFrame([("a", "b:1"), ("a", "b:1"), ("a:b", "1"), ("1:a", None), (None, "1:a"), (None, None), (None, None), ("", None), (None, "")],
                              "x string, y string")
    checks = [q.Check("both", "t", "unique_combination", columns=("x", "y")), q.Check("one", "t", "unique", "x"), q.Check("list", "t", "accepted_values", "y", values=("1",))]
    out = q.summary(checks, {"t": t}.__getitem__)
    assert {r.check_name: r.failing_rows for r in out.collect()} == {"both": 2, "one": 1, "list": 3}
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "array_filter" not in plan.lower() and "lambda" not in plan    # no record is built and taken apart again per row
