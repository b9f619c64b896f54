import datetime as dt
from decimal import Decimal, localcontext

import pytest
from pyspark.sql import functions as F

from riskmesh.functions import (
    email_domain, guarded_ratio, money_product, normalize_email, partition_date_text,
    partition_range, scaled, strip_ws, surrogate_key, word_initcap,
)


def one(spark, col, value, schema="v string"):
    return spark.createDataFrame([(value,)], schema).select(col.alias("r")).first()["r"]


def test_strip_ws_removes_unicode_whitespace(spark):
    assert one(spark, strip_ws(F.col("v")), "\t  a b  \n") == "a b"
    assert one(spark, strip_ws(F.col("v")), None) is None


def test_email_normalisation_and_domain(spark):
    e = normalize_email(F.col("v"))
    assert one(spark, e, "\tUser@Mail.COM ") == "user@mail.com"
    assert one(spark, email_domain(e), "\tUser@Mail.COM ") == "mail.com"
    assert one(spark, email_domain(e), "no-at-sign") is None          # no '@'
    assert one(spark, email_domain(e), "a@b@c.com") == "b@c.com"       # after the first '@'
    assert one(spark, email_domain(e), "trailing@") is None


def test_word_initcap_splits_on_punctuation(spark):
    c = word_initcap(F.col("v"))
    assert one(spark, c, "rio-grande do sul/norte") == "Rio-Grande Do Sul/Norte"
    assert one(spark, c, "SÃO PAULO") == "São Paulo"
    assert one(spark, c, "o'higgins (norte)") == "O'higgins (Norte)"
    assert one(spark, c, "") == ""
    assert one(spark, c, None) is None


def test_surrogate_key_matches_md5_of_joined_parts(spark):
    df = spark.createDataFrame([("a", "b", "c"), ("a", None, "c")], "x string, y string, z string")
    got = [r[0] for r in df.select(surrogate_key(F.col("x"), F.col("y"), F.col("z"))).collect()]
    import hashlib
    assert got[0] == hashlib.md5(b"a-b-c").hexdigest()
    assert got[1] == hashlib.md5(b"a-_dbt_utils_surrogate_key_null_-c").hexdigest()


def test_guarded_ratio_is_numeric_scale_9(spark):
    df = spark.createDataFrame([(Decimal("2"), Decimal("3")), (Decimal("1"), Decimal("0")),
                                (Decimal("1"), None)], "a decimal(38,9), b decimal(38,9)")
    out = df.select(guarded_ratio(F.col("a"), F.col("b")).alias("r"))
    assert out.schema["r"].dataType.simpleString() == "decimal(38,9)"
    assert [r.r for r in out.collect()] == [Decimal("0.666666667"), None, None]


def test_money_product_keeps_scale(spark):
    df = spark.createDataFrame([(3, "25.123456789")], "f bigint, c string")
    out = df.select(money_product(F.col("f"), F.col("c")).alias("p"))
    assert out.schema["p"].dataType.simpleString() == "decimal(38,9)"
    assert out.first().p == Decimal("75.370370367")


def test_scaled_is_exact(spark):
    df = spark.createDataFrame([(Decimal("333.333333333"),)], "d decimal(38,9)")
    v = df.select(scaled(F.col("d"), Decimal("1.5")).alias("x")).first().x
    assert v == Decimal("499.9999999995")


def test_partition_date_text_cases(spark):
    c = partition_date_text(F.col("v"))
    assert one(spark, c, "2026-01-20") == dt.date(2026, 1, 20)
    assert one(spark, c, "2026-01-20 21:46:20") == dt.date(2026, 1, 20)
    assert one(spark, c, "  2026-01-20T23:00:00-03:00") == dt.date(2026, 1, 20)
    assert one(spark, c, "20/01/2026") is None
    assert one(spark, c, "2026-99-99") is None     # rejected at ingest (calendar check)
    assert one(spark, c, None) is None


def test_partition_range_excludes_future(spark):
    df = spark.createDataFrame([(dt.date(1899, 12, 31),), (dt.date(2024, 1, 1),),
                                (dt.date(2030, 1, 1),)], "d date")
    got = [r.d for r in df.where(partition_range(F.col("d"), "2026-01-01")).collect()]
    assert got == [dt.date(2024, 1, 1)]


def test_every_column_of_the_models_is_described(spark):
    from riskmesh import descriptions
    from riskmesh.plans.pipeline import with_comments
    from riskmesh.sources.layers import MODEL_ORDER, Layers
    L = Layers.from_benchmark(spark, "/root/testdata/sf0.001")
    for name in MODEL_ORDER:
        df = with_comments(L.ref(name), name)
        assert df.schema.fields[0].metadata["table_comment"] == descriptions.TABLES[name]
        assert all(f.metadata["comment"] for f in df.schema.fields)


def test_trim_takes_unicode_space_and_cpa_is_exact_up_to_its_bounds(spark):
    from decimal import Decimal
    from riskmesh.functions import money_product, strip_ws
    df = spark.createDataFrame([("　\t a  b \n", 999_999_999, Decimal("9999999999999999999.999999999"))], "s string, n long, v decimal(38,9)")
    r = df.select(strip_ws(F.col("s")).alias("s"), money_product(F.col("n"), F.col("v")).alias("p")).first()
    with localcontext(prec=60):
        assert r.s == "a  b" and r.p == Decimal(999_999_999) * Decimal("9999999999999999999.999999999")
    for bad in ("CAST(1000000000 AS LONG) AS n, CAST(1 AS DECIMAL(38,9)) AS v", "CAST(1 AS LONG) AS n, CAST('10000000000000000000' AS DECIMAL(38,9)) AS v"):
        with pytest.raises(Exception):
            spark.sql(f"SELECT {bad}").select(money_product(F.col("n"), F.col("v"))).collect()
