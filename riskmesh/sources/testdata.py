"""Bronze-shaped feeds derived from the benchmark tables.

The engine's inputs are four raw feeds (players, sessions, transactions,
affiliate acquisition). The benchmark directory holds TPC-H-like tables, so
each feed is *derived* from them with plain column expressions; the derived
frames have exactly the bronze layout (all strings + a DATE partition column)
and grow with the tables. The same rules are restated in SQL by the oracle.

Rules (ids are the source row's key):
  players       customer x nation. email = two spaces + upper(c_name) + '@' +
                segment + '.COM' + one space (id%97=0: no '@'; id%89=0: tab-
                wrapped with a second '@'); city = space + n_name (id%5=0:
                lower(n_name) + '-do sul/norte'); created_at = 2024-01-01 +
                id%60 days.
  sessions      events (event_id%83=0: NULL player). ip from props.k: k=50 -> NULL, k<2 -> 'shared-'+user/10,
                else 'own-'+user+'-'+k%3; device = event_type when user%3=0,
                else web (click/view) / mobile, wrapped in spaces, upper-cased.
  transactions  orders. time = o_orderdate + id%24 hours; type by status
                O/F/P -> 'Deposit'/'WITHDRAW'/'bet' (id%50=0 'bonus', id%47=0
                ' deposit'); amount = decimal(o_totalprice,2) * 0.001
                (id%61=0 negated, id%67=0 NULL, id%71=0 '0'); id%73=0: NULL player.
  affiliate     lineitem x orders. affiliate = l_suppkey, player = o_custkey,
                country = AR/BR/CL/CO/MX by suppkey%5, lower-case on odd line
                numbers; funnel numbers from quantity / partkey / orderkey with
                planted anomalies; clicks '0' when orderkey%101=0, NULL when
                orderkey%103=0, negated when orderkey%107=0; ingest_date fixed.
Duplicates: ids with id%7=0 get a second, older row with a changed attribute
(the original must win); for transactions with an even id the copy is an hour
*newer* but has an invalid type, so the older valid row must survive.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskmesh.specs import ACCEPTED_COUNTRIES, FEEDS

AFFILIATE_INGEST_DATE = "2024-02-01"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One benchmark table, as it is scanned."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _s(c: Column) -> Column:
    return c.cast("string")


def _dt(text: Column) -> Column:
    return F.substring(text, 1, 10).cast("date")


def _versions(df: DataFrame, versions, names: list[str]) -> DataFrame:
    """Emit, per input row, one output row per version whose condition holds
    (``None`` = always): a single scan instead of a union of filtered copies."""
    structs = []
    for cond, cols in versions:
        st = F.struct(*[c.alias(n) for c, n in zip(cols, names)])
        structs.append(st if cond is None else F.when(cond, st))
    out = df.select(F.explode(F.filter(F.array(*structs), lambda r: r.isNotNull())).alias("r"))
    return out.select(*[F.col(f"r.{n}").alias(n) for n in names])


def _bronze(df: DataFrame, feed: str) -> DataFrame:
    spec = FEEDS[feed]
    return df.select(*[F.col(c).cast("string").alias(c) for c in spec.columns],
                     F.col(spec.partition_column).cast("date").alias(spec.partition_column))


def players(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    j = c.join(n, c.c_nationkey == n.n_nationkey, "inner")
    key = F.col("c_custkey")
    name = F.upper(F.col("c_name"))
    email = (F.when(key % 97 == 0, F.concat(F.lit("  "), name, F.lit(" ")))
             .when(key % 89 == 0, F.concat(F.lit("\t"), name, F.lit("@"), F.col("c_mktsegment"),
                                           F.lit("@MAIL.COM\t")))
             .otherwise(F.concat(F.lit("  "), name, F.lit("@"), F.col("c_mktsegment"),
                                 F.lit(".COM "))))
    city = F.when(key % 5 == 0, F.concat(F.lower(F.col("n_name")), F.lit("-do sul/norte"))) \
            .otherwise(F.concat(F.lit(" "), F.col("n_name")))
    created = F.date_add(F.lit("2024-01-01").cast("date"), (key % 60).cast("int"))
    older = F.date_sub(created, 1)
    rows = _versions(j, [
        (None, [_s(key), email, city, _s(created), created]),
        (key % 7 == 0, [_s(key), email, F.lit(" OLD TOWN"), _s(older), older]),
    ], ["player_id", "email", "city", "created_at", "dt"])
    return _bronze(rows, "players")


def _k(props: Column) -> Column:
    """The integer property ``k`` of the JSON text (NULL when absent)."""
    return F.regexp_extract(props, r'"k":\s*(\d+)', 1).try_cast("bigint")


def sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    k = _k(F.col("props"))
    user = F.col("user_id")
    ip = (F.when(k.isNull() | (k == 50), F.lit(None).cast("string"))
          .when(k < 2, F.concat(F.lit("shared-"), _s(F.floor(user / 10))))
          .otherwise(F.concat(F.lit("own-"), _s(user), F.lit("-"), _s(k % 3))))
    kind = F.when(user % 3 == 0, F.col("event_type")) \
            .when(F.col("event_type").isin("click", "view"), F.lit("web")) \
            .otherwise(F.lit("mobile"))
    device = F.concat(F.lit(" "), F.upper(kind), F.lit(" "))
    player = F.when(F.col("event_id") % 83 == 0, F.lit(None).cast("string")).otherwise(_s(user))
    sid = _s(F.col("event_id"))
    rows = _versions(e, [
        (None, [sid, player, ip, device, F.col("ts")]),
        (F.col("event_id") % 7 == 0,
         [sid, player, ip, F.lit(" TABLET "), F.col("ts") - F.expr("INTERVAL 1 HOUR")]),
    ], ["session_id", "player_id", "ip", "device", "_ts"])
    ts = _s(F.col("_ts"))
    return _bronze(rows.withColumn("timestamp", ts).withColumn("dt", _dt(ts)), "sessions")


def transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    key = F.col("o_orderkey")
    ts = F.col("o_orderdate") + F.make_dt_interval(hours=(key % 24).cast("int"))
    kind = (F.when(key % 50 == 0, F.lit("bonus"))
            .when(key % 47 == 0, F.lit(" deposit"))
            .when(F.col("o_orderstatus") == "O", F.lit("Deposit"))
            .when(F.col("o_orderstatus") == "F", F.lit("WITHDRAW"))
            .otherwise(F.lit("bet")))
    price = F.col("o_totalprice").cast("decimal(18,2)")
    amount = (F.when(key % 67 == 0, F.lit(None).cast("string"))
              .when(key % 71 == 0, F.lit("0"))
              .when(key % 61 == 0, _s(price * F.lit(-0.001).cast("decimal(3,3)")))
              .otherwise(_s(price * F.lit(0.001).cast("decimal(3,3)"))))
    player = F.when(key % 73 == 0, F.lit(None).cast("string")).otherwise(_s(F.col("o_custkey")))
    tid = _s(key)
    hour = F.expr("INTERVAL 1 HOUR")
    rows = _versions(o, [
        (None, [tid, player, kind, amount, ts]),
        ((key % 7 == 0) & (key % 2 == 0), [tid, player, F.lit("bonus"), amount, ts + hour]),
        ((key % 7 == 0) & (key % 2 == 1), [tid, player, F.lit("bet"), F.lit("1.5"), ts - hour]),
    ], ["transaction_id", "player_id", "type", "amount", "_ts"])
    text = _s(F.col("_ts"))
    return _bronze(rows.withColumn("timestamp", text).withColumn("dt", _dt(text)), "transactions")


def affiliate_cpa_ftd(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity")
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    j = li.join(o, li.l_orderkey == o.o_orderkey, "inner")
    okey, pkey, skey, line = (F.col("l_orderkey"), F.col("l_partkey"), F.col("l_suppkey"),
                              F.col("l_linenumber"))
    codes = F.array(*[F.lit(c) for c in ACCEPTED_COUNTRIES])
    code = F.element_at(codes, (skey % 5 + 1).cast("int"))
    country = F.when(line % 2 == 1, F.lower(code)).otherwise(code)
    clicks = F.col("l_quantity").cast("bigint")
    regs = F.when(pkey % 389 == 0, clicks + 3).otherwise(F.least(clicks, pkey % 20))
    ftd = F.when(okey % 397 == 0, regs + 2).otherwise(F.least(clicks, pkey % 20, okey % 11))
    shown_clicks = (F.when(okey % 103 == 0, F.lit(None).cast("string"))
                    .when(okey % 101 == 0, F.lit("0"))
                    .when(okey % 107 == 0, _s(-clicks))
                    .otherwise(_s(clicks)))
    cpa = _s((F.lit(20) + F.lit(5) * line).cast("decimal(18,9)"))
    out = j.select(_s(skey).alias("affiliate_id"), _s(F.col("o_custkey")).alias("player_id"),
                   country.alias("country"), shown_clicks.alias("clicks"),
                   _s(regs).alias("registrations"), _s(ftd).alias("ftd"), cpa.alias("cpa_value"),
                   F.lit(AFFILIATE_INGEST_DATE).cast("date").alias("ingest_date"))
    return _bronze(out, "affiliate_cpa_ftd")


FEED_BUILDERS = {
    "players": players,
    "sessions": sessions,
    "transactions": transactions,
    "affiliate_cpa_ftd": affiliate_cpa_ftd,
}


def bronze_feed(spark: SparkSession, sf_dir: str, feed: str) -> DataFrame:
    return FEED_BUILDERS[feed](spark, sf_dir)
