"""Named queries over a benchmark directory, one per operator of the
inventory. Each takes (spark, sf_dir) and returns a DataFrame whose decimal
columns are doubles and whose timestamps are wall-clock UTC (timestamp_ntz),
so they compare directly with a SQL engine reading the same Parquet files.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskmesh.functions import (
    event_date, money, partition_date_text, partition_range, strip_ws, surrogate_key, to_instant,
    word_initcap,
)
from riskmesh.operators import gold, quality, reports, silver
from riskmesh.operators.dedup import dedup_latest
from riskmesh.operators.silver import required
from riskmesh.plans.upsert import merge_partition_local, watermark_of
from riskmesh.session import configure
from riskmesh.sources.layers import Layers
from riskmesh.specs import ACCEPTED_COUNTRIES, ACCEPTED_TRANSACTION_TYPES, FEEDS

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

# Fixed parameters of the catalog queries.
RANGE_AS_OF = "1999-12-31"          # partition_range_filter upper bound
SCAN_AS_OF = "2024-01-31"           # bronze_scan upper bound (players feed)
FIRST_LOAD_BEFORE = "2000-01-01"    # incremental queries: first load = earlier partitions
FRESHNESS_AS_OF = "2024-02-15"
FRESHNESS_MAX_AGE_DAYS = 30
TOP_K = 100


def comparable(df: DataFrame) -> DataFrame:
    """Decimals -> double, instants -> wall-clock UTC timestamp_ntz."""
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.DecimalType):
            c = c.cast("double")
        elif isinstance(f.dataType, T.TimestampType):
            c = c.cast("timestamp_ntz")
        cols.append(c.alias(f.name))
    return df.select(*cols)


def query(name: str):
    def register(fn: Callable[[Layers], DataFrame]) -> Callable[[Layers], DataFrame]:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            configure(spark)
            return comparable(fn(Layers.shared_benchmark(spark, sf_dir)))
        run.__name__ = f"q_{name}"
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        return fn
    return register


# ------------------------------------------------------------ typed sources
def typed_sessions(L: Layers) -> DataFrame:
    """Source-data step of slv_sessions: filtered, typed, renamed; before dedup."""
    return silver.typed_sessions(L.source("sessions"))


def typed_transactions_unfiltered(L: Layers) -> DataFrame:
    b = L.source("transactions")
    at = to_instant(F.col("timestamp"))
    return b.select(F.col("transaction_id"), F.col("player_id"),
                    F.lower(F.col("type")).alias("transaction_type"),
                    money(F.col("amount")).alias("amount"), at.alias("transaction_at"),
                    event_date(at).alias("transaction_date"), F.col("dt"))


# ------------------------------------------------------------ SRC
@query("bronze_stringify")
def _(L):
    """Affiliate feed as bronze rows: every column a string, in schema order."""
    return L.source("affiliate_cpa_ftd")


@query("bronze_partition_date")
def _(L):
    """Rows per partition value derived from the transactions' event text."""
    b = L.source("transactions")
    return (b.select(partition_date_text(F.col("timestamp")).alias("dt"))
            .groupBy("dt").agg(F.count(F.lit(1)).alias("row_count")))


@query("bronze_scan")
def _(L):
    """Bronze players written as a dt-partitioned dataset (in the shared
    checkpoint folder) and read back through the bounded bronze scan."""
    from riskmesh.sources.ingest import write_bronze
    from riskmesh.sources.bronze import read_bronze
    from riskmesh.session import checkpoint_dir
    import uuid
    path = f"{checkpoint_dir(L.spark).rstrip('/')}/riskmesh-bronze-{uuid.uuid4().hex}/players"
    write_bronze(L.source("players"), path, "players")
    return read_bronze(L.spark, path, "players", "1900-01-01", SCAN_AS_OF)


@query("load_report")
def _(L):
    """Landing-job reports of all four feeds: rows and partitions written."""
    from riskmesh.sources.ingest import write_bronze
    from riskmesh.session import checkpoint_dir
    import uuid
    base = f"{checkpoint_dir(L.spark).rstrip('/')}/riskmesh-load-{uuid.uuid4().hex}"
    reports_ = [write_bronze(L.source(feed), f"{base}/{feed}", feed, rows_per_file=1_000_000) for feed in FEEDS]
    return L.spark.createDataFrame([(r.table, r.rows_written, r.partitions_written) for r in reports_],
                                   "table_name string, rows_written long, partitions_written long")


# ------------------------------------------------------------ PRJ / FLT
@query("typed_projection")
def _(L):
    return typed_sessions(L).drop("dt")


@query("project_except")
def _(L):
    """Typed players projection, then SELECT * EXCEPT(dt)."""
    return silver.typed_players(L.source("players")).drop("dt")


@query("conditional_measures")
def _(L):
    return L.ref("slv_transactions").select("transaction_id", "transaction_type", "amount",
                                            "deposit_amount", "withdraw_amount", "bet_amount")


@query("threshold_flags")
def _(L):
    return L.ref("gold_financial_signals").select(
        "player_id", "total_deposit_amount", "total_withdraw_amount", "total_bet_amount",
        "has_high_withdraw_signal", "has_high_bet_velocity_signal")


@query("fraud_signal_count")
def _(L):
    return L.ref("gold_fraud_overview").select("player_id", *quality.SIGNAL_FLAGS,
                                               "fraud_signal_count")


@query("filter_required_keys")
def _(L):
    """Per feed: rows in, rows with all required keys present."""
    keys = {"players": ("player_id",), "sessions": ("session_id", "player_id", "timestamp"),
            "transactions": ("transaction_id", "player_id", "timestamp"),
            "affiliate_cpa_ftd": ("affiliate_id", "player_id", "country")}
    parts = [L.source(feed).agg(F.count(F.lit(1)).alias("rows_in"),
                                F.count_if(required(*cols)).alias("rows_kept"))
             .select(F.lit(feed).alias("feed"), "rows_in", "rows_kept")
             for feed, cols in keys.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


@query("filter_accepted_types")
def _(L):
    """Raw type values, whether they pass lower(type) IN (...), and their rows."""
    b = L.source("transactions")
    return b.groupBy(F.col("type")).agg(F.count(F.lit(1)).alias("row_count")).select(
        "type", F.lower(F.col("type")).isin(*ACCEPTED_TRANSACTION_TYPES).alias("accepted"),
        "row_count")


@query("filter_non_negative")
def _(L):
    """Transactions kept by the amount rule (amount >= 0; NULL dropped)."""
    b = L.source("transactions")
    return b.where(money(F.col("amount")) >= 0).select(
        "transaction_id", "dt", money(F.col("amount")).alias("amount"))


@query("partition_range_filter")
def _(L):
    """Transactions bronze restricted to 1900-01-01 <= dt <= RANGE_AS_OF."""
    b = L.source("transactions")
    return (b.where(partition_range(F.col("dt"), RANGE_AS_OF))
            .groupBy("dt").agg(F.count(F.lit(1)).alias("row_count")))


def _first_load_and_batch(L: Layers):
    """slv_transactions from partitions before FIRST_LOAD_BEFORE, then the
    next run's batch: rows at or after the target's max event (inclusive)."""
    from riskmesh.operators.silver import slv_transactions
    bronze = L.source("transactions")
    first = slv_transactions(bronze.where(F.col("dt") < F.lit(FIRST_LOAD_BEFORE).cast("date")))
    since = watermark_of(first, "transaction_at")
    batch = slv_transactions(bronze, since=since)
    return first, batch


@query("incremental_watermark_filter")
def _(L):
    _, batch = _first_load_and_batch(L)
    return batch.select("transaction_id", "player_id", "transaction_at", "amount")


@query("incremental_batch")
def _(L):
    """Target after the second run: partition-local merge of the batch."""
    first, batch = _first_load_and_batch(L)
    return merge_partition_local(first, batch, "transaction_id", "transaction_date")


STATE_SPLIT = "2024-01-18"           # ip state queries: day the second load starts (inside a week)


def _two_loads(L: Layers):
    """Sessions loaded twice (days before STATE_SPLIT, then the rest): after each
    load the stored player sets of the days it touched are taken anew."""
    import uuid
    from riskmesh.operators.silver import slv_sessions
    from riskmesh.plans.ip_state import IpState
    from riskmesh.plans.upsert import incremental_build
    from riskmesh.session import checkpoint_dir
    from riskmesh.specs import SILVER
    base = f"{checkpoint_dir(L.spark).rstrip('/')}/riskmesh-ip-state-{uuid.uuid4().hex}"
    state, bronze = IpState(L.spark, f"{base}/state"), L.source("sessions")
    for load in (bronze.where(F.col("dt") < F.lit(STATE_SPLIT).cast("date")), bronze):
        done = incremental_build(L.spark, f"{base}/slv_sessions", load, SILVER["slv_sessions"], slv_sessions)
        state.refresh(L.spark.read.parquet(f"{base}/slv_sessions"), done.days)
    return state


@query("ip_players_by_week")
def _(L):
    """Distinct players per IP and week, merged from the stored sets of its days."""
    return _two_loads(L).players_per_ip(every="week")


@query("ip_risk_from_state")
def _(L):
    """The shared-IP risk of every player from the stored sets after two loads."""
    return _two_loads(L).risk()


@query("gold_overview_from_state")
def _(L):
    """gold_fraud_overview finished from partial aggregates per day: those of the
    sessions are stored by two loads (all earlier days, then the days of the second
    load alone), those of the transactions are merged as they are computed."""
    import uuid
    from riskmesh.plans.gold_state import DAY, GoldState
    from riskmesh.plans.upsert import _build
    from riskmesh.session import checkpoint_dir
    from riskmesh.sources.tables import read_table
    base = f"{checkpoint_dir(L.spark).rstrip('/')}/riskmesh-gold-state-{uuid.uuid4().hex}"
    state = GoldState(L.spark, f"{base}/state")
    # each load reads its days several times: the silver table is computed once, one folder a day
    _build(L.spark, L.ref("slv_sessions"), f"{base}/slv_sessions", "session_date")
    sessions, later = read_table(L.spark, f"{base}/slv_sessions"), F.col("session_date") >= F.lit(STATE_SPLIT).cast("date")
    state.refresh_sessions(sessions.where(~later))
    state.refresh_sessions(sessions, [r[0] for r in sessions.where(later).select("session_date").distinct().collect()])   # calendar days
    per_day = gold.financial_aggregates(L.ref("slv_transactions").withColumnRenamed("transaction_date", DAY), DAY)
    return state.fraud_overview(L.ref("slv_players"), L.ref("slv_affiliate_cpa_ftd"), gold.financial_signals(gold.merged_financial(per_day)))


STREAM_SPLIT = "2024-02-01"          # streaming_micro_loads: day the second landing starts


@query("streaming_micro_loads")
def _(L):
    """Players feed landed as two batches of JSON Lines files; after each, one
    micro-load: an ``availableNow`` stream appends the new files to bronze,
    then the incremental build (watermark + partition-local upsert) updates
    slv_players. A player whose creation day moved between the batches keeps
    its old row and gains a new one (the partition-local merge)."""
    import uuid
    from riskmesh.session import checkpoint_dir
    from riskmesh.streaming import micro_load
    base = f"{checkpoint_dir(L.spark).rstrip('/')}/riskmesh-stream-{uuid.uuid4().hex}"
    bronze = L.source("players")
    split = F.lit(STREAM_SPLIT).cast("date")
    target = f"{base}/slv_players"
    for i, part in enumerate((bronze.where(F.col("dt") < split), bronze.where(F.col("dt") >= split))):
        (part.drop("dt").write.mode("overwrite")
         .option("ignoreNullFields", False).json(f"{base}/landing/batch{i}"))
        micro_load(L.spark, f"{base}/landing/*/*.json", "players", target,
                   f"{base}/stream-checkpoint", source_format="jsonl")
    return L.spark.read.parquet(target).select(
        "player_id", "email", "email_domain", "city", "created_at")


def _land_and_keep_latest(L: Layers, feed: str, source_format: str, batches) -> DataFrame:
    """Each batch written as landing files, followed by one ``latest_load``."""
    import uuid
    from riskmesh.session import checkpoint_dir
    from riskmesh.streaming import latest_load
    base = f"{checkpoint_dir(L.spark).rstrip('/')}/riskmesh-latest-{uuid.uuid4().hex}"
    target, end = f"{base}/silver", {"csv": "csv", "jsonl": "json"}[source_format]
    for i, part in enumerate(batches):
        out = part.drop("dt").write.mode("overwrite")
        if source_format == "csv":
            out.options(header=True, ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False).csv(f"{base}/landing/batch{i}")
        else:
            out.option("ignoreNullFields", False).json(f"{base}/landing/batch{i}")
        latest_load(L.spark, f"{base}/landing/*/*.{end}", feed, target, f"{base}/progress", source_format=source_format)
    return L.spark.read.parquet(target)


@query("streaming_latest_sessions")
def _(L):
    """slv_sessions from the latest-row state after two landings of JSON Lines; the
    second one also holds late rows (older versions of sessions, earlier days)."""
    b = L.source("sessions")
    late = F.crc32(F.concat_ws("|", "session_id", "device")) % 5 == 0
    second = (F.col("dt") >= F.lit(STATE_SPLIT).cast("date")) | late
    return _land_and_keep_latest(L, "sessions", "jsonl", (b.where(~second), b.where(second))) \
        .select("session_id", "player_id", "ip", "device", "session_at", "session_date")


@query("streaming_csv_players")
def _(L):
    """slv_players from the latest-row state after two landings of CSV files; the
    second one also holds late rows, older versions and moved players included."""
    b = L.source("players")
    late = F.crc32(F.concat_ws("|", "player_id", "city")) % 5 == 0
    second = (F.col("dt") >= F.lit(STREAM_SPLIT).cast("date")) | late
    return _land_and_keep_latest(L, "players", "csv", (b.where(~second), b.where(second))) \
        .select("player_id", "email", "email_domain", "city", "created_at")


@query("duplicate_keys")
def _(L):
    """Transaction ids with several valid typed rows before the dedup."""
    t = typed_transactions_unfiltered(L).where(
        required("transaction_id", "player_id", "transaction_at")
        & F.col("transaction_type").isin(*ACCEPTED_TRANSACTION_TYPES) & (F.col("amount") >= 0))
    return reports.duplicate_keys(t, "transaction_id")


# ------------------------------------------------------------ JN / AGG
@query("ip_risk")
def _(L):
    return gold.ip_risk(L.ref("slv_sessions"))


@query("player_star_join")
def _(L):
    return L.ref("gold_fraud_overview").select(
        "player_id", "session_count", "max_players_on_same_ip", "transaction_count",
        "total_deposit_amount", "has_affiliate_funnel_anomaly")


@query("dq_relationships")
def _(L):
    """Session player ids missing from a players table without the ids
    ending in 3 (planted orphans), rows per orphan key."""
    parent = L.ref("slv_players").where(F.col("player_id").cast("bigint") % 10 != 3)
    orphans = quality.relationships(L.ref("slv_sessions"), "player_id", parent)
    return orphans.groupBy("player_id").agg(F.count(F.lit(1)).alias("n_records"))


@query("session_features")
def _(L):
    return gold.session_features(L.ref("slv_sessions"))


@query("ip_player_counts")
def _(L):
    return gold.ip_player_counts(L.ref("slv_sessions"))


@query("transaction_type_counts")
def _(L):
    return gold.transaction_type_counts(L.ref("slv_transactions"))


@query("player_amount_totals")
def _(L):
    return L.ref("gold_financial_signals").select(
        "player_id", "total_deposit_amount", "total_withdraw_amount", "total_bet_amount")


@query("affiliate_cost")
def _(L):
    return L.ref("slv_affiliate_cpa_ftd").select("affiliate_player_country_key", "ftd",
                                                 "cpa_value", "estimated_cpa_cost")


@query("last_activity")
def _(L):
    return L.ref("gold_fraud_overview").select("player_id", "last_session_at",
                                               "last_transaction_at")


@query("affiliate_risk")
def _(L):
    return gold.affiliate_risk(L.ref("slv_affiliate_cpa_ftd"))


@query("affiliate_funnel_flags")
def _(L):
    return L.ref("slv_affiliate_cpa_ftd").select(
        "affiliate_player_country_key", "clicks", "registrations", "ftd",
        "has_registration_over_click_anomaly", "has_ftd_over_registration_anomaly")


@query("affiliate_funnel_rates")
def _(L):
    return L.ref("slv_affiliate_cpa_ftd").select("affiliate_player_country_key",
                                                 "registration_rate", "ftd_rate")


@query("affiliate_grain")
def _(L):
    """Silver rows per (affiliate, player, upper-cased country)."""
    return (L.ref("slv_affiliate_cpa_ftd").groupBy("affiliate_id", "player_id", "country")
            .agg(F.count(F.lit(1)).alias("silver_rows")))


@query("layer_row_counts")
def _(L):
    rel = {("bronze", f): L.source(f) for f in FEEDS}
    rel.update({("silver", m): L.ref(m) for m in
                ("slv_players", "slv_sessions", "slv_transactions", "slv_affiliate_cpa_ftd")})
    rel.update({("gold", m): L.ref(m) for m in
                ("gold_financial_signals", "gold_affiliate_metrics", "gold_fraud_overview")})
    return reports.layer_row_counts(rel)


# ------------------------------------------------------------ WIN / TOP
@query("dedup_latest")
def _(L):
    """Latest row per transaction id over *all* typed rows (no validity filter)."""
    t = typed_transactions_unfiltered(L).where(F.col("transaction_id").isNotNull())
    return dedup_latest(t, "transaction_id", ["transaction_at", "dt"]).select(
        "transaction_id", "transaction_type", "amount", "transaction_at")


@query("top_risk_players")
def _(L):
    return gold.top_risk_players(L.ref("gold_fraud_overview"), TOP_K).select(
        "player_id", "fraud_signal_count", "city")


# ------------------------------------------------------------ FN
@query("normalize_strings")
def _(L):
    return L.ref("slv_players").select("player_id", "email", "city")


@query("normalize_city")
def _(L):
    b = L.source("players")
    return (b.groupBy(F.col("city").alias("raw_city")).agg(F.count(F.lit(1)).alias("row_count"))
            .select("raw_city", word_initcap(strip_ws(F.col("raw_city"))).alias("city"),
                    "row_count"))


@query("email_domain")
def _(L):
    return (L.ref("slv_players").groupBy("email_domain")
            .agg(F.count(F.lit(1)).alias("players")))


@query("event_date")
def _(L):
    return (L.ref("slv_sessions").groupBy("session_date")
            .agg(F.count(F.lit(1)).alias("sessions")))


@query("surrogate_key")
def _(L):
    b = L.source("affiliate_cpa_ftd").select("affiliate_id", "player_id", "country").distinct()
    return b.select(surrogate_key(F.col("affiliate_id"), F.col("player_id"), F.col("country"))
                    .alias("affiliate_player_country_key"), "affiliate_id", "player_id", "country")


# ------------------------------------------------------------ models
for _name in ("slv_players", "slv_sessions", "slv_transactions", "slv_affiliate_cpa_ftd",
              "gold_financial_signals", "gold_affiliate_metrics", "gold_fraud_overview"):
    query(_name)(lambda L, _n=_name: L.ref(_n))


def _signal(flag: str, *extra: str):
    return lambda L: L.ref("gold_fraud_overview").where(F.col(flag)).select("player_id", *extra)


query("signal_high_withdraw")(_signal("has_high_withdraw_signal", "total_withdraw_amount",
                                      "total_deposit_amount"))
query("signal_high_bet")(_signal("has_high_bet_velocity_signal", "total_bet_amount",
                                 "total_deposit_amount"))
query("signal_affiliate_funnel")(_signal("has_affiliate_funnel_anomaly"))
query("signal_shared_ip")(_signal("has_shared_ip_signal", "max_players_on_same_ip"))
query("signal_many_devices")(_signal("has_many_devices_signal", "distinct_device_count"))


# ------------------------------------------------------------ DQ
@query("dq_not_null")
def _(L):
    """Bronze rows with a NULL key column, per feed and column: one aggregate per feed."""
    out = None
    for feed, cols in {"sessions": ("session_id", "player_id"),
                       "transactions": ("transaction_id", "player_id", "amount"),
                       "affiliate_cpa_ftd": ("affiliate_id", "clicks")}.items():
        counts = L.source(feed).agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
        part = counts.unpivot([], list(cols), "column_name", "failing_rows") \
            .select(F.lit(feed).alias("table_name"), "column_name", "failing_rows")
        out = part if out is None else out.unionByName(part)
    return out


@query("dq_unique")
def _(L):
    """session_id values that repeat in the typed sessions (before dedup)."""
    return quality.unique(typed_sessions(L), "session_id")


@query("dq_accepted_values")
def _(L):
    """Lower-cased transaction types outside the accepted list (bronze)."""
    t = L.source("transactions").select(F.lower(F.col("type")).alias("transaction_type"))
    return quality.accepted_values(t, "transaction_type", ACCEPTED_TRANSACTION_TYPES)


@query("dq_accepted_countries")
def _(L):
    """Raw affiliate countries outside the accepted (upper-case) list."""
    return quality.accepted_values(L.source("affiliate_cpa_ftd"), "country", ACCEPTED_COUNTRIES)


@query("dq_unique_combination")
def _(L):
    """(affiliate, player, country) groups with several silver rows: the
    raw-country grain of the surrogate key made visible."""
    return quality.unique_combination(L.ref("slv_affiliate_cpa_ftd"),
                                      ("affiliate_id", "player_id", "country"))


def planted_affiliate(L: Layers) -> DataFrame:
    """slv_affiliate_cpa_ftd with stale flags: the first is wrong where clicks
    are divisible by 7, the second where ftd is divisible by 5, and NULL
    registrations (nothing to compare with) where clicks are divisible by 11."""
    reg = F.when(F.col("clicks") % 11 != 0, F.col("registrations"))
    return L.ref("slv_affiliate_cpa_ftd").select(
        "affiliate_player_country_key", "country", "clicks", reg.alias("registrations"), "ftd",
        (F.col("has_registration_over_click_anomaly") != (F.col("clicks") % 7 == 0)).alias("has_registration_over_click_anomaly"),
        (F.col("has_ftd_over_registration_anomaly") != (F.col("ftd") % 5 == 0)).alias("has_ftd_over_registration_anomaly"))


@query("dq_affiliate_flags")
def _(L):
    """Rows of the planted affiliate table whose stored flags disagree with the metrics."""
    return quality.affiliate_flags_mismatch(planted_affiliate(L))


@query("dq_where_scope")
def _(L):
    """NULL registrations of the planted affiliate table, judged among Brazilian rows only."""
    return quality.not_null(planted_affiliate(L), "registrations", where="country = 'BR'").select("affiliate_player_country_key", "clicks")


@query("dq_affiliate_non_negative")
def _(L):
    return quality.affiliate_negative_metrics(L.ref("slv_affiliate_cpa_ftd")).select(
        "affiliate_player_country_key", "clicks", "registrations", "ftd", "cpa_value")


@query("dq_signal_count")
def _(L):
    """Rows whose stored count is wrong, over an overview with planted counts:
    one too many (player id divisible by 3), 6 (by 5), -1 (by 7)."""
    player = F.col("player_id").cast("bigint")
    n = F.col("fraud_signal_count")
    planted = (F.when(player % 3 == 0, n + 1).when(player % 5 == 0, 6).when(player % 7 == 0, -1).otherwise(n)).cast("bigint")
    return quality.signal_count_inconsistent(L.ref("gold_fraud_overview").withColumn("fraud_signal_count", planted)) \
        .select("player_id", "fraud_signal_count")


@query("dq_financial_non_negative")
def _(L):
    """Financial rows with a negative metric, after withdrawals (player id
    divisible by 4), a ratio (by 9) and a count (by 10) turned negative."""
    player = F.col("player_id").cast("bigint")
    planted = L.ref("gold_financial_signals") \
        .withColumn("total_withdraw_amount", F.when(player % 4 == 0, -F.col("total_withdraw_amount")).otherwise(F.col("total_withdraw_amount"))) \
        .withColumn("bet_to_deposit_ratio", F.when(player % 9 == 0, -F.col("bet_to_deposit_ratio")).otherwise(F.col("bet_to_deposit_ratio"))) \
        .withColumn("bet_count", F.when(player % 10 == 0, -F.col("bet_count")).otherwise(F.col("bet_count")))
    return quality.financial_negative_metrics(planted).select("player_id", "total_withdraw_amount", "bet_count")


@query("dq_amount_non_negative")
def _(L):
    """Negative amounts among typed transactions (before the silver filter)."""
    return quality.negative_amounts(typed_transactions_unfiltered(L)).select(
        "transaction_id", "amount")


@query("dq_summary")
def _(L):
    checks = quality.bronze_checks() + quality.silver_checks() + quality.gold_checks()
    return quality.summary(checks, L.written().relation)


@query("dq_freshness")
def _(L):
    parts = [quality.freshness(L.ref(m), c, FRESHNESS_AS_OF, FRESHNESS_MAX_AGE_DAYS, m)
             .select("table_name", F.col("newest_event").cast("timestamp").alias("newest_event"),
                     "age_days", "is_stale")
             for m, c in (("slv_players", "created_at"), ("slv_sessions", "session_at"),
                          ("slv_transactions", "transaction_at"))]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


# ------------------------------------------------------------ RPT
@query("signal_validation_counts")
def _(L):
    return reports.signal_validation_counts(L.ref("slv_players"), L.ref("slv_transactions"),
                                            L.ref("slv_affiliate_cpa_ftd"),
                                            L.ref("gold_fraud_overview"))


@query("report_risk_by_score")
def _(L):
    return reports.risk_by_score(L.ref("gold_fraud_overview"))


@query("report_risk_by_city")
def _(L):
    return reports.risk_by_city(L.ref("gold_fraud_overview"))


@query("report_overview_pages")
def _(L):
    return reports.overview_pages(L.ref("gold_fraud_overview"))


@query("report_affiliates")
def _(L):
    return reports.affiliates_page(L.ref("gold_affiliate_metrics"))


@query("report_financial")
def _(L):
    return reports.financial_page(L.ref("slv_transactions"))
