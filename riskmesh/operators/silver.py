"""Silver models: typed, cleaned, deduplicated views of the bronze feeds.

Each model is a pure ``bronze DataFrame -> DataFrame`` function. ``as_of``
bounds the bronze partition range (default: today, UTC); ``since`` is the
incremental watermark (the target's max event), applied as a literal so it
also prunes bronze partitions.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskmesh.functions import (
    count_ratio, email_domain, event_date, money, money_product, normalize_email,
    normalize_lower, partition_range, strip_ws, surrogate_key, word_initcap,
)
from riskmesh.operators.dedup import dedup_latest
from riskmesh.specs import ACCEPTED_TRANSACTION_TYPES, TYPED_COLUMNS

Since = _dt.date | _dt.datetime | str | None

# what makes a row the newest of its key, first column first
NEWEST = {"slv_players": ["created_at", "dt"], "slv_sessions": ["session_at", "dt"], "slv_transactions": ["transaction_at", "dt"]}


def castable(feed: str) -> Column:
    """TRUE when every typed column of the row is NULL or converts."""
    cond = F.lit(True)
    for name, kind in TYPED_COLUMNS[feed].items():
        cond = cond & (F.col(name).isNull() | F.col(name).try_cast(kind).isNotNull())
    return cond


def _typed(c: Column, kind: str, strict: bool) -> Column:
    """``strict``: a bad value fails the job (ANSI cast, the default).
    Otherwise the value becomes NULL and the row is set aside by ``castable``
    (see ``quality.cast_failures`` for the quarantined rows)."""
    return c.cast(kind) if strict else c.try_cast(kind)


def _since_filter(event: Column, dt: Column, since: Since, kind: str) -> Column:
    """event >= since (inclusive), plus a coarse bound on the partition column.

    The partition value is the *local* date of the raw text while the event is
    an instant in UTC: they differ by at most one day, so ``dt >= date(since)
    - 1`` never drops a qualifying row and lets the scan skip old partitions.
    """
    at = instant(since)
    lit = at if kind == "timestamp" else at.cast(kind)
    return (event >= lit) & (dt >= F.date_sub(at.cast("date"), 1))


def instant(since: Since) -> Column:
    """A literal instant. A datetime with a zone is taken by its microseconds;
    without one, and as text or date, it is wall-clock time of the session (UTC)."""
    if isinstance(since, _dt.datetime) and since.tzinfo is not None:
        delta = since - _dt.datetime(1970, 1, 1, tzinfo=_dt.timezone.utc)
        return F.timestamp_micros(F.lit((delta.days * 86_400 + delta.seconds) * 1_000_000 + delta.microseconds).cast("long"))
    return F.lit(str(since)).cast("timestamp")


def required(*names: str) -> Column:
    cond = None
    for n in names:
        c = F.col(n).isNotNull()
        cond = c if cond is None else cond & c
    return cond


def typed_players(bronze: DataFrame, *, as_of=None, since: Since = None, strict: bool = True) -> DataFrame:
    """Filtered and typed players with their ``dt``, before the dedup."""
    email = normalize_email(F.col("email"))
    if not strict:
        bronze = bronze.where(castable("players"))
    src = bronze.where(required("player_id") & partition_range(F.col("dt"), as_of)).select(
        F.col("player_id").cast("string").alias("player_id"),
        email.alias("email"),
        email_domain(email).alias("email_domain"),
        word_initcap(strip_ws(F.col("city"))).alias("city"),
        _typed(F.col("created_at"), "date", strict).alias("created_at"),
        F.col("dt"),
    )
    if since is not None:
        src = src.where(_since_filter(F.col("created_at"), F.col("dt"), since, "date"))
    return src


def slv_players(bronze: DataFrame, *, as_of=None, since: Since = None,
                strict: bool = True) -> DataFrame:
    return dedup_latest(typed_players(bronze, as_of=as_of, since=since, strict=strict), "player_id", NEWEST["slv_players"]).drop("dt")


def typed_sessions(bronze: DataFrame, *, as_of=None, since: Since = None, strict: bool = True) -> DataFrame:
    """Filtered and typed sessions with their ``dt``, before the dedup."""
    at = _typed(F.col("timestamp"), "timestamp", strict)
    if not strict:
        bronze = bronze.where(castable("sessions"))
    src = bronze.where(required("session_id", "player_id", "timestamp")
                       & partition_range(F.col("dt"), as_of)).select(
        F.col("session_id").cast("string").alias("session_id"),
        F.col("player_id").cast("string").alias("player_id"),
        F.col("ip").cast("string").alias("ip"),
        normalize_lower(F.col("device")).alias("device"),
        at.alias("session_at"),
        event_date(at).alias("session_date"),
        F.col("dt"),
    )
    if since is not None:
        src = src.where(_since_filter(F.col("session_at"), F.col("dt"), since, "timestamp"))
    return src


def slv_sessions(bronze: DataFrame, *, as_of=None, since: Since = None,
                 strict: bool = True) -> DataFrame:
    return dedup_latest(typed_sessions(bronze, as_of=as_of, since=since, strict=strict), "session_id", NEWEST["slv_sessions"]).drop("dt")


def transaction_measures(df: DataFrame) -> DataFrame:
    """Split the amount into deposit / withdraw / bet columns (0 otherwise)."""
    zero = F.lit(0).cast("decimal(38,9)")
    out = df
    for kind in ACCEPTED_TRANSACTION_TYPES:
        out = out.withColumn(f"{kind}_amount",
                             F.when(F.col("transaction_type") == kind, F.col("amount"))
                             .otherwise(zero).cast("decimal(38,9)"))
    return out


def valid_transaction(type_col: Column, amount_col: Column, strict: bool = True) -> Column:
    """Accepted type after lower-casing (no trim) and a non-negative amount
    (a NULL amount is dropped too)."""
    amount = money(amount_col) if strict else amount_col.try_cast("decimal(38,9)")
    return F.lower(type_col).isin(*ACCEPTED_TRANSACTION_TYPES) & (amount >= 0)


def typed_transactions(bronze: DataFrame, *, as_of=None, since: Since = None, strict: bool = True) -> DataFrame:
    """Valid, typed transactions with their ``dt``, before the dedup."""
    at = _typed(F.col("timestamp"), "timestamp", strict)
    if not strict:
        bronze = bronze.where(castable("transactions"))
    src = bronze.where(required("transaction_id", "player_id", "timestamp")
                       & valid_transaction(F.col("type"), F.col("amount"), strict)
                       & partition_range(F.col("dt"), as_of)).select(
        F.col("transaction_id").cast("string").alias("transaction_id"),
        F.col("player_id").cast("string").alias("player_id"),
        F.lower(F.col("type")).alias("transaction_type"),
        _typed(F.col("amount"), "decimal(38,9)", strict).alias("amount"),
        at.alias("transaction_at"),
        event_date(at).alias("transaction_date"),
        F.col("dt"),
    )
    if since is not None:
        src = src.where(_since_filter(F.col("transaction_at"), F.col("dt"), since, "timestamp"))
    return src


def slv_transactions(bronze: DataFrame, *, as_of=None, since: Since = None,
                     strict: bool = True) -> DataFrame:
    """Filters run *before* the dedup: an invalid newer duplicate does not hide
    an older valid row."""
    src = typed_transactions(bronze, as_of=as_of, since=since, strict=strict)
    return transaction_measures(dedup_latest(src, "transaction_id", NEWEST["slv_transactions"]).drop("dt"))


def slv_affiliate_cpa_ftd(bronze: DataFrame, *, as_of=None, strict: bool = True) -> DataFrame:
    """Full rebuild at affiliate x player x raw-country grain.

    The surrogate key hashes the *raw* country while the output shows it
    upper-cased, so ``br`` and ``BR`` stay two rows that both read ``BR``.
    Grouping by (affiliate, player, raw country) is the same grain as grouping
    by (key, affiliate, player, upper(country)); the key is computed once per
    group after the aggregation instead of once per input row.
    """
    clicks = _typed(F.col("clicks"), "bigint", strict)
    regs = _typed(F.col("registrations"), "bigint", strict)
    ftd = _typed(F.col("ftd"), "bigint", strict)
    cpa = _typed(F.col("cpa_value"), "decimal(38,9)", strict)
    if not strict:
        bronze = bronze.where(castable("affiliate_cpa_ftd"))
    src = bronze.where(required("affiliate_id", "player_id", "country")
                       & partition_range(F.col("ingest_date"), as_of))
    g = src.groupBy(
        F.col("affiliate_id").cast("string").alias("affiliate_id"),
        F.col("player_id").cast("string").alias("player_id"),
        F.col("country").cast("string").alias("raw_country"),
    ).agg(
        F.sum(clicks).alias("clicks"),
        F.sum(regs).alias("registrations"),
        F.sum(ftd).alias("ftd"),
        F.max(cpa).alias("cpa_value"),
        F.sum(money_product(ftd, cpa)).alias("estimated_cpa_cost"),
    )
    return g.select(
        surrogate_key(F.col("affiliate_id"), F.col("player_id"), F.col("raw_country"))
        .alias("affiliate_player_country_key"),
        "affiliate_id", "player_id",
        F.upper(F.col("raw_country")).alias("country"),
        "clicks", "registrations", "ftd", "cpa_value", "estimated_cpa_cost",
        count_ratio(F.col("registrations"), F.col("clicks")).alias("registration_rate"),
        count_ratio(F.col("ftd"), F.col("registrations")).alias("ftd_rate"),
        (F.col("registrations") > F.col("clicks")).alias("has_registration_over_click_anomaly"),
        (F.col("ftd") > F.col("registrations")).alias("has_ftd_over_registration_anomaly"),
    )
