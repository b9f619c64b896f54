"""Gold marts and the five risk signals.

Every per-player piece is aggregated on ``player_id`` before it is joined, so
the star join of the overview meets sides that are already hash-partitioned
on the join key: one exchange for the players side, none added for the rest.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskmesh.functions import count_ratio, flag_count, guarded_ratio, scaled
from riskmesh.operators.salting import salted_join
from riskmesh.specs import THRESHOLDS, SignalThresholds


# ---------------------------------------------------------------- financial
def financial_aggregates(tx: DataFrame, *also_by: str) -> DataFrame:
    """Per-player counts, totals and last transaction, one partial+final aggregate
    (``also_by``: further columns of the grain, such as the day)."""
    return tx.groupBy("player_id", *also_by).agg(
        F.count(F.lit(1)).alias("transaction_count"),
        F.count_if(F.col("transaction_type") == "deposit").alias("deposit_count"),
        F.count_if(F.col("transaction_type") == "withdraw").alias("withdraw_count"),
        F.count_if(F.col("transaction_type") == "bet").alias("bet_count"),
        F.sum("deposit_amount").alias("total_deposit_amount"),
        F.sum("withdraw_amount").alias("total_withdraw_amount"),
        F.sum("bet_amount").alias("total_bet_amount"),
        F.max("transaction_at").alias("last_transaction_at"),
    )


def merged_financial(parts: DataFrame) -> DataFrame:
    """``financial_aggregates`` of all rows from those of parts of them (days)."""
    sums = ("transaction_count", "deposit_count", "withdraw_count", "bet_count",
            "total_deposit_amount", "total_withdraw_amount", "total_bet_amount")
    return parts.groupBy("player_id").agg(*[F.sum(c).cast(parts.schema[c].dataType).alias(c) for c in sums],
                                          F.max("last_transaction_at").alias("last_transaction_at"))


def transaction_type_counts(tx: DataFrame) -> DataFrame:
    """Per-player transaction counts by type (the unused sums are pruned)."""
    return financial_aggregates(tx).select("player_id", "transaction_count", "deposit_count",
                                           "withdraw_count", "bet_count")


def high_withdraw(withdraw, deposit, t: SignalThresholds = THRESHOLDS):
    return (withdraw > scaled(deposit, t.withdraw_to_deposit)) & (withdraw >= F.lit(t.min_withdraw))


def high_bet(bet, deposit, t: SignalThresholds = THRESHOLDS):
    return (bet >= scaled(deposit, t.bet_to_deposit)) & (bet >= F.lit(t.min_bet))


def gold_financial_signals(tx: DataFrame, t: SignalThresholds = THRESHOLDS) -> DataFrame:
    return financial_signals(financial_aggregates(tx), t)


def financial_signals(a: DataFrame, t: SignalThresholds = THRESHOLDS) -> DataFrame:
    """The financial mart from per-player aggregates."""
    d, w, b = F.col("total_deposit_amount"), F.col("total_withdraw_amount"), F.col("total_bet_amount")
    return a.select(
        "player_id", "transaction_count", "deposit_count", "withdraw_count", "bet_count",
        "total_deposit_amount", "total_withdraw_amount", "total_bet_amount",
        guarded_ratio(w, d).alias("withdraw_to_deposit_ratio"),
        guarded_ratio(b, d).alias("bet_to_deposit_ratio"),
        high_withdraw(w, d, t).alias("has_high_withdraw_signal"),
        high_bet(b, d, t).alias("has_high_bet_velocity_signal"),
        "last_transaction_at",
    )


# ---------------------------------------------------------------- affiliate
def gold_affiliate_metrics(aff: DataFrame) -> DataFrame:
    """Affiliate x country. Rates are recomputed from the sums, not averaged."""
    reg_anom = F.col("has_registration_over_click_anomaly")
    ftd_anom = F.col("has_ftd_over_registration_anomaly")
    a = aff.groupBy("affiliate_id", "country").agg(
        F.count_distinct("player_id").alias("attributed_players"),
        F.sum("clicks").alias("clicks"),
        F.sum("registrations").alias("registrations"),
        F.sum("ftd").alias("ftd"),
        F.sum("estimated_cpa_cost").alias("estimated_cpa_cost"),
        F.count_if(reg_anom).alias("registration_over_click_rows"),
        F.count_if(ftd_anom).alias("ftd_over_registration_rows"),
        # NULL flags count as "no anomaly": the result is never NULL
        (F.count_if(reg_anom | ftd_anom) > 0).alias("has_funnel_anomaly"),
    )
    return a.select(
        "affiliate_id", "country", "attributed_players", "clicks", "registrations", "ftd",
        "estimated_cpa_cost",
        count_ratio(F.col("registrations"), F.col("clicks")).alias("registration_rate"),
        count_ratio(F.col("ftd"), F.col("registrations")).alias("ftd_rate"),
        "registration_over_click_rows", "ftd_over_registration_rows", "has_funnel_anomaly",
    )


def affiliate_risk(aff: DataFrame) -> DataFrame:
    """Any silver row of the player with a funnel anomaly. NULL when every
    row's flags are NULL (like MAX over NULLs); the overview coalesces it."""
    anomaly = F.col("has_registration_over_click_anomaly") | F.col("has_ftd_over_registration_anomaly")
    return aff.groupBy("player_id").agg(F.bool_or(anomaly).alias("has_affiliate_funnel_anomaly"))


# ----------------------------------------------------------------- sessions
def player_ip_pairs(sessions: DataFrame, *also_by: str) -> DataFrame:
    """(player, ip) groups with their session count and last session (``also_by``:
    further columns of the grain, such as the day).

    Session counts, distinct IPs and the shared-IP risk are all derived from
    this pre-aggregate; a proxy IP carrying a third of all sessions is reduced
    map-side to one row per (player, ip) before anything is shuffled by IP.
    """
    return sessions.groupBy("player_id", "ip", *also_by).agg(
        F.count(F.lit(1)).alias("sessions"),
        F.max("session_at").alias("last_session_at"),
    )


def merged_pairs(parts: DataFrame) -> DataFrame:
    """``player_ip_pairs`` of all sessions from those of parts of them (days)."""
    return parts.groupBy("player_id", "ip").agg(F.sum("sessions").alias("sessions"), F.max("last_session_at").alias("last_session_at"))


def ip_player_counts(sessions: DataFrame) -> DataFrame:
    """Distinct players per (non-null) IP."""
    pairs = player_ip_pairs(sessions).where(F.col("ip").isNotNull())
    return pairs.groupBy("ip").agg(F.count(F.lit(1)).alias("player_count"))


def session_behaviour(sessions: DataFrame) -> DataFrame:
    """Per player: session_count, distinct_ip_count, last_session_at and
    max_players_on_same_ip, all from the one (player, ip) pre-aggregate.

    Distinct players per IP are counted on the pre-aggregate (one row per
    (player, ip)), then joined back on ``ip`` with a salt of the player, so a
    hot IP is spread over several tasks. NULL IPs keep their sessions, never
    match, and are spread by player.
    """
    return behaviour_of_pairs(player_ip_pairs(sessions))


def behaviour_of_pairs(pairs: DataFrame) -> DataFrame:
    """``session_behaviour`` from the (player, ip) pre-aggregate."""
    per_ip = (pairs.where(F.col("ip").isNotNull()).groupBy("ip")
              .agg(F.count(F.lit(1)).alias("player_count")))
    return (salted_join(pairs, per_ip, "ip", "left", ["player_id"]).groupBy("player_id").agg(
        F.sum("sessions").alias("session_count"),
        F.count("ip").alias("distinct_ip_count"),            # NULL ip is not an IP
        F.max("last_session_at").alias("last_session_at"),
        F.max("player_count").alias("max_players_on_same_ip"),
    ))


def ip_risk(sessions: DataFrame) -> DataFrame:
    """Per player with at least one IP: the largest number of distinct players
    seen on one of its IPs."""
    return (session_behaviour(sessions).where(F.col("max_players_on_same_ip").isNotNull())
            .select("player_id", "max_players_on_same_ip"))


def device_counts(sessions: DataFrame) -> DataFrame:
    """Distinct non-null device types per player (distinct pairs first, so a
    player with a third of all sessions is reduced map-side)."""
    return devices_of_pairs(sessions.select("player_id", "device"))


def devices_of_pairs(pairs: DataFrame) -> DataFrame:
    """``device_counts`` from (player, device) rows, repeated or not."""
    return (pairs.where(F.col("device").isNotNull()).select("player_id", "device").distinct()
            .groupBy("player_id").agg(F.count(F.lit(1)).alias("distinct_device_count")))


def session_features(sessions: DataFrame) -> DataFrame:
    """session_count, distinct_ip_count, distinct_device_count, last_session_at."""
    b = session_behaviour(sessions)
    return b.join(device_counts(sessions), "player_id", "left").select(
        "player_id", "session_count", "distinct_ip_count",
        F.coalesce(F.col("distinct_device_count"), F.lit(0).cast("bigint")).alias("distinct_device_count"),
        "last_session_at",
    )


# ----------------------------------------------------------------- overview
def gold_fraud_overview(players: DataFrame, sessions: DataFrame, financial: DataFrame,
                        aff: DataFrame, t: SignalThresholds = THRESHOLDS) -> DataFrame:
    """players LEFT JOIN features, ip risk, financial, affiliate risk on player_id.

    Activity of players absent from ``players`` is dropped. Unmatched sides
    become 0 / FALSE; ratios coalesce to 0 while flags keep their own value.
    """
    return overview_of(players, session_behaviour(sessions), device_counts(sessions), financial, affiliate_risk(aff), t)


def overview_of(players: DataFrame, behaviour: DataFrame, device_df: DataFrame, financial: DataFrame, ar: DataFrame,
                t: SignalThresholds = THRESHOLDS) -> DataFrame:
    """The overview from sides that have one row per player."""
    fin = financial.select("player_id", "transaction_count", "total_deposit_amount",
                           "total_withdraw_amount", "total_bet_amount",
                           "withdraw_to_deposit_ratio", "bet_to_deposit_ratio",
                           "has_high_withdraw_signal", "has_high_bet_velocity_signal",
                           "last_transaction_at")
    j = (players.select("player_id", "email_domain", "city", "created_at")
         .join(behaviour, "player_id", "left")
         .join(device_df, "player_id", "left")
         .join(fin, "player_id", "left")
         .join(ar, "player_id", "left"))
    zero = F.lit(0).cast("bigint")
    zero_money = F.lit(0).cast("decimal(38,9)")
    max_ip = F.coalesce(F.col("max_players_on_same_ip"), zero)
    devices = F.coalesce(F.col("distinct_device_count"), zero)
    shared = max_ip >= t.shared_ip_players
    many = devices >= t.many_devices
    hw = F.coalesce(F.col("has_high_withdraw_signal"), F.lit(False))
    hb = F.coalesce(F.col("has_high_bet_velocity_signal"), F.lit(False))
    fa = F.coalesce(F.col("has_affiliate_funnel_anomaly"), F.lit(False))
    return j.select(
        "player_id", "email_domain", "city", "created_at",
        F.coalesce(F.col("session_count"), zero).alias("session_count"),
        F.coalesce(F.col("distinct_ip_count"), zero).alias("distinct_ip_count"),
        devices.alias("distinct_device_count"),
        max_ip.alias("max_players_on_same_ip"),
        F.coalesce(F.col("transaction_count"), zero).alias("transaction_count"),
        F.coalesce(F.col("total_deposit_amount"), zero_money).alias("total_deposit_amount"),
        F.coalesce(F.col("total_withdraw_amount"), zero_money).alias("total_withdraw_amount"),
        F.coalesce(F.col("total_bet_amount"), zero_money).alias("total_bet_amount"),
        F.coalesce(F.col("withdraw_to_deposit_ratio"), zero_money).alias("withdraw_to_deposit_ratio"),
        F.coalesce(F.col("bet_to_deposit_ratio"), zero_money).alias("bet_to_deposit_ratio"),
        shared.alias("has_shared_ip_signal"),
        many.alias("has_many_devices_signal"),
        hw.alias("has_high_withdraw_signal"),
        hb.alias("has_high_bet_velocity_signal"),
        fa.alias("has_affiliate_funnel_anomaly"),
        flag_count(shared, many, hw, hb, fa).alias("fraud_signal_count"),
        "last_session_at", "last_transaction_at",
    )


def top_risk_players(overview: DataFrame, k: int = 100) -> DataFrame:
    """The k players with most signals (ties by player_id): a top-k report."""
    return overview.orderBy(F.col("fraud_signal_count").desc(), F.col("player_id").asc()).limit(k)
