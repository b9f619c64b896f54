"""Reports over the marts (validation counts and the three dashboard pages)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskmesh.functions import count_ratio, guarded_ratio
from riskmesh.operators.quality import SIGNAL_FLAGS


def layer_row_counts(relations: dict[tuple[str, str], DataFrame]) -> DataFrame:
    """(layer, table_name, row_count): one global count per relation, unioned."""
    parts = [df.agg(F.count(F.lit(1)).alias("row_count"))
             .select(F.lit(layer).alias("layer"), F.lit(name).alias("table_name"), "row_count")
             for (layer, name), df in relations.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def duplicate_keys(df: DataFrame, key: str) -> DataFrame:
    """Keys with more than one row (``GROUP BY key HAVING COUNT(*) > 1``)."""
    return (df.groupBy(key).agg(F.count(F.lit(1)).alias("n_records"))
            .where(F.col("n_records") > 1))


def signal_validation_counts(players: DataFrame, transactions: DataFrame,
                             affiliate: DataFrame, overview: DataFrame) -> DataFrame:
    """(metric, value) rows: players, transaction rows, affiliate rows, rows per
    funnel anomaly, players per signal, players with >= 1 / >= 2 signals.
    One global aggregate per relation, unpivoted and unioned."""
    reg = F.col("has_registration_over_click_anomaly")
    ftd = F.col("has_ftd_over_registration_anomaly")
    measured = [
        (players, [("players", F.count(F.lit(1)))]),
        (transactions, [("transaction_rows", F.count(F.lit(1)))]),
        (affiliate, [("affiliate_rows", F.count(F.lit(1))),
                     ("registration_over_click_rows", F.count_if(reg)),
                     ("ftd_over_registration_rows", F.count_if(ftd)),
                     ("funnel_anomaly_rows", F.count_if(reg | ftd))]),
        (overview, [(f"players_{f}", F.count_if(F.col(f))) for f in SIGNAL_FLAGS]
         + [("players_with_1plus_signals", F.count_if(F.col("fraud_signal_count") >= 1)),
            ("players_with_2plus_signals", F.count_if(F.col("fraud_signal_count") >= 2))]),
    ]
    out = None
    for df, metrics in measured:
        agg = df.agg(*[expr.alias(name) for name, expr in metrics])
        long = agg.select(F.explode(F.array(*[
            F.struct(F.lit(name).alias("metric"), F.col(name).cast("bigint").alias("value"))
            for name, _ in metrics])).alias("m")).select("m.*")
        out = long if out is None else out.unionByName(long)
    return out


def risk_by_score(overview: DataFrame) -> DataFrame:
    return overview.groupBy("fraud_signal_count").agg(F.count(F.lit(1)).alias("players"))


def _risk_measures() -> list[Column]:
    return [
        F.count(F.lit(1)).alias("players"),
        F.count_if(F.col("fraud_signal_count") >= 1).alias("flagged_players"),
        F.sum("fraud_signal_count").alias("total_signals"),
        *[F.count_if(F.col(f)).alias(f"players_{f}") for f in SIGNAL_FLAGS],
        F.sum("distinct_device_count").alias("total_devices"),
        F.max("max_players_on_same_ip").alias("max_players_on_same_ip"),
    ]


def risk_by_city(overview: DataFrame) -> DataFrame:
    return overview.groupBy("city").agg(*_risk_measures())


def overview_pages(overview: DataFrame) -> DataFrame:
    """The dashboard's groups over the overview in one pass: the risk measures per
    score, per city and in total (``page`` says which), by grouping sets: one Expand
    and one aggregate instead of a scan a page."""
    score, city = F.col("fraud_signal_count"), F.col("city")
    page = F.element_at(F.array(F.lit("score"), F.lit("city"), F.lit("total")), F.grouping_id("fraud_signal_count", "city").cast("int"))
    return overview.groupingSets([[score], [city], []], score, city).agg(page.alias("page"), *_risk_measures())


def affiliates_page(metrics: DataFrame) -> DataFrame:
    """Per country: funnel totals, conversion, CPA cost, anomaly counts."""
    a = metrics.groupBy("country").agg(
        F.count(F.lit(1)).alias("affiliates"),
        F.sum("clicks").alias("clicks"),
        F.sum("registrations").alias("registrations"),
        F.sum("ftd").alias("ftd"),
        F.sum("estimated_cpa_cost").alias("estimated_cpa_cost"),
        F.sum("registration_over_click_rows").alias("registration_over_click_rows"),
        F.sum("ftd_over_registration_rows").alias("ftd_over_registration_rows"),
        F.count_if(F.col("has_funnel_anomaly")).alias("affiliates_with_anomaly"),
    )
    return a.select("*",
                    count_ratio(F.col("registrations"), F.col("clicks")).alias("registration_rate"),
                    count_ratio(F.col("ftd"), F.col("registrations")).alias("ftd_rate"),
                    count_ratio(F.col("ftd"), F.col("clicks")).alias("click_to_ftd_rate"))


def financial_page(transactions: DataFrame) -> DataFrame:
    """Per transaction year: volumes and withdraw / bet to deposit ratios."""
    a = transactions.groupBy(F.year("transaction_date").cast("bigint").alias("year")).agg(
        F.count(F.lit(1)).alias("transactions"),
        F.countDistinct("player_id").alias("players"),
        F.sum("deposit_amount").alias("total_deposit_amount"),
        F.sum("withdraw_amount").alias("total_withdraw_amount"),
        F.sum("bet_amount").alias("total_bet_amount"),
    )
    d = F.col("total_deposit_amount")
    return a.select("*",
                    guarded_ratio(F.col("total_withdraw_amount"), d).alias("withdraw_to_deposit_ratio"),
                    guarded_ratio(F.col("total_bet_amount"), d).alias("bet_to_deposit_ratio"))
