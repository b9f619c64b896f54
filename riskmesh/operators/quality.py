"""Data-quality checks. Each check returns the *failing* rows (pass = empty),
like a SQL test that selects violations; ``summary`` counts them for many
checks at once, in one aggregate per table, and ``gate`` raises on failures.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskmesh.functions import flag_count
from riskmesh.operators.salting import salted_join


# -------------------------------------------------------------- generic checks
def not_null(df: DataFrame, column: str, where: str | Column | None = None) -> DataFrame:
    """Rows whose column is NULL (optionally only among rows matching ``where``)."""
    scoped = df if where is None else df.where(where)
    return scoped.where(F.col(column).isNull())


def unique(df: DataFrame, column: str) -> DataFrame:
    """Non-null values occurring more than once, with their count."""
    return (df.where(F.col(column).isNotNull()).groupBy(column)
            .agg(F.count(F.lit(1)).alias("n_records")).where(F.col("n_records") > 1))


def accepted_values(df: DataFrame, column: str, values: Sequence[str]) -> DataFrame:
    """Values outside the list with their count; NULL passes."""
    return (df.where(F.col(column).isNotNull() & ~F.col(column).isin(*values))
            .groupBy(column).agg(F.count(F.lit(1)).alias("n_records")))


def relationships(child: DataFrame, column: str, parent: DataFrame,
                  parent_column: str | None = None) -> DataFrame:
    """Child rows whose (non-null) key is missing from the parent: a left anti
    join with the parent's distinct keys, salted so that a child key with a
    third of all rows is spread over several tasks."""
    pcol = parent_column or column
    keys = parent.select(F.col(pcol).alias(column)).where(F.col(column).isNotNull()).distinct()
    return salted_join(child.where(F.col(column).isNotNull()), keys, column, "left_anti", child.columns)


def unique_combination(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Groups over several columns that hold more than one row."""
    return (df.groupBy(*columns).agg(F.count(F.lit(1)).alias("n_records"))
            .where(F.col("n_records") > 1))


# ----------------------------------------------------------- singular checks
SIGNAL_FLAGS = ("has_shared_ip_signal", "has_many_devices_signal", "has_high_withdraw_signal",
                "has_high_bet_velocity_signal", "has_affiliate_funnel_anomaly")
FINANCIAL_METRICS = ("transaction_count", "deposit_count", "withdraw_count", "bet_count",
                     "total_deposit_amount", "total_withdraw_amount", "total_bet_amount",
                     "withdraw_to_deposit_ratio", "bet_to_deposit_ratio")

# The failing rows of each singular check (NULL never fails): the declared suites and the
# functions below share these.
FAILING = {
    "assert_affiliate_flags_match_metrics":
        "has_registration_over_click_anomaly != (registrations > clicks) OR has_ftd_over_registration_anomaly != (ftd > registrations)",
    "assert_affiliate_funnel_metrics_not_negative": "clicks < 0 OR registrations < 0 OR ftd < 0 OR cpa_value < 0",
    "assert_fraud_signal_count_consistency":
        f"fraud_signal_count NOT BETWEEN 0 AND {len(SIGNAL_FLAGS)} OR fraud_signal_count != ("
        + " + ".join(f"CAST({f} AS BIGINT)" for f in SIGNAL_FLAGS) + ")",
    "assert_gold_financial_metrics_non_negative": " OR ".join(f"{m} < 0" for m in FINANCIAL_METRICS),
    "assert_non_negative_amounts": "amount < 0",
}


def affiliate_flags_mismatch(aff: DataFrame) -> DataFrame:
    """Stored funnel flags that disagree with the metrics."""
    return aff.where(FAILING["assert_affiliate_flags_match_metrics"])


def affiliate_negative_metrics(aff: DataFrame) -> DataFrame:
    return aff.where(FAILING["assert_affiliate_funnel_metrics_not_negative"])


def signal_count_inconsistent(overview: DataFrame) -> DataFrame:
    return overview.where(FAILING["assert_fraud_signal_count_consistency"])


def financial_negative_metrics(fin: DataFrame) -> DataFrame:
    return fin.where(FAILING["assert_gold_financial_metrics_non_negative"])


def negative_amounts(tx: DataFrame) -> DataFrame:
    return tx.where(FAILING["assert_non_negative_amounts"])


def cast_failures(bronze: DataFrame, feed: str) -> DataFrame:
    """Quarantine view: bronze rows with a value that does not convert to its
    silver type, with the names of the failing columns (the rows a non-strict
    silver build sets aside)."""
    from riskmesh.specs import TYPED_COLUMNS
    bad = [F.when(F.col(n).isNotNull() & F.col(n).try_cast(k).isNull(), F.lit(n))
           for n, k in TYPED_COLUMNS[feed].items()]
    failed = F.filter(F.array(*bad), lambda x: x.isNotNull())
    return bronze.withColumn("failed_columns", failed).where(F.size("failed_columns") > 0)


def freshness(df: DataFrame, event_column: str, as_of: _dt.date | str,
              max_age_days: int, table_name: str) -> DataFrame:
    """One row: the newest event, its age in days at ``as_of``, and whether it
    is stale (older than ``max_age_days``)."""
    newest = df.agg(F.max(F.col(event_column)).alias("newest_event"))
    age = F.datediff(F.lit(str(as_of)).cast("date"), F.to_date(F.col("newest_event"))).cast("bigint")
    return newest.select(F.lit(table_name).alias("table_name"), "newest_event",
                         age.alias("age_days"),
                         (F.coalesce(age > max_age_days, F.lit(True))).alias("is_stale"))


# ------------------------------------------------------------------- summary
@dataclass(frozen=True)
class Check:
    """One check on one relation. ``kind`` is one of: not_null, accepted_values,
    row_filter (a predicate selecting failing rows), unique, unique_combination,
    relationships."""

    name: str
    table: str
    kind: str
    column: str | None = None
    columns: tuple[str, ...] = ()
    values: tuple[str, ...] = ()
    predicate: str | None = None
    where: str | None = None
    parent: str | None = None
    parent_column: str | None = None
    meta: dict = field(default_factory=dict, compare=False)


def _scope(c: Check) -> Column:
    return F.lit(True) if c.where is None else F.expr(c.where)


def _row_level_failure(c: Check) -> Column:
    """Predicate that is TRUE on a failing row of a row-level check."""
    if c.kind == "not_null":
        bad = F.col(c.column).isNull()
    elif c.kind == "row_filter":
        bad = F.expr(c.predicate)
    else:
        raise ValueError(c.kind)
    return _scope(c) & bad


def _group_columns(c: Check) -> tuple[str, ...]:
    return (c.column,) if c.kind in ("unique", "accepted_values") else tuple(c.columns)


def _candidate(c: Check) -> Column:
    """Rows that take part in a group check (the others can never fail it)."""
    if c.kind == "unique":
        return _scope(c) & F.col(c.column).isNotNull()
    if c.kind == "accepted_values":
        return _scope(c) & F.col(c.column).isNotNull() & ~F.col(c.column).isin(*c.values)
    return _scope(c)


def _group_key(c: Check) -> Column:
    """One text per group: the value itself, or all values behind their lengths
    (which tells every combination apart, NULLs too)."""
    parts = [F.col(x).cast("string") for x in _group_columns(c)]
    if len(parts) == 1:
        return parts[0]
    return F.concat(*[F.coalesce(F.concat(F.length(x).cast("string"), F.lit(":"), x), F.lit("-")) for x in parts])


def _as_rows(counts: DataFrame, named: list[tuple[str, str]]) -> DataFrame:
    """One-row frame with columns c0..cN -> (check_name, table_name, failing_rows)."""
    stack = F.explode(F.array(*[
        F.struct(F.lit(name).alias("check_name"), F.lit(table).alias("table_name"),
                 F.col(f"c{i}").cast("bigint").alias("failing_rows"))
        for i, (name, table) in enumerate(named)]))
    return counts.select(stack.alias("r")).select("r.*")


def summary(checks: Sequence[Check], relation) -> DataFrame:
    """(check_name, table_name, failing_rows) for every check of a suite.

    Row-level checks (not_null, row_filter) are conditional counts in one global
    aggregate per table. Group checks (unique, accepted_values, unique_combination)
    of *all* tables share one aggregate: each check reads its own columns and emits one
    ``(check, key)`` record per row that takes part; the records are counted per
    ``(check, key)`` with partial aggregation first, so a hot key is combined map-side,
    and every count is read from that aggregate.
    Relationships checks are grouped by parent: the children's keys are
    pre-aggregated to ``(check, key, rows)`` and anti-joined once with the
    parent's distinct keys. Counts follow the checks' own queries: NULL / bad
    rows, bad distinct values, duplicated keys or groups, orphan child rows.
    ``relation`` maps a table name to its DataFrame.
    """
    known = ("not_null", "row_filter", "unique", "accepted_values", "unique_combination",
             "relationships")
    for c in checks:
        if c.kind not in known:
            raise ValueError(f"unknown check kind {c.kind}")
    parts: list[DataFrame] = []
    per_row: dict[str, list[Check]] = {}
    for c in checks:
        if c.kind in ("not_null", "row_filter"):
            per_row.setdefault(c.table, []).append(c)
    for table_name, mine in per_row.items():
        counts = relation(table_name).agg(*[F.count_if(_row_level_failure(c)).alias(f"c{k}") for k, c in enumerate(mine)])
        parts.append(_as_rows(counts, [(c.name, c.table) for c in mine]))

    grouped = [(i, c) for i, c in enumerate(checks) if c.kind in ("unique", "accepted_values", "unique_combination")]
    if grouped:
        records = None
        for i, c in grouped:
            stream = relation(c.table).where(_candidate(c)).select(F.lit(i).alias("check"), _group_key(c).alias("key"))
            records = stream if records is None else records.unionByName(stream)
        groups = records.groupBy("check", "key").agg(F.count(F.lit(1)).alias("n"))
        aggs = []
        for k, (i, c) in enumerate(grouped):
            found = F.col("check") == i
            if c.kind != "accepted_values":
                found = found & (F.col("n") > 1)
            aggs.append(F.count_if(found).alias(f"c{k}"))
        parts.append(_as_rows(groups.agg(*aggs), [(c.name, c.table) for _, c in grouped]))

    by_parent: dict[tuple[str, str], list[Check]] = {}
    for c in checks:
        if c.kind == "relationships":
            by_parent.setdefault((c.parent, c.parent_column or c.column), []).append(c)
    for (parent, pcol), group in by_parent.items():
        keys = (relation(parent).where(F.col(pcol).isNotNull())
                .select(F.col(pcol).cast("string").alias("key")).distinct())
        children = None
        for i, c in enumerate(group):
            part = (relation(c.table).where(_scope(c) & F.col(c.column).isNotNull())
                    .select(F.lit(i).alias("check"), F.col(c.column).cast("string").alias("key")))
            children = part if children is None else children.unionByName(part)
        per_key = children.groupBy("check", "key").agg(F.count(F.lit(1)).alias("n"))
        orphans = per_key.join(keys, "key", "left_anti")
        agg = orphans.agg(*[F.coalesce(F.sum(F.when(F.col("check") == i, F.col("n"))), F.lit(0))
                            .alias(f"c{i}") for i in range(len(group))])
        parts.append(_as_rows(agg, [(c.name, c.table) for c in group]))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


class QualityGateError(RuntimeError):
    pass


def gate(summary: DataFrame | Sequence[tuple[str, str, int]]) -> list[tuple[str, str, int]]:
    """Raise when any check fails. Takes a summary or its collected rows: one
    row per check, bounded by the number of checks, not by the data."""
    rows = summary.collect() if isinstance(summary, DataFrame) else summary
    failed = [(name, table, int(n)) for name, table, n in rows if n > 0]
    if failed:
        detail = ", ".join(f"{n} on {t}: {k}" for n, t, k in failed)
        raise QualityGateError(f"data-quality checks failed: {detail}")
    return failed


# ------------------------------------------------- declared suites per layer
def bronze_checks() -> list[Check]:
    part = "dt >= DATE'1900-01-01' AND dt <= DATE'9999-12-31'"
    ingest = "ingest_date >= DATE'1900-01-01' AND ingest_date <= DATE'9999-12-31'"
    return [
        Check("not_null_players_player_id", "players", "not_null", "player_id", where=part),
        Check("not_null_players_dt", "players", "not_null", "dt", where=part),
        Check("not_null_sessions_session_id", "sessions", "not_null", "session_id", where=part),
        Check("not_null_sessions_dt", "sessions", "not_null", "dt", where=part),
        Check("not_null_transactions_transaction_id", "transactions", "not_null", "transaction_id",
              where=part),
        Check("not_null_transactions_dt", "transactions", "not_null", "dt", where=part),
        Check("not_null_affiliate_cpa_ftd_affiliate_id", "affiliate_cpa_ftd", "not_null",
              "affiliate_id", where=ingest),
        Check("not_null_affiliate_cpa_ftd_ingest_date", "affiliate_cpa_ftd", "not_null",
              "ingest_date", where=ingest),
    ]


def _singular(name: str, table: str) -> Check:
    return Check(name, table, "row_filter", predicate=FAILING[name])


def silver_checks() -> list[Check]:
    from riskmesh.specs import ACCEPTED_COUNTRIES, ACCEPTED_TRANSACTION_TYPES
    return [
        Check("not_null_slv_players_player_id", "slv_players", "not_null", "player_id"),
        Check("unique_slv_players_player_id", "slv_players", "unique", "player_id"),
        Check("not_null_slv_players_email", "slv_players", "not_null", "email"),
        Check("not_null_slv_sessions_session_id", "slv_sessions", "not_null", "session_id"),
        Check("unique_slv_sessions_session_id", "slv_sessions", "unique", "session_id"),
        Check("not_null_slv_sessions_player_id", "slv_sessions", "not_null", "player_id"),
        Check("relationships_slv_sessions_player_id", "slv_sessions", "relationships", "player_id",
              parent="slv_players"),
        Check("not_null_slv_sessions_session_date", "slv_sessions", "not_null", "session_date"),
        Check("not_null_slv_transactions_transaction_id", "slv_transactions", "not_null",
              "transaction_id"),
        Check("unique_slv_transactions_transaction_id", "slv_transactions", "unique",
              "transaction_id"),
        Check("not_null_slv_transactions_player_id", "slv_transactions", "not_null", "player_id"),
        Check("relationships_slv_transactions_player_id", "slv_transactions", "relationships",
              "player_id", parent="slv_players"),
        Check("accepted_values_slv_transactions_transaction_type", "slv_transactions",
              "accepted_values", "transaction_type", values=ACCEPTED_TRANSACTION_TYPES),
        Check("not_null_slv_transactions_amount", "slv_transactions", "not_null", "amount"),
        Check("not_null_slv_transactions_transaction_date", "slv_transactions", "not_null",
              "transaction_date"),
        _singular("assert_non_negative_amounts", "slv_transactions"),
        Check("not_null_slv_affiliate_key", "slv_affiliate_cpa_ftd", "not_null",
              "affiliate_player_country_key"),
        Check("unique_slv_affiliate_key", "slv_affiliate_cpa_ftd", "unique",
              "affiliate_player_country_key"),
        Check("not_null_slv_affiliate_player_id", "slv_affiliate_cpa_ftd", "not_null", "player_id"),
        Check("relationships_slv_affiliate_player_id", "slv_affiliate_cpa_ftd", "relationships",
              "player_id", parent="slv_players"),
        Check("not_null_slv_affiliate_country", "slv_affiliate_cpa_ftd", "not_null", "country"),
        Check("accepted_values_slv_affiliate_country", "slv_affiliate_cpa_ftd", "accepted_values",
              "country", values=ACCEPTED_COUNTRIES),
        _singular("assert_affiliate_flags_match_metrics", "slv_affiliate_cpa_ftd"),
        _singular("assert_affiliate_funnel_metrics_not_negative", "slv_affiliate_cpa_ftd"),
    ]


def gold_checks() -> list[Check]:
    return [
        Check("not_null_gold_financial_player_id", "gold_financial_signals", "not_null", "player_id"),
        Check("unique_gold_financial_player_id", "gold_financial_signals", "unique", "player_id"),
        _singular("assert_gold_financial_metrics_non_negative", "gold_financial_signals"),
        Check("unique_combination_gold_affiliate", "gold_affiliate_metrics", "unique_combination",
              columns=("affiliate_id", "country")),
        Check("not_null_gold_affiliate_affiliate_id", "gold_affiliate_metrics", "not_null",
              "affiliate_id"),
        Check("not_null_gold_affiliate_country", "gold_affiliate_metrics", "not_null", "country"),
        Check("not_null_gold_overview_player_id", "gold_fraud_overview", "not_null", "player_id"),
        Check("unique_gold_overview_player_id", "gold_fraud_overview", "unique", "player_id"),
        Check("not_null_gold_overview_fraud_signal_count", "gold_fraud_overview", "not_null",
              "fraud_signal_count"),
        _singular("assert_fraud_signal_count_consistency", "gold_fraud_overview"),
    ]


__all__ = [
    "Check", "QualityGateError", "accepted_values", "affiliate_flags_mismatch",
    "affiliate_negative_metrics", "bronze_checks", "financial_negative_metrics", "flag_count",
    "freshness", "gate", "gold_checks", "negative_amounts", "not_null", "relationships",
    "signal_count_inconsistent", "silver_checks", "summary", "unique", "unique_combination",
]
