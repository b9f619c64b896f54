"""Runs the layers in dependency order with the quality gates:

    landing -> bronze (+ bronze checks) -> slv_players, slv_sessions,
    slv_transactions (incremental), slv_affiliate_cpa_ftd (full)
    (+ silver checks) -> gold_financial_signals, gold_affiliate_metrics
    -> gold_fraud_overview (+ gold checks)

The overview is built after the financial mart it reads (the dependency is
explicit here rather than implied by trigger order). Each layer is written
before the next reads it, so the next layer starts from a short lineage.
"""

from __future__ import annotations

import datetime as _dt
import os
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskmesh import descriptions
from riskmesh.operators import gold, quality, silver
from riskmesh.plans.gold_state import GoldState
from riskmesh.plans.upsert import _exists, incremental_build
from riskmesh.session import configure
from riskmesh.sources.ingest import LoadReport, ingest
from riskmesh.sources.layers import Layers
from riskmesh.specs import ROWS_PER_FILE, SILVER, THRESHOLDS, SignalThresholds

INCREMENTAL_MODELS = {
    "slv_players": ("players", silver.slv_players),
    "slv_sessions": ("sessions", silver.slv_sessions),
    "slv_transactions": ("transactions", silver.slv_transactions),
}


def with_comments(df: DataFrame, table: str) -> DataFrame:
    """Attach the table's column descriptions as field metadata (the table's own
    on its first column); Spark stores the schema with them in the Parquet
    footer, so they travel with the data."""
    out = []
    for i, f in enumerate(df.schema.fields):
        meta = {**f.metadata, "comment": descriptions.column(table, f.name)}
        if i == 0:
            meta["table_comment"] = descriptions.TABLES[table]
        out.append(df[f"`{f.name}`"].alias(f.name, metadata=meta))
    return df.select(*out)


@dataclass
class RunReport:
    loads: dict[str, LoadReport] = field(default_factory=dict)
    models: dict[str, str] = field(default_factory=dict)
    checks: dict[str, list] = field(default_factory=dict)
    refreshed_days: dict[str, int] = field(default_factory=dict)   # of the gold state, per silver table


def run(spark: SparkSession, root: str, landing: dict[str, str] | None = None,
        as_of: _dt.date | str | None = None, full_refresh: bool = False,
        thresholds: SignalThresholds = THRESHOLDS, ingest_date: _dt.date | None = None,
        partition_local: bool = True, gate: bool = True,
        freshness_max_age_days: int | None = None, formats: dict[str, str] | None = None,
        splittable: bool = False, rows_per_file: int = ROWS_PER_FILE, incremental_gold: bool = False) -> RunReport:
    """One pipeline run over the warehouse folder ``root``
    (``bronze/``, ``silver/``, ``gold/``). ``formats`` overrides a feed's landing
    format, ``splittable`` says that no CSV field holds a newline (many tasks a
    file), ``rows_per_file`` bounds bronze files. ``freshness_max_age_days`` turns on
    the source-freshness check of the incremental silver tables (off by
    default: no threshold is declared); a stale table fails the gate.
    ``incremental_gold`` keeps partial aggregates per day under ``root/state`` and
    finishes the financial mart and the overview from them, reading only the silver
    days that changed since the last run."""
    configure(spark)
    rep = RunReport()
    as_of_s = str(as_of) if as_of else _dt.datetime.now(_dt.timezone.utc).date().isoformat()
    for feed, path in (landing or {}).items():
        rep.loads[feed] = ingest(spark, feed, path, os.path.join(root, "bronze", feed),
                                 source_format=(formats or {}).get(feed), rows_per_file=rows_per_file,
                                 ingest_date=ingest_date, multi_line=False if splittable else None)
    layers = Layers.from_warehouse(spark, root, as_of=as_of_s, thresholds=thresholds)

    def available(layer: str, names) -> set[str]:
        return {n for n in names if _exists(spark, os.path.join(root, layer, n))}

    def check(suite: str, checks: list[quality.Check], rel, present: set[str]) -> None:
        usable = [c for c in checks if c.table in present and (c.parent is None or c.parent in present)]
        if not usable:
            return
        rep.checks[suite] = [tuple(r) for r in quality.summary(usable, rel).collect()]
        if gate:
            quality.gate(rep.checks[suite])

    # a feed never landed has no bronze yet: its models (and the marts that
    # need them) are skipped and reported as such instead of failing the run
    feeds = available("bronze", ("players", "sessions", "transactions", "affiliate_cpa_ftd"))
    # the checks cover every partition, future-dated ones too
    check("bronze", quality.bronze_checks(), Layers.from_warehouse(spark, root).source, feeds)

    for name, (feed, model) in INCREMENTAL_MODELS.items():
        if feed not in feeds:
            rep.models[name] = "skipped: no bronze"
            continue
        path = os.path.join(root, "silver", name)
        res = incremental_build(spark, path, layers.source(feed), SILVER[name],
                                lambda b, m=model, n=name, **kw: with_comments(m(b, **kw), n),
                                full_refresh=full_refresh, as_of=as_of_s,
                                partition_local=partition_local)
        rep.models[name] = res.mode
    if "affiliate_cpa_ftd" in feeds:
        aff = silver.slv_affiliate_cpa_ftd(layers.source("affiliate_cpa_ftd"), as_of=as_of_s)
        with_comments(aff, "slv_affiliate_cpa_ftd").write.mode("overwrite") \
            .parquet(os.path.join(root, "silver", "slv_affiliate_cpa_ftd"))
        rep.models["slv_affiliate_cpa_ftd"] = "full"
    else:
        rep.models["slv_affiliate_cpa_ftd"] = "skipped: no bronze"

    silver_present = available("silver", SILVER)
    silver_layers = Layers.from_warehouse(spark, root, as_of=as_of_s, thresholds=thresholds)
    check("silver", quality.silver_checks(), silver_layers.relation, silver_present)
    if freshness_max_age_days is not None:
        parts = [quality.freshness(silver_layers.ref(name), SILVER[name].event_column, as_of_s,
                                   freshness_max_age_days, name)
                 .select("table_name", F.col("is_stale").cast("bigint").alias("failing_rows"))
                 for name in INCREMENTAL_MODELS if name in silver_present]
        fresh = parts[0]
        for p in parts[1:]:
            fresh = fresh.unionByName(p)
        fresh = fresh.select(F.concat(F.lit("freshness_"), F.col("table_name")).alias("check_name"),
                             "table_name", "failing_rows")
        rep.checks["freshness"] = [tuple(r) for r in fresh.collect()]
        if gate:
            quality.gate(rep.checks["freshness"])

    def write_gold(name: str, df: DataFrame) -> None:
        with_comments(df, name).write.mode("overwrite") \
            .parquet(os.path.join(root, "gold", name))
        rep.models[name] = "full"

    def skip(name: str) -> None:
        rep.models[name] = "skipped: missing input"

    state = GoldState(spark, os.path.join(root, "state")) if incremental_gold else None
    if state:
        rep.refreshed_days = state.refresh(os.path.join(root, "silver"))
    if "slv_transactions" in silver_present:
        write_gold("gold_financial_signals", state.financial_signals(thresholds) if state else
                   gold.gold_financial_signals(silver_layers.ref("slv_transactions"), thresholds))
    else:
        skip("gold_financial_signals")
    if "slv_affiliate_cpa_ftd" in silver_present:
        write_gold("gold_affiliate_metrics",
                   gold.gold_affiliate_metrics(silver_layers.ref("slv_affiliate_cpa_ftd")))
    else:
        skip("gold_affiliate_metrics")
    if silver_present >= set(SILVER) and rep.models.get("gold_financial_signals") == "full":
        gold_layers = Layers.from_warehouse(spark, root, as_of=as_of_s, thresholds=thresholds)
        players, financial, affiliates = (gold_layers.ref(n) for n in ("slv_players", "gold_financial_signals", "slv_affiliate_cpa_ftd"))
        write_gold("gold_fraud_overview", state.fraud_overview(players, affiliates, financial, thresholds) if state else
                   gold.gold_fraud_overview(players, gold_layers.ref("slv_sessions"), financial, affiliates, thresholds))
    else:
        skip("gold_fraud_overview")
    final = Layers.from_warehouse(spark, root, as_of=as_of_s, thresholds=thresholds)
    gold_present = available("gold", ("gold_financial_signals", "gold_affiliate_metrics",
                                      "gold_fraud_overview"))
    check("gold", quality.gold_checks(), final.relation, gold_present)
    return rep


def seed_bronze_from_benchmark(spark: SparkSession, sf_dir: str, root: str) -> dict[str, LoadReport]:
    """Write the four feeds derived from the benchmark tables as bronze
    datasets under ``root/bronze`` (what the landing job would produce)."""
    from riskmesh.sources import testdata
    from riskmesh.sources.ingest import write_bronze
    configure(spark)
    return {feed: write_bronze(testdata.bronze_feed(spark, sf_dir, feed),
                               os.path.join(root, "bronze", feed), feed,
                               rows_per_file=ROWS_PER_FILE)
            for feed in ("players", "sessions", "transactions", "affiliate_cpa_ftd")}


def main(argv: list[str] | None = None) -> None:
    """python -m riskmesh.plans.pipeline ROOT [--landing feed=path ...]
    [--from-benchmark SF_DIR] [--as-of DATE] [--full-refresh] [--no-gate]"""
    import argparse
    import json
    from riskmesh.session import build_session
    ap = argparse.ArgumentParser(description="run the risk-signal pipeline")
    ap.add_argument("root")
    ap.add_argument("--landing", nargs="*", default=[], help="feed=path")
    ap.add_argument("--format", nargs="*", default=[], help="feed=format")
    ap.add_argument("--splittable", action="store_true", help="no CSV field holds a newline")
    ap.add_argument("--rows-per-file", type=int, default=ROWS_PER_FILE)
    ap.add_argument("--from-benchmark")
    ap.add_argument("--as-of")
    ap.add_argument("--full-refresh", action="store_true")
    ap.add_argument("--no-gate", action="store_true")
    ap.add_argument("--incremental-gold", action="store_true", help="finish the marts from stored partial aggregates per day")
    ap.add_argument("--freshness-max-age-days", type=int)
    a = ap.parse_args(argv)
    spark = build_session()
    if a.from_benchmark:
        seed_bronze_from_benchmark(spark, a.from_benchmark, a.root)
    landing = dict(x.split("=", 1) for x in a.landing)
    rep = run(spark, a.root, landing or None, as_of=a.as_of, full_refresh=a.full_refresh,
              gate=not a.no_gate, freshness_max_age_days=a.freshness_max_age_days,
              formats=dict(x.split("=", 1) for x in a.format), splittable=a.splittable, rows_per_file=a.rows_per_file,
              incremental_gold=a.incremental_gold)
    print(json.dumps({"models": rep.models, "checks": rep.checks,
                      "loads": {k: v.rows_written for k, v in rep.loads.items()}}, default=str))


if __name__ == "__main__":
    main()
