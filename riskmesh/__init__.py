"""riskmesh: risk-signal marts (players, sessions, transactions, affiliate
acquisition) built on the Spark DataFrame / SQL API.

Layers: landing files -> bronze (all-string, date-partitioned Parquet) ->
silver (typed, cleaned, deduplicated, incremental) -> gold marts carrying five
boolean risk signals per player -> data-quality checks and reports.
"""

from riskmesh.specs import FEEDS, SILVER, THRESHOLDS, SignalThresholds  # noqa: F401

__all__ = ["FEEDS", "SILVER", "THRESHOLDS", "SignalThresholds"]
