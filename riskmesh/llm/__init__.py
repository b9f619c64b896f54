"""Operators of a training-data pipeline (quality, language, dedup, mixing,
sharding, extraction, scoring). Nothing outside this package imports it."""
