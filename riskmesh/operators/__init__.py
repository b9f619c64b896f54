"""DataFrame -> DataFrame operators: dedup, silver models, gold marts,
data-quality checks and reports."""
