"""Surrogate keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values -----------------------------------------------------------
# Token standing for a NULL part and separator of the hashed text.
NULL_PART_TOKEN = "_dbt_utils_surrogate_key_null_"
KEY_SEPARATOR = "-"
# ---------------------------------------------------------------------------


def surrogate_key(*cols: Column) -> Column:
    """Hex MD5 of the parts cast to string, NULLs replaced by a token, joined by '-'."""
    parts = [F.coalesce(c.cast("string"), F.lit(NULL_PART_TOKEN)) for c in cols]
    return F.md5(F.concat_ws(KEY_SEPARATOR, *parts))
