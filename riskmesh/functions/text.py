"""String normalisers."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values -----------------------------------------------------------
# White space that TRIM takes off both ends (Unicode, not only ' ').
_EDGE_WS = "\t\n\x0b\x0c\r \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
# Word delimiters of INITCAP: white space plus these characters, in this order.
INITCAP_DELIMITERS = " []{}()/|\\<>!?@\"^#$&~_,.:;*%+-"
# Domain of an email: everything after the first '@'.
EMAIL_DOMAIN_PATTERN = r"@(.+)$"
# ---------------------------------------------------------------------------

_DELIM_CLASS = "\\s" + "".join(re.escape(ch) for ch in INITCAP_DELIMITERS.replace(" ", ""))
_WORD_OR_GAP = f"([^{_DELIM_CLASS}]+|[{_DELIM_CLASS}]+)"


def strip_ws(c: Column) -> Column:
    """Remove leading and trailing white space (tabs, newlines, NBSP ...)."""
    return F.btrim(c, F.lit(_EDGE_WS))


def normalize_lower(c: Column) -> Column:
    return F.lower(strip_ws(c))


def normalize_email(c: Column) -> Column:
    return normalize_lower(c)


def email_domain(normalized_email: Column) -> Column:
    """Text after the first '@'; NULL when there is no '@' or nothing follows."""
    return F.nullif(F.regexp_extract(normalized_email, EMAIL_DOMAIN_PATTERN, 1), F.lit(""))


def word_initcap(c: Column) -> Column:
    """Capitalise the first character of every word, lower-case the rest.

    Words are split on white space *and* punctuation delimiters, so
    ``rio-grande do sul/norte`` becomes ``Rio-Grande Do Sul/Norte``
    (Spark's ``initcap`` splits on spaces only). The string is cut into
    alternating word / delimiter runs, each run is cased, and the runs are
    joined back: all JVM-side higher-order functions.
    """
    runs = F.regexp_extract_all(c, F.lit(_WORD_OR_GAP), 1)
    cased = F.transform(runs, lambda t: F.concat(F.upper(F.substr(t, F.lit(1), F.lit(1))),
                                                 F.lower(F.substr(t, F.lit(2)))))
    return F.array_join(cased, "")
