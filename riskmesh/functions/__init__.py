"""Column expressions: every function takes and returns ``Column`` objects so
they stay inside whole-stage codegen (no Python UDFs anywhere)."""

from riskmesh.functions.text import (  # noqa: F401
    email_domain, normalize_email, normalize_lower, strip_ws, word_initcap,
)
from riskmesh.functions.keys import surrogate_key  # noqa: F401
from riskmesh.functions.numeric import (  # noqa: F401
    guarded_ratio, money, money_product, scaled, count_ratio, flag_count, as_bigint,
)
from riskmesh.functions.dates import (  # noqa: F401
    event_date, partition_date_text, partition_range, to_instant,
)
