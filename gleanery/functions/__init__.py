"""Column expressions; all but the text similarity stay in the JVM."""

from .periods import lag_window, latest_period, month_before, trailing_month
from .rules import active_type, detail_url, is_executor
from .similarity import fuzz_ratio
from .text import (
    code_prefixes,
    concat_skip_null,
    drop_quotes,
    md5_key,
    storage_link,
    strip_ws,
    unwrap_redirect,
    url_domain,
)
from .values import falsy_to_null, local_date, naive_timestamp, parse_number, to_rubles, unit_rate

__all__ = [
    "active_type",
    "code_prefixes",
    "concat_skip_null",
    "detail_url",
    "drop_quotes",
    "falsy_to_null",
    "fuzz_ratio",
    "is_executor",
    "lag_window",
    "latest_period",
    "local_date",
    "md5_key",
    "month_before",
    "naive_timestamp",
    "parse_number",
    "storage_link",
    "strip_ws",
    "to_rubles",
    "trailing_month",
    "unit_rate",
    "unwrap_redirect",
    "url_domain",
]
