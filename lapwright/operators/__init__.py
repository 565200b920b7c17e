from lapwright.operators.conform import conform
from lapwright.operators.dedupe import keep_first
from lapwright.operators.heavy_join import heavy_keys, join_heavy, join_rows
from lapwright.operators.interval_join import points_in_intervals
from lapwright.operators.layout import clustered
from lapwright.operators.quality import broken_rules, dropping_bits, enforce, observed, passes, rule_names, violations
from lapwright.operators.quantiles import exact_quantile
from lapwright.operators.selection import first_n, latest_value, top_rows

__all__ = [
    "broken_rules",
    "clustered",
    "conform",
    "dropping_bits",
    "enforce",
    "exact_quantile",
    "first_n",
    "heavy_keys",
    "join_heavy",
    "join_rows",
    "keep_first",
    "latest_value",
    "observed",
    "passes",
    "points_in_intervals",
    "rule_names",
    "top_rows",
    "violations",
]
