"""Column-expression helpers; all return built-in Spark expressions (no UDFs)."""

from tierlake.functions.exprs import bool_flag, count_if, safe_div, surrogate_key
from tierlake.functions.text import initcap_columns
from tierlake.functions.dates import parse_date
from tierlake.functions.ordering import ascending_key, count_at_or_below, window_order

__all__ = ["bool_flag", "count_if", "safe_div", "surrogate_key", "initcap_columns", "parse_date",
           "ascending_key", "count_at_or_below", "window_order"]
