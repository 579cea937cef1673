"""Column-level helpers. Every function takes and returns ``Column``s and
stays inside Spark's built-in expressions (no Python UDFs)."""

from stayflow.functions.text import (  # noqa: F401
    contains_ci, leading_number, mask_pii, money_to_decimal, sentinel_to_null,
    surrogate_key, flag_name, flag_names,
)
from stayflow.functions.dates import (  # noqa: F401
    day_name, is_weekend, month_start, months_between_boundaries, years_between_boundaries,
    weekday_order,
)
from stayflow.functions.ratios import avg_exact, band, div0, least_strict, round_half_up, safe_div  # noqa: F401
