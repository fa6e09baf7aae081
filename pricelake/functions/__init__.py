from pricelake.functions.columns import (
    calendar_columns, clean_url, clip, direction, discount_measures, last_saturday, month_window,
    parse_category_label, period_starts, since, stats_product_key, surrogate_key, valid_url, variation_pct,
)
from pricelake.functions.text import (
    STRIPPED_BLANKS, parse_price, parse_unit, parse_unit_amount, standardize, strip_accents, strip_accents_exact,
    tokens,
)

__all__ = [
    "STRIPPED_BLANKS", "calendar_columns", "clean_url", "clip", "direction", "discount_measures", "last_saturday",
    "month_window", "parse_category_label", "parse_price", "parse_unit", "parse_unit_amount", "period_starts",
    "since", "standardize", "stats_product_key", "strip_accents", "strip_accents_exact", "surrogate_key", "tokens",
    "valid_url", "variation_pct",
]
