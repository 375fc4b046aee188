"""Operators: every one takes and returns DataFrames (lazy plans)."""

from tillroll.operators.ids import with_random_id, with_row_number
from tillroll.operators.items import basket, explode_items, with_month
from tillroll.operators.render import (
    parse_month_list,
    parse_top_line,
    ranked_list,
    render_revenue_array,
    render_revenue_slash,
    render_revenue_tuple,
    render_rules_decimal,
    render_rules_percent,
    render_rules_raw,
    render_top_columns,
    render_top_line,
    render_top_tuple,
)
from tillroll.operators.revenue import dedup_prices, monthly_revenue, product_month_counts
from tillroll.operators.rules import (
    pair_counts,
    pair_rules,
    product_occurrences,
    receipt_total,
    tagged_counts,
)
from tillroll.operators.stepwise import pair_rules_stepwise
from tillroll.operators.top_products import (
    monthly_counts,
    monthly_counts_sum_of_ones,
    monthly_top_products,
    top_k,
)

__all__ = [
    "with_random_id", "with_row_number", "basket", "explode_items", "with_month",
    "parse_month_list", "parse_top_line", "ranked_list", "render_revenue_array", "render_revenue_slash",
    "render_revenue_tuple", "render_rules_decimal", "render_rules_percent", "render_rules_raw",
    "render_top_columns", "render_top_line", "render_top_tuple", "dedup_prices",
    "monthly_revenue", "product_month_counts", "pair_counts", "pair_rules",
    "product_occurrences", "receipt_total", "tagged_counts", "monthly_counts",
    "monthly_counts_sum_of_ones", "monthly_top_products", "top_k", "pair_rules_stepwise",
]
