"""Column expressions (all built-in Spark functions, no UDFs)."""

from refinery.functions.columns import (
    DEFAULT_TIERS,
    MONEY_SCALE,
    UPPERCASE_FAIL,
    UPPERCASE_PASS,
    date_text,
    is_integral,
    line_total,
    money,
    parse_date,
    pretty_size,
    reduction_pct,
    tier_label,
    uppercase_verdict,
)

__all__ = [
    "DEFAULT_TIERS", "MONEY_SCALE", "UPPERCASE_FAIL", "UPPERCASE_PASS",
    "date_text", "is_integral", "line_total", "money", "parse_date", "pretty_size",
    "reduction_pct", "tier_label", "uppercase_verdict",
]
