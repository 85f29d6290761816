"""Column expressions shared by the operators."""

from riskloom.functions.expressions import (
    code_group,
    flag,
    keep_or_default,
    null_if,
    percent,
    positive_probability,
    require_columns,
    risk_band,
    safe_ratio,
)

__all__ = [
    "code_group", "flag", "keep_or_default", "null_if", "percent",
    "positive_probability", "require_columns", "risk_band", "safe_ratio",
]
