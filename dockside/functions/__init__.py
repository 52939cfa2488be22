from .predicates import first_true, if_else_null, matching, not_matching
from .scalars import ots_percent, pct_text, pct_text_of, percent_digits, ratio, thousands, whole

__all__ = [
    "first_true",
    "if_else_null",
    "matching",
    "not_matching",
    "ots_percent",
    "pct_text",
    "pct_text_of",
    "percent_digits",
    "ratio",
    "thousands",
    "whole",
]
