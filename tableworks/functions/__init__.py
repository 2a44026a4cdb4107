from .columns import (
    SPLIT_RATIOS,
    array_mad,
    array_median,
    match_ratio,
    null_safe_corr,
    signed_log,
    sorted_mad,
    sorted_median,
)

__all__ = [
    "SPLIT_RATIOS",
    "array_mad",
    "array_median",
    "match_ratio",
    "null_safe_corr",
    "signed_log",
    "sorted_mad",
    "sorted_median",
]
