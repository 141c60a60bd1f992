"""Column expressions. Nothing in here starts a job."""

from acreline.functions.expressions import (
    bin_right_closed,
    cast_or_null,
    finite,
    is_unusable,
    log_plus_one,
    merge_values,
    one_hot,
    rbf_similarity,
    safe_ratio,
    sanitize_name,
    sanitize_names,
    standardize,
)

__all__ = [
    "bin_right_closed",
    "cast_or_null",
    "finite",
    "is_unusable",
    "log_plus_one",
    "merge_values",
    "one_hot",
    "rbf_similarity",
    "safe_ratio",
    "sanitize_name",
    "sanitize_names",
    "standardize",
]
