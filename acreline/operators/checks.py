"""Argument checks, all made before any job starts."""

from __future__ import annotations

import re
from collections.abc import Iterable

from pyspark.sql import DataFrame

from acreline.errors import DataValidationError


def require_columns(df: DataFrame, columns: Iterable[str]) -> None:
    missing = sorted(set(columns) - set(df.columns))
    if missing:
        raise ValueError(f"missing columns: {missing}")


def require_rows(df: DataFrame, what: str = "input") -> DataFrame:
    """Stop on an empty frame; looks for one row, does not count."""
    if df.isEmpty():
        raise DataValidationError(f"{what} is empty")
    return df


def check_fraction(value: float) -> None:
    if not 0 < value < 1:
        raise ValueError("the test share must lie between 0 and 1")


def check_folds(folds: int) -> None:
    if folds < 2:
        raise ValueError("at least two folds are needed")


def check_clusters(clusters: int) -> None:
    if clusters < 2:
        raise ValueError("at least two clusters are needed")


def check_choice(value: str, allowed: Iterable[str], what: str) -> None:
    if value not in allowed:
        raise ValueError(f"{what} must be one of {sorted(allowed)}, not {value!r}")


def check_table_name(name: str) -> None:
    if not re.fullmatch(r"[A-Za-z0-9_]+", name):
        raise ValueError(f"table name {name!r} may hold letters, digits and underscores only")
