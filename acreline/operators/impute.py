"""Fill values and scales, learned on one frame and applied to any other."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from acreline.errors import DataValidationError
from acreline.functions.expressions import finite, standardize
from acreline.operators.checks import check_choice, require_columns
from acreline.operators.quantiles import exact_quantiles, modes

NUMERIC_STRATEGIES = ("mean", "median", "most_frequent")
CATEGORY_STRATEGIES = ("most_frequent", "constant")
ALL_STRATEGIES = (*NUMERIC_STRATEGIES, "constant")

# Fill values used by the "constant" strategy.
CONSTANT_NUMBER = 0.0
CONSTANT_CATEGORY = "missing_value"


def fill_values(
    df: DataFrame,
    columns: Mapping[str, Column],
    strategy: str,
    extra: Mapping[str, Column] | None = None,
    known_rows: int | None = None,
    middles: dict[str, tuple[int, float, float]] | None = None,
) -> tuple[dict[str, float], dict[str, Any]]:
    """Fill value per numeric expression (columns without any value are absent), and the ``extra``
    aggregates of the same frame, which share a pass with it where the strategy has one. ``middles``
    receives the count and the two middle values of every column whose median was searched."""
    check_choice(strategy, ALL_STRATEGIES, "strategy")
    extra = extra or {}
    if strategy == "median":
        found = exact_quantiles(df, columns, (0.5,), extra, known_rows=known_rows)
        if middles is not None:
            middles |= {n: (found.counts[n], *v[0]) for n, v in found.neighbours.items()}
        return {n: v[0] for n, v in found.values.items() if v}, found.extra
    means = {f"m{i}": F.avg(c) for i, c in enumerate(columns.values())} if strategy == "mean" else {}
    aggs = [c.alias(k) for k, c in {**means, **extra}.items()]
    row = df.agg(*aggs).first().asDict() if aggs else {}
    riding = {k: row[k] for k in extra}
    if strategy == "mean":
        return {n: row[f"m{i}"] for i, n in enumerate(columns) if row[f"m{i}"] is not None}, riding
    if strategy == "constant":
        return {n: CONSTANT_NUMBER for n in columns}, riding
    return modes(df, columns, "double"), riding


def require_filled(fills: Mapping[str, Any], names: Sequence[str]) -> None:
    empty = [n for n in names if n not in fills]
    if empty:
        raise DataValidationError(f"columns without any value: {empty}")


def learn_fills(df: DataFrame, columns: Sequence[str], strategy: str) -> dict[str, Any]:
    """Fill values of numeric and text columns by name."""
    require_columns(df, columns)
    text = [c for c in columns if isinstance(df.schema[c].dataType, T.StringType)]
    numeric = [c for c in columns if c not in text]
    fills: dict[str, Any] = {}
    if numeric:
        fills |= fill_values(df.select(*numeric), {c: finite(F.col(c).cast("double")) for c in numeric}, strategy)[0]
    if text:
        check_choice(strategy, CATEGORY_STRATEGIES, "strategy of text columns")
        fills |= {c: CONSTANT_CATEGORY for c in text} if strategy == "constant" else modes(df, {c: F.col(c) for c in text}, "string")
    require_filled(fills, columns)
    return fills


def apply_fills(df: DataFrame, fills: Mapping[str, Any]) -> DataFrame:
    """Missing (also NaN and infinite) cells get their fill value: map-only."""
    filled = {}
    for name, value in fills.items():
        cell = F.col(name)
        if isinstance(df.schema[name].dataType, (T.DoubleType, T.FloatType)):
            cell = finite(cell)
        filled[name] = F.coalesce(cell, F.lit(value))
    return df.withColumns(filled)


def learn_scales(df: DataFrame, columns: Sequence[str]) -> dict[str, tuple[float, float]]:
    """Mean and population deviation per column, all in one aggregation."""
    require_columns(df, columns)
    aggs = [a for i, c in enumerate(columns) for a in (F.avg(c).alias(f"m{i}"), F.stddev_pop(c).alias(f"s{i}"))]
    row = df.agg(*aggs).first()
    return {c: (row[f"m{i}"] or 0.0, row[f"s{i}"] or 0.0) for i, c in enumerate(columns)}


def apply_scales(df: DataFrame, scales: Mapping[str, tuple[float, float]]) -> DataFrame:
    return df.withColumns({c: standardize(F.col(c), mean, std) for c, (mean, std) in scales.items()})
