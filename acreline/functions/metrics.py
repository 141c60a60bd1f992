"""Regression metrics as aggregate columns, so that any subset is one aggregation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

SUPPORTED = ("rmse", "mae", "r2", "mse")


def check_metrics(names: Sequence[str]) -> list[str]:
    unknown = sorted(set(names) - set(SUPPORTED))
    if unknown or not names:
        raise ValueError(f"unsupported metrics {unknown}; choose from {sorted(SUPPORTED)}")
    return list(names)


def metric_columns(label: Column, prediction: Column, names: Sequence[str] = SUPPORTED) -> list[Column]:
    """Aggregate columns named after the metrics asked for."""
    error = prediction - label
    squared = error * error
    spread = F.var_pop(label) * F.count(label)
    r2 = F.when(spread > 0, 1.0 - F.sum(squared) / spread).otherwise(
        F.when(F.sum(squared) == 0, F.lit(1.0)).otherwise(F.lit(0.0))
    )
    table = {
        "rmse": F.sqrt(F.avg(squared)),
        "mae": F.avg(F.abs(error)),
        "r2": r2,
        "mse": F.avg(squared),
    }
    return [table[n].alias(n) for n in check_metrics(names)]
