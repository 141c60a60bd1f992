"""Scores of predictions: metrics, folds, gate, ranking, guards."""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from acreline.errors import DataValidationError
from acreline.functions.expressions import is_unusable
from acreline.functions.metrics import SUPPORTED, check_metrics, metric_columns
from acreline.operators.checks import require_columns

HIGHER_IS_BETTER = frozenset({"r2"})
QUALITY_THRESHOLD = 60_000.0


def prediction_guard(df: DataFrame, prediction: str = "prediction") -> DataFrame:
    """One row: rows and rows whose prediction is missing or not finite."""
    return df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(is_unusable(F.col(prediction))).alias("n_bad"),
    )


def regression_metrics(
    df: DataFrame,
    label: str = "label",
    prediction: str = "prediction",
    metrics: Sequence[str] = SUPPORTED,
    by: Sequence[str] = (),
) -> DataFrame:
    """Row count, unusable rows and the metrics, per group of ``by``, in one aggregation."""
    check_metrics(metrics)
    require_columns(df, [label, prediction, *by])
    y, p = F.col(label).cast("double"), F.col(prediction).cast("double")
    return df.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(is_unusable(p) | is_unusable(y)).alias("n_bad"),
        *metric_columns(y, p, metrics),
    )


def evaluate(
    df: DataFrame, set_name: str, label: str = "label", prediction: str = "prediction", metrics: Sequence[str] = SUPPORTED
) -> dict[str, float]:
    """The metrics as numbers; stops on an empty set and on predictions that are not finite."""
    row = regression_metrics(df, label, prediction, metrics).first()
    if not row["n_rows"]:
        raise DataValidationError(f"the {set_name!r} set is empty")
    if row["n_bad"]:
        raise DataValidationError(f"{row['n_bad']} labels or predictions of {set_name!r} are not finite")
    return {m: float(row[m]) for m in metrics}


def cv_summary(scores: DataFrame, metrics: Sequence[str] = SUPPORTED, by: Sequence[str] = ("model",)) -> DataFrame:
    """Mean and population deviation over the folds, as validation_mean_* and validation_std_*."""
    check_metrics(metrics)
    aggs: list[Column] = []
    for m in metrics:
        aggs += [
            F.avg(m).alias(f"validation_mean_{m}"),
            F.stddev_pop(m).alias(f"validation_std_{m}"),
        ]
    return scores.groupBy(*by).agg(*aggs)


def quality_gate(summary: DataFrame, metric: str = "rmse", threshold: float = QUALITY_THRESHOLD) -> DataFrame:
    """Adds ``passed``: the mean score is on the right side of the threshold for its metric."""
    check_metrics([metric])
    score = F.col(f"validation_mean_{metric}")
    good = score >= threshold if metric in HIGHER_IS_BETTER else score <= threshold
    return summary.withColumn("passed", F.coalesce(good, F.lit(False)))


def require_quality(summary: DataFrame, metric: str = "rmse", threshold: float = QUALITY_THRESHOLD) -> None:
    failed = quality_gate(summary, metric, threshold).filter("NOT passed").collect()
    if failed:
        found = [f"{metric} {row[f'validation_mean_{metric}']} against {threshold}" for row in failed]
        raise DataValidationError(f"quality gate failed: {'; '.join(found)}", found)


def leaderboard(scores: DataFrame, metric: str = "rmse", model_col: str = "model") -> DataFrame:
    """Models by score with their rank. The input has one row per model, so the one-group window
    sorts as many rows as there are models."""
    check_metrics([metric])
    best = F.col(metric).desc() if metric in HIGHER_IS_BETTER else F.col(metric).asc()
    return scores.withColumn("rank", F.rank().over(Window.orderBy(best))).orderBy("rank", model_col)


def run_observed(df: DataFrame, action: Callable[[DataFrame], None], prediction: str = "prediction") -> dict[str, float]:
    """Run a write and count its rows while they pass: no second scan for the telemetry."""
    watch = Observation()
    seen = df.observe(
        watch,
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(is_unusable(F.col(prediction))).alias("n_bad"),
    )
    start = time.monotonic()
    action(seen)
    seconds = time.monotonic() - start
    rows = watch.get["n_rows"]
    return {
        "n_rows": rows,
        "n_bad": watch.get["n_bad"],
        "seconds_total": seconds,
        "seconds_per_row": seconds / rows if rows else 0.0,
    }
