"""Sinks. All of them append or overwrite a folder; none collects rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from acreline.operators.checks import check_table_name
from acreline.operators.keys import hash_sample

PREVIEW_ROWS = 100


def stamp(df: DataFrame, prediction: str, model_version: str, service_version: str) -> DataFrame:
    """Input columns plus predicted_value, model_version and service_version."""
    return df.withColumnRenamed(prediction, "predicted_value").withColumns(
        {"model_version": F.lit(model_version), "service_version": F.lit(service_version)}
    )


def write_predictions(df: DataFrame, path: str, mode: str = "append") -> None:
    """Scored rows as Parquet, one folder per model version."""
    df.write.mode(mode).partitionBy("model_version").parquet(path)


def preview(df: DataFrame, id_cols: Sequence[str] | None = None, rows: int = PREVIEW_ROWS, seed: int = 42) -> DataFrame:
    """At most ``rows`` rows to look at, the same ones on every run."""
    return hash_sample(df, rows, id_cols, seed, "preview")


def prediction_json() -> Column:
    """The result columns of a row as JSON text."""
    return F.to_json(F.struct("predicted_value", "service_version", "model_version"))


def write_bucketed(df: DataFrame, name: str, key: str, buckets: int, path: str) -> None:
    """A catalog table whose files hold the rows by the hash of ``key``, sorted: joins and groups of two such tables by
    that key need no exchange. The files lie below ``path``."""
    check_table_name(name)
    if buckets < 1:
        raise ValueError("buckets start at 1")
    # a task a bucket: else every task writes a file into every bucket
    laid = df.repartition(buckets, key)
    laid.write.format("parquet").option("path", path).bucketBy(buckets, key).sortBy(key).mode("overwrite").saveAsTable(name)


def write_metrics(scores: DataFrame, path: str, mode: str = "append") -> None:
    """Scores as JSON lines per set and model, metric names in sorted order."""
    keys = ["set_name", "model"]
    rest = sorted(c for c in scores.columns if c not in keys)
    scores.select(*keys, *rest).write.mode(mode).partitionBy(*keys).json(path)


def metrics_frame(spark: SparkSession, model: str, set_name: str, run_id: str, metrics: Mapping[str, float]) -> DataFrame:
    """One run's metrics as a row for ``write_metrics``."""
    names = sorted(metrics)
    schema = "model string, set_name string, run_id string" + "".join(f", {n} double" for n in names)
    return spark.createDataFrame([(model, set_name, run_id, *[float(metrics[n]) for n in names])], schema)


def write_violations(failures: DataFrame, path: str, mode: str = "overwrite") -> None:
    """The violation report as CSV with header."""
    failures.write.mode(mode).option("header", True).csv(path)
