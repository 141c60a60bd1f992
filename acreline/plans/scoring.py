"""Batch scoring: check, score, stamp, write. No shuffle; the batch is read once to see that it is not empty, once for its
good records and, in mode ``quarantine``, once for the bad ones."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from acreline.errors import DataValidationError
from acreline.functions.expressions import is_unusable
from acreline.operators.checks import check_choice, require_rows
from acreline.operators.contract import INFERENCE, Contract
from acreline.operators.evaluate import run_observed
from acreline.operators.models import predict
from acreline.sources.writers import stamp, write_predictions

BAD_RECORD_MODES = ("reject", "quarantine")


def checked_records(df: DataFrame, contract: Contract = INFERENCE, mode: str = "reject") -> tuple[DataFrame, DataFrame | None]:
    """(records to score, bad records). ``reject``: one bad record stops the batch; ``quarantine``:
    bad records go their own way."""
    check_choice(mode, BAD_RECORD_MODES, "mode")
    problems = contract.structure_failures(df)
    if problems:
        raise DataValidationError(f"records cannot be scored: {'; '.join(problems)}", problems)
    require_rows(df, "batch")
    if mode == "quarantine":
        return contract.good_rows(df), contract.bad_rows(df)
    return contract.validate(df), None


def run_observed_count(df: DataFrame, action: Callable[[DataFrame], None]) -> int:
    """The rows that ``action`` sees, counted on the way."""
    seen = Observation()
    action(df.observe(seen, F.count(F.lit(1)).alias("n")))
    return seen.get["n"]


def score_batch(
    model: PipelineModel,
    df: DataFrame,
    path: str,
    model_version: str,
    service_version: str,
    mode: str = "reject",
    bad_path: str | None = None,
) -> dict[str, float]:
    """Score and write a batch; returns its telemetry. Predictions that are not finite stop it."""
    if mode == "quarantine" and not bad_path:
        raise ValueError("quarantine needs bad_path: bad records have to go somewhere")
    good, bad = checked_records(df, mode=mode)
    value = F.col("prediction")
    # A prediction that is not finite fails the write, which then leaves no file behind.
    sure = F.when(~is_unusable(value), value).otherwise(F.raise_error(F.lit("prediction is not finite")).cast("double"))
    scored = predict(model, good).withColumn("prediction", sure)
    telemetry = run_observed(
        scored,
        lambda seen: write_predictions(stamp(seen, "prediction", model_version, service_version), path),
    )
    telemetry["n_rejected"] = 0
    if bad is not None:
        telemetry["n_rejected"] = run_observed_count(bad, lambda seen: seen.write.mode("append").parquet(bad_path))
    return telemetry
