"""The whole training run: contract, cleaning, strata, split, validation, gate, refit, test scores."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping
from contextlib import contextmanager
from dataclasses import dataclass, field
from typing import Any

from pyspark import StorageLevel
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession

from acreline.operators.checks import require_rows
from acreline.operators.clean import TARGET_CAP, add_stratum, clean_capped, normalize_missing
from acreline.operators.contract import Contract
from acreline.operators.models import (
    Prepared,
    Training,
    fit_on,
    gate,
    score,
    summarize,
    validation_sets,
)
from acreline.operators.models import prepare as prepare_matrix
from acreline.operators.split import random_split, require_strata, stratified_split
from acreline.session import fresh_dir


def prepare(df: DataFrame, training: Training, contract: Contract | None = None, cap: float | None = TARGET_CAP, min_rows: int = 3) -> DataFrame:
    """Checked, cleaned rows with their stratum. The cap filter comes first so that it is pushed
    into the scan."""
    checked = contract.validate(df) if contract else df
    rows = normalize_missing(clean_capped(checked, training.label, cap))
    if training.stratum is None:
        return rows
    strata = add_stratum(rows, out=training.stratum)
    require_strata(strata, training.stratum, min_rows)
    return strata


def split(df: DataFrame, training: Training, test_size: float = 0.2) -> DataFrame:
    """Adds ``part``; without strata the rows are split as one."""
    if training.stratum is None:
        return random_split(df, training.id_cols, test_size, training.seed)
    return stratified_split(df, training.stratum, training.id_cols, test_size, training.seed)


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write once to the shared folder and go on from the file: many passes follow, each of them
    then reads only its columns, and nothing is lost with an executor."""
    path = fresh_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@dataclass
class _Run:
    """One model on its way through validation, gate, refit and test."""

    name: str
    settings: Mapping[str, Any] | None
    folds: list[dict[str, float]] = field(default_factory=list)
    summary: dict[str, float] = field(default_factory=dict)
    test: dict[str, float] = field(default_factory=dict)
    error: str | None = None

    def attempt(self, step: Callable[[], None]) -> None:
        """A failure ends this model's run and is reported; the other models go on."""
        if self.error is None:
            try:
                step()
            except Exception as problem:
                self.error = str(problem)


@contextmanager
def _prepared(runs: list[_Run], rows: DataFrame, training: Training) -> Iterator[Prepared | None]:
    """The matrix of a fold, released at the end; if it cannot be made, that is every run's error."""
    ready = None
    try:
        ready = prepare_matrix(rows, training)
    except Exception as problem:
        for run in runs:
            run.error = run.error or str(problem)
    try:
        yield ready
    finally:
        if ready is not None:
            ready.release()


def train_all(
    parted: DataFrame,
    training: Training,
    models: Mapping[str, Mapping[str, Any] | None],
    keep: dict[str, PipelineModel] | None = None,
) -> DataFrame:
    """Train every named model on the same split rows; one that fails does not stop the others.

    The features of a fold are learned once and serve all models. Returns one row per model:
    status, error, validation summary and test scores.
    """
    spark: SparkSession = parted.sparkSession
    require_rows(parted, "split table")
    train_rows = parted.filter("part = 'train'")
    if not parted.is_cached:  # rows that the caller keeps are not kept twice
        train_rows.persist(StorageLevel.MEMORY_AND_DISK)
    test_rows = parted.filter("part = 'test'")
    runs = [_Run(name, settings) for name, settings in models.items()]
    kept = {} if keep is None else keep

    def validate(run: _Run, ready: Prepared, set_name: str, val_rows: DataFrame) -> None:
        model = fit_on(ready, run.name, training, run.settings)
        run.folds.append(score(model, val_rows, set_name, training))

    def pass_gate(run: _Run) -> None:
        run.summary = summarize(run.folds)
        gate(run.summary, training)

    def refit(run: _Run, ready: Prepared) -> None:
        kept[run.name] = fit_on(ready, run.name, training, run.settings)
        run.test = score(kept[run.name], test_rows, "test", training)

    try:
        for set_name, fit_rows, val_rows in validation_sets(train_rows, training):
            with _prepared(runs, fit_rows, training) as ready:
                for run in runs:
                    run.attempt(lambda run=run: validate(run, ready, set_name, val_rows))
        for run in runs:
            run.attempt(lambda run=run: pass_gate(run))
        if any(run.error is None for run in runs):
            with _prepared(runs, train_rows, training) as ready:
                for run in runs:
                    run.attempt(lambda run=run: refit(run, ready))
    finally:
        if not parted.is_cached:
            train_rows.unpersist()
    keys = [f"validation_{k}_{m}" for m in training.metrics for k in ("mean", "std")]
    schema = "model string, status string, error string"
    schema += "".join(f", {k} double" for k in keys) + "".join(f", test_{m} double" for m in training.metrics)
    rows = [
        (
            run.name,
            "ok" if run.error is None else "failed",
            run.error,
            *[run.summary.get(k) for k in keys],
            *[run.test.get(m) for m in training.metrics],
        )
        for run in runs
    ]
    return spark.createDataFrame(rows, schema)
