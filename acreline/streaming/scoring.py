"""Scoring of a stream of records. Each record is on its own: no state, no watermark, no shuffle."""

from __future__ import annotations

import os
import time
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from acreline.operators.contract import INFERENCE, Contract
from acreline.operators.models import predict
from acreline.sources.readers import payload_rows, unreadable_payloads
from acreline.sources.writers import stamp


def payload_stream(spark: SparkSession, path: str, files_per_trigger: int | None = None) -> DataFrame:
    """Lines of JSON text arriving as files."""
    reader = spark.readStream.format("text").schema("value string")
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.load(path)


def record_stream(lines: DataFrame, schema: T.StructType) -> DataFrame:
    """Records out of the JSON text, list or single object; see ``unreadable_lines`` for the rest."""
    return payload_rows(lines, "value", schema)


def unreadable_lines(lines: DataFrame, schema: T.StructType) -> DataFrame:
    """The lines that are no JSON, as they came, with the time they were seen; write them beside
    ``bad_records`` so that every line of a stream ends up somewhere."""
    return unreadable_payloads(lines, "value", schema).withColumn("seen_at", F.current_timestamp())


def score_stream(
    model: PipelineModel, records: DataFrame, model_version: str, service_version: str, contract: Contract = INFERENCE
) -> DataFrame:
    """Good records with their prediction; a bad record cannot stop a stream, so it is left to
    ``bad_records``."""
    return stamp(predict(model, contract.good_rows(records)), "prediction", model_version, service_version)


def bad_records(records: DataFrame, contract: Contract = INFERENCE) -> DataFrame:
    """The records a stream does not score, with the time they were seen."""
    return contract.bad_rows(records).withColumn("seen_at", F.current_timestamp())


def write_stream(df: DataFrame, path: str, checkpoint: str, available_now: bool = True) -> StreamingQuery:
    """Exactly-once Parquet files; ``available_now`` works off what is there and ends."""
    writer = df.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint)
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.outputMode("append").start()


# --- every line to its place, from one read of the stream -----------------------------------------

TELEMETRY = "n_lines long, n_scored long, n_refused long, n_unreadable long, seconds double"


@dataclass(frozen=True)
class Routes:
    """Folders of a stream's outputs. Each holds a folder ``batch=<id>`` for every micro-batch."""

    scored: str
    refused: str
    unreadable: str
    telemetry: str

    @staticmethod
    def below(path: str) -> "Routes":
        return Routes(*[os.path.join(path, n) for n in ("scored", "refused", "unreadable", "telemetry")])


def _observed(df: DataFrame, path: str) -> int:
    """Writes a batch's rows in place of what an earlier try left there, and counts them on the way."""
    seen = Observation()
    df.observe(seen, F.count(F.lit(1)).alias("n")).write.mode("overwrite").parquet(path)
    return seen.get["n"]


def route_stream(
    model: PipelineModel,
    lines: DataFrame,
    schema: T.StructType,
    routes: Routes,
    checkpoint: str,
    model_version: str,
    service_version: str,
    contract: Contract = INFERENCE,
    available_now: bool = True,
) -> StreamingQuery:
    """Scores a stream of JSON lines; no line is lost and none counts twice.

    Every micro-batch is read once. Its records are scored or refused by the contract, its lines that are no JSON records
    (broken, empty, null) are kept as they came, and a row of telemetry says how many went where and how long it took.
    Folders are named by the batch's id and overwritten, and Spark repeats a batch that was not finished under the same id
    with the same lines: after a crash in the middle, the second try replaces what the first one wrote. The telemetry is
    written last, so a batch that has its row is complete.
    """

    def route(batch: DataFrame, number: int) -> None:
        begin = time.monotonic()
        batch = batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            at = lambda path: os.path.join(path, f"batch={number}")
            records = record_stream(batch, schema)
            found = [
                batch.count(),
                _observed(score_stream(model, records, model_version, service_version, contract), at(routes.scored)),
                _observed(bad_records(records, contract), at(routes.refused)),
                _observed(unreadable_lines(batch, schema), at(routes.unreadable)),
            ]
            row = [(*found, time.monotonic() - begin)]
            batch.sparkSession.createDataFrame(row, TELEMETRY).coalesce(1).write.mode("overwrite").parquet(at(routes.telemetry))
        finally:
            batch.unpersist()

    writer = lines.writeStream.foreachBatch(route).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()
