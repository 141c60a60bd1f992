"""Scans. Every reader takes a declared schema where the format does not carry one."""

from __future__ import annotations

import os

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from acreline.errors import DataValidationError
from acreline.operators.checks import check_table_name

SUFFIXES = {".csv": "csv", ".json": "json", ".jsonl": "json", ".parquet": "parquet", ".orc": "orc"}

FEATURE_SCHEMA = T.StructType(
    [
        T.StructField(name, T.DoubleType())
        for name in (
            "longitude",
            "latitude",
            "housing_median_age",
            "total_rooms",
            "total_bedrooms",
            "population",
            "households",
            "median_income",
        )
    ]
    + [T.StructField("ocean_proximity", T.StringType())]
)

# Records as they come in: text cells, so that a number given as text is accepted and a cell that is
# no number is reported instead of silently lost.
RECORD_SCHEMA = T.StructType([T.StructField(f.name, T.StringType()) for f in FEATURE_SCHEMA.fields])


def format_of(path: str) -> str:
    """File format by suffix, case-blind."""
    suffix = os.path.splitext(path.rstrip("/"))[1].lower()
    if suffix not in SUFFIXES:
        raise ValueError(f"unsupported file format {suffix!r}; use one of {sorted(SUFFIXES)}")
    return SUFFIXES[suffix]


def _load(reader, path: str) -> DataFrame:
    try:
        return reader.load(path)
    except AnalysisException as problem:
        raise FileNotFoundError(f"cannot read {path}: {problem.getCondition()}") from problem


def read_file(
    spark: SparkSession,
    path: str,
    schema: T.StructType | None = None,
    fmt: str | None = None,
    json_list: bool = False,
) -> DataFrame:
    """Parquet, ORC, CSV with header, or JSON.

    JSON is one record per line, which Spark can split. ``json_list=True`` reads files that hold
    one list each; such a file cannot be split, so keep them small and many.
    """
    kind = fmt or format_of(path)
    reader = spark.read.format(kind)
    if kind in {"csv", "json"}:
        if schema is None:
            raise ValueError(f"{kind} needs a schema: inferring it would be a second scan")
        reader = reader.schema(schema)
    elif schema is not None:
        reader = reader.schema(schema)
    if kind == "csv":
        reader = reader.option("header", True)
    if kind == "json" and json_list:
        reader = reader.option("multiLine", True)
    return _load(reader, path)


def read_table(spark: SparkSession, name: str) -> DataFrame:
    """A table of the session catalog by its plain name."""
    check_table_name(name)
    if not spark.catalog.tableExists(name):
        raise DataValidationError(f"table {name!r} does not exist")
    return spark.table(name)


def jdbc_options(url: str, table: str, key: str, low: int, high: int, parts: int) -> dict[str, str]:
    """Options of a parallel database scan: ``parts`` ranges of a numeric key."""
    check_table_name(table)
    if parts < 1 or high <= low:
        raise ValueError("a partitioned scan needs low < high and at least one part")
    return {
        "url": url,
        "dbtable": table,
        "partitionColumn": key,
        "lowerBound": str(low),
        "upperBound": str(high),
        "numPartitions": str(parts),
        "fetchsize": "10000",
    }


def read_database(spark: SparkSession, url: str, table: str, key: str, low: int, high: int, parts: int) -> DataFrame:
    """A database table through its JDBC driver; filters and columns are pushed to the database."""
    return spark.read.format("jdbc").options(**jdbc_options(url, table, key, low, high, parts)).load()


def payload_rows(df: DataFrame, payload: str | Column, schema: T.StructType, keep: tuple[str, ...] = (), strict: bool = False) -> DataFrame:
    """JSON text per row -> one row per record: a list gives many, a single object one. Text that is no
    JSON stops a ``strict`` batch; otherwise, as in streams, it is left to ``unreadable_payloads``."""
    text = F.col(payload) if isinstance(payload, str) else payload
    kind = T.ArrayType(schema)
    records = F.from_json(text, kind)
    if strict:
        refused = F.raise_error(F.concat(F.lit("no JSON: "), text)).cast(kind)
        records = F.when(records.isNull() & text.isNotNull(), refused).otherwise(records)
    return df.select(*keep, F.inline(records))


def unreadable_payloads(df: DataFrame, payload: str, schema: T.StructType) -> DataFrame:
    """The rows whose text is no JSON at all."""
    return df.filter(F.from_json(F.col(payload), T.ArrayType(schema)).isNull())
