"""Missing markers and censored rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from acreline.functions.expressions import bin_right_closed, finite, merge_values, sanitize_names
from acreline.operators.checks import require_columns

# The censoring mark of the target and the income classes used for stratified splits.
TARGET_CAP = 500_001.0
INCOME_EDGES = (0.0, 1.5, 3.0, 4.5, 6.0, float("inf"))
INCOME_LABELS = (1, 2, 3, 4, 5)


def columns_of_type(df: DataFrame, numeric: bool = True, skip: Sequence[str] = ()) -> list[str]:
    """Numeric (or else text) columns, from the schema alone."""
    kind = T.NumericType if numeric else T.StringType
    return [f.name for f in df.schema.fields if isinstance(f.dataType, kind) and f.name not in skip]


def normalize_missing(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """NaN and infinities of the floating columns become NULL, the only marker used from here on."""
    floating = [f.name for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
    chosen = floating if columns is None else [c for c in columns if c in floating]
    return df.withColumns({c: finite(F.col(f"`{c}`")) for c in chosen}) if chosen else df


def clean_capped(df: DataFrame, target: str = "median_house_value", cap: float | None = TARGET_CAP) -> DataFrame:
    """Keep rows strictly below the cap (a missing target goes too). The plain comparison reaches
    the scan as a pushed filter; normalise after it, not before."""
    require_columns(df, [target])
    return df if cap is None else df.filter(F.col(target) < F.lit(float(cap)))


def clean_stats(df: DataFrame, target: str = "median_house_value", cap: float | None = TARGET_CAP) -> DataFrame:
    """One row: rows before, removed, kept, percent removed."""
    kept = F.count(F.lit(1)) if cap is None else F.count_if(F.col(target) < F.lit(float(cap)))
    counted = df.agg(F.count(F.lit(1)).alias("rows_before"), kept.alias("rows_kept"))
    removed = F.col("rows_before") - F.col("rows_kept")
    return counted.select(
        "rows_before",
        removed.alias("rows_removed"),
        "rows_kept",
        F.coalesce(F.try_divide(removed * 100.0, F.col("rows_before")), F.lit(0.0)).alias("pct_removed"),
    )


def add_stratum(
    df: DataFrame,
    column: str = "median_income",
    edges: Sequence[float] = INCOME_EDGES,
    labels: Sequence[int] = INCOME_LABELS,
    out: str = "stratum",
) -> DataFrame:
    require_columns(df, [column])
    return df.withColumn(out, bin_right_closed(F.col(column), edges, labels))


def merge_categories(df: DataFrame, column: str, mapping: Mapping[str, str]) -> DataFrame:
    require_columns(df, [column])
    return df.withColumn(column, merge_values(F.col(column), mapping))


def sanitize_columns(df: DataFrame) -> DataFrame:
    return df.toDF(*sanitize_names(df.columns))
