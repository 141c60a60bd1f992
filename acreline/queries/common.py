"""Frames that several queries start from."""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from acreline.operators.clean import add_stratum, clean_capped
from acreline.operators.models import Training
from acreline.operators.split import kfold, stratified_split
from acreline.queries.registry import ID, TARGET
from acreline.sources.district import district


def several_passes(df: DataFrame) -> DataFrame:
    """The district table is a join; operators that scan it several times get it kept."""
    return df.persist(StorageLevel.MEMORY_AND_DISK)


def clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean_capped(district(spark, sf_dir))


def binned(spark: SparkSession, sf_dir: str) -> DataFrame:
    return add_stratum(clean(spark, sf_dir))


def parted(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stratified_split(binned(spark, sf_dir), "stratum", [ID])


def folded(spark: SparkSession, sf_dir: str) -> DataFrame:
    train = several_passes(parted(spark, sf_dir).filter("part = 'train'"))
    return kfold(train, 5, "stratum", [ID])


def scored(df: DataFrame) -> DataFrame:
    """A fixed linear scorer: 20,000 + 42,000 x income."""
    return df.withColumn("prediction", F.lit(20000.0) + F.lit(42000.0) * F.col("median_income"))


# Further fixed scorers, (model, intercept, slope), for reports over several models.
SCORERS = (("income_line", 20000.0, 42000.0), ("steep_line", 10000.0, 45000.0), ("flat_line", 200000.0, 0.0))


def scored_by_models(df: DataFrame) -> DataFrame:
    cells = [
        F.struct(F.lit(m).alias("model"), (F.lit(a) + F.lit(b) * F.col("median_income")).alias("prediction"))
        for m, a, b in SCORERS
    ]
    kept = [c for c in df.columns if c in {ID, TARGET, "fold", "part"}]
    return df.select(*kept, F.inline(F.array(*cells)))


def training() -> Training:
    return Training(id_cols=(ID,))
