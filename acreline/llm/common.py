"""Shared small parts: word bytes, code point blocks, written tables, connected components."""

from __future__ import annotations

import re
from collections.abc import Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from acreline.session import ensure_checkpoint_dir, fresh_dir

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a table in the shared folder: cuts the lineage, costs one compressed write."""
    path = fresh_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def arrow_batches(spark: SparkSession, size: int) -> Iterator[None]:
    """Jobs started inside hand their Python functions about ``size`` bytes at a time, or less where the session says so.

    Without this a batch is bounded by its rows, and a task holds it several times over: in rows, in Arrow, in Python and
    as a result.
    """
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(name)
    number, unit = re.fullmatch(r"(\d+)([kmgtp]?)b?", before.strip().lower()).groups()
    held = int(number) << 10 * " kmgtp".index(unit or " ")
    spark.conf.set(name, str(min(size, held)))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def checkpointed(df: DataFrame) -> DataFrame:
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint()


def ascii_lower(text: Column) -> Column:
    """A-Z to a-z and nothing else, unlike ``lower``."""
    return F.translate(text, UPPER, UPPER.lower())


def free_name(df: DataFrame, stem: str) -> str:
    """A column name that ``df`` does not have, whatever extra columns it carries."""
    taken = {c.lower() for c in df.columns}
    while stem.lower() in taken:
        stem += "_"
    return stem


def claim(df: DataFrame, *names: str) -> None:
    """An operator's result columns must be free in its input: the one rule for clashing names."""
    taken = {c.lower() for c in df.columns} & {n.lower() for n in names}
    if taken:
        raise ValueError(f"the input already has the result column(s) {sorted(taken)}: rename them, or choose another name")


def texts(array: pa.Array) -> Iterator[str]:
    """Strings of an Arrow array, null as empty, one at a time."""
    return (x.as_py() or "" for x in array)


def utf8(array: pa.Array) -> Iterator[bytes]:
    """UTF-8 bytes of an Arrow string array, null as empty, without decoding."""
    return (x.as_py() or b"" for x in array.cast(pa.large_binary()))


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for the nodes of ``edges(a, b)``: root is the smallest node that can be reached.

    Alternating large-star and small-star steps: every node is tied to the smallest of its
    neighbourhood until nothing changes. A step is an aggregation with map-side combining and a
    join, so a hub only makes a skewed join, which AQE splits. The number of steps grows with the
    logarithm of the longest chain. Each step is cut off by a reliable checkpoint.
    """
    mark = F.xxhash64("u", "v")
    links = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u <> v").distinct()
    links = checkpointed(links)
    seen = None
    while True:
        state = links.agg(F.count("*").alias("n"), F.bit_xor(mark).alias("x")).first()
        if tuple(state) == seen or state["n"] == 0:
            return links.select(F.col("u").alias("node"), F.col("v").alias("root"))
        seen = tuple(state)
        both = links.union(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(low, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").filter("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        links = checkpointed(small.union(low.select("u", F.col("m").alias("v"))).distinct())
