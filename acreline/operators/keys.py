"""Row keys and repeatable hash order, independent of partitioning and row position."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def row_key(df: DataFrame, id_cols: Sequence[str] | None = None) -> Column:
    """Text key of a row: its id columns, or a digest of the whole row when it has none."""
    columns = list(id_cols) if id_cols else df.columns
    if len(columns) == 1 and id_cols:
        return F.col(columns[0]).cast("string")
    cells = [F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("\u0000")) for c in columns]
    return F.md5(F.concat_ws("\u001f", *cells))


def hash_order(df: DataFrame, id_cols: Sequence[str] | None, seed: int, salt: str) -> Column:
    """Uniform 32-digit hex text: a random order that is the same on every run and every engine."""
    return F.md5(F.concat(F.lit(f"{seed}:{salt}:"), row_key(df, id_cols)))


def hash_sample(df: DataFrame, rows: int, id_cols: Sequence[str] | None = None, seed: int = 42, salt: str = "sample") -> DataFrame:
    """Exactly ``rows`` rows (or all, if fewer) in hash order: a per-task top-k, not a full sort."""
    if rows < 1:
        raise ValueError("rows must be positive")
    order = hash_order(df, id_cols, seed, salt)
    return df.withColumn("__h", order).orderBy("__h", row_key(df, id_cols)).limit(rows).drop("__h")


#: Rows of a task on large tables. A learner starts a job a level of a tree, in which a task of 20,000 rows works for some
#: milliseconds, and every task sends the sums of all open nodes: fewer tasks are less to start and less to shuffle.
TASK_ROWS = 200_000


def parts_for(rows: int, least: int = 2_000) -> int:
    """Number of partitions for an iterative learner, from the row count alone: up to eight tasks of
    ``least`` rows on small tables, ``TASK_ROWS`` and later a million rows per task on large ones,
    never more tasks than a driver can follow."""
    small = max(1, min(8, rows // least))
    return max(small, min(-(-rows // TASK_ROWS), max(2_000, -(-rows // 1_000_000)), 100_000))


def stable_layout(df: DataFrame, id_cols: Sequence[str] | None) -> DataFrame:
    """Same partitions and same row order for the same rows, however the input was laid out.

    The iterative learners depend on both. The number of partitions follows the row count only.
    With real id columns every key is one row, so no partition can run hot. Without them equal
    rows would share a partition; they are spread first, which is safe because they are equal.
    """
    rows = df.count()
    parts = parts_for(rows)
    keyed = df.withColumn("__k", row_key(df, id_cols))
    if id_cols:
        laid = keyed.repartition(parts, "__k")
    else:
        laid = keyed.withColumn("__s", F.floor(F.rand(17) * parts)).repartition(parts, "__k", "__s").drop("__s")
    return laid.sortWithinPartitions("__k").drop("__k")
