"""Exact, repeatable splits and folds.

Every row gets a uniform hash. A slice of a stratum (train, test, fold 3, ...) is a contiguous
piece of its hash order, so a split is fully described by a few cut hashes per stratum. Finding
them takes counting passes over ever longer hash prefixes; assigning rows is then a comparison with
a tiny broadcast table. No window and no sort ever sees the whole table or a whole stratum.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Mapping, Sequence

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from acreline.errors import DataValidationError
from acreline.operators.checks import check_fraction, check_folds, require_columns
from acreline.operators.keys import hash_order

MAX_STRATA = 10_000
PREFIX_STEP = 3
BUCKET_LIMIT = 50_000
# Tasks that hold the counts of the first prefixes, 4,096 a stratum at most, whatever the number of shuffle partitions.
BUCKET_TASKS = 32
COPY_BLOCK = 100_000
# A hash text per cell: 100,000 cells are some 5 MB. Larger cut tables are joined as Spark sees fit.
BROADCAST_CELLS = 100_000


# --- how many rows each slice gets -----------------------------------------------------------


def largest_remainder(sizes: Mapping, part: int) -> dict:
    """Share ``part`` rows out over the strata in proportion; ties go to the smaller label."""
    total = sum(sizes.values())
    exact = {k: (n * part // total, n * part % total) for k, n in sizes.items()}
    quota = {k: whole for k, (whole, _) in exact.items()}
    left = part - sum(quota.values())
    for k in sorted(sizes, key=lambda k: (-exact[k][1], k))[:left]:
        quota[k] += 1
    return quota


def test_rows(total: int, test_size: float) -> int:
    return math.ceil(test_size * total)


def fold_quota(sizes: Mapping, folds: int) -> dict:
    """Rows per stratum and fold when the strata are dealt out one after another, card by card."""
    quota, start = {}, 0
    for k in sorted(sizes):
        end = start + sizes[k]
        quota[k] = [len(range(start + (f - start) % folds, end, folds)) for f in range(folds)]
        start = end
    return quota


# --- cutting the hash order ------------------------------------------------------------------


def _stratum_sizes(buckets: DataFrame) -> dict:
    rows = buckets.groupBy("__s").agg(F.sum("n").alias("n")).limit(MAX_STRATA + 1).collect()
    if len(rows) > MAX_STRATA:
        raise DataValidationError(f"more than {MAX_STRATA} strata; bin the column first")
    return {row["__s"]: row["n"] for row in rows}


def _locate(buckets: DataFrame, cuts: DataFrame, keys: list[str], step: str) -> DataFrame:
    """The bucket in which each wanted rank falls, and the rows before that bucket."""
    order = Window.partitionBy(*keys).orderBy(step)
    running = buckets.withColumn("upto", F.sum("n").over(order))
    return (
        running.join(cuts, keys)
        .withColumn("first", F.col("base") + F.col("upto") - F.col("n"))
        .filter((F.col("first") < F.col("rank")) & (F.col("rank") <= F.col("first") + F.col("n")))
    )


def _cut_hashes(keyed: DataFrame, buckets: DataFrame, wanted: list[tuple], stype: str) -> list[tuple]:
    """(stratum, cut, hash, rows to take of those with this hash, rows with this hash)."""
    spark = keyed.sparkSession
    width = PREFIX_STEP
    cuts = spark.createDataFrame(
        [(s, c, r, 0) for s, c, r in wanted], f"__s {stype}, cut int, rank bigint, base bigint"
    )
    # a row a stratum and cut, a hash text at most: broadcast while that is small, else joined as Spark sees fit
    near = F.broadcast if len(wanted) <= BROADCAST_CELLS else lambda x: x
    hits = _locate(buckets, near(cuts), ["__s"], "__p").collect()
    while True:
        # At most strata x cuts rows, each known from a bucket of the pass before.
        known = [(h["__s"], h["cut"], h["rank"], h["first"], h["__p"]) for h in hits]
        cuts = spark.createDataFrame(
            known, f"__s {stype}, cut int, rank bigint, base bigint, __p string"
        )
        targets = cuts.select("__s", "__p").distinct()
        inside = keyed.withColumn("__p", F.substring("__h", 1, width)).join(
            near(targets), ["__s", "__p"]
        )
        last = max(h["n"] for h in hits) <= BUCKET_LIMIT or width >= 3 * PREFIX_STEP
        step = F.col("__h") if last else F.substring("__h", 1, width + PREFIX_STEP)
        finer = inside.withColumn("__q", step).groupBy("__s", "__p", "__q").agg(F.count(F.lit(1)).alias("n"))
        hits = (
            _locate(finer, near(cuts), ["__s", "__p"], "__q")
            .select("__s", "cut", "rank", "first", "n", F.col("__q").alias("__p"))
            .collect()
        )
        if last:
            return [(h["__s"], h["cut"], h["__p"], h["rank"] - h["first"], h["n"]) for h in hits]
        width += PREFIX_STEP


def assign_slices(
    df: DataFrame,
    quota: Callable[[dict], dict[object, Sequence[int]]],
    out: str,
    stratum: str | None = None,
    id_cols: Sequence[str] | None = None,
    seed: int = 42,
    salt: str = "slice",
) -> DataFrame:
    """Add ``out`` = number of the slice (0, 1, ...) of each row.

    ``quota`` maps {stratum: rows} to {stratum: rows per slice}. Sizes are met exactly.
    """
    require_columns(df, [*(id_cols or []), *([stratum] if stratum else [])])
    if out in df.columns:
        raise ValueError(f"column {out!r} is there already")
    stype = df.schema[stratum].dataType.simpleString() if stratum else "int"
    keyed = df.withColumn("__h", hash_order(df, id_cols, seed, salt)).withColumn(
        "__s", F.col(stratum) if stratum else F.lit(0)
    )
    # the search sees the stratum and the hash alone, kept for its passes and released after them
    narrow = keyed.select("__s", "__h").persist(StorageLevel.MEMORY_AND_DISK)
    buckets = (
        narrow.groupBy("__s", F.substring("__h", 1, PREFIX_STEP).alias("__p"))
        .agg(F.count(F.lit(1)).alias("n"))
        .coalesce(BUCKET_TASKS)
        .persist()
    )
    try:
        sizes = _stratum_sizes(buckets)
        if None in sizes:
            raise DataValidationError(f"{sizes[None]} rows have no stratum")
        shares = quota(sizes)
        wanted, always = [], []
        for s, rows in shares.items():
            if sum(rows) != sizes[s]:
                raise ValueError("slice sizes must add up to the stratum size")
            upto = 0
            for cut, n in enumerate(rows[:-1]):
                upto += n
                # A cut before the first row lies below every hash.
                (wanted if upto else always).append((s, cut, upto) if upto else (s, cut, "", 0, 0))
        found = always + (_cut_hashes(narrow, buckets, wanted, stype) if wanted else [])
    finally:
        buckets.unpersist()
        narrow.unpersist()

    slices = max(len(rows) for rows in shares.values()) if shares else 1
    table: dict[object, list[str]] = {s: ["~"] * (slices - 1) for s in shares}
    tied: dict[tuple, list[tuple[int, int, int]]] = {}
    for s, cut, digest, take, rows in found:
        table[s][cut] = digest
        if take < rows:
            tied.setdefault((s, digest), []).append((cut, take, rows))
    names = [f"__c{i}" for i in range(slices - 1)]
    cut_table = df.sparkSession.createDataFrame(
        [(s, *digests) for s, digests in table.items()],
        f"__s {stype}" + "".join(f", {n} string" for n in names),
    )
    number = F.lit(0)
    for n in names:
        number = number + (F.col("__h") > F.col(n)).cast("int")
    if stratum:
        small = len(table) * slices <= BROADCAST_CELLS
        placed = keyed.join(F.broadcast(cut_table) if small else cut_table, "__s")
    else:
        only = next(iter(table.values()), [])
        placed = keyed.withColumns({n: F.lit(v) for n, v in zip(names, only)})
    columns = [F.col(f"`{c}`") for c in df.columns]
    if not tied:
        return placed.select(*columns, number.alias(out))
    # As many rows as there are cuts inside a group of copies: never more than strata x slices.
    cut_keys = df.sparkSession.createDataFrame(list(tied), f"__s {stype}, __h string")
    if len(tied) <= BROADCAST_CELLS:
        cut_keys = F.broadcast(cut_keys)
    plain = placed.join(cut_keys, ["__s", "__h"], "left_anti").select(*columns, number.alias(out))
    copies = placed.join(cut_keys, ["__s", "__h"], "left_semi").select(*columns, "__s", "__h")
    return plain.unionByName(_deal_copies(copies, df.columns, tied, slices, stype, out))


def _deal_copies(
    copies: DataFrame, columns: list[str], tied: Mapping, slices: int, stype: str, out: str
) -> DataFrame:
    """Rows that share a cut hash are copies of one another: count them, share the count out and
    write the copies again, block by block, so that a huge group of copies is never one task."""
    pieces = []
    for (s, digest), cuts in tied.items():
        rows = cuts[0][2]
        taken = {cut: take for cut, take, _ in cuts}
        start = 0
        for number in range(min(taken), slices):
            end = taken.get(number, rows)
            if end > start:
                pieces.append((s, digest, number, start, end))
            start = max(start, end)
            if start >= rows:
                break
    spans = copies.sparkSession.createDataFrame(
        pieces, f"__s {stype}, __h string, {out} int, __a bigint, __b bigint"
    )
    content = F.md5(F.concat_ws("\u001f", *[F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("\u0000")) for c in columns]))
    counted = (
        copies.groupBy("__s", "__h", *[F.col(f"`{c}`") for c in columns])
        .agg(F.count(F.lit(1)).alias("__n"))
        .withColumn("__e", F.sum("__n").over(Window.partitionBy("__s", "__h").orderBy(content)))
    )
    share = F.least("__b", "__e") - F.greatest("__a", F.col("__e") - F.col("__n"))
    if len(pieces) <= BROADCAST_CELLS:
        spans = F.broadcast(spans)
    dealt = counted.join(spans, ["__s", "__h"]).withColumn("__m", share).filter("__m > 0")
    blocks = dealt.withColumn(
        "__block", F.explode(F.sequence(F.lit(0), F.expr(f"CAST((__m - 1) DIV {COPY_BLOCK} AS INT)")))
    ).repartition("__h", out, "__block")
    size = F.least(F.lit(COPY_BLOCK), F.col("__m") - F.col("__block") * COPY_BLOCK)
    return blocks.select(
        *[F.col(f"`{c}`") for c in columns],
        out,
        F.explode(F.sequence(F.lit(1), size.cast("int"))).alias("__i"),
    ).drop("__i")


# --- the splits of the training flow ---------------------------------------------------------


def _two_parts(test_size: float) -> Callable[[dict], dict]:
    def quota(sizes: dict) -> dict:
        total = sum(sizes.values())
        test = test_rows(total, test_size)
        if test >= total:
            raise ValueError("the test part would take every row")
        train = largest_remainder(sizes, total - test)
        return {s: [train[s], sizes[s] - train[s]] for s in sizes}

    return quota


def _label(df: DataFrame, number: str, part_col: str, names: tuple[str, str]) -> DataFrame:
    part = F.when(F.col(number) == 0, F.lit(names[0])).otherwise(F.lit(names[1]))
    return df.withColumn(part_col, part).drop(number)


def stratified_split(
    df: DataFrame,
    stratum: str,
    id_cols: Sequence[str] | None = None,
    test_size: float = 0.2,
    seed: int = 42,
    salt: str = "test",
    part_col: str = "part",
    names: tuple[str, str] = ("train", "test"),
) -> DataFrame:
    """Train/test split that keeps every stratum's share to within one row; test = ceil(f * n)."""
    check_fraction(test_size)
    sliced = assign_slices(df, _two_parts(test_size), "__part", stratum, id_cols, seed, salt)
    return _label(sliced, "__part", part_col, names)


def random_split(
    df: DataFrame,
    id_cols: Sequence[str] | None = None,
    test_size: float = 0.2,
    seed: int = 42,
    salt: str = "test",
    part_col: str = "part",
    names: tuple[str, str] = ("train", "test"),
) -> DataFrame:
    """The same without strata."""
    check_fraction(test_size)
    sliced = assign_slices(df, _two_parts(test_size), "__part", None, id_cols, seed, salt)
    return _label(sliced, "__part", part_col, names)


def kfold(
    df: DataFrame,
    folds: int = 5,
    stratum: str | None = None,
    id_cols: Sequence[str] | None = None,
    seed: int = 42,
    salt: str = "fold",
    fold_col: str = "fold",
) -> DataFrame:
    """Number the rows 0 .. folds-1; fold sizes, overall and per stratum, differ by at most one."""
    check_folds(folds)
    return assign_slices(df, lambda sizes: fold_quota(sizes, folds), fold_col, stratum, id_cols, seed, salt)


def threshold_split(
    df: DataFrame,
    id_cols: Sequence[str] | None = None,
    test_size: float = 0.2,
    seed: int = 42,
    salt: str = "test",
    part_col: str = "part",
) -> DataFrame:
    """Map-only split with approximate sizes: no counting pass at all."""
    check_fraction(test_size)
    share = F.conv(F.substring(hash_order(df, id_cols, seed, salt), 1, 13), 16, 10).cast("double") / float(16**13)
    return df.withColumn(part_col, F.when(share < 1.0 - test_size, "train").otherwise("test"))


# --- gates and audits ------------------------------------------------------------------------


def strata_report(df: DataFrame, stratum: str, min_rows: int = 3) -> DataFrame:
    """One row: rows without a stratum, number of strata, smallest stratum, whether a split may go on."""
    sizes = df.groupBy(stratum).agg(F.count(F.lit(1)).alias("n"))
    known = F.col(stratum).isNotNull()
    report = sizes.agg(
        F.coalesce(F.sum(F.when(~known, F.col("n"))), F.lit(0)).alias("rows_outside"),
        F.count_if(known).alias("strata"),
        F.coalesce(F.min(F.when(known, F.col("n"))), F.lit(0)).alias("smallest"),
    )
    return report.withColumn("passed", (F.col("rows_outside") == 0) & (F.col("smallest") >= max(2, min_rows)))


def require_strata(df: DataFrame, stratum: str, min_rows: int = 3) -> None:
    """Stop unless every row has a stratum and every stratum is large enough."""
    row = strata_report(df, stratum, min_rows).first()
    if row["rows_outside"]:
        raise DataValidationError(f"{row['rows_outside']} rows fall outside all bins of {stratum!r}")
    if not row["passed"]:
        raise DataValidationError(
            f"smallest stratum of {stratum!r} has {row['smallest']} rows, needed are {max(2, min_rows)}"
        )


def split_audit(df: DataFrame, part_col: str, stratum: str) -> DataFrame:
    """Rows per part and stratum and the stratum's share of its part."""
    counts = df.groupBy(part_col, stratum).agg(F.count(F.lit(1)).alias("n_rows"))
    total = F.sum("n_rows").over(Window.partitionBy(part_col))
    return counts.withColumn("share", F.col("n_rows") / total)


def fold_sizes(df: DataFrame, fold_col: str = "fold") -> DataFrame:
    """Rows to fit on and rows to score for every fold."""
    counts = df.groupBy(fold_col).agg(F.count(F.lit(1)).alias("n_val"))
    return counts.withColumn("n_train", F.sum("n_val").over(Window.partitionBy(F.lit(0))) - F.col("n_val"))


def fold_parts(df: DataFrame, fold: int, fold_col: str = "fold") -> tuple[DataFrame, DataFrame]:
    """(rows to fit on, rows to score) of one fold."""
    return df.filter(F.col(fold_col) != fold), df.filter(F.col(fold_col) == fold)
