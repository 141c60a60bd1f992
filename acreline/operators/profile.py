"""Profiling reports. Each returns a small frame; each reads only the columns it needs.

NaN and infinities count as missing in every number that is reported.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from acreline.functions.expressions import finite, safe_ratio
from acreline.operators.checks import require_columns
from acreline.operators.comoments import comoments
from acreline.operators.keys import hash_sample
from acreline.operators.quantiles import exact_quantiles, quantiles_by

QUARTILES = (0.25, 0.5, 0.75)
BROADCAST_GROUPS = 10_000
#: Highest power kept of a cell's rows for a density; see ``density_curves`` for the error.
KERNEL_ORDER = 12


def _number(column: str) -> Column:
    """The column as a double that is missing where it is no finite number."""
    return finite(F.col(f"`{column}`").cast("double"))


def _unpivot(row: DataFrame, names: Sequence[str], fields: dict[str, str]) -> DataFrame:
    """One wide row -> one row per column; ``fields`` maps output name to the alias prefix."""
    cells = [
        F.struct(F.lit(n).alias("column"), *[F.col(f"{p}{i}").alias(f) for f, p in fields.items()])
        for i, n in enumerate(names)
    ]
    return row.select(F.inline(F.array(*cells)))


def structure(df: DataFrame) -> DataFrame:
    """(column, type, non_null, n_rows) in one scan."""
    aggs = [F.count(F.lit(1)).alias("rows")]
    aggs += [F.count(F.col(f"`{c}`")).alias(f"n{i}") for i, c in enumerate(df.columns)]
    cells = [
        F.struct(
            F.lit(f.name).alias("column"),
            F.lit(f.dataType.simpleString()).alias("type"),
            F.col(f"n{i}").alias("non_null"),
            F.col("rows").alias("n_rows"),
        )
        for i, f in enumerate(df.schema.fields)
    ]
    return df.agg(*aggs).select(F.inline(F.array(*cells)))


def head(df: DataFrame, order: Sequence[str], rows: int = 5) -> DataFrame:
    """First rows in the order of a key (Spark has no row order of its own); a top-k, not a sort."""
    require_columns(df, order)
    return df.orderBy(*order).limit(rows)


def null_counts(df: DataFrame) -> DataFrame:
    """(column, n_null) for the columns that have missing cells."""
    counted = df.agg(*[F.count_if(F.col(f"`{c}`").isNull()).alias(f"n{i}") for i, c in enumerate(df.columns)])
    return _unpivot(counted, df.columns, {"n_null": "n"}).filter("n_null > 0")


def duplicate_rows(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Copies beyond the first. Copies combine before the shuffle, so a huge group is one record."""
    keys = list(columns or df.columns)
    groups = df.groupBy(*[F.col(f"`{c}`") for c in keys]).agg(F.count(F.lit(1)).alias("n"))
    return groups.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("n_rows"),
        F.count(F.lit(1)).alias("n_distinct"),
        F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("n_duplicates"),
    )


def top_values(df: DataFrame, column: str, top: int = 5) -> DataFrame:
    """Most frequent values, smaller value first on equal counts."""
    require_columns(df, [column])
    counts = df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("n_rows"))
    return counts.orderBy(F.desc("n_rows"), F.asc(column)).limit(top)


def cap_profile(df: DataFrame, column: str) -> DataFrame:
    """The maximum, the rows that sit on it and their percentage: the sign of a censored column."""
    require_columns(df, [column])
    value = _number(column)
    high = df.agg(F.max(value).alias("m")).first()["m"]
    at_cap = F.count_if(value == F.lit(high)) if high is not None else F.lit(0).cast("bigint")
    counted = df.agg(at_cap.alias("n_at_cap"), F.count(F.lit(1)).alias("n_rows"))
    return counted.select(
        F.lit(high).cast("double").alias("cap_value"),
        "n_at_cap",
        "n_rows",
        F.coalesce(F.try_divide(F.col("n_at_cap") * 100.0, F.col("n_rows")), F.lit(0.0)).alias("pct_at_cap"),
    )


def describe(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """count, mean, sample deviation, min, exact quartiles, max; one row per column."""
    require_columns(df, columns)
    extra: dict[str, Column] = {}
    for i, c in enumerate(columns):
        v = finite(F.col(c).cast("double"))
        extra |= {f"mean{i}": F.avg(v), f"std{i}": F.stddev_samp(v), f"min{i}": F.min(v), f"max{i}": F.max(v)}
    found = exact_quantiles(df.select(*columns), {c: F.col(c) for c in columns}, QUARTILES, extra)
    rows = []
    for i, c in enumerate(columns):
        quartiles = found.values[c] or [None] * 3
        x = found.extra
        rows.append((c, found.counts[c], x[f"mean{i}"], x[f"std{i}"], x[f"min{i}"], *quartiles, x[f"max{i}"]))
    schema = "`column` string, n_rows bigint, mean double, std double, min double, q25 double, q50 double, q75 double, max double"
    return df.sparkSession.createDataFrame(rows, schema)


def approx_describe(df: DataFrame, columns: Sequence[str], accuracy: int = 10_000) -> DataFrame:
    """The same in a single scan; quartiles within rows / accuracy ranks."""
    aggs = []
    for i, c in enumerate(columns):
        v = finite(F.col(c).cast("double"))
        aggs += [
            F.count(v).alias(f"n{i}"),
            F.avg(v).alias(f"a{i}"),
            F.stddev_samp(v).alias(f"s{i}"),
            F.min(v).alias(f"l{i}"),
            F.max(v).alias(f"h{i}"),
            F.percentile_approx(v, list(QUARTILES), accuracy).alias(f"q{i}"),
        ]
    row = df.agg(*aggs)
    for i in range(len(columns)):
        row = row.withColumns({f"q{j}_{i}": F.col(f"q{i}")[j] for j in range(3)})
    fields = {"n_rows": "n", "mean": "a", "std": "s", "min": "l", "q25": "q0_", "q50": "q1_", "q75": "q2_", "max": "h"}
    return _unpivot(row, columns, fields)


def _bin_index(value: Column, low: float, width: float, bins: int) -> Column:
    place = F.floor((value - F.lit(low)) / F.lit(width)) if width else F.lit(0)
    return F.least(place.cast("int"), F.lit(bins - 1))


def _ranges(df: DataFrame, columns: Sequence[str]) -> dict[str, tuple[float, float]]:
    row = df.agg(
        *[F.min(_number(c)).alias(f"l{i}") for i, c in enumerate(columns)],
        *[F.max(_number(c)).alias(f"h{i}") for i, c in enumerate(columns)],
    ).first()
    return {c: (row[f"l{i}"], row[f"h{i}"]) for i, c in enumerate(columns) if row[f"l{i}"] is not None}


def histogram(df: DataFrame, columns: Sequence[str], bins: int = 50) -> DataFrame:
    """Equal-width bins of each column's range: (column, bin, bin_low, n_rows), empty bins left out.

    Two scans for any number of columns: ranges, then counts. The counts combine before the shuffle
    to columns x bins records.
    """
    require_columns(df, columns)
    if bins < 1:
        raise ValueError("bins must be positive")
    return _binned(df, {c: bins for c in columns}, _ranges(df.select(*columns), columns))


def _binned(df: DataFrame, bins: dict[str, int], ranges: dict[str, tuple[float, float]]) -> DataFrame:
    cells = []
    for c, (low, high) in ranges.items():
        width = (high - low) / bins[c]
        value = _number(c)
        index = _bin_index(value, low, width, bins[c])
        cells.append(
            F.struct(
                F.lit(c).alias("column"),
                F.when(value.isNotNull(), index).alias("bin"),
                (F.lit(low) + index * F.lit(width)).alias("bin_low"),
            )
        )
    if not cells:
        return df.sparkSession.createDataFrame([], "`column` string, bin int, bin_low double, n_rows bigint")
    return (
        df.select(F.inline(F.array(*cells)))
        .filter("bin IS NOT NULL")
        .groupBy("column", "bin", "bin_low")
        .agg(F.count(F.lit(1)).alias("n_rows"))
    )


def auto_bins(df: DataFrame, column: str) -> tuple[int, float, float]:
    """(bins, min, max): the finer of the Sturges and the Freedman-Diaconis width."""
    v = _number(column)
    found = exact_quantiles(df.select(column), {column: v}, (0.25, 0.75), {"low": F.min(v), "high": F.max(v)})
    n = found.counts[column]
    if not n:
        raise ValueError(f"column {column!r} has no values")
    low, high = found.extra["low"], found.extra["high"]
    span = high - low
    if not span:
        return 1, low, high
    q25, q75 = found.values[column]
    width = span / (math.log2(n) + 1.0)
    if q75 > q25:
        width = min(width, 2.0 * (q75 - q25) / n ** (1.0 / 3.0))
    return math.ceil(span / width), low, high


def histogram_auto(df: DataFrame, column: str) -> DataFrame:
    """Histogram with the bin count chosen from the data."""
    require_columns(df, [column])
    bins, low, high = auto_bins(df, column)
    return _binned(df.select(column), {column: bins}, {column: (low, high)})


def density_curves(df: DataFrame, columns: Sequence[str], points: int = 200) -> DataFrame:
    """(column, point, x, density): Gaussian kernel density of each column on a grid over its range, bandwidth h by
    Scott's rule. One scan for ranges and deviations, one for all densities.

    The second scan keeps, for each cell of width h / 4, the power sums S_k of (x - centre) / h up to ``KERNEL_ORDER``. The
    kernels of a cell's rows add up to phi(z) sum_k He_k(z) S_k / k! at distance z h from the centre, by the generating
    function of the Hermite polynomials He_k. As |He_k(z)| exp(-z^2 / 2) <= 1.09 sqrt(k!) and |x - centre| <= h / 8, what is
    left out of a row's kernel is below 3e-17 of its peak, and so are rows more than 9 h away, which are passed over. Cells combine before the shuffle; they are at most 4 range / h.
    """
    require_columns(df, columns)
    if points < 2:
        raise ValueError("a curve has two points at least")
    v = {c: _number(c) for c in columns}
    aggs = [f(x).alias(f"{n}{i}") for i, x in enumerate(v.values()) for n, f in (("l", F.min), ("h", F.max), ("s", F.stddev_samp), ("n", F.count))]
    row = df.agg(*aggs).first()
    cells = []
    for i, (c, x) in enumerate(v.items()):
        low, high, spread, n = (row[f"{k}{i}"] for k in "lhsn")
        if not n or not spread:
            raise ValueError(f"column {c!r} has no spread")
        band = spread * n ** (-0.2)
        cell = F.floor((x - F.lit(low)) / F.lit(band / 4))
        t = (x - F.lit(low)) / F.lit(band) - (cell + F.lit(0.5)) / F.lit(4.0)
        step = (high - low) / (points - 1)
        own = (F.lit(c).alias("column"), F.lit(float(low)).alias("low"), F.lit(band).alias("band"), F.lit(step).alias("step"), F.lit(n).alias("n"))
        cells.append(F.struct(*own, cell.alias("cell"), t.alias("t")))
    rows = df.select(F.inline(F.array(*cells))).filter("t IS NOT NULL")
    power, sums = F.lit(1.0), []
    for k in range(KERNEL_ORDER + 1):
        sums.append(F.sum(power).alias(f"s{k}"))
        power = power * F.col("t")
    kept = rows.groupBy("column", "low", "band", "step", "n", "cell").agg(*sums)
    centre = F.col("low") + (F.col("cell") + F.lit(0.5)) * F.col("band") / 4
    first = F.greatest(F.ceil((centre - F.col("low") - 9 * F.col("band")) / F.col("step")), F.lit(0))
    last = F.least(F.floor((centre - F.col("low") + 9 * F.col("band")) / F.col("step")), F.lit(points - 1))
    near = kept.withColumns({"c": centre, "first": first, "last": last}).filter("first <= last")
    near = near.withColumn("point", F.explode(F.sequence("first", "last")))
    near = near.withColumn("x", F.col("low") + F.col("point") * F.col("step"))
    near = near.withColumn("z", (F.col("x") - F.col("c")) / F.col("band"))
    before, he, total = F.lit(0.0), F.lit(1.0), F.lit(0.0)
    for k in range(KERNEL_ORDER + 1):
        total = total + he * F.col(f"s{k}") / math.factorial(k)
        before, he = he, F.col("z") * he - k * before
    kernel = total * F.exp(F.col("z") * F.col("z") * F.lit(-0.5))
    curve = near.groupBy("column", "low", "band", "step", "n", "point").agg((F.sum(kernel) / math.sqrt(2.0 * math.pi)).alias("k"))
    grid = df.sparkSession.range(points).select(F.col("id").alias("point"))
    known = [(c, float(row[f"l{i}"]), (row[f"h{i}"] - row[f"l{i}"]) / (points - 1)) for i, c in enumerate(columns)]
    # every point of every curve, also where no row is near: columns x points rows
    whole = df.sparkSession.createDataFrame(known, "`column` string, low double, step double").join(grid)
    found = curve.select("column", "point", (F.col("k") / (F.col("n") * F.col("band"))).alias("density"))
    return whole.join(found, ["column", "point"], "left").select(
        "column", F.col("point").cast("int").alias("point"), (F.col("low") + F.col("point") * F.col("step")).alias("x"), F.coalesce("density", F.lit(0.0)).alias("density")
    )


def density_curve(df: DataFrame, column: str, points: int = 200) -> DataFrame:
    """(point, x, density) of one column."""
    return density_curves(df, [column], points).drop("column")


def cardinality(df: DataFrame, columns: Sequence[str], exact: bool = True) -> DataFrame:
    """Distinct values per column, all columns in one scan. Exact counting combines equal values
    before its shuffle; the approximate way has no shuffle to speak of."""
    require_columns(df, columns)
    count = F.count_distinct if exact else F.approx_count_distinct
    row = df.agg(*[count(F.col(c)).alias(f"n{i}") for i, c in enumerate(columns)])
    return _unpivot(row, columns, {"n_distinct": "n"})


def category_share(df: DataFrame, column: str) -> DataFrame:
    """Rows per category and percent of all rows (missing ones count in the total), most frequent first."""
    require_columns(df, [column])
    counts = df.groupBy(column).agg(F.count(F.lit(1)).alias("n_rows"))
    total = F.broadcast(counts.agg(F.sum("n_rows").alias("__total")))  # one row, of the counts that are there already
    shares = counts.join(total).withColumn("pct", F.col("n_rows") * 100.0 / F.col("__total")).drop("__total")
    return shares.filter(F.col(column).isNotNull()).orderBy(F.desc("n_rows"), column)


def pearson(a: str, b: str) -> Column:
    """r over the rows where both are known; missing when one of them does not vary there (the
    built-in ``corr`` divides by zero then, an error in ANSI mode)."""
    x, y = finite(F.col(a).cast("double")), finite(F.col(b).cast("double"))
    spread = F.var_pop(F.when(y.isNotNull(), x)) * F.var_pop(F.when(x.isNotNull(), y))
    return F.try_divide(F.covar_pop(x, y), F.sqrt(spread))


def correlations(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Pearson's r of every pair, both ways and with itself, over the rows where both are known: one scan for any number
    of columns. Missing where a column does not vary over those rows."""
    require_columns(df, columns)
    if len(columns) < 2:
        raise ValueError("at least two columns are needed")
    r = comoments(df, columns).pearson()
    np.fill_diagonal(r, np.where(np.isnan(r.diagonal()), np.nan, 1.0))
    cells = [(a, b, None if np.isnan(r[i, j]) else float(r[i, j])) for i, a in enumerate(columns) for j, b in enumerate(columns)]
    return df.sparkSession.createDataFrame(cells, "column_a string, column_b string, r double")


def target_correlations(
    df: DataFrame, target: str, columns: Sequence[str], ratios: dict[str, tuple[str, str]], own: bool = False
) -> DataFrame:
    """r of each column and of each added ratio with the target, largest first; with ``own`` the target's own row, too."""
    wide = df.withColumns({name: safe_ratio(F.col(a), F.col(b)) for name, (a, b) in ratios.items()})
    names = [*columns, *ratios, *([target] if own else [])]
    row = wide.agg(*[pearson(n, target).alias(f"r{i}") for i, n in enumerate(names)])
    return _unpivot(row, names, {"r": "r"}).orderBy(F.desc_nulls_last("r"), "column")


def pair_counts(df: DataFrame, columns: Sequence[str], bins: int = 50) -> DataFrame:
    """The scatter matrix of all rows as numbers: (column_a, column_b, bin_a, bin_b, n_rows) for every pair of columns over
    the rows where both are known, in equal-width bins of each column's range; empty cells are left out.

    Two scans for any number of pairs: ranges, then counts, which combine before the shuffle to pairs x bins x bins records
    at most.
    """
    require_columns(df, columns)
    if len(columns) < 2 or bins < 1:
        raise ValueError("two columns and one bin at least")
    place = {}
    for c, (low, high) in _ranges(df.select(*columns), columns).items():
        place[c] = F.when(_number(c).isNotNull(), _bin_index(_number(c), low, (high - low) / bins, bins))
    pairs = [(a, b) for i, a in enumerate(columns) for b in columns[i + 1 :] if a in place and b in place]
    if not pairs:
        return df.sparkSession.createDataFrame([], "column_a string, column_b string, bin_a int, bin_b int, n_rows bigint")
    rows = df.select(*[p.alias(f"p{i}") for i, p in enumerate(place.values())])
    at = {c: F.col(f"p{i}") for i, c in enumerate(place)}
    cells = [F.struct(F.lit(a).alias("column_a"), F.lit(b).alias("column_b"), at[a].alias("bin_a"), at[b].alias("bin_b")) for a, b in pairs]
    known = rows.select(F.inline(F.array(*cells))).filter("bin_a IS NOT NULL AND bin_b IS NOT NULL")
    return known.groupBy("column_a", "column_b", "bin_a", "bin_b").agg(F.count(F.lit(1)).alias("n_rows"))


def pair_rows(df: DataFrame, columns: Sequence[str], id_cols: Sequence[str]) -> DataFrame:
    """All rows of the chosen columns for a scatter matrix: a projection, nothing is left out."""
    require_columns(df, [*columns, *id_cols])
    return df.select(*dict.fromkeys([*id_cols, *columns]))


def pair_sample(df: DataFrame, columns: Sequence[str], id_cols: Sequence[str], rows: int = 1_000, seed: int = 42) -> DataFrame:
    """Rows for a scatter matrix of the chosen columns: a repeatable sample of fixed size."""
    require_columns(df, [*columns, *id_cols])
    wanted = list(dict.fromkeys([*id_cols, *columns]))
    return hash_sample(df.select(*wanted), rows, id_cols, seed, "pairs")


def box_stats(df: DataFrame, by: str, value: str) -> DataFrame:
    """Box plot numbers per category: exact quartiles, whiskers at the last point within 1.5 IQR,
    points outside."""
    require_columns(df, [by, value])
    narrow = df.select(by, _number(value).alias(value)).filter(F.col(by).isNotNull() & F.col(value).isNotNull())
    boxes = quantiles_by(narrow, by, value, QUARTILES, ("q25", "q50", "q75"))
    # One small row per category. With few of them, which is checked, they travel to the rows; with
    # many, the join is by key and Spark splits the large categories.
    few = boxes.limit(BROADCAST_GROUPS + 1).collect()
    if len(few) <= BROADCAST_GROUPS:
        boxes = F.broadcast(df.sparkSession.createDataFrame(few, boxes.schema))
    reach = (F.col("q75") - F.col("q25")) * 1.5
    low, high = F.col("q25") - reach, F.col("q75") + reach
    v = F.col(value)
    inside = (v >= low) & (v <= high)
    return (
        narrow.join(boxes, by)
        .groupBy(by, "q25", "q50", "q75")
        .agg(
            F.count(F.lit(1)).alias("n_rows"),
            F.least(F.min(F.when(inside, v)), F.col("q25")).alias("whisker_low"),
            F.greatest(F.max(F.when(inside, v)), F.col("q75")).alias("whisker_high"),
            F.count_if(~inside).alias("n_outliers"),
        )
    )


def geo_grid(df: DataFrame, lon: str, lat: str, size: str, value: str, step: float = 0.5) -> DataFrame:
    """Map cells of ``step`` degrees: rows, summed size, mean value."""
    require_columns(df, [lon, lat, size, value])
    if step <= 0:
        raise ValueError("step must be positive")
    place = [F.floor(_number(c) / F.lit(step)).alias(n) for c, n in ((lon, "cell_lon"), (lat, "cell_lat"))]
    return (
        df.filter(_number(lon).isNotNull() & _number(lat).isNotNull())
        .groupBy(*place)
        .agg(
            F.count(F.lit(1)).alias("n_rows"),
            F.sum(_number(size)).alias("total_size"),
            F.avg(_number(value)).alias("mean_value"),
        )
    )
