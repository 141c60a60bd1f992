"""Exact quantiles, modes and vocabularies that never gather a whole column in one place.

``percentile``/``median``/``mode`` keep one counter per distinct value and merge all counters in a
single task, which ends somewhere between 10^7 and 10^8 distinct doubles. Here a mergeable sketch
first brackets the wanted order statistic, a counting pass fixes its rank inside the bracket, and
only the few values strictly inside the bracket are looked at exactly. The result is the exact
quantile (linear interpolation between neighbours) at any table size; each pass is a scan with a
map-side aggregation of a handful of numbers.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from acreline.functions.expressions import finite
from acreline.session import ensure_checkpoint_dir

INTERIOR_LIMIT = 1_000_000
#: Values inside a bracket that are put in order at most; a wider bracket is narrowed first.
INNER_LIMIT = 200_000
#: Size parameter of the sketches (some 25 KB each, ranks right to about 0.3 %): a reduce task merges one of every partition
#: and column. Two ranks in ``ACCURACY`` are the least reach of a bracket beyond the wanted rank, which counting verifies.
SKETCH_SIZE, ACCURACY = 1_000, 400


@dataclass
class _Search:
    """One wanted order statistic (0-based rank) of one column and the bracket around it."""

    column: str
    rank: int
    low: float
    high: float
    found: float | None = None
    inner_rank: int = 0
    inner_rows: int = 0


@dataclass
class Quantiles:
    """Exact quantiles per column, row counts, and whatever else was aggregated on the way. ``neighbours`` has the two
    values around each quantile of the columns that were searched (not of those that the built-in function solved)."""

    values: dict[str, list[float]]
    counts: dict[str, int]
    extra: dict[str, Any] = field(default_factory=dict)
    neighbours: dict[str, list[tuple[float, float]]] = field(default_factory=dict)


def _position(count: int, prob: float) -> tuple[int, float]:
    place = (count - 1) * prob
    base = min(int(math.floor(place)), count - 1)
    return base, place - base


def between(count: int, prob: float, low: float, high: float) -> float:
    """The value between two neighbours in the arithmetic of the built-in percentile, so that both ways
    to the neighbours end at the same double."""
    place = (count - 1) * prob
    base, top = math.floor(place), math.ceil(place)
    return low if top == base or low == high else (top - place) * low + (place - base) * high


def _disc(column: str, probs: Sequence[float]) -> Column:
    return F.expr(f"percentile_disc(array({', '.join(f'{p!r}D' for p in probs)})) WITHIN GROUP (ORDER BY {column})")


def _ranks(value: Column, shares: Sequence[float]) -> Column:
    """Values near the given ranks (shares of 1), off a mergeable sketch; missing without values."""
    sketch = F.kll_sketch_agg_double(value, SKETCH_SIZE)
    return F.when(F.count(value) > 0, F.kll_sketch_get_quantile_double(sketch, F.array(*[F.lit(float(p)) for p in shares])))


def _sketch(frame: DataFrame, names: Sequence[str], probs: Sequence[float], accuracy: int, extra: Mapping[str, Column]) -> Row:
    slack = 2.0 / min(accuracy, ACCURACY)
    ends = [p for prob in probs for p in (max(prob - slack, 0.0), min(prob + slack, 1.0))]
    aggs = [c.alias(f"x_{k}") for k, c in extra.items()]
    for i, name in enumerate(names):
        value = F.col(name)
        aggs += [
            F.count(value).alias(f"n_{i}"),
            F.min(value).alias(f"lo_{i}"),
            F.max(value).alias(f"hi_{i}"),
            _ranks(value, ends).alias(f"q_{i}"),
        ]
    return frame.agg(*aggs).first()


def exact_quantiles(
    df: DataFrame,
    columns: Mapping[str, Column],
    probs: Sequence[float] = (0.5,),
    extra: Mapping[str, Column] | None = None,
    interior_limit: int = INTERIOR_LIMIT,
    accuracy: int = ACCURACY,
    known_rows: int | None = None,
) -> Quantiles:
    """Exact ``probs`` quantiles of every expression in ``columns``; missing values, NaN and infinities
    are skipped. ``interior_limit`` only chooses the way, never the result.

    ``extra`` aggregates of the same frame ride along in the first pass, or in the counting pass of a
    frame known to be large: that pass is plain sums, which cost several times less there than beside
    sketches. A column without any value has count 0 and no quantiles. ``known_rows``, when the caller
    has counted already, saves the sketch pass on frames that need none.
    """
    extra = extra or {}
    if not columns:
        row = df.agg(*[c.alias(k) for k, c in extra.items()]).first() if extra else None
        return Quantiles({}, {}, row.asDict() if row else {})
    names = list(columns)
    tagged = {name: f"__v{i}" for i, name in enumerate(names)}
    frame = df.withColumns({tagged[n]: finite(columns[n].cast("double")) for n in names})
    if known_rows is not None and known_rows <= interior_limit:
        row = frame.agg(
            *[c.alias(f"x_{k}") for k, c in extra.items()],
            *[F.count(tagged[n]).alias(f"n_{tagged[n]}") for n in names],
            *[F.percentile(F.col(tagged[n]), list(probs)).alias(tagged[n]) for n in names],
        ).first()
        return Quantiles(
            {n: list(row[tagged[n]] or []) for n in names},
            {n: row[f"n_{tagged[n]}"] for n in names},
            {k: row[f"x_{k}"] for k in extra},
        )
    late = extra if known_rows is not None else {}
    riding = [c.alias(f"x_{k}") for k, c in late.items()]
    first = _sketch(frame, [tagged[n] for n in names], probs, accuracy, {} if late else extra)
    counts = {n: first[f"n_{i}"] for i, n in enumerate(names)}
    result = Quantiles(
        {n: [] for n in names}, counts, {k: first[f"x_{k}"] for k in extra if k not in late}
    )
    full = [n for n in names if counts[n]]
    if not full or max(counts.values()) <= interior_limit:
        aggs = riding + [F.percentile(F.col(tagged[n]), list(probs)).alias(tagged[n]) for n in full]
        if aggs:
            exact = frame.agg(*aggs).first()
            result.values.update({n: list(exact[tagged[n]]) for n in full})
            result.extra.update({k: exact[f"x_{k}"] for k in late})
        return result

    wanted: dict[tuple[str, int], _Search] = {}
    for i, name in enumerate(names):
        if not counts[name]:
            continue
        for j, prob in enumerate(probs):
            base, part = _position(counts[name], prob)
            for rank in {base, base + 1 if part else base}:
                wanted[(name, rank)] = _Search(
                    tagged[name], rank, first[f"q_{i}"][2 * j], first[f"q_{i}"][2 * j + 1]
                )
    bounds = {tagged[n]: (first[f"lo_{i}"], first[f"hi_{i}"]) for i, n in enumerate(names)}
    row = _settle(frame, list(wanted.values()), bounds, interior_limit, accuracy, riding)
    result.extra.update({k: row[f"x_{k}"] for k in late})
    for name in full:
        for prob in probs:
            base, part = _position(counts[name], prob)
            low = wanted[(name, base)].found
            high = wanted[(name, base + 1)].found if part else low
            result.neighbours.setdefault(name, []).append((low, high))
            result.values[name].append(between(counts[name], prob, low, high))
    return result


def _settle(
    frame: DataFrame,
    open_searches: list[_Search],
    bounds: Mapping[str, tuple[float, float]],
    interior_limit: int,
    accuracy: int,
    riding: Sequence[Column] = (),
) -> Row:
    """Find every wanted value; returns the row of the first counting pass, which has the ``riding`` aggregates."""
    first = None
    while open_searches:
        row = _place(frame, open_searches, bounds, () if first else riding)
        first = first or row
        open_searches = [s for s in open_searches if s.found is None]
        ready = [s for s in open_searches if s.inner_rows <= min(interior_limit, INNER_LIMIT)]
        wide = [s for s in open_searches if s.inner_rows > min(interior_limit, INNER_LIMIT)]
        aggs = []
        # neighbours share a bracket, whose values are put in order once
        brackets: dict[tuple, list[_Search]] = {}
        for s in ready:
            brackets.setdefault((s.column, s.low, s.high), []).append(s)
        for i, same in enumerate(brackets.values()):
            # (rank + 1/2) / rows hits exactly this rank and is safe from rounding.
            aggs.append(_disc(f"__in{i}", [(s.inner_rank + 0.5) / s.inner_rows for s in same]).alias(f"r{i}"))
        slack = 2.0 / min(accuracy, ACCURACY)
        for i, s in enumerate(wide):
            middle = (s.inner_rank + 0.5) / s.inner_rows
            ends = [max(middle - slack, 0.0), min(middle + slack, 1.0)]
            inside = F.when(_inside(s), F.col(s.column))
            aggs.append(_ranks(inside, ends).alias(f"w{i}"))
        if aggs:
            row = frame.withColumns({f"__in{i}": F.when(_inside(same[0]), F.col(same[0].column)) for i, same in enumerate(brackets.values())}).agg(*aggs).first()
            for i, same in enumerate(brackets.values()):
                for s, found in zip(same, row[f"r{i}"]):
                    s.found = found
            for i, s in enumerate(wide):
                s.low, s.high = row[f"w{i}"]
        open_searches = wide
    return first


def _inside(s: _Search) -> Column:
    return (F.col(s.column) > F.lit(s.low)) & (F.col(s.column) < F.lit(s.high))


def _place(
    frame: DataFrame, searches: list[_Search], bounds: Mapping[str, tuple[float, float]], riding: Sequence[Column] = ()
) -> Row:
    """Count the rows below, at and inside each bracket and fix the rank within it."""
    aggs = list(riding)
    for i, s in enumerate(searches):
        value = F.col(s.column)
        aggs += [
            F.count_if(value < F.lit(s.low)).alias(f"b{i}"),
            F.count_if(value == F.lit(s.low)).alias(f"l{i}"),
            F.count_if(_inside(s)).alias(f"i{i}"),
            F.count_if(value == F.lit(s.high)).alias(f"h{i}"),
        ]
    row = frame.agg(*aggs).first()
    again = []
    for i, s in enumerate(searches):
        below, at_low, inside = row[f"b{i}"], row[f"l{i}"], row[f"i{i}"]
        at_high = row[f"h{i}"] if s.high > s.low else 0
        if s.rank < below or s.rank >= below + at_low + inside + at_high:
            # The sketch missed: fall back to the whole range, which always holds the rank.
            s.low, s.high = bounds[s.column]
            again.append(s)
        elif s.rank < below + at_low:
            s.found = s.low
        elif s.rank >= below + at_low + inside:
            s.found = s.high
        else:
            s.inner_rank, s.inner_rows = s.rank - below - at_low, inside
    if again:
        _place(frame, again, bounds)
    return row


def value_counts(df: DataFrame, columns: Mapping[str, Column], type_name: str) -> DataFrame:
    """(column, value, n) of several columns in one shuffle; equal values combine before it."""
    cells = F.array(
        *[
            F.struct(F.lit(name).alias("column"), c.cast(type_name).alias("value"))
            for name, c in columns.items()
        ]
    )
    return (
        df.select(F.inline(cells))
        .filter(F.col("value").isNotNull())
        .groupBy("column", "value")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def modes(df: DataFrame, columns: Mapping[str, Column], type_name: str) -> dict[str, Any]:
    """Most frequent value per column, the smallest one on a tie; columns without values are absent."""
    if not columns:
        return {}
    best = (
        value_counts(df, columns, type_name)
        .groupBy("column")
        .agg(F.min_by("value", F.struct(-F.col("n"), F.col("value"))).alias("mode"))
    )
    return {row["column"]: row["mode"] for row in best.collect()}


def categories(df: DataFrame, columns: Mapping[str, Column], max_size: int = 1_000) -> dict[str, dict[str, int]]:
    """Rows per value of each text column, values sorted; all columns in one shuffle.

    A column per value follows, so a column with more than ``max_size`` values is an error. The
    check comes before anything is collected.
    """
    if not columns:
        return {}
    counts = value_counts(df, columns, "string")
    rows = counts.limit(max_size * len(columns) + 1).collect()
    found: dict[str, dict[str, int]] = {name: {} for name in columns}
    for row in sorted(rows, key=lambda r: r["value"]):
        found[row["column"]][row["value"]] = row["n"]
    large = [name for name, words in found.items() if len(words) > max_size]
    if large:
        raise ValueError(f"more than {max_size} categories in {large}: a column per category is no use here")
    return found


def distinct_values(df: DataFrame, value: Column, name: str = "category") -> DataFrame:
    """The distinct values as rows, however many there are; nothing is collected."""
    return df.select(value.alias(name)).filter(F.col(name).isNotNull()).distinct()


def vocabulary(df: DataFrame, column: str | Column, max_size: int = 1_000) -> list[str]:
    """Sorted distinct values of one text column."""
    value = F.col(column) if isinstance(column, str) else column
    return list(categories(df, {"value": value}, max_size)["value"])


# --- per group -----------------------------------------------------------------------------------

#: Size parameter of a group's sketch (8 KB, ranks right to about 0.7 %), steps its quantiles are read off at, and how far
#: beyond the wanted rank a bracket reaches. A wrong bracket is noticed by counting and costs a pass, never a result.
SKETCH, GRID, REACH = 400, 200, 0.01
#: Groups whose brackets (a few numbers each) are broadcast; above, they are joined by key.
SENT_GROUPS = 20_000
#: Rows of one bracket that are put in order in a task.
ORDERED = 20_000


def _grid(value: Column) -> Column:
    """GRID + 1 quantiles of a group, from its sketch; empty without rows."""
    sketch = F.kll_sketch_agg_double(value, SKETCH)
    steps = F.array(*[F.lit(i / GRID) for i in range(GRID + 1)])
    return F.when(F.count(value) > 0, F.kll_sketch_get_quantile_double(sketch, steps))


def _bracket(grid: str, middle: Column, low: Column, high: Column) -> tuple[Column, Column]:
    """Ends around the rank ``middle`` (a share); at the edge those of the whole range."""
    first, last = F.floor((middle - REACH) * GRID), F.ceil((middle + REACH) * GRID)
    at = lambda i: F.element_at(grid, (F.greatest(F.least(i, F.lit(GRID)), F.lit(0)) + 1).cast("int"))
    return F.when(first < 0, low).otherwise(at(first)), F.when(last > GRID, high).otherwise(at(last))


def _hot_quantiles(rows: DataFrame, groups: DataFrame, probs: Sequence[float], names: Sequence[str], ordered: int) -> DataFrame:
    """(k, names...) of ``groups(k, n, few)`` from ``rows(k, v)``.

    All groups go through the same passes, each a map-side aggregation by group: a sketch brackets every wanted rank,
    a count fixes its place there, and so on inside the brackets, until at most ``ordered`` rows are left in each, which
    are put in order. The passes grow with the logarithm of the largest group, not with the number of groups; nothing
    but one number a pass reaches the driver.
    """
    ensure_checkpoint_dir(rows.sparkSession)
    searches = range(2 * len(probs))
    few = groups.count() <= SENT_GROUPS

    def with_state(state: DataFrame) -> DataFrame:
        """The rows of the groups, with their brackets."""
        return rows.join(F.broadcast(state) if few else state, "k")

    def open_(i: int) -> Column:
        return F.col(f"found{i}").isNull()

    def within(i: int) -> Column:
        return F.when(open_(i) & (F.col("v") > F.col(f"lo{i}")) & (F.col("v") < F.col(f"hi{i}")), F.col("v"))

    hot = rows.join(F.broadcast(groups.select("k")) if few else groups.select("k"), "k", "left_semi")
    state = hot.groupBy("k").agg(F.count("v").alias("n"), F.min("v").alias("low"), F.max("v").alias("high"), _grid(F.col("v")).alias("grid"))
    columns = {}
    for i in searches:
        place = (F.col("n") - 1) * F.lit(float(probs[i // 2]))
        base = F.least(F.floor(place), F.col("n") - 1)
        rank = base if i % 2 == 0 else F.when(place > base, base + 1).otherwise(base)
        lo, hi = _bracket("grid", (rank + 0.5) / F.col("n"), F.col("low"), F.col("high"))
        none = F.lit(None)
        columns |= {f"rank{i}": rank, f"lo{i}": lo, f"hi{i}": hi, f"found{i}": none.cast("double"), f"inner{i}": none.cast("bigint"), f"rows{i}": none.cast("bigint")}
    state = state.withColumns(columns).drop("grid").checkpoint()
    while True:
        counts = []
        for i in searches:
            v, lo, hi = F.col("v"), F.col(f"lo{i}"), F.col(f"hi{i}")
            counts += [F.count_if(open_(i) & (v < lo)).alias(f"b{i}"), F.count_if(open_(i) & (v == lo)).alias(f"l{i}")]
            counts += [F.count(within(i)).alias(f"i{i}"), F.count_if(open_(i) & (v == hi) & (hi > lo)).alias(f"h{i}")]
        counted = with_state(state).groupBy("k").agg(*counts)
        columns = {}
        for i in searches:
            rank, below, low, inside, high = (F.col(f"{c}{i}") for c in ("rank", "b", "l", "i", "h"))
            missed = (rank < below) | (rank >= below + low + inside + high)
            found = F.when(missed, None).when(rank < below + low, F.col(f"lo{i}")).when(rank >= below + low + inside, F.col(f"hi{i}"))
            columns |= {
                f"found{i}": F.coalesce(f"found{i}", found),
                f"inner{i}": rank - below - low,
                # a missed bracket counts as far too wide: it starts again from the whole range
                f"rows{i}": F.when(open_(i), F.when(missed, F.lit(1 << 62)).otherwise(inside)),
                f"miss{i}": open_(i) & missed,
            }
        kept = [c for c in state.columns if c.rstrip("0123456789") in ("k", "n", "low", "high", "rank", "lo", "hi")]
        state = state.join(counted, "k").select(*kept, *[c.alias(n) for n, c in columns.items()]).checkpoint()
        missing = F.lit(0)
        for i in searches:
            missing = F.greatest(missing, F.when(open_(i), F.col(f"rows{i}")).otherwise(0))
        if state.agg(F.max(missing)).first()[0] <= ordered:
            break
        for i in searches:
            whole = F.col(f"miss{i}")
            state = state.withColumns({f"lo{i}": F.when(whole, F.col("low")).otherwise(F.col(f"lo{i}")), f"hi{i}": F.when(whole, F.col("high")).otherwise(F.col(f"hi{i}"))})
        grids = with_state(state).groupBy("k").agg(*[_grid(within(i)).alias(f"grid{i}") for i in searches])
        narrowed = state.join(grids, "k")
        for i in searches:
            wide = open_(i) & ~F.col(f"miss{i}") & (F.col(f"rows{i}") > ordered)
            lo, hi = _bracket(f"grid{i}", (F.col(f"inner{i}") + 0.5) / F.col(f"rows{i}"), F.col(f"lo{i}"), F.col(f"hi{i}"))
            narrowed = narrowed.withColumns({f"lo{i}": F.when(wide, lo).otherwise(F.col(f"lo{i}")), f"hi{i}": F.when(wide, hi).otherwise(F.col(f"hi{i}"))})
        state = narrowed.select(*[c for c in state.columns if not c.startswith(("miss", "inner", "rows"))]).checkpoint()
    last = with_state(state).groupBy("k").agg(*[F.array_sort(F.collect_list(within(i))).alias(f"in{i}") for i in searches])
    solved = state.join(last, "k")
    value = [F.coalesce(f"found{i}", F.try_element_at(f"in{i}", (F.col(f"inner{i}") + 1).cast("int"))) for i in searches]
    results = []
    for j, prob in enumerate(probs):
        # the arithmetic of ``between``
        place = (F.col("n") - 1) * F.lit(float(prob))
        low, high = value[2 * j], value[2 * j + 1]
        results.append(F.when((F.ceil(place) == F.floor(place)) | (low == high), low).otherwise((F.ceil(place) - place) * low + (place - F.floor(place)) * high))
    return solved.select("k", *[c.alias(n) for c, n in zip(results, names)])


def quantiles_by(
    df: DataFrame,
    by: str,
    value: str,
    probs: Sequence[float],
    names: Sequence[str],
    interior_limit: int = INTERIOR_LIMIT,
    ordered: int = ORDERED,
) -> DataFrame:
    """Exact quantiles per group as columns ``names``; groups of any size, any number of groups.

    Groups small enough for one task use the built-in percentile. Groups above ``interior_limit`` rows are solved
    together by ``_hot_quantiles``, to the same double.
    """
    known = df.select(F.col(by).alias("k"), finite(F.col(value).cast("double")).alias("v")).filter("k IS NOT NULL AND v IS NOT NULL")
    large = known.groupBy("k").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > interior_limit).persist()
    some = not large.isEmpty()
    cold = (known.join(large, "k", "left_anti") if some else known).groupBy("k").agg(F.percentile("v", list(probs)).alias("q"))
    cold = cold.select("k", *[F.col("q")[i].alias(n) for i, n in enumerate(names)])
    both = cold.unionByName(_hot_quantiles(known, large, probs, names, ordered)) if some else cold
    return both.withColumnRenamed("k", by)
