import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from acreline.operators.quantiles import exact_quantiles, modes, quantiles_by, vocabulary

PROBS = (0.0, 0.1, 0.25, 0.5, 0.75, 0.9, 1.0)


def data(kind, n=3001):
    rng = random.Random(5)
    if kind == "normal":
        return [rng.gauss(0, 10) for _ in range(n)]
    if kind == "ties":  # a third of all rows is one value
        return [7.0 if i % 3 == 0 else float(rng.randrange(20)) for i in range(n)]
    if kind == "steep":
        return [10.0 ** rng.uniform(-30, 30) * rng.choice([-1, 1]) for _ in range(n)]
    return [4.0] * n


@pytest.mark.parametrize("kind", ["normal", "ties", "steep", "constant"])
@pytest.mark.parametrize("limit, accuracy", [(10_000_000, 10_000), (40, 20)])
def test_quantiles_are_exact_however_small_the_bracket(rows, kind, limit, accuracy):
    values = data(kind)
    df = rows([(v,) for v in values] + [(None,)] * 5, "x double")
    found = exact_quantiles(df, {"x": F.col("x")}, PROBS, interior_limit=limit, accuracy=accuracy)
    assert found.counts == {"x": len(values)}
    assert found.values["x"] == pytest.approx(list(np.quantile(values, PROBS)), rel=1e-12)


def test_several_columns_and_riding_aggregates(rows):
    df = rows([(float(i), float(i % 7), None) for i in range(100)], "a double, b double, c double")
    columns = {c: F.col(c) for c in "abc"}
    for known in (None, 100):
        found = exact_quantiles(df, columns, (0.5,), {"top": F.max("a")}, known_rows=known)
        assert found.values == {"a": [49.5], "b": [3.0], "c": []}
        assert found.extra == {"top": 99.0}


def test_a_wide_bracket_is_narrowed_before_its_values_are_put_in_order(spark, monkeypatch):
    from acreline.operators import quantiles

    v = F.pmod(F.xxhash64("id"), F.lit(1_000_003)) / 7.0
    df = spark.range(60_000, numPartitions=30).select(v.alias("a"), (-v * v).alias("b"), F.when(F.col("id") % 3 != 0, 2.5).otherwise(v).alias("c"))
    want = df.agg(*[F.percentile(c, [0.25, 0.5, 0.9]).alias(c) for c in "abc"]).first()
    ordered, disc = [], quantiles._disc
    monkeypatch.setattr(quantiles, "INNER_LIMIT", 100)
    monkeypatch.setattr(quantiles, "_disc", lambda column, probs: ordered.extend(probs) or disc(column, probs))
    found = exact_quantiles(df, {c: F.col(c) for c in "abc"}, (0.25, 0.5, 0.9), interior_limit=50_000)
    assert found.values == {c: list(want[c]) for c in "abc"}
    # the lowest share of n values in order is 1 / (2 n)
    assert ordered and min(min(p, 1 - p) for p in ordered) >= 0.5 / 100


def test_a_missed_bracket_is_widened(rows):
    from acreline.operators import quantiles

    values = data("normal", 500)
    frame = rows([(v,) for v in values], "x double")
    wrong = quantiles._Search("x", 250, 1e6, 2e6)
    quantiles._settle(frame, [wrong], {"x": (min(values), max(values))}, 20, 50)
    assert wrong.found == sorted(values)[250]


@pytest.mark.parametrize("limit", [10_000, 100])
def test_grouped_quantiles_with_a_hot_group(rows, limit):
    rng = random.Random(2)
    values = [("hot" if i % 3 == 0 else f"k{i % 40}", rng.gauss(0, 1)) for i in range(2000)]
    df = rows(values + [("hot", None), (None, 1.0)], "k string, v double")
    got = {r["k"]: r["m"] for r in quantiles_by(df, "k", "v", (0.5,), ("m",), limit, 50).collect()}
    want = {k: float(np.median([v for g, v in values if g == k])) for k in {g for g, _ in values}}
    assert got == pytest.approx(want)


def test_many_hot_groups_to_the_last_bit_in_a_fixed_number_of_jobs(spark, monkeypatch):
    from acreline.operators import quantiles

    v = F.when(F.col("id") % 11 == 0, 3.0).otherwise(F.pmod(F.xxhash64("id"), F.lit(100_000)) / 7.0)
    df = spark.range(120_000).select((F.col("id") % 60).alias("k"), F.when(F.col("id") % 60 == 7, 1.5).otherwise(v).alias("v"))
    probs, names = (0.0, 0.25, 0.5, 0.9, 1.0), ("a", "b", "c", "d", "e")
    want = {r["k"]: r["q"] for r in df.groupBy("k").agg(F.percentile("v", list(probs)).alias("q")).collect()}

    def jobs(groups, **settings):
        before = len(spark.sparkContext.statusTracker().getJobIdsForGroup(None))
        got = {r["k"]: list(r)[1:] for r in quantiles_by(df.filter(F.col("k") < groups), "k", "v", probs, names, 10, **settings).collect()}
        assert got == {k: q for k, q in want.items() if k < groups}
        return len(spark.sparkContext.statusTracker().getJobIdsForGroup(None)) - before

    counts = [jobs(groups, ordered=20) for groups in (3, 60)]
    assert counts[1] <= counts[0] + 12
    monkeypatch.setattr(quantiles, "SENT_GROUPS", 0)
    jobs(60, ordered=20)
    monkeypatch.setattr(quantiles, "REACH", -0.02)  # brackets that miss start again from the whole range
    monkeypatch.setattr(quantiles, "SENT_GROUPS", 100)
    got = {r["k"]: list(r)[1:] for r in quantiles_by(df.filter("k < 2"), "k", "v", probs, names, 10, ordered=5_000).collect()}
    assert got == {k: want[k] for k in (0, 1)}


def test_mode_takes_the_smallest_on_a_tie(rows):
    df = rows([(1.0, "b"), (1.0, "a"), (2.0, "a"), (2.0, "b"), (None, None)], "x double, s string")
    assert modes(df, {"x": F.col("x")}, "double") == {"x": 1.0}
    assert modes(df, {"s": F.col("s")}, "string") == {"s": "a"}


def test_vocabulary_is_sorted_and_bounded(rows):
    df = rows([("b",), ("a",), (None,), ("b",)], "s string")
    assert vocabulary(df, "s") == ["a", "b"]
    with pytest.raises(ValueError):
        vocabulary(df, "s", max_size=1)


def test_nan_and_infinity_are_missing_on_both_ways(spark):
    values = [(float(i * 37 % 101) / 7,) for i in range(400)] + [(float("nan"),)] * 50 + [(float("inf"),)] * 9 + [(float("-inf"),)] * 7
    df = spark.createDataFrame(values, "v double")
    probs = [0.1, 0.25, 0.5, 0.77, 0.9]
    small = exact_quantiles(df, {"v": F.col("v")}, probs)
    large = exact_quantiles(df, {"v": F.col("v")}, probs, interior_limit=10, accuracy=50)
    assert small.counts == large.counts == {"v": 400}
    assert small.values == large.values  # bit for bit
    known = df.filter("v > -1e300 AND v < 1e300").agg(F.percentile("v", probs).alias("q")).first().q
    assert small.values["v"] == known


def test_riding_aggregates_of_a_large_frame_are_counted_not_sketched(spark, monkeypatch):
    from acreline.operators import quantiles

    df = spark.range(1_000).select((F.col("id") * 7.0).alias("v"), F.when(F.col("id") < 0, 1.0).alias("none"))
    extra, sketched, sketch = {"mean": F.avg("v"), "rows": F.count(F.lit(1))}, [], quantiles._sketch
    monkeypatch.setattr(quantiles, "_sketch", lambda *a: sketched.append(a[-1]) or sketch(*a))
    for limit, rows in ((10, 1_000), (10, None), (2_000, 1_000), (2_000, None), (500, 1_000)):
        found = quantiles.exact_quantiles(df, {"v": F.col("v"), "none": F.col("none")}, (0.5,), extra, limit, known_rows=rows)
        assert found.values == {"v": [3496.5], "none": []} and found.extra == {"mean": 3496.5, "rows": 1_000}
        assert not (rows and sketched and sketched.pop())
        sketched.clear()
    found = quantiles.exact_quantiles(df, {"none": F.col("none")}, (0.5,), extra, 10, known_rows=1_000)
    assert found.values == {"none": []} and found.extra == {"mean": 3496.5, "rows": 1_000}
