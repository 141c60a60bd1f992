import numpy as np
import pytest
from pyspark.sql import functions as F

from acreline.operators import profile

GAPS = [(1.0, "a", 2.0), (1.0, "a", 2.0), (None, "b", 3.0), (4.0, None, 5.0), (1.0, "a", 2.0)]
SCHEMA = "x double, s string, y double"


def test_structure_nulls_and_duplicates(rows):
    df = rows(GAPS, SCHEMA)
    assert [tuple(r) for r in profile.structure(df).collect()] == [
        ("x", "double", 4, 5), ("s", "string", 4, 5), ("y", "double", 5, 5),
    ]
    assert {tuple(r) for r in profile.null_counts(df).collect()} == {("x", 1), ("s", 1)}
    assert tuple(profile.duplicate_rows(df).first()) == (5, 3, 2)
    assert tuple(profile.duplicate_rows(df.limit(0)).first()) == (0, 0, 0)
    assert [r["y"] for r in profile.head(df, ["y"], 2).collect()] == [2.0, 2.0]


def test_top_values_break_ties_by_value(rows):
    df = rows([(v,) for v in [3, 3, 1, 1, 2, None, None, None]], "x int")
    assert [tuple(r) for r in profile.top_values(df, "x", 2).collect()] == [(1, 2), (3, 2)]


def test_cap_profile(rows):
    df = rows([(v,) for v in [1.0, 9.0, 9.0, None]], "x double")
    assert tuple(profile.cap_profile(df, "x").first()) == (9.0, 2, 4, 50.0)
    assert tuple(profile.cap_profile(df.filter("x IS NULL"), "x").first()) == (None, 0, 1, 0.0)


def test_describe_agrees_with_numpy(rows):
    values = list(np.random.default_rng(1).normal(size=501))
    df = rows([(float(v), None) for v in values], "x double, y double")
    exact = {r["column"]: r for r in profile.describe(df, ["x", "y"]).collect()}
    assert exact["x"]["n_rows"] == 501 and exact["x"]["std"] == pytest.approx(np.std(values, ddof=1))
    assert [exact["x"][q] for q in ("q25", "q50", "q75")] == pytest.approx(list(np.quantile(values, [0.25, 0.5, 0.75])))
    assert exact["y"]["n_rows"] == 0 and exact["y"]["q50"] is None
    close = profile.approx_describe(df, ["x"]).first()
    assert close["q50"] == pytest.approx(exact["x"]["q50"], abs=0.05) and close["mean"] == pytest.approx(exact["x"]["mean"])


def test_histogram_keeps_every_row(rows):
    values = [0.0, 0.1, 5.0, 9.99, 10.0, None]
    df = rows([(v, 3.0, None) for v in values], "x double, c double, n double")
    got = profile.histogram(df, ["x", "c", "n"], 10).collect()
    assert {r["bin"]: r["n_rows"] for r in got if r["column"] == "x"} == {0: 2, 5: 1, 9: 2}
    assert [(r["bin"], r["n_rows"]) for r in got if r["column"] == "c"] == [(0, 6)]
    assert not [r for r in got if r["column"] == "n"]


def test_auto_histogram_follows_the_finer_rule(rows):
    values = list(np.random.default_rng(2).exponential(size=1000))
    df = rows([(float(v),) for v in values], "x double")
    bins, low, high = profile.auto_bins(df, "x")
    span = max(values) - min(values)
    q25, q75 = np.quantile(values, [0.25, 0.75])
    want = np.ceil(span / min(span / (np.log2(1000) + 1), 2 * (q75 - q25) / 1000 ** (1 / 3)))
    assert (bins, low, high) == (want, min(values), max(values))
    assert profile.histogram_auto(df, "x").agg(F.sum("n_rows")).first()[0] == 1000


def test_density_is_close_to_the_unbinned_one(rows):
    values = np.random.default_rng(3).normal(size=400)
    df = rows([(float(v),) for v in values], "x double")
    got = sorted(profile.density_curve(df, "x", points=50).collect(), key=lambda r: r["point"])
    band = values.std(ddof=1) * 400 ** (-0.2)
    grid = np.linspace(values.min(), values.max(), 50)
    want = [np.exp(-0.5 * ((g - values) / band) ** 2).sum() / (400 * band * np.sqrt(2 * np.pi)) for g in grid]
    np.testing.assert_allclose([r["density"] for r in got], want, rtol=1e-11)


def test_densities_with_far_rows_and_gaps(rows):
    values = np.concatenate([np.random.default_rng(3).normal(size=300), [1e4, np.nan, np.inf]])
    df = rows([(float(v), float(i)) for i, v in enumerate(values)], "x double, y double")
    got = profile.density_curves(df, ["x", "y"], points=40).collect()
    for name, v in (("x", values[np.isfinite(values)]), ("y", np.arange(303.0))):
        band = v.std(ddof=1) * len(v) ** (-0.2)
        want = [np.exp(-0.5 * ((g - v) / band) ** 2).sum() / (len(v) * band * np.sqrt(2 * np.pi)) for g in np.linspace(v.min(), v.max(), 40)]
        mine = [r["density"] for r in sorted(got, key=lambda r: r["point"]) if r["column"] == name]
        np.testing.assert_allclose(mine, want, rtol=1e-10, atol=1e-16)


ODD = [*[(float(i % 40), "a", 1.0 + i % 7) for i in range(400)], *[(float("nan"), "a", 2.0)] * 20, *[(float("inf"), "a", float("-inf"))] * 3]


def test_nan_and_infinity_are_missing_everywhere(rows):
    df, plain = rows(ODD, "x double, s string, y double"), rows(ODD[:400], "x double, s string, y double")
    same = lambda f: sorted(map(tuple, f(df).collect())) == sorted(map(tuple, f(plain).collect()))
    assert same(lambda d: profile.histogram(d, ["x"], 8)) and same(lambda d: profile.histogram_auto(d, "x"))
    assert same(lambda d: profile.density_curve(d, "x", 9)) and same(lambda d: profile.box_stats(d, "s", "x"))
    assert same(lambda d: profile.describe(d, ["x"]))
    assert tuple(profile.cap_profile(df, "x").first())[:2] == (39.0, 10)
    assert sum(r["n_rows"] for r in profile.geo_grid(df, "x", "y", "y", "x").collect()) == 400
    assert [r["r"] for r in profile.correlations(df.withColumn("z", F.col("x") * 2), ["x", "z"]).collect()] == pytest.approx([1.0] * 4)


def test_correlations_take_one_scan_and_lose_no_digits(spark):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(3000, 4)) @ rng.normal(size=(4, 4)) + [0, 1e9, -1e7, 5]
    x[rng.random(x.shape) < 0.1] = np.nan
    scanned = spark.sparkContext.accumulator(0)

    def seen(batches):
        for batch in batches:
            scanned.add(batch.num_rows)
            yield batch

    schema = "a double, b double, c double, d double"
    df = spark.createDataFrame(x.tolist(), schema).repartition(13).mapInArrow(seen, schema)
    got = {(r["column_a"], r["column_b"]): r["r"] for r in profile.correlations(df, list("abcd")).collect()}
    assert scanned.value == 3000
    for i, a in enumerate("abcd"):
        for j, b in enumerate("abcd"):
            both = ~np.isnan(x[:, i]) & ~np.isnan(x[:, j])
            u, v = x[both, i] - x[both, i].mean(), x[both, j] - x[both, j].mean()
            assert got[a, b] == pytest.approx((u @ v) / np.sqrt((u @ u) * (v @ v)), rel=1e-6)


def test_shares_go_through_no_single_task(rows):
    plan = profile.category_share(rows(GAPS, SCHEMA), "s")._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan

def test_counts_of_values(rows):
    df = rows(GAPS, SCHEMA).withColumn("z", F.lit(None).cast("double"))
    want = {"x": 2, "s": 2, "y": 3, "z": 0}
    assert {r["column"]: r["n_distinct"] for r in profile.cardinality(df, list(want)).collect()} == want
    assert {r["column"]: r["n_distinct"] for r in profile.cardinality(df, list(want), exact=False).collect()} == want
    assert [tuple(r) for r in profile.category_share(df, "s").collect()] == [("a", 3, 60.0), ("b", 1, 20.0)]


def test_correlations_use_pairwise_complete_rows(rows):
    values = [(1.0, 2.0, 7.0), (2.0, None, 7.0), (3.0, 1.0, 7.0), (4.0, 9.0, 7.0)]
    df = rows(values, "a double, b double, c double")
    got = {(r["column_a"], r["column_b"]): r["r"] for r in profile.correlations(df, list("abc")).collect()}
    assert len(got) == 9 and got[("a", "a")] == 1.0 and got[("c", "c")] is None and got[("a", "c")] is None
    assert got[("a", "b")] == got[("b", "a")] == pytest.approx(np.corrcoef([1, 3, 4], [2, 1, 9])[0, 1])


@pytest.mark.parametrize("groups", [10_000, 1])
def test_box_numbers(rows, monkeypatch, groups):
    monkeypatch.setattr(profile, "BROADCAST_GROUPS", groups)
    values = [("a", float(v)) for v in [1, 2, 3, 4, 5, 100]] + [("b", 7.0), ("b", None), (None, 1.0)]
    got = {r["k"]: r for r in profile.box_stats(rows(values, "k string, v double"), "k", "v").collect()}
    q25, q75 = np.quantile([1, 2, 3, 4, 5, 100], [0.25, 0.75])
    assert (got["a"]["q25"], got["a"]["q75"]) == (q25, q75)
    assert (got["a"]["whisker_low"], got["a"]["whisker_high"], got["a"]["n_outliers"], got["a"]["n_rows"]) == (1.0, 5.0, 1, 6)
    assert (got["b"]["whisker_low"], got["b"]["whisker_high"], got["b"]["n_rows"]) == (7.0, 7.0, 1)


def test_grid(rows):
    df = rows([(0.1, 0.1, 1.0, 10.0), (0.4, 0.2, 2.0, 20.0), (-0.1, 0.0, 5.0, 1.0)], "x double, y double, p double, v double")
    got = {(r["cell_lon"], r["cell_lat"]): (r["n_rows"], r["total_size"], r["mean_value"]) for r in profile.geo_grid(df, "x", "y", "p", "v").collect()}
    assert got == {(0, 0): (2, 3.0, 15.0), (-1, 0): (1, 5.0, 1.0)}


def test_describe_skips_nan_and_infinity(rows):
    from acreline.operators import profile

    df = rows([(1.0,), (2.0,), (3.0,), (float("nan"),), (float("inf"),), (None,)], "v double")
    r = profile.describe(df, ["v"]).first()
    assert (r.n_rows, r.mean, r.min, r.q50, r.max) == (3, 2.0, 1.0, 2.0, 3.0)


def test_counts_of_pairs_keep_every_known_pair(rows):
    df = rows([(0.0, 0.0, None), (10.0, 1.0, 5.0), (10.0, None, 5.0), (float("nan"), 1.0, 5.0), (5.0, 0.5, 5.0)], "a double, b double, c double")
    got = {tuple(r)[:4]: r["n_rows"] for r in profile.pair_counts(df, ["a", "b", "c"], 2).collect()}
    assert got == {
        ("a", "b", 0, 0): 1, ("a", "b", 1, 1): 2, ("a", "c", 1, 0): 3, ("b", "c", 1, 0): 3,
    }
    assert profile.pair_counts(df.limit(0), ["a", "b"], 2).count() == 0
