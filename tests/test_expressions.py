import math

import pytest
from pyspark.sql import functions as F

from acreline.functions import (
    bin_right_closed,
    finite,
    log_plus_one,
    merge_values,
    one_hot,
    rbf_similarity,
    safe_ratio,
    sanitize_name,
    sanitize_names,
    standardize,
)
from acreline.operators.clean import INCOME_EDGES, INCOME_LABELS, clean_capped, normalize_missing

INF, NAN = float("inf"), float("nan")


def column(rows, values, expr):
    df = rows([(i, v) for i, v in enumerate(values)], "i int, x double")
    return [r[0] for r in df.orderBy("i").select(expr(F.col("x"))).collect()]


def test_missing_markers_fall_together(rows):
    assert column(rows, [1.0, NAN, INF, -INF, None, 0.0], finite) == [1.0, None, None, None, None, 0.0]


def test_bins_are_closed_on_the_right(rows):
    got = column(
        rows,
        [-1.0, 0.0, 0.01, 1.5, 1.51, 3.0, 4.5, 6.0, 6.01, 1e9, None, NAN],
        lambda x: bin_right_closed(x, INCOME_EDGES, INCOME_LABELS),
    )
    assert got == [None, None, 1, 1, 2, 2, 3, 4, 5, 5, None, None]


def test_values_above_a_finite_last_edge_have_no_bin(rows):
    assert column(rows, [1.0, 2.0, 2.5, INF], lambda x: bin_right_closed(x, [0.0, 1.0, 2.0], [1, 2])) == [1, 2, None, None]


@pytest.mark.parametrize("edges, labels", [([0.0, 1.0], [1, 2]), ([0.0, 2.0, 1.0], [1, 2])])
def test_bad_bins_are_refused(edges, labels):
    with pytest.raises(ValueError):
        bin_right_closed(F.lit(1.0), edges, labels)


def test_ratio_is_never_infinite(rows):
    df = rows(
        [(1.0, 2.0), (1.0, 0.0), (0.0, 0.0), (NAN, 1.0), (1.0, INF), (1e308, 1e-10), (None, 1.0)], "a double, b double"
    )
    got = [r[0] for r in df.select(safe_ratio(F.col("a"), F.col("b"))).collect()]
    assert got == [0.5, None, None, None, None, None, None]


def test_log_is_missing_at_and_below_minus_one(rows):
    got = column(rows, [0.0, 1.0, -1.0, -2.0, None], log_plus_one)
    assert got[0] == 0.0 and got[1] == pytest.approx(math.log(2)) and got[2:] == [None, None, None]


def test_constant_columns_scale_to_zero(rows):
    assert column(rows, [5.0, 5.0], lambda x: standardize(x, 5.0, 0.0)) == [0.0, 0.0]


def test_merging_is_one_step_and_leaves_the_rest(rows):
    df = rows([("a",), ("b",), ("c",), (None,)], "k string")
    got = [r[0] for r in df.select(merge_values(F.col("k"), {"a": "b", "b": "d"})).collect()]
    assert got == ["b", "d", "c", None]


def test_one_hot_of_unknown_and_missing_is_all_zero(rows):
    df = rows([("a",), ("x",), (None,)], "k string")
    flags = one_hot(F.col("k"), ["a", "b"])
    assert [tuple(r) for r in df.select(*flags.values()).collect()] == [(1.0, 0.0), (0.0, 0.0), (0.0, 0.0)]


def test_one_hot_can_refuse_unknown_values(rows):
    df = rows([("x",)], "k string")
    with pytest.raises(Exception, match="unknown category"):
        df.select(*one_hot(F.col("k"), ["a"], "error").values()).collect()
    with pytest.raises(ValueError):
        one_hot(F.col("k"), ["a"], "guess")


def test_similarity_is_one_at_the_centre(rows):
    df = rows([(1.0, 2.0), (2.0, 2.0)], "x double, y double")
    got = [r[0] for r in df.select(rbf_similarity((F.col("x"), F.col("y")), (1.0, 2.0), 0.5)).collect()]
    assert got == [1.0, pytest.approx(math.exp(-0.5))]


def test_names_keep_letters_digits_and_underscores():
    assert sanitize_name("cat__ocean_proximity_<1H OCEAN") == "cat__ocean_proximity__1H_OCEAN"
    assert sanitize_name("größe") == "gr__e"
    assert sanitize_names(["a b", None, ""]) == ["a_b", "feature_1", "feature_2"]
    with pytest.raises(ValueError):
        sanitize_names(["a b", "a-b"])


def test_cap_is_strict_and_reaches_the_scan(spark, rows, tmp_path):
    values = [(1, 500001.0), (2, 500000.99), (3, None), (4, NAN)]
    df = rows(values, "i int, median_house_value double")
    assert [r["i"] for r in clean_capped(df).collect()] == [2]
    assert clean_capped(df, cap=None).count() == 4
    df.write.parquet(str(tmp_path / "t"))
    plan = clean_capped(spark.read.parquet(str(tmp_path / "t")))._jdf.queryExecution().executedPlan().toString()
    assert "LessThan(median_house_value,500001.0)" in plan


def test_normalizing_leaves_other_types_alone(rows):
    df = rows([(1, NAN, "x")], "i int, d double, s string")
    assert tuple(normalize_missing(df).first()) == (1, None, "x")
