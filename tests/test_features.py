import math
import threading

import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from acreline.errors import DataValidationError
from acreline.operators import impute
from acreline.operators.cluster import fit_centres, max_similarity
from acreline.operators.features import FeatureSpec, TabularFeatures

NAN, INF = float("nan"), float("inf")
DROP = ["district_id", "stratum"]


def fitted(df, spec=None, label="median_house_value"):
    drop = DROP + ([] if label else ["median_house_value"])
    return TabularFeatures(spec=spec or FeatureSpec(), labelCol=label, dropCols=drop).fit(df)


@pytest.fixture(scope="module")
def model(districts):
    return fitted(districts)


@pytest.fixture(scope="module")
def matrix(model, districts):
    return model.select_features(districts, "district_id").toPandas().set_index("district_id").sort_index()


def test_names_and_order(model):
    names = model.feature_names()
    assert names[:3] == [
        "bedroom_ratio__total_bedrooms_per_total_rooms",
        "rooms_per_house__total_rooms_per_households",
        "people_per_house__population_per_households",
    ]
    assert names[3:8] == [f"log__{c}" for c in FeatureSpec().logs]
    assert names[8:18] == [f"geo__cluster_{i}_similarity" for i in range(10)]
    assert names[18:] == [
        "cat__ocean_proximity__1H_OCEAN",
        "cat__ocean_proximity_INLAND",
        "cat__ocean_proximity_NEAR_BAY",
        "cat__ocean_proximity_NEAR_OCEAN",
        "remainder__housing_median_age",
    ]
    assert len(names) == 23


def test_matrix_equals_numpy(model, matrix, districts):
    raw = districts.toPandas().set_index("district_id").sort_index()

    def fill(x):
        return x.fillna(x.median())

    def scale(x):
        return (x - x.mean()) / x.std(ddof=0)

    ratio = fill(fill(raw.total_bedrooms) / fill(raw.total_rooms))
    want = {
        "bedroom_ratio__total_bedrooms_per_total_rooms": scale(ratio),
        "log__population": scale(np.log1p(fill(raw.population))),
        "remainder__housing_median_age": scale(raw.housing_median_age),
    }
    centres = np.array(model.statistics()["centres"])
    point = np.stack([scale(raw.longitude), scale(raw.latitude)], axis=1)
    for i, c in enumerate(centres):
        similar = np.exp(-((point - c) ** 2).sum(axis=1))
        want[f"geo__cluster_{i}_similarity"] = (similar - similar.mean()) / similar.std()
    for name, values in want.items():
        np.testing.assert_allclose(matrix[name], values, atol=1e-9)
    place = raw.ocean_proximity.replace({"ISLAND": "NEAR OCEAN"})
    place = place.fillna(place.mode()[0])
    np.testing.assert_array_equal(matrix["cat__ocean_proximity_NEAR_OCEAN"], (place == "NEAR OCEAN").astype(float))
    assert not matrix.isna().any().any()


def test_layout_of_the_input_does_not_matter(model, districts):
    other = fitted(districts.repartition(17)).statistics()
    mine = model.statistics()
    np.testing.assert_allclose(other["centres"], mine["centres"], atol=1e-8)
    assert other["fills"] == mine["fills"] and other["vocabulary"] == mine["vocabulary"]


def test_one_row_alone_gets_the_values_it_gets_in_the_batch(model, matrix, districts):
    one = districts.orderBy("district_id").limit(1)
    got = model.select_features(one, "district_id").first()
    np.testing.assert_array_equal(list(got[1:]), matrix.iloc[0])


def test_nothing_is_learned_from_other_rows(districts):
    part = districts.filter("district_id % 2 = 0")
    wild = part.withColumn("total_rooms", F.lit(1e9)).withColumn("ocean_proximity", F.lit("MOON"))
    model = fitted(part, FeatureSpec(geo=()))
    before = model.statistics()
    model.select_features(wild).collect()
    assert model.statistics() == before and "MOON" not in before["vocabulary"]["ocean_proximity"]


def test_application_is_one_projection(model, districts):
    plan = model.transform(districts)
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in text.split("InMemoryRelation")[0] and "Python" not in text


def test_scoring_rows_with_gaps_are_filled(model, spark, districts):
    schema = districts.drop("stratum", "median_house_value").schema
    odd = spark.createDataFrame(
        [
            (1, -120.0, 35.0, None, INF, NAN, None, 0.0, 3.0, "LAKE"),
            (2, None, None, None, -5.0, -1.0, None, None, None, None),
        ],
        schema,
    )
    got = model.select_features(odd, "district_id").toPandas().set_index("district_id")
    assert np.isfinite(got.to_numpy()).all()
    assert got.loc[1, [c for c in got if c.startswith("cat__")]].sum() == 0
    fills = model.statistics()["final_fills"]
    assert got.loc[2, "log__total_rooms"] == pytest.approx(fills["log__total_rooms"])


def test_saved_and_loaded_stage_is_the_same(model, districts, tmp_path):
    path = str(tmp_path / "m")
    PipelineModel([model]).write().save(path)
    back = PipelineModel.load(path).stages[0]
    a = model.select_features(districts, "district_id").orderBy("district_id").collect()
    b = back.select_features(districts, "district_id").orderBy("district_id").collect()
    assert a == b and back.statistics()["centres"] == model.statistics()["centres"]


def test_errors(rows, districts):
    with pytest.raises(ValueError, match="missing columns"):
        fitted(districts.drop("households"))
    with pytest.raises(DataValidationError, match="without any value"):
        fitted(districts.withColumn("households", F.lit(None).cast("double")))
    with pytest.raises(DataValidationError, match="cluster weights"):
        fitted(districts.withColumn("median_house_value", -F.col("median_house_value")))
    with pytest.raises(DataValidationError, match="empty"):
        fitted(districts.limit(0))
    for bad in (dict(clusters=1), dict(numeric_strategy="x"), dict(unknown="x"), dict(final_strategy="x"), dict(ratios={"r": ("a",)})):
        with pytest.raises(ValueError):
            FeatureSpec(**bad).check()


@pytest.mark.parametrize("strategy", ["mean", "most_frequent"])
def test_other_strategies(districts, strategy):
    spec = FeatureSpec(geo=(), numeric_strategy=strategy, category_strategy="constant", final_strategy="constant")
    stats = fitted(districts, spec).statistics()
    column = districts.select("total_rooms").toPandas()["total_rooms"].dropna()
    want = column.mean() if strategy == "mean" else column.mode().min()
    assert stats["fills"]["total_rooms"] == pytest.approx(want)
    assert "missing_value" in stats["vocabulary"]["ocean_proximity"]
    assert set(stats["final_fills"].values()) == {0.0}


def test_constant_column_scales_to_zero(rows):
    df = rows([(float(i), 4.0) for i in range(5)], "a double, b double")
    spec = FeatureSpec(ratios={}, logs=(), geo=(), merges={})
    got = TabularFeatures(spec=spec).fit(df).select_features(df).collect()
    assert {r["remainder__b"] for r in got} == {0.0}


def test_fill_values_by_name(rows):
    df = rows([(1.0, "a"), (2.0, "b"), (NAN, "b"), (3.0, None), (4.0, "a")], "x double, s string")
    assert impute.learn_fills(df, ["x"], "median") == {"x": 2.5}
    assert impute.learn_fills(df, ["x", "s"], "most_frequent") == {"x": 1.0, "s": "a"}
    fills = impute.learn_fills(df, ["x", "s"], "constant")
    assert fills == {"x": 0.0, "s": "missing_value"}
    assert [tuple(r) for r in impute.apply_fills(df, fills).collect()][2:4] == [(0.0, "b"), (3.0, "missing_value")]
    with pytest.raises(ValueError):
        impute.learn_fills(df, ["s"], "mean")


# --- clustering ------------------------------------------------------------------------------


def test_heavy_places_attract_the_centres(rows):
    values = [(0.0, 0.0, 1.0)] * 10 + [(1.0, 0.0, 99.0)] * 10 + [(50.0, 50.0, 1.0)] * 5
    df = rows(values, "x double, y double, w double")
    weighted = fit_centres(df, F.col("x"), F.col("y"), F.col("w"), 2)
    plain = fit_centres(df, F.col("x"), F.col("y"), None, 2)
    assert weighted[0] == pytest.approx((0.99, 0.0)) and plain[0] == pytest.approx((0.5, 0.0))
    assert weighted[1] == pytest.approx((50.0, 50.0)) and weighted == sorted(weighted)


def test_copies_count_like_weights(rows):
    spread = [(float(i % 7), float(i % 5), 1.0) for i in range(70)]
    copied = rows(spread + [(3.0, 3.0, 2.0)] * 40, "x double, y double, w double")
    summed = rows(spread + [(3.0, 3.0, 80.0)], "x double, y double, w double")
    a = fit_centres(copied, F.col("x"), F.col("y"), F.col("w"), 4, restarts=2)
    b = fit_centres(summed.repartition(5), F.col("x"), F.col("y"), F.col("w"), 4, restarts=2)
    np.testing.assert_allclose(a, b, atol=1e-9)


@pytest.mark.parametrize("bad", [None, NAN, INF, -1.0])
def test_bad_weights_are_refused(rows, bad):
    df = rows([(0.0, 0.0, 1.0), (1.0, 1.0, bad)], "x double, y double, w double")
    with pytest.raises(DataValidationError):
        fit_centres(df, F.col("x"), F.col("y"), F.col("w"), 2)


def test_max_similarity(rows):
    df = rows([(0.0, 0.0), (3.0, 4.0)], "x double, y double")
    for centres, want in (([(0.0, 0.0)], math.exp(-25)), ([(0.0, 0.0), (3.0, 4.0)], 1.0)):
        got = [r[0] for r in df.select(max_similarity((F.col("x"), F.col("y")), centres)).collect()]
        assert got == [1.0, pytest.approx(want)]


@pytest.mark.parametrize("gap", [0, 3, 4])
def test_medians_of_logs_come_from_the_medians_of_their_inputs(spark, monkeypatch, gap):
    """A searched median is not searched again under a logarithm; a column that loses rows to it is."""
    cells = [(None if i < gap else (i * 37 % 101) / 7.0, float(i % 13) - 2.0, float(i)) for i in range(100)]
    df = spark.createDataFrame(cells, "a double, b double, c double")
    spec = FeatureSpec(ratios={}, logs=("a", "b", "c"), geo=(), merges={})
    want = TabularFeatures(spec=spec).fit(df).statistics()
    searched, search = [], impute.exact_quantiles

    def small(df, columns, *args, **kw):
        searched.append(list(columns))
        return search(df, columns, *args, interior_limit=10, **kw)

    monkeypatch.setattr(impute, "exact_quantiles", small)
    got = TabularFeatures(spec=spec).fit(df).statistics()
    assert got["fills"] == want["fills"] and got["final_fills"] == want["final_fills"]
    assert got["scales"].keys() == want["scales"].keys()
    assert ["log__b"] in searched and not any({"log__a", "log__c"} & set(names) for names in searched)


def test_clusters_are_learned_beside_the_ratios(spark, monkeypatch):
    from acreline.operators import features

    i = F.col("id")
    spec = FeatureSpec(logs=(), ratios={"share": ("a", "b")}, geo=("x", "y"), clusters=2, merges={})
    rows = spark.range(60).select((i % 7).cast("double").alias("x"), (i % 5).cast("double").alias("y"), (i + 1.0).alias("a"), (i % 3 + 1.0).alias("b"), F.lit(2.0).alias("t"))
    want = TabularFeatures(spec=spec, labelCol="t").fit(rows).statistics()
    both, medians, centres = threading.Barrier(2), features.fill_values, features.fit_centres

    def fill_values(df, columns, *args, **named):
        if "share" in columns:
            both.wait(20)
        return medians(df, columns, *args, **named)

    def fit(*args, **named):
        both.wait(20)
        return centres(*args, **named)

    monkeypatch.setattr(features, "fill_values", fill_values)
    monkeypatch.setattr(features, "fit_centres", fit)
    got = TabularFeatures(spec=spec, labelCol="t").fit(rows).statistics()
    assert got["centres"] == [pytest.approx(c) for c in want["centres"]]
    assert got["ratio_fills"] == want["ratio_fills"] and got["scales"].keys() == want["scales"].keys()
    empty = rows.withColumn("b", F.lit(0.0))  # the error of one step is raised when the others are over
    with pytest.raises(DataValidationError, match="without any value"):
        TabularFeatures(spec=spec, labelCol="t").fit(empty)
