import json
import re
import threading

import pytest
from pyspark.sql import functions as F

from acreline.errors import DataValidationError
from acreline.operators import evaluate, models
from acreline.operators.contract import TRAINING
from acreline.operators.features import FeatureSpec
from acreline.plans import scoring, training as plan
from acreline.sources import readers, writers
from acreline.sources.district import district
from acreline.streaming import scoring as stream

SF = "/root/testdata/sf0.001"
TARGET = "median_house_value"
SPEC = FeatureSpec(clusters=3)
TRAIN = models.Training(spec=SPEC, folds=2)


@pytest.fixture(scope="module")
def parted(spark):
    rows = plan.prepare(district(spark, SF), TRAIN, TRAINING)
    return plan.split(rows, TRAIN).persist()


@pytest.fixture(scope="module")
def fitted(parted):
    return models.fit_full(parted.filter("part = 'train'"), "boosted_trees", TRAIN, models.shorten("boosted_trees", 5, 4))


@pytest.fixture(scope="module")
def test_rows(parted):
    return parted.filter("part = 'test'").drop("stratum", "part")


def test_boosting_beats_the_mean_by_far(fitted, test_rows):
    scores = models.score(fitted, test_rows, "test", TRAIN)
    spread = test_rows.agg(F.stddev_pop(TARGET)).first()[0]
    assert scores["rmse"] < 0.5 * spread and scores["r2"] > 0.75
    assert scores["mse"] == pytest.approx(scores["rmse"] ** 2)


def test_same_rows_in_another_layout_give_the_same_forest(parted):
    train = parted.filter("part = 'train'")
    settings = models.shorten("random_forest", 3, 4)
    a = models.fit_full(train, "random_forest", TRAIN, settings)
    b = models.fit_full(train.repartition(11), "random_forest", TRAIN, settings)
    # Equal but for the last digits of sums taken in another order.
    left, right = (re.findall(r"-?\d+\.\d+|feature \d+|If|Else", m.stages[-1].toDebugString) for m in (a, b))
    assert len(left) == len(right) > 30
    for x, y in zip(left, right):
        assert x == y or float(x) == pytest.approx(float(y), abs=1e-9)


def test_saved_model_predicts_the_same(fitted, test_rows, spark, tmp_path):
    models.save_model(fitted, str(tmp_path), test_rows, ["district_id"])
    loaded, schema = models.load_model(spark, str(tmp_path))
    assert schema == test_rows.schema and spark.read.parquet(str(tmp_path / "example")).count() == 5
    key = ["district_id"]
    a = models.predict(fitted, test_rows).orderBy(key).collect()
    assert a == models.predict(loaded, test_rows).orderBy(key).collect()


def test_prediction_is_map_only(fitted, test_rows, spark, tmp_path):
    test_rows.write.parquet(str(tmp_path / "r"))
    text = models.predict(fitted, spark.read.parquet(str(tmp_path / "r")))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in text and "Python" not in text


def test_all_models_on_one_split_and_a_failing_one(parted):
    kept = {}
    names = {n: models.shorten(n, 3, 3) for n in models.PRESETS} | {"nonsense": None}
    loose = models.Training(spec=FeatureSpec(geo=()), threshold=500_000.0)
    report = {r["model"]: r for r in plan.train_all(parted, loose, names, kept).collect()}
    assert set(kept) == set(models.PRESETS)
    assert report["nonsense"]["status"] == "failed" and "model must be one of" in report["nonsense"]["error"]
    for name in models.PRESETS:
        assert report[name]["status"] == "ok" and report[name]["test_rmse"] > 0
        assert report[name]["validation_std_rmse"] == 0.0


def test_gate_stops_training(parted):
    strict = models.Training(spec=FeatureSpec(geo=()), threshold=1.0)
    with pytest.raises(DataValidationError, match="quality gate"):
        models.train(parted.filter("part = 'train'"), "random_forest", strict, models.shorten("random_forest", 1, 2))


def test_folds_are_scored_apart(parted):
    spec = models.Training(spec=FeatureSpec(geo=()), validation="cross_validation", folds=2)
    scores = models.validation_scores(parted.filter("part = 'train'"), "random_forest", spec, models.shorten("random_forest", 2, 3))
    summary = models.summarize(scores)
    values = [s["rmse"] for s in scores]
    assert len(scores) == 2 and summary["validation_mean_rmse"] == pytest.approx(sum(values) / 2)
    assert summary["validation_std_rmse"] == pytest.approx(abs(values[0] - values[1]) / 2)


def test_presets_and_settings():
    short = models.shorten("boosted_trees", 100)
    assert short["maxIter"] == 100 and short["stepSize"] == pytest.approx(1188 * 0.019655684599424853 / 100)
    assert models.shorten("boosted_trees", 5)["stepSize"] == 0.3
    assert models.build_regressor("random_forest", {"maxDepth": 40}).getMaxDepth() == 30
    assert models.build_regressor("random_forest", {"maxDepth": None}).getMaxDepth() == 30
    with pytest.raises(ValueError):
        models.build_regressor("linear")
    with pytest.raises(ValueError):
        models.Training(validation="none")
    with pytest.raises(ValueError):
        models.Training(metrics=("rmsle",))


# --- metrics ---------------------------------------------------------------------------------


def test_metrics_against_hand_values(rows):
    df = rows([(1.0, 2.0), (2.0, 2.0), (3.0, 5.0)], "label double, prediction double")
    got = evaluate.evaluate(df, "t")
    assert got == pytest.approx({"rmse": (5 / 3) ** 0.5, "mae": 1.0, "r2": 1 - 5 / 2, "mse": 5 / 3})
    flat = rows([(1.0, 1.0), (1.0, 1.0)], "label double, prediction double")
    assert evaluate.evaluate(flat, "t")["r2"] == 1.0
    assert evaluate.evaluate(flat.withColumn("prediction", F.lit(2.0)), "t")["r2"] == 0.0


@pytest.mark.parametrize("bad", [None, float("nan"), float("inf")])
def test_guards(rows, bad):
    df = rows([(1.0, bad)], "label double, prediction double")
    with pytest.raises(DataValidationError, match="not finite"):
        evaluate.evaluate(df, "t")
    with pytest.raises(DataValidationError, match="empty"):
        evaluate.evaluate(df.limit(0), "t")
    with pytest.raises(ValueError, match="unsupported"):
        evaluate.evaluate(df, "t", metrics=("rmsle",))
    assert tuple(evaluate.prediction_guard(df).first()) == (1, 1)


def test_gate_knows_the_direction(rows):
    df = rows([("a", 5.0, 0.9)], "model string, validation_mean_rmse double, validation_mean_r2 double")
    assert evaluate.quality_gate(df, "rmse", 6.0).first()["passed"]
    assert not evaluate.quality_gate(df, "rmse", 4.0).first()["passed"]
    assert evaluate.quality_gate(df, "r2", 0.8).first()["passed"]
    evaluate.require_quality(df, "r2", 0.8)
    with pytest.raises(DataValidationError):
        evaluate.require_quality(df, "r2", 0.95)


# --- batch and stream scoring ----------------------------------------------------------------


def test_batch_payload(fitted, test_rows, spark, tmp_path):
    out, bad = str(tmp_path / "out"), str(tmp_path / "bad")
    records = test_rows.drop(TARGET).withColumn("note", F.lit("kept"))
    gaps = records.filter("ocean_proximity IS NULL").count()
    seen = scoring.score_batch(fitted, records, out, "m1", "0.1", mode="quarantine", bad_path=bad)
    assert seen["n_rows"] == records.count() - gaps and seen["n_bad"] == 0 and seen["seconds_per_row"] > 0
    assert spark.read.parquet(bad).count() == gaps
    back = spark.read.parquet(out)
    assert set(back.columns) == {*records.columns, "predicted_value", "model_version", "service_version"}
    holes = records.limit(3).withColumn("ocean_proximity", F.lit(None).cast("string"))
    with pytest.raises(DataValidationError, match="not_null"):
        scoring.score_batch(fitted, holes, out, "m1", "0.1")
    with pytest.raises(DataValidationError, match="missing column latitude"):
        scoring.score_batch(fitted, records.drop("latitude"), out, "m1", "0.1")
    with pytest.raises(DataValidationError, match="empty"):
        scoring.score_batch(fitted, records.limit(0), out, "m1", "0.1")


def test_stream_gives_the_batch_result(fitted, test_rows, spark, tmp_path):
    inbox, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    good = test_rows.drop(TARGET).filter("ocean_proximity IS NOT NULL")
    features = [f.name for f in readers.FEATURE_SCHEMA.fields]
    lines = good.select(F.to_json(F.struct("district_id", *features)).alias("value"))
    odd = [
        json.dumps([{"district_id": "-1", "ocean_proximity": "INLAND", "longitude": "-120.5"}, {"district_id": "-2", "ocean_proximity": None}]),
        json.dumps({"district_id": "-3", "ocean_proximity": "INLAND", "latitude": "north"}),
        "no json",
    ]
    lines.unionByName(spark.createDataFrame([(x,) for x in odd], "value string")).repartition(3).write.text(inbox)
    schema = readers.RECORD_SCHEMA.__class__([*readers.RECORD_SCHEMA.fields]).add("district_id", "string")
    records = stream.record_stream(stream.payload_stream(spark, inbox, 1), schema)
    assert records.isStreaming
    stream.write_stream(stream.score_stream(fitted, records, "m1", "0.1"), out, state).awaitTermination()
    got = {int(r["district_id"]): r["predicted_value"] for r in spark.read.parquet(out).collect()}
    want = {r["district_id"]: r["prediction"] for r in models.predict(fitted, good).collect()}
    assert got.pop(-1) > 0 and got == want
    batch = readers.payload_rows(spark.read.text(inbox), "value", schema)
    assert {r["district_id"] for r in stream.bad_records(batch).collect()} == {"-2", "-3"}
    assert readers.unreadable_payloads(spark.read.text(inbox), "value", schema).count() == 1


# --- sources and sinks -----------------------------------------------------------------------


def test_formats_and_errors(spark, rows, tmp_path):
    df = rows([(1.5, "x,y"), (None, None)], "a double, b string")
    for fmt in ("csv", "json", "parquet", "orc"):
        path = str(tmp_path / f"t.{fmt.upper()}")
        df.write.format(fmt).option("header", True).save(path)
        schema = None if fmt in ("parquet", "orc") else df.schema
        assert sorted(readers.read_file(spark, path, schema).collect(), key=str) == sorted(df.collect(), key=str)
    (tmp_path / "list.json").write_text(json.dumps([{"a": 1.0, "b": "p"}, {"a": 2.0}]))
    got = readers.read_file(spark, str(tmp_path / "list.json"), df.schema, json_list=True).collect()
    assert [tuple(r) for r in got] == [(1.0, "p"), (2.0, None)]
    with pytest.raises(ValueError, match="unsupported"):
        readers.read_file(spark, "x.xlsx")
    with pytest.raises(ValueError, match="schema"):
        readers.read_file(spark, "x.csv")
    with pytest.raises(FileNotFoundError):
        readers.read_file(spark, str(tmp_path / "none.parquet"))


def test_tables_and_database_options(spark, rows):
    rows([(1,)], "x int").createOrReplaceTempView("some_table_1")
    assert readers.read_table(spark, "some_table_1").count() == 1
    with pytest.raises(DataValidationError):
        readers.read_table(spark, "no_such_table")
    with pytest.raises(ValueError):
        readers.read_table(spark, "x; drop")
    options = readers.jdbc_options("jdbc:x", "housing", "id", 0, 100, 4)
    assert options["numPartitions"] == "4" and options["partitionColumn"] == "id"
    with pytest.raises(ValueError):
        readers.jdbc_options("jdbc:x", "housing", "id", 5, 5, 4)


def test_metrics_sink(spark, tmp_path):
    path = str(tmp_path / "m")
    for run in ("r1", "r2"):
        writers.write_metrics(writers.metrics_frame(spark, "gbt", "test", run, {"rmse": 2.0, "mae": 1.0}), path)
    back = spark.read.json(path).collect()
    assert {(r["run_id"], r["rmse"], r["model"], r["set_name"]) for r in back} == {("r1", 2.0, "gbt", "test"), ("r2", 2.0, "gbt", "test")}


def test_quarantine_needs_a_place(fitted, districts):
    with pytest.raises(ValueError, match="bad_path"):
        scoring.score_batch(fitted, districts, "unused", "m1", "0.1", mode="quarantine")


def test_payloads_that_are_no_json(rows):
    from pyspark.sql import types as T

    from acreline.sources import readers

    df = rows([('{"k": 1}',), ("oops",)], "value string")
    schema = T.StructType().add("k", T.LongType())
    assert readers.payload_rows(df, "value", schema).count() == 1
    with pytest.raises(Exception, match="no JSON"):
        readers.payload_rows(df, "value", schema, strict=True).collect()


def test_training_without_strata(districts):
    from acreline.operators.models import Training
    from acreline.plans import training

    plan = Training(id_cols=("district_id",), stratum=None)
    parted = training.split(training.prepare(districts.drop("stratum"), plan), plan)
    assert "stratum" not in parted.columns
    n = parted.count()
    assert parted.filter("part = 'test'").count() == -(-n // 5)


def test_tasks_of_a_learner_hold_some_rows():
    """A job a level of a tree: tasks of 20,000 rows would be mostly their own start and their sums of open nodes."""
    from acreline.operators.keys import parts_for

    assert [parts_for(n) for n in (0, 1_999, 4_000, 16_000, 120_000)] == [1, 1, 2, 8, 8]
    assert parts_for(7_200_000) == 36 and parts_for(43_000_000) == 215
    assert parts_for(3_000_000_000) == 3_000
    assert [parts_for(n, 20_000) for n in (100, 40_000, 950_000, 4_000_000)] == [1, 2, 8, 20]


def test_the_inputs_travel_not_the_matrix(parted):
    prepared = models.prepare(parted.filter("part = 'train'"), TRAIN)
    try:
        plan_text = prepared.table._jdf.queryExecution().analyzed().toString()
        assert plan_text.index("UDF") < plan_text.index("RepartitionByExpression")
    finally:
        prepared.release()


@pytest.mark.parametrize("validation", ["single_split", "cross_validation"])
def test_validation_rows_are_kept_while_they_are_used(parted, validation):
    setup = models.Training(spec=SPEC, folds=2, validation=validation)
    sets = models.validation_sets(parted.filter("part = 'train'"), setup)
    column = "fold" if validation == "cross_validation" else "val_part"

    def kept(df):
        found = df.select("*")._jdf.queryExecution().withCachedData().toString()
        return any(f"{column}#" in line for line in found.splitlines() if "InMemoryRelation" in line)

    _, fit_rows, val_rows = next(sets)
    assert kept(fit_rows) and kept(val_rows)
    sets.close()
    assert not kept(fit_rows) and not kept(val_rows)


def test_rows_that_are_kept_already_are_not_kept_again(spark, parted):
    assert parted.is_cached
    before = spark.sparkContext._jsc.getPersistentRDDs().size()
    seen = []

    class Watched(dict):
        def items(self):
            seen.append(parted.filter("part = 'train'")._jdf.queryExecution().withCachedData().toString().count("InMemoryRelation"))
            return super().items()

    plan.train_all(parted, TRAIN, Watched(no_such_model=None)).collect()
    assert seen == [1] and spark.sparkContext._jsc.getPersistentRDDs().size() == before


def _own_rows(spark):
    """Rows of the training table's columns, built here; the value follows the income."""
    i = F.col("id")
    mixed = lambda salt, n: F.pmod(F.xxhash64(i, F.lit(salt)), F.lit(n))
    columns = {"longitude": mixed(1, 9) / 2.0 - 122, "latitude": mixed(2, 7) / 2.0 + 33, "median_income": mixed(3, 90) / 10.0 + 0.5}
    columns |= {c: (mixed(4 + k, 400) + 5).cast("double") for k, c in enumerate(("housing_median_age", "total_rooms", "total_bedrooms", "population", "households"))}
    rows = spark.range(800).select(i.alias("district_id"), *[v.alias(c) for c, v in columns.items()], F.when(i % 3 == 0, "INLAND").otherwise("NEAR BAY").alias("ocean_proximity"), (i % 4).cast("string").alias("stratum"))
    return rows.withColumn(TARGET, 20_000 + 42_000 * F.col("median_income"))


@pytest.mark.parametrize("threshold", [1e9, 0.0])
def test_features_of_the_refit_are_learned_beside_the_validation(spark, monkeypatch, threshold):
    rows = _own_rows(spark).persist()
    own = models.Training(spec=SPEC, threshold=threshold)
    short, prepared, at_gate = models.shorten("boosted_trees", 2, 2), models.prepare, []
    begun, gate, kept = threading.Semaphore(0), models.gate, len(spark.sparkContext._jsc.getPersistentRDDs())

    def prepare(df, training):
        begun.release()
        return prepared(df, training)

    def watched(summary, training):
        at_gate.append(all(begun.acquire(timeout=20) for _ in range(2)))
        return gate(summary, training)

    monkeypatch.setattr(models, "prepare", prepare)
    monkeypatch.setattr(models, "gate", watched)
    if threshold:
        model, summary = models.train(rows, "boosted_trees", own, short)
        assert summary == pytest.approx(models.summarize(models.validation_scores(rows, "boosted_trees", own, short)))
        monkeypatch.undo()
        same = models.predict(models.fit_full(rows, "boosted_trees", own, short), models.predict(model, rows, "one"), "two")
        assert same.filter(F.abs(F.col("one") - F.col("two")) > 1e-6 * F.abs("one")).isEmpty()
    else:
        with pytest.raises(DataValidationError, match="quality gate"):
            models.train(rows, "boosted_trees", own, short)
    assert at_gate == [True]
    assert len(spark.sparkContext._jsc.getPersistentRDDs()) <= kept + 1  # the rows, perhaps; no matrix is left
    rows.unpersist()
