"""Every query with a SQL twin equals it; the others return rows with a stable schema."""

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import __spark_entry__  # noqa: E402
from compare import compare, connect  # noqa: E402

from acreline.operators import models  # noqa: E402
from acreline.queries import ORACLES, QUERIES, learned  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return connect(SF)


@pytest.mark.parametrize("name", [n for n in QUERIES if n in ORACLES and n != "model_roundtrip"])
def test_query_equals_sql(spark, duck, name):
    result, _ = compare(spark, duck, SF, name)
    assert result.startswith("ok") and result != "ok 0"


def test_registry(spark):
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
    first = __spark_entry__.entry(spark)
    assert first.count() == 10 and first.columns == ["part", "stratum", "n_rows", "share"]


@pytest.mark.parametrize("name", models.PRESETS)
def test_training_queries_run_whole_presets(spark, monkeypatch, name):
    asked = []
    monkeypatch.setattr(learned, "_rows", lambda *_: spark.createDataFrame([("train",), ("test",)], "part string"))
    monkeypatch.setattr(models, "fit_full", lambda rows, name, plan, settings=None: asked.append((name, settings)))
    monkeypatch.setattr(models, "score", lambda *_: dict.fromkeys(("rmse", "mae", "r2", "mse"), 0.0))
    assert QUERIES[f"train_{name}"](spark, "").first()["model"] == name
    assert asked[0][0] == name and _built_whole(*asked[0])


def test_train_all_runs_whole_presets(spark, monkeypatch):
    asked = {}
    monkeypatch.setattr(learned, "_rows", lambda *_: None)
    monkeypatch.setattr(learned, "train_all", lambda rows, plan, names: asked.update(names))
    QUERIES["train_all"](spark, "")
    assert set(asked) == {*models.PRESETS, "no_such_model"} and all(_built_whole(n, asked[n]) for n in models.PRESETS)


def _built_whole(name, settings):
    built = models.build_regressor(name, settings)
    return all(built.getOrDefault(k) == v for k, v in models.PRESETS[name].items())


def test_clusters_and_hotspots(spark):
    spots = QUERIES["geo_hotspots"](spark, SF).toPandas()
    assert len(spots) == 1500 and spots["max_similarity"].between(0, 1).all() and spots["max_similarity"].max() > 0.5
    again = QUERIES["geo_hotspots"](spark, SF).toPandas()
    key = ["district_id"]
    assert spots.sort_values(key).reset_index(drop=True).equals(again.sort_values(key).reset_index(drop=True))


def test_named_tables_in_buckets_meet_without_an_exchange(spark):
    plan = QUERIES["bucketed_join"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and plan.count("Bucketed: true") == 2
