"""A routed stream loses no line, also when it breaks off in the middle of a batch."""

import json

import pytest
from pyspark.sql import types as T
from pyspark.sql import functions as F

from acreline.operators import models
from acreline.operators.features import FeatureSpec
from acreline.plans import training as plan
from acreline.sources import readers
from acreline.sources.district import district
from acreline.streaming import scoring as stream

SF = "/root/testdata/sf0.001"
SCHEMA = T.StructType([T.StructField("district_id", T.StringType()), *readers.RECORD_SCHEMA.fields])


@pytest.fixture(scope="module")
def model(spark):
    training = models.Training(spec=FeatureSpec(geo=()))
    rows = plan.split(plan.prepare(district(spark, SF), training), training).filter("part = 'train'")
    return models.fit_full(rows, "boosted_trees", training, models.shorten("boosted_trees", 2, 3))


def record(key, place="INLAND", **more):
    return {"district_id": key, "longitude": -120.0, "latitude": 35.0, "housing_median_age": 9.0, "total_rooms": 5.0, "total_bedrooms": 2.0, "population": 8.0, "households": 2.0, "median_income": 4.0, "ocean_proximity": place} | more


LINES = [
    json.dumps(record("a")),
    json.dumps([record("b"), record("c", None)]),
    json.dumps(record("d", median_income="text")),
    '{"district_id": "e", "longit',
    "",
    None,
    "null",
    "not JSON at all",
    "[]",
    json.dumps(record("a")),
]


def keys(spark, path):
    return sorted(r[0] or "" for r in spark.read.parquet(path).select("district_id").collect())


def test_every_line_has_a_place_after_a_crash(spark, model, tmp_path, monkeypatch):
    inbox, routes, state = str(tmp_path / "in"), stream.Routes.below(str(tmp_path / "out")), str(tmp_path / "state")
    spark.createDataFrame([(x,) for x in LINES], "value string").coalesce(1).write.parquet(inbox)
    lines = spark.readStream.schema("value string").parquet(inbox)
    run = lambda: stream.route_stream(model, lines, SCHEMA, routes, state, "m", "s").awaitTermination()
    with monkeypatch.context() as broken:

        def fails(*_):
            raise RuntimeError("crash after two outputs")

        broken.setattr(stream, "unreadable_lines", fails)
        with pytest.raises(Exception, match="crash after two outputs"):
            run()
    assert keys(spark, routes.scored) == ["a", "a", "b"]
    run()
    run()  # nothing is left to do
    assert keys(spark, routes.scored) == ["a", "a", "b"]
    assert keys(spark, routes.refused) == ["c", "d"]
    left = [r["value"] for r in spark.read.parquet(routes.unreadable).collect()]
    assert sorted(left, key=str) == sorted([LINES[i] for i in (3, 4, 5, 6, 7)], key=str)
    told = spark.read.parquet(routes.telemetry).collect()
    assert [(r.n_lines, r.n_scored, r.n_refused, r.n_unreadable) for r in told] == [(10, 3, 2, 5)]
    spark.createDataFrame([("",), (LINES[0],)], "value string").coalesce(1).write.mode("append").parquet(inbox)
    run()
    assert keys(spark, routes.scored) == ["a", "a", "a", "b"] and spark.read.parquet(routes.unreadable).count() == 6
    total = spark.read.parquet(routes.telemetry).agg(F.sum("n_lines"), F.count("*")).first()
    assert tuple(total) == (12, 2)


def test_an_inbox_holds_a_few_files_of_some_size(spark, tmp_path, monkeypatch):
    from acreline.queries import learned

    monkeypatch.setattr(learned, "INBOX_LINES", 100)
    rows = spark.range(2_000, numPartitions=60).select(F.col("id").cast("string").alias("value"))
    for some in (rows.filter("id < 300"), rows.filter("id >= 300")):
        learned._post(some, str(tmp_path / "inbox"))
    files = list((tmp_path / "inbox").glob("*.txt"))
    assert len(files) <= 8 + 17
    assert sorted(int(r["value"]) for r in spark.read.text(str(tmp_path / "inbox")).collect()) == list(range(2_000))
