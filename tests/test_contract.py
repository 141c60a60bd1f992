import pytest

from acreline.errors import DataValidationError
from acreline.operators import contract as C
from acreline.operators.checks import check_choice, check_clusters, check_table_name, require_rows

NAN, INF = float("nan"), float("inf")
SCHEMA = (
    "district_id bigint, longitude double, latitude double, housing_median_age double, total_rooms double, "
    "total_bedrooms double, population double, households double, median_income double, median_house_value double, "
    "ocean_proximity string"
)


def row(i, **changes):
    base = dict(
        longitude=-120.0, latitude=35.0, housing_median_age=20.0, total_rooms=10.0, total_bedrooms=3.0, population=8.0,
        households=4.0, median_income=3.0, median_house_value=1000.0, ocean_proximity="INLAND",
    )
    base.update(changes)
    return (i, *base.values())


def test_every_violation_is_reported_at_once(rows):
    df = rows(
        [
            row(1),
            row(2, median_income=0.0, households=0.0),
            row(3, longitude=None, latitude=NAN),
            row(4, ocean_proximity="LAKE"),
            row(5, ocean_proximity=None, total_bedrooms=None, total_rooms=NAN, population=INF),
            row(6, longitude=-180.0, latitude=90.0),
            row(7, longitude=180.5),
        ],
        SCHEMA,
    )
    got = {(r["row_id"], r["column"], r["check"], r["failure_case"]) for r in C.TRAINING.failures(df, ["district_id"]).collect()}
    assert got == {
        ("2", "median_income", "gt:0", "0.0"),
        ("2", "households", "gt:0", "0.0"),
        ("3", "longitude", "not_null", None),
        ("3", "latitude", "not_null", "NaN"),
        ("4", "ocean_proximity", "isin", "LAKE"),
        ("7", "longitude", "le:180", "180.5"),
    }
    counts = {(r["column"], r["check"]): r["n_failures"] for r in C.TRAINING.summary(df).collect() if r["n_failures"]}
    assert sum(counts.values()) == 6 and counts[("households", "gt:0")] == 1
    assert sorted(r["district_id"] for r in C.TRAINING.good_rows(df).collect()) == [1, 5, 6]
    assert sorted(r["district_id"] for r in C.TRAINING.bad_rows(df).collect()) == [2, 3, 4, 7]
    with pytest.raises(DataValidationError) as caught:
        C.TRAINING.validate(df)
    assert len(caught.value.failures) == 6


def test_report_scans_once_without_a_shuffle(rows):
    plan = C.TRAINING.failures(rows([row(1)], SCHEMA), ["district_id"])._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and plan.count("Scan") == 1


def test_structure(rows):
    df = rows([row(1)], SCHEMA)
    assert C.TRAINING.structure_failures(df) == []
    assert C.TRAINING.structure_failures(df.select(*reversed(df.columns))) == []
    broken = df.drop("latitude").withColumn("extra", df.longitude)
    assert C.TRAINING.structure_failures(broken) == ["missing column latitude", "unexpected column extra"]
    with pytest.raises(DataValidationError, match="unexpected column extra"):
        C.TRAINING.validate(broken)
    assert C.INFERENCE.structure_failures(df) == []


def test_text_is_cast_first_and_uncastable_cells_fail(rows):
    rules = C.Contract((C.ColumnRule("x", "double", above=0.0),))
    df = rows([("1.5",), ("-2",), ("abc",), (None,)], "x string")
    assert [r["x"] for r in rules.coerce(df).collect()] == [1.5, -2.0, None, None]
    got = {(r["check"], r["failure_case"]) for r in rules.failures(df).collect()}
    assert got == {("type:double", "abc"), ("gt:0", "-2")}
    clean = rules.validate(rows([("1.5",)], "x string"))
    assert clean.dtypes == [("x", "double")]


def test_inference_needs_the_category_only(rows):
    df = rows([row(1, longitude=None, total_rooms=NAN), row(2, ocean_proximity=None)], SCHEMA)
    assert [r["row_id"] for r in C.INFERENCE.failures(df, ["district_id"]).collect()] == ["2"]


def test_argument_checks(rows):
    for bad in ("a b", "x;y", ""):
        with pytest.raises(ValueError):
            check_table_name(bad)
    with pytest.raises(ValueError):
        check_clusters(1)
    with pytest.raises(ValueError):
        check_choice("x", ["a"], "thing")
    with pytest.raises(DataValidationError):
        require_rows(rows([], "x int"))
