"""Queries on scans, sinks, contracts, projections and row functions."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from acreline.functions import rbf_similarity, safe_ratio
from acreline.functions.expressions import log_plus_one
from acreline.operators import contract as C
from acreline.operators.clean import (
    add_stratum,
    clean_capped,
    clean_stats,
    columns_of_type,
    merge_categories,
    normalize_missing,
    sanitize_columns,
)
from acreline.operators.cluster import max_similarity
from acreline.operators.evaluate import prediction_guard
from acreline.queries.common import scored
from acreline.queries.registry import (
    CLEAN,
    DISTRICT,
    ID,
    NUMERIC,
    STRATUM_SQL,
    hash_sql,
    query,
    r,
    round_all,
    rounded,
)
from acreline.session import fresh_dir
from acreline.sources import readers, writers
from acreline.sources.district import district, table

ALL_SQL = ", ".join(f"{r(c)} AS {c}" for c in NUMERIC)
DISTRICT_ROWS = f"WITH {DISTRICT}\nSELECT {ID}, {ALL_SQL}, ocean_proximity FROM district"


# --- scans and sinks -------------------------------------------------------------------------


@query("scan_table", DISTRICT_ROWS)
def scan_table(spark, sf_dir):
    return round_all(district(spark, sf_dir))


@query("scan_csv", DISTRICT_ROWS)
def scan_csv(spark, sf_dir):
    df = district(spark, sf_dir)
    path = fresh_dir(spark, "csv")
    df.write.option("header", True).csv(path)
    return round_all(readers.read_file(spark, path, df.schema, "csv"))


@query("scan_json", DISTRICT_ROWS)
def scan_json(spark, sf_dir):
    df = district(spark, sf_dir)
    path = fresh_dir(spark, "json")
    df.write.json(path)
    return round_all(readers.read_file(spark, path, df.schema, "json"))


@query(
    "json_payload_rows",
    "SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events",
)
def json_payload_rows(spark, sf_dir):
    schema = T.StructType([T.StructField("k", T.LongType())])
    return readers.payload_rows(table(spark, sf_dir, "events"), "props", schema, keep=("event_id",), strict=True)


SCORED_SQL = f"WITH {CLEAN},\nscored AS (SELECT *, CAST(20000 AS DOUBLE) + CAST(42000 AS DOUBLE) * median_income AS prediction FROM clean)"


@query(
    "write_predictions",
    f"{SCORED_SQL}\nSELECT {ID}, {ALL_SQL}, ocean_proximity, {r('prediction')} AS predicted_value, "
    "'income_line_1' AS model_version, '0.1' AS service_version FROM scored",
)
def write_predictions(spark, sf_dir):
    path = fresh_dir(spark, "payload")
    stamped = writers.stamp(scored(clean_capped(district(spark, sf_dir))), "prediction", "income_line_1", "0.1")
    writers.write_predictions(stamped, path)
    back = readers.read_file(spark, path, stamped.schema, "parquet")
    return round_all(back)


@query(
    "preview_sample",
    f"{SCORED_SQL}\nSELECT {ID}, {r('prediction')} AS predicted_value FROM scored "
    f"ORDER BY {hash_sql('preview')}, CAST({ID} AS VARCHAR) LIMIT 100",
)
def preview_sample(spark, sf_dir):
    rows = scored(clean_capped(district(spark, sf_dir))).select(ID, rounded("prediction").alias("predicted_value"))
    return writers.preview(rows, [ID])


@query(
    "predictions_json",
    f"{SCORED_SQL}\nSELECT {ID}, '{{\"predicted_value\":' || CAST(ROUND(prediction, 2) AS VARCHAR) || "
    "',\"service_version\":\"0.1\",\"model_version\":\"income_line_1\"}' AS result FROM scored",
)
def predictions_json(spark, sf_dir):
    rows = scored(clean_capped(district(spark, sf_dir))).withColumn("prediction", F.round("prediction", 2))
    stamped = writers.stamp(rows, "prediction", "income_line_1", "0.1")
    return stamped.select(ID, writers.prediction_json().alias("result"))


# --- contracts -------------------------------------------------------------------------------

SEGMENTS = ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD")
CUSTOMER = C.Contract(
    (
        C.ColumnRule("c_acctbal", "double", nullable=False, above=0.0),
        C.ColumnRule("c_mktsegment", "string", one_of=SEGMENTS),
    ),
    strict=False,
)
PART = C.Contract((C.ColumnRule("p_size", "int", nullable=False, at_least=1, at_most=40),), strict=False)
SEGMENT_LIST = ", ".join(f"'{s}'" for s in SEGMENTS)
FAILURES_SQL = f"""
SELECT CAST(c_custkey AS VARCHAR) AS row_id, 'c_acctbal' AS "column", 'gt:0' AS "check", CAST(c_acctbal AS VARCHAR) AS failure_case
FROM customer WHERE NOT c_acctbal > 0
UNION ALL SELECT CAST(c_custkey AS VARCHAR), 'c_mktsegment', 'isin', c_mktsegment FROM customer WHERE c_mktsegment NOT IN ({SEGMENT_LIST})
UNION ALL SELECT CAST(p_partkey AS VARCHAR), 'p_size', 'ge:1', CAST(p_size AS VARCHAR) FROM part WHERE p_size < 1
UNION ALL SELECT CAST(p_partkey AS VARCHAR), 'p_size', 'le:40', CAST(p_size AS VARCHAR) FROM part WHERE p_size > 40
""".strip()


def _failures(spark, sf_dir):
    customers = CUSTOMER.failures(table(spark, sf_dir, "customer"), ["c_custkey"])
    return customers.unionByName(PART.failures(table(spark, sf_dir, "part"), ["p_partkey"]))


@query("contract_failures", FAILURES_SQL)
def contract_failures(spark, sf_dir):
    return _failures(spark, sf_dir)


@query("write_violations", FAILURES_SQL)
def write_violations(spark, sf_dir):
    path = fresh_dir(spark, "violations")
    failures = _failures(spark, sf_dir)
    writers.write_violations(failures, path)
    return readers.read_file(spark, path, failures.schema, "csv")


@query(
    "contract_summary",
    f"""
WITH {DISTRICT}, c AS (SELECT count(*) AS n,
  count(*) FILTER (longitude IS NULL) a1, count(*) FILTER (longitude < -180) a2, count(*) FILTER (longitude > 180) a3,
  count(*) FILTER (latitude IS NULL) b1, count(*) FILTER (latitude < -90) b2, count(*) FILTER (latitude > 90) b3,
  count(*) FILTER (housing_median_age <= 0) d1, count(*) FILTER (total_rooms <= 0) d2,
  count(*) FILTER (total_bedrooms <= 0) d3, count(*) FILTER (population <= 0) d4, count(*) FILTER (households <= 0) d5,
  count(*) FILTER (median_income IS NULL) e1, count(*) FILTER (median_income <= 0) e2,
  count(*) FILTER (median_house_value IS NULL) f1, count(*) FILTER (median_house_value <= 0) f2,
  count(*) FILTER (ocean_proximity NOT IN ('<1H OCEAN', 'INLAND', 'NEAR OCEAN', 'NEAR BAY', 'ISLAND')) g1
FROM district)
"""
    + "\nUNION ALL\n".join(
        f'SELECT \'{col}\' AS "column", \'{check}\' AS "check", CAST({src} AS BIGINT) AS n_failures FROM c'
        for col, check, src in [
            *[(c, "type:double", "0") for c in NUMERIC],
            ("ocean_proximity", "type:string", "0"),
            ("longitude", "not_null", "a1"),
            ("longitude", "ge:-180", "a2"),
            ("longitude", "le:180", "a3"),
            ("latitude", "not_null", "b1"),
            ("latitude", "ge:-90", "b2"),
            ("latitude", "le:90", "b3"),
            ("housing_median_age", "gt:0", "d1"),
            ("total_rooms", "gt:0", "d2"),
            ("total_bedrooms", "gt:0", "d3"),
            ("population", "gt:0", "d4"),
            ("households", "gt:0", "d5"),
            ("median_income", "not_null", "e1"),
            ("median_income", "gt:0", "e2"),
            ("median_house_value", "not_null", "f1"),
            ("median_house_value", "gt:0", "f2"),
            ("ocean_proximity", "isin", "g1"),
        ]
    ),
)
def contract_summary(spark, sf_dir):
    return C.TRAINING.summary(district(spark, sf_dir))


@query(
    "contract_good_rows",
    f"SELECT c_custkey, {r('c_acctbal')} AS c_acctbal, c_mktsegment FROM customer "
    f"WHERE c_acctbal > 0 AND c_mktsegment IN ({SEGMENT_LIST})",
)
def contract_good_rows(spark, sf_dir):
    good = CUSTOMER.good_rows(table(spark, sf_dir, "customer"))
    return round_all(good.select("c_custkey", "c_acctbal", "c_mktsegment"))


# Text records as they come from a file: every 7th age is a word, every 11th room count is absent.
TEXT_SQL = f"""WITH {DISTRICT}, t AS (SELECT {ID},
  CASE WHEN {ID} % 7 = 0 THEN 'unknown' ELSE CAST(CAST(housing_median_age AS INTEGER) AS VARCHAR) END AS housing_median_age,
  CASE WHEN {ID} % 11 <> 0 THEN CAST(CAST(total_rooms AS INTEGER) AS VARCHAR) END AS total_rooms, ocean_proximity
FROM district)"""


def _text_records(spark, sf_dir):
    key = F.col(ID)
    age = F.col("housing_median_age").cast("int").cast("string")
    return district(spark, sf_dir).withColumns(
        {
            "housing_median_age": F.when(key % 7 == 0, "unknown").otherwise(age),
            "total_rooms": F.when(key % 11 != 0, F.col("total_rooms").cast("int").cast("string")),
        }
    )


@query(
    "contract_coerce",
    f"{TEXT_SQL}\nSELECT {ID}, TRY_CAST(housing_median_age AS DOUBLE) AS housing_median_age, "
    "TRY_CAST(total_rooms AS DOUBLE) AS total_rooms, "
    "housing_median_age IS NOT NULL AND TRY_CAST(housing_median_age AS DOUBLE) IS NULL AS rejected FROM t",
)
def contract_coerce(spark, sf_dir):
    raw = _text_records(spark, sf_dir).select(ID, "housing_median_age", "total_rooms")
    rules = C.Contract((C.ColumnRule("housing_median_age", "double"), C.ColumnRule("total_rooms", "double")), strict=False)
    flagged = raw.withColumn("rejected", rules.broken(raw))
    return rules.coerce(flagged)


@query(
    "inference_contract",
    f"{TEXT_SQL}\nSELECT CAST({ID} AS VARCHAR) AS row_id, 'housing_median_age' AS \"column\", 'type:double' AS \"check\", "
    "housing_median_age AS failure_case FROM t WHERE housing_median_age = 'unknown'\n"
    f"UNION ALL SELECT CAST({ID} AS VARCHAR), 'ocean_proximity', 'not_null', NULL FROM t WHERE ocean_proximity IS NULL",
)
def inference_contract(spark, sf_dir):
    return C.INFERENCE.failures(_text_records(spark, sf_dir), [ID])


# --- projections and filters -----------------------------------------------------------------


@query("clean_capped", f"WITH {CLEAN}\nSELECT {ID}, {ALL_SQL}, ocean_proximity FROM clean")
def clean_capped_rows(spark, sf_dir):
    return round_all(clean_capped(district(spark, sf_dir)))


@query(
    "clean_stats",
    f"WITH {DISTRICT}, c AS (SELECT count(*) AS b, count(*) FILTER (median_house_value < 500001) AS k FROM district)\n"
    f"SELECT b AS rows_before, b - k AS rows_removed, k AS rows_kept, {r('CAST(100 AS DOUBLE) * (b - k) / b')} AS pct_removed FROM c",
)
def clean_stats_row(spark, sf_dir):
    return round_all(clean_stats(district(spark, sf_dir)))


@query("select_numeric", f"WITH {DISTRICT}\nSELECT {ID}, {ALL_SQL} FROM district")
def select_numeric(spark, sf_dir):
    df = district(spark, sf_dir)
    return round_all(df.select(*columns_of_type(df)))


@query(
    "sanitize_names",
    f"SELECT o_orderkey AS order_key, {r('o_totalprice')} AS price___1_, o_orderpriority AS prio_ity_class FROM orders",
)
def sanitize_names(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", rounded("o_totalprice"), "o_orderpriority")
    return sanitize_columns(orders.toDF("order key", "price <[1]", "prio-ity class"))


# --- row functions ---------------------------------------------------------------------------


@query(
    "ratio_features",
    f"WITH {DISTRICT}\nSELECT {ID}, {r('total_bedrooms / NULLIF(total_rooms, 0)')} AS bedroom_ratio, "
    f"{r('total_rooms / NULLIF(households, 0)')} AS rooms_per_house, {r('population / NULLIF(households, 0)')} AS people_per_house FROM district",
)
def ratio_features(spark, sf_dir):
    return district(spark, sf_dir).select(
        ID,
        rounded(safe_ratio(F.col("total_bedrooms"), F.col("total_rooms"))).alias("bedroom_ratio"),
        rounded(safe_ratio(F.col("total_rooms"), F.col("households"))).alias("rooms_per_house"),
        rounded(safe_ratio(F.col("population"), F.col("households"))).alias("people_per_house"),
    )


LOGS = ("total_bedrooms", "total_rooms", "population", "households", "median_income")


@query(
    "log_features",
    f"WITH {DISTRICT}\nSELECT {ID}, " + ", ".join(f"{r(f'ln(1 + {c})')} AS {c}" for c in LOGS) + " FROM district",
)
def log_features(spark, sf_dir):
    return district(spark, sf_dir).select(ID, *[rounded(log_plus_one(F.col(c))).alias(c) for c in LOGS])


@query(
    "merge_categories",
    f"WITH {DISTRICT}\nSELECT {ID}, CASE WHEN ocean_proximity = 'ISLAND' THEN 'NEAR OCEAN' ELSE ocean_proximity END AS ocean_proximity FROM district",
)
def merge_categories_rows(spark, sf_dir):
    df = district(spark, sf_dir).select(ID, "ocean_proximity")
    return merge_categories(df, "ocean_proximity", {"ISLAND": "NEAR OCEAN"})


@query("income_bins", f"WITH {DISTRICT}\nSELECT {ID}, CAST({STRATUM_SQL} AS INTEGER) AS stratum FROM district")
def income_bins(spark, sf_dir):
    return add_stratum(district(spark, sf_dir)).select(ID, "stratum")


@query("inf_to_null", f"WITH {DISTRICT}\nSELECT {ID}, CASE WHEN total_bedrooms IS NOT NULL THEN total_rooms END AS total_rooms FROM district")
def inf_to_null(spark, sf_dir):
    # Rows without bedrooms stand for overflows: their room count is set to an infinity or to NaN.
    key = F.col(ID)
    odd = F.when(key % 3 == 0, F.lit(float("inf"))).when(key % 3 == 1, F.lit(float("-inf"))).otherwise(F.lit(float("nan")))
    rooms = F.when(F.col("total_bedrooms").isNull(), odd).otherwise(F.col("total_rooms"))
    return normalize_missing(district(spark, sf_dir).select(ID, rooms.alias("total_rooms")))


# Fixed centres of the similarity queries.
CENTRES = ((-122.4, 37.8), (-118.2, 34.1), (-117.2, 32.7))


def _similarity_sql(x: float, y: float) -> str:
    dx, dy = f"(longitude - CAST({x} AS DOUBLE))", f"(latitude - CAST({y} AS DOUBLE))"
    return f"exp(-1 * ({dx} * {dx} + {dy} * {dy}))"


@query(
    "rbf_similarity",
    f"WITH {DISTRICT}\nSELECT {ID}, "
    + ", ".join(f"{r(_similarity_sql(x, y))} AS cluster_{i}_similarity" for i, (x, y) in enumerate(CENTRES))
    + " FROM district",
)
def rbf_similarity_rows(spark, sf_dir):
    point = (F.col("longitude"), F.col("latitude"))
    return district(spark, sf_dir).select(
        ID, *[rounded(rbf_similarity(point, c, 1.0)).alias(f"cluster_{i}_similarity") for i, c in enumerate(CENTRES)]
    )


@query(
    "max_similarity",
    f"WITH {DISTRICT}\nSELECT {ID}, {r('greatest(' + ', '.join(_similarity_sql(x, y) for x, y in CENTRES) + ')')} AS max_similarity FROM district",
)
def max_similarity_rows(spark, sf_dir):
    point = (F.col("longitude"), F.col("latitude"))
    return district(spark, sf_dir).select(ID, rounded(max_similarity(point, CENTRES, 1.0)).alias("max_similarity"))


@query(
    "prediction_guard",
    f"WITH {DISTRICT}\nSELECT count(*) AS n_rows, count(*) FILTER (total_bedrooms IS NULL) AS n_bad FROM district",
)
def prediction_guard_row(spark, sf_dir):
    # A scorer that divides by bedrooms has no finite answer where they are unknown.
    value = F.col("median_income") / F.coalesce(F.col("total_bedrooms"), F.lit(float("nan")))
    return prediction_guard(district(spark, sf_dir).select(value.alias("prediction")))
