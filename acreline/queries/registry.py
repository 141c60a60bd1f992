"""The table of queries and of their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from acreline.operators.clean import TARGET_CAP
from acreline.sources.district import DISTRICT_SQL

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

ID = "district_id"
FEATURES = (
    "longitude",
    "latitude",
    "housing_median_age",
    "total_rooms",
    "total_bedrooms",
    "population",
    "households",
    "median_income",
)
TARGET = "median_house_value"
NUMERIC = (*FEATURES, TARGET)


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name!r} is registered twice")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


def rounded(value: Column | str, digits: int = 6) -> Column:
    """Rounded double without a negative zero."""
    return F.round(F.col(value) if isinstance(value, str) else value, digits) + F.lit(0.0)


def round_all(df: DataFrame, digits: int = 6) -> DataFrame:
    doubles = [f.name for f in df.schema.fields if f.dataType.simpleString() == "double"]
    return df.withColumns({c: rounded(c, digits) for c in doubles})


def r(expr: str, digits: int = 6) -> str:
    return f"ROUND({expr}, {digits}) + CAST(0 AS DOUBLE)"


# --- SQL fragments ---------------------------------------------------------------------------

STRATUM_SQL = (
    "CASE WHEN median_income <= 0 THEN NULL WHEN median_income <= 1.5 THEN 1 "
    "WHEN median_income <= 3 THEN 2 WHEN median_income <= 4.5 THEN 3 "
    "WHEN median_income <= 6 THEN 4 ELSE 5 END"
)
DISTRICT = f"district AS ({DISTRICT_SQL})"
CLEAN = f"{DISTRICT},\nclean AS (SELECT * FROM district WHERE median_house_value < {TARGET_CAP:.0f})"
BINNED = f"{CLEAN},\nbinned AS (SELECT *, {STRATUM_SQL} AS stratum FROM clean)"


def hash_sql(salt: str) -> str:
    return f"md5('42:{salt}:' || CAST(district_id AS VARCHAR))"


def split_sql(out: str, source: str, salt: str, size: float, stratum: str, part: str, names: tuple[str, str]) -> str:
    """CTEs for an exact split: quota by largest remainder, rows by hash order in one window."""
    return f"""
{out}_a AS (SELECT *, {stratum} AS s_ FROM {source}),
{out}_n AS (SELECT s_, count(*) AS c FROM {out}_a GROUP BY s_),
{out}_m AS (SELECT s_, c, CAST(sum(c) OVER () AS BIGINT) AS n FROM {out}_n),
{out}_q AS (SELECT s_, c, n, n - CAST(ceil(CAST({size} AS DOUBLE) * n) AS BIGINT) AS k FROM {out}_m),
{out}_e AS (SELECT *, (c * k) // n AS whole, (c * k) % n AS rest FROM {out}_q),
{out}_r AS (SELECT *, k - CAST(sum(whole) OVER () AS BIGINT) AS spare,
            row_number() OVER (ORDER BY rest DESC, s_) AS pos FROM {out}_e),
{out}_t AS (SELECT s_, whole + CASE WHEN pos <= spare THEN 1 ELSE 0 END AS quota FROM {out}_r),
{out}_k AS (SELECT *, row_number() OVER (PARTITION BY s_ ORDER BY {hash_sql(salt)}, district_id) AS rk FROM {out}_a),
{out} AS (SELECT k.* EXCLUDE (rk, s_), CASE WHEN k.rk <= t.quota THEN '{names[0]}' ELSE '{names[1]}' END AS {part}
          FROM {out}_k k JOIN {out}_t t ON k.s_ = t.s_)"""


def fold_sql(out: str, source: str, folds: int, stratum: str) -> str:
    """CTEs for exact folds: strata dealt out card by card, rows by hash order."""
    return f"""
{out}_a AS (SELECT *, {stratum} AS s_ FROM {source}),
{out}_n AS (SELECT s_, count(*) AS c FROM {out}_a GROUP BY s_),
{out}_o AS (SELECT s_, c, CAST(sum(c) OVER (ORDER BY s_) AS BIGINT) - c AS o FROM {out}_n),
{out}_f AS (SELECT s_, f, (o + c - f + {folds} - 1) // {folds} - (o - f + {folds} - 1) // {folds} AS m
            FROM {out}_o, (SELECT unnest(range({folds})) AS f)),
{out}_c AS (SELECT s_, f, m, CAST(sum(m) OVER (PARTITION BY s_ ORDER BY f) AS BIGINT) AS upto FROM {out}_f),
{out}_k AS (SELECT *, row_number() OVER (PARTITION BY s_ ORDER BY {hash_sql("fold")}, district_id) AS rk FROM {out}_a),
{out} AS (SELECT k.* EXCLUDE (rk, s_), CAST(c.f AS INTEGER) AS fold
          FROM {out}_k k JOIN {out}_c c ON k.s_ = c.s_ AND k.rk > c.upto - c.m AND k.rk <= c.upto)"""


SPLIT = BINNED + "," + split_sql("parted", "binned", "test", 0.2, "stratum", "part", ("train", "test"))
TRAIN = SPLIT + ",\ntrain AS (SELECT * FROM parted WHERE part = 'train')"
FOLDED = TRAIN + "," + fold_sql("folded", "train", 5, "stratum")
