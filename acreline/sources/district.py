"""The district table: the ten housing columns derived from orders, customer and lineitem."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# The same derivation as SQL, for comparing engines. Literals are cast because a bare 1.5 is DECIMAL.
DISTRICT_SQL = """
SELECT o.o_orderkey AS district_id,
  CAST(-124.0 AS DOUBLE) + CAST(o.o_custkey % 1000 AS DOUBLE) / CAST(100 AS DOUBLE) AS longitude,
  CAST(32.5 AS DOUBLE) + CAST(o.o_orderkey % 950 AS DOUBLE) / CAST(100 AS DOUBLE) AS latitude,
  CAST(1 + o.o_orderkey % 52 AS DOUBLE) AS housing_median_age,
  l.total_rooms, l.total_bedrooms, l.population, l.households,
  (c.c_acctbal + CAST(1000 AS DOUBLE)) / CAST(1000 AS DOUBLE) AS median_income,
  LEAST(CAST(500001 AS DOUBLE),
        CAST(20000 AS DOUBLE)
        + CAST(42000 AS DOUBLE) * ((c.c_acctbal + CAST(1000 AS DOUBLE)) / CAST(1000 AS DOUBLE))
        + CAST(0.15 AS DOUBLE) * o.o_totalprice) AS median_house_value,
  CASE o.o_orderpriority
    WHEN '1-URGENT' THEN '<1H OCEAN' WHEN '2-HIGH' THEN 'INLAND'
    WHEN '3-MEDIUM' THEN 'NEAR OCEAN' WHEN '4-NOT SPECIFIED' THEN 'NEAR BAY'
    ELSE CASE WHEN o.o_orderkey % 50 = 0 THEN 'ISLAND'
              WHEN o.o_orderkey % 50 = 1 THEN NULL ELSE 'INLAND' END
  END AS ocean_proximity
FROM orders o
JOIN customer c ON o.o_custkey = c.c_custkey
LEFT JOIN (
  SELECT l_orderkey, SUM(l_quantity) AS total_rooms,
         SUM(l_quantity) FILTER (WHERE l_returnflag = 'R') AS total_bedrooms,
         CAST(SUM(l_linenumber) AS DOUBLE) AS population,
         CAST(COUNT(*) AS DOUBLE) AS households
  FROM lineitem GROUP BY l_orderkey) l ON o.o_orderkey = l.l_orderkey
""".strip()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def district(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per order. Lines combine per order before they meet the orders, so both joins are on
    unique keys of one side."""
    orders, customer, lines = (table(spark, sf_dir, n) for n in ("orders", "customer", "lineitem"))
    per_order = lines.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(
        F.sum("l_quantity").alias("total_rooms"),
        F.sum(F.when(F.col("l_returnflag") == "R", F.col("l_quantity"))).alias("total_bedrooms"),
        F.sum("l_linenumber").cast("double").alias("population"),
        F.count(F.lit(1)).cast("double").alias("households"),
    )
    accounts = customer.select(F.col("c_custkey").alias("o_custkey"), "c_acctbal")
    key = F.col("o_orderkey")
    income = (F.col("c_acctbal") + 1000.0) / 1000.0
    value = F.lit(20000.0) + F.lit(42000.0) * income + F.lit(0.15) * F.col("o_totalprice")
    priority = F.col("o_orderpriority")
    place = (
        F.when(priority == "1-URGENT", "<1H OCEAN")
        .when(priority == "2-HIGH", "INLAND")
        .when(priority == "3-MEDIUM", "NEAR OCEAN")
        .when(priority == "4-NOT SPECIFIED", "NEAR BAY")
        .when(key % 50 == 0, "ISLAND")
        .when(key % 50 != 1, "INLAND")
    )
    return (
        orders.join(accounts, "o_custkey")
        .join(per_order, "o_orderkey", "left")
        .select(
            key.alias("district_id"),
            (F.lit(-124.0) + (F.col("o_custkey") % 1000).cast("double") / 100.0).alias("longitude"),
            (F.lit(32.5) + (key % 950).cast("double") / 100.0).alias("latitude"),
            (key % 52 + 1).cast("double").alias("housing_median_age"),
            "total_rooms",
            "total_bedrooms",
            "population",
            "households",
            income.alias("median_income"),
            F.least(F.lit(500001.0), value).alias("median_house_value"),
            place.alias("ocean_proximity"),
        )
    )
