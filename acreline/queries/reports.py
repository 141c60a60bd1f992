"""Queries of the profiling reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from acreline.operators import profile
from acreline.operators.clean import add_stratum
from acreline.operators.cluster import hotspots
from acreline.operators.quantiles import distinct_values
from acreline.functions import merge_values
from acreline.queries.common import several_passes
from acreline.queries.registry import (
    DISTRICT,
    FEATURES,
    ID,
    NUMERIC,
    STRATUM_SQL,
    TARGET,
    hash_sql,
    query,
    r,
    round_all,
    rounded,
)
from acreline.sources.district import district, table

COLUMNS = [(ID, "bigint"), *[(c, "double") for c in NUMERIC], ("ocean_proximity", "string")]


@query(
    "profile_structure",
    f"WITH {DISTRICT}\n"
    + "\nUNION ALL ".join(
        f"SELECT '{c}' AS \"column\", '{t}' AS type, count({c}) AS non_null, count(*) AS n_rows FROM district" for c, t in COLUMNS
    ),
)
def profile_structure(spark, sf_dir):
    return profile.structure(district(spark, sf_dir))


@query(
    "profile_head",
    f"WITH {DISTRICT}\nSELECT {ID}, {', '.join(f'{r(c)} AS {c}' for c in NUMERIC)}, ocean_proximity FROM district ORDER BY {ID} LIMIT 5",
)
def profile_head(spark, sf_dir):
    return round_all(profile.head(district(spark, sf_dir), [ID], 5))


@query(
    "profile_nulls",
    f"WITH {DISTRICT}, n AS (\n"
    + "\nUNION ALL ".join(f"SELECT '{c}' AS \"column\", count(*) - count({c}) AS n_null FROM district" for c, _ in COLUMNS)
    + ")\nSELECT * FROM n WHERE n_null > 0",
)
def profile_nulls(spark, sf_dir):
    return profile.null_counts(district(spark, sf_dir))


@query(
    "profile_duplicates",
    "SELECT CAST(sum(n) AS BIGINT) AS n_rows, count(*) AS n_distinct, CAST(sum(n - 1) AS BIGINT) AS n_duplicates\n"
    "FROM (SELECT count(*) AS n, l.* FROM lineitem l GROUP BY ALL)",
)
def profile_duplicates(spark, sf_dir):
    return profile.duplicate_rows(table(spark, sf_dir, "lineitem"))


@query(
    "top_values",
    f"WITH {DISTRICT}\nSELECT {r(TARGET)} AS {TARGET}, count(*) AS n_rows FROM district GROUP BY {TARGET} ORDER BY count(*) DESC, {TARGET} LIMIT 5".replace(
        f"ORDER BY count(*) DESC, {TARGET}", f"ORDER BY n_rows DESC, district.{TARGET}"
    ),
)
def top_values(spark, sf_dir):
    return round_all(profile.top_values(district(spark, sf_dir), TARGET, 5))


@query(
    "cap_profile",
    f"WITH {DISTRICT}, m AS (SELECT max({TARGET}) AS m FROM district)\n"
    f"SELECT m AS cap_value, count(*) FILTER ({TARGET} = m) AS n_at_cap, count(*) AS n_rows, "
    f"{r(f'CAST(100 AS DOUBLE) * count(*) FILTER ({TARGET} = m) / count(*)')} AS pct_at_cap FROM district, m GROUP BY m",
)
def cap_profile(spark, sf_dir):
    return round_all(profile.cap_profile(district(spark, sf_dir), TARGET))


@query(
    "describe_numeric",
    f"WITH {DISTRICT}\n"
    + "\nUNION ALL ".join(
        f"SELECT '{c}' AS \"column\", count({c}) AS n_rows, {r(f'avg({c})')} AS mean, {r(f'stddev_samp({c})')} AS std, "
        f"{r(f'min({c})')} AS min, {r(f'quantile_cont({c}, 0.25)')} AS q25, {r(f'quantile_cont({c}, 0.5)')} AS q50, "
        f"{r(f'quantile_cont({c}, 0.75)')} AS q75, {r(f'max({c})')} AS max FROM district"
        for c in FEATURES
    ),
)
def describe_numeric(spark, sf_dir):
    return round_all(profile.describe(several_passes(district(spark, sf_dir)), FEATURES))


def _bins_sql(c: str, bins: str, source: str) -> str:
    """Counts of equal-width bins; ``source`` has the columns v, lo, hi."""
    width = f"((hi - lo) / {bins})"
    return (
        f"SELECT '{c}' AS \"column\", CAST(least(floor((v - lo) / {width}), {bins} - 1) AS INTEGER) AS bin, "
        f"{r(f'lo + CAST(least(floor((v - lo) / {width}), {bins} - 1) AS INTEGER) * {width}')} AS bin_low, count(*) AS n_rows "
        f"FROM {source} WHERE v IS NOT NULL GROUP BY 1, 2, 3"
    )


def _ranged(c: str) -> str:
    return f"(SELECT {c} AS v, min({c}) OVER () AS lo, max({c}) OVER () AS hi FROM district)"


@query(
    "histogram",
    f"WITH {DISTRICT}\n" + "\nUNION ALL ".join(_bins_sql(c, "50", _ranged(c)) for c in FEATURES),
)
def histogram(spark, sf_dir):
    return round_all(profile.histogram(several_passes(district(spark, sf_dir)), FEATURES, 50))


@query(
    "histogram_auto",
    f"WITH {DISTRICT}, s AS (SELECT min({TARGET}) AS lo, max({TARGET}) AS hi, count({TARGET}) AS n, "
    f"quantile_cont({TARGET}, 0.75) - quantile_cont({TARGET}, 0.25) AS iqr FROM district),\n"
    "b AS (SELECT lo, hi, ceil((hi - lo) / least((hi - lo) / (log2(n) + 1), 2 * iqr / pow(n, CAST(1 AS DOUBLE) / 3))) AS nb FROM s)\n"
    + _bins_sql(TARGET, "nb", f"(SELECT {TARGET} AS v, lo, hi, nb FROM district, b)"),
)
def histogram_auto(spark, sf_dir):
    return round_all(profile.histogram_auto(several_passes(district(spark, sf_dir)), TARGET))


def _density_sql(columns, cells: str) -> str:
    """The plain kernel sum over all rows."""
    one = """SELECT {out} FROM (SELECT point, lo, span, sum(exp(CAST(-0.5 AS DOUBLE) * pow((lo + point * (span / 199) - {c}) / h, 2))) / (n * h * sqrt(2 * pi())) AS density
FROM district, (SELECT CAST(unnest(range(200)) AS INTEGER) AS point), (SELECT min({c}) AS lo, max({c}) - min({c}) AS span, count({c}) AS n,
  stddev_samp({c}) * pow(count({c}), CAST(-0.2 AS DOUBLE)) AS h FROM district) WHERE {c} IS NOT NULL GROUP BY point, lo, span, n, h)"""
    parts = [one.format(c=c, out=cells.format(c=c, x=r("lo + point * (span / 199)"))) for c in columns]
    return f"WITH {DISTRICT}\n" + "\nUNION ALL ".join(parts)


@query(
    "density_curve",
    _density_sql((TARGET,), "point, {x} AS x, ROUND(density, 12) AS density"),
)
def density_curve(spark, sf_dir):
    curve = profile.density_curve(several_passes(district(spark, sf_dir)), TARGET)
    return curve.select("point", rounded("x").alias("x"), F.round("density", 12).alias("density"))


@query("density_curves", _density_sql(NUMERIC, "'{c}' AS \"column\", point, {x} AS x, ROUND(density * span, 9) AS range_density"))
def density_curves(spark, sf_dir):
    """All numeric columns; densities as they are where a column's range counts as 1."""
    curves = profile.density_curves(several_passes(district(spark, sf_dir)), NUMERIC)
    span = F.max("x").alias("high"), F.min("x").alias("low")
    spans = curves.groupBy("column").agg(*span).select("column", (F.col("high") - F.col("low")).alias("span"))
    return curves.join(spans, "column").select("column", "point", rounded("x").alias("x"), F.round(F.col("density") * F.col("span"), 9).alias("range_density"))


@query("bin_counts", f"WITH {DISTRICT}\nSELECT CAST({STRATUM_SQL} AS INTEGER) AS stratum, count(*) AS n_rows FROM district GROUP BY 1")
def bin_counts(spark, sf_dir):
    return add_stratum(district(spark, sf_dir)).groupBy("stratum").agg(F.count(F.lit(1)).alias("n_rows"))


@query(
    "cardinality",
    f"WITH {DISTRICT}\n"
    + "\nUNION ALL ".join(
        f"SELECT '{c}' AS \"column\", count(DISTINCT {c}) AS n_distinct FROM district" for c in ("ocean_proximity", "housing_median_age", "longitude")
    ),
)
def cardinality(spark, sf_dir):
    return profile.cardinality(district(spark, sf_dir), ["ocean_proximity", "housing_median_age", "longitude"])


@query(
    "category_share",
    f"WITH {DISTRICT}\nSELECT ocean_proximity, count(*) AS n_rows, "
    f"{r('CAST(100 AS DOUBLE) * count(*) / (SELECT count(*) FROM district)')} AS pct FROM district WHERE ocean_proximity IS NOT NULL GROUP BY 1",
)
def category_share(spark, sf_dir):
    return round_all(profile.category_share(district(spark, sf_dir), "ocean_proximity"))


def _corr_sql() -> str:
    parts = []
    for a in NUMERIC:
        for b in NUMERIC:
            value = f"CASE WHEN var_pop({a}) > 0 THEN CAST(1 AS DOUBLE) END" if a == b else r(f"corr({a}, {b})")
            parts.append(f"SELECT '{a}' AS column_a, '{b}' AS column_b, {value} AS r FROM district")
    return "\nUNION ALL ".join(parts)


@query("corr_matrix", f"WITH {DISTRICT}\n{_corr_sql()}")
def corr_matrix(spark, sf_dir):
    return round_all(profile.correlations(several_passes(district(spark, sf_dir)), NUMERIC))


RATIOS = {
    "rooms_per_house": ("total_rooms", "households"),
    "bedrooms_ratio": ("total_bedrooms", "total_rooms"),
    "people_per_house": ("population", "households"),
}


@query(
    "eda_ratio_corr",
    f"WITH {DISTRICT}, w AS (SELECT *, "
    + ", ".join(f"{a} / NULLIF({b}, 0) AS {n}" for n, (a, b) in RATIOS.items())
    + " FROM district)\n"
    + "\nUNION ALL ".join(f"SELECT '{c}' AS \"column\", {r(f'corr({c}, {TARGET})')} AS r FROM w" for c in (*FEATURES, *RATIOS)),
)
def eda_ratio_corr(spark, sf_dir):
    return round_all(profile.target_correlations(district(spark, sf_dir), TARGET, FEATURES, RATIOS))


@query(
    "target_corr_list",
    f"WITH {DISTRICT}, w AS (SELECT *, "
    + ", ".join(f"{a} / NULLIF({b}, 0) AS {n}" for n, (a, b) in RATIOS.items())
    + " FROM district)\n"
    + "\nUNION ALL ".join(f"SELECT '{c}' AS \"column\", {r(f'corr({c}, {TARGET})')} AS r FROM w" for c in (*FEATURES, *RATIOS, TARGET)),
)
def target_corr_list(spark, sf_dir):
    """The whole list, the target's own row included."""
    return round_all(profile.target_correlations(district(spark, sf_dir), TARGET, FEATURES, RATIOS, own=True))


PAIR_COLUMNS = ("median_house_value", "median_income", "total_rooms", "housing_median_age")


@query(
    "pair_sample",
    f"WITH {DISTRICT}\nSELECT {ID}, {', '.join(f'{r(c)} AS {c}' for c in PAIR_COLUMNS)} FROM district "
    f"ORDER BY {hash_sql('pairs')}, CAST({ID} AS VARCHAR) LIMIT 1000",
)
def pair_sample(spark, sf_dir):
    return round_all(profile.pair_sample(district(spark, sf_dir), PAIR_COLUMNS, [ID], 1000))


def _pair_counts_sql(columns, bins: int) -> str:
    ranges = ", ".join(f"min({c}) AS l_{c}, max({c}) - min({c}) AS w_{c}" for c in columns)
    place = ", ".join(f"CASE WHEN {c} IS NOT NULL THEN CAST(least(floor(({c} - l_{c}) / (w_{c} / {bins})), {bins - 1}) AS INTEGER) END AS b_{c}" for c in columns)
    parts = [
        f"SELECT '{a}' AS column_a, '{b}' AS column_b, b_{a} AS bin_a, b_{b} AS bin_b, count(*) AS n_rows FROM p WHERE b_{a} IS NOT NULL AND b_{b} IS NOT NULL GROUP BY ALL"
        for i, a in enumerate(columns)
        for b in columns[i + 1 :]
    ]
    return f"WITH {DISTRICT}, g AS (SELECT {ranges} FROM district), p AS (SELECT {place} FROM district, g)\n" + "\nUNION ALL ".join(parts)


@query("pair_counts", _pair_counts_sql(PAIR_COLUMNS, 20))
def pair_counts(spark, sf_dir):
    """The scatter matrix of all rows, as counts."""
    return profile.pair_counts(several_passes(district(spark, sf_dir)), PAIR_COLUMNS, 20)


@query("pair_rows", f"WITH {DISTRICT}\nSELECT {ID}, {', '.join(f'{r(c)} AS {c}' for c in PAIR_COLUMNS)} FROM district")
def pair_rows(spark, sf_dir):
    return round_all(profile.pair_rows(district(spark, sf_dir), PAIR_COLUMNS, [ID]))


@query(
    "box_stats",
    f"""WITH {DISTRICT}, q AS (SELECT ocean_proximity AS g, quantile_cont({TARGET}, 0.25) AS q25, quantile_cont({TARGET}, 0.5) AS q50,
  quantile_cont({TARGET}, 0.75) AS q75 FROM district WHERE ocean_proximity IS NOT NULL GROUP BY 1),
j AS (SELECT d.ocean_proximity, d.{TARGET} AS v, q25, q50, q75,
  d.{TARGET} BETWEEN q25 - 1.5 * (q75 - q25) AND q75 + 1.5 * (q75 - q25) AS inside FROM district d JOIN q ON d.ocean_proximity = q.g)
SELECT ocean_proximity, {r('q25')} AS q25, {r('q50')} AS q50, {r('q75')} AS q75, count(*) AS n_rows,
  {r('least(min(v) FILTER (inside), q25)')} AS whisker_low, {r('greatest(max(v) FILTER (inside), q75)')} AS whisker_high,
  count(*) FILTER (NOT inside) AS n_outliers
FROM j GROUP BY ocean_proximity, q25, q50, q75""",
)
def box_stats(spark, sf_dir):
    return round_all(profile.box_stats(several_passes(district(spark, sf_dir)), "ocean_proximity", TARGET))


@query(
    "geo_grid",
    f"WITH {DISTRICT}\nSELECT CAST(floor(longitude / 0.5) AS BIGINT) AS cell_lon, CAST(floor(latitude / 0.5) AS BIGINT) AS cell_lat, "
    f"count(*) AS n_rows, {r('sum(population)')} AS total_size, {r(f'avg({TARGET})')} AS mean_value FROM district GROUP BY 1, 2",
)
def geo_grid(spark, sf_dir):
    return round_all(profile.geo_grid(district(spark, sf_dir), "longitude", "latitude", "population", TARGET, 0.5))


@query("geo_hotspots")
def geo_hotspots(spark, sf_dir):
    df = several_passes(district(spark, sf_dir))
    return round_all(hotspots(df).select(ID, "longitude", "latitude", "max_similarity"))


@query(
    "category_vocab",
    f"WITH {DISTRICT}\nSELECT DISTINCT CASE WHEN ocean_proximity = 'ISLAND' THEN 'NEAR OCEAN' ELSE ocean_proximity END AS category "
    "FROM district WHERE ocean_proximity IS NOT NULL",
)
def category_vocab(spark, sf_dir):
    return distinct_values(district(spark, sf_dir), merge_values(F.col("ocean_proximity"), {"ISLAND": "NEAR OCEAN"}))
