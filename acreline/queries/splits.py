"""Queries of splits, folds, gates and metrics."""

from __future__ import annotations

from pyspark.sql import functions as F

from acreline.operators import evaluate, split
from acreline.queries.common import SCORERS, binned, clean, folded, parted, scored, scored_by_models, several_passes
from acreline.queries.registry import BINNED, CLEAN, FOLDED, ID, SPLIT, TARGET, TRAIN, fold_sql, hash_sql, query, r, round_all, split_sql
from acreline.session import fresh_dir
from acreline.sources import readers, writers

# --- splits ----------------------------------------------------------------------------------


@query(
    "strata_gate",
    f"WITH {BINNED}, c AS (SELECT stratum, count(*) AS n FROM binned GROUP BY 1)\n"
    "SELECT CAST(coalesce(sum(n) FILTER (stratum IS NULL), 0) AS BIGINT) AS rows_outside, count(*) FILTER (stratum IS NOT NULL) AS strata, "
    "coalesce(min(n) FILTER (stratum IS NOT NULL), 0) AS smallest, "
    "coalesce(sum(n) FILTER (stratum IS NULL), 0) = 0 AND coalesce(min(n) FILTER (stratum IS NOT NULL), 0) >= 3 AS passed FROM c",
)
def strata_gate(spark, sf_dir):
    return split.strata_report(binned(spark, sf_dir), "stratum", 3)


@query("stratified_split", f"WITH {SPLIT}\nSELECT {ID}, CAST(stratum AS INTEGER) AS stratum, part FROM parted")
def stratified_split(spark, sf_dir):
    return parted(spark, sf_dir).select(ID, "stratum", "part")


@query(
    "random_split",
    f"WITH {CLEAN},{split_sql('parted', 'clean', 'test', 0.2, '0', 'part', ('train', 'test'))}\nSELECT {ID}, part FROM parted",
)
def random_split(spark, sf_dir):
    return split.random_split(several_passes(clean(spark, sf_dir)), [ID]).select(ID, "part")


@query(
    "holdout_split",
    f"WITH {TRAIN},{split_sql('held', 'train', 'val', 0.25, 'stratum', 'val_part', ('fit', 'val'))}\n"
    f"SELECT {ID}, CAST(stratum AS INTEGER) AS stratum, val_part FROM held",
)
def holdout_split(spark, sf_dir):
    train = several_passes(parted(spark, sf_dir).filter("part = 'train'"))
    held = split.stratified_split(train, "stratum", [ID], 0.25, salt="val", part_col="val_part", names=("fit", "val"))
    return held.select(ID, "stratum", "val_part")


@query("stratified_kfold", f"WITH {FOLDED}\nSELECT {ID}, CAST(stratum AS INTEGER) AS stratum, fold FROM folded")
def stratified_kfold(spark, sf_dir):
    return folded(spark, sf_dir).select(ID, "stratum", "fold")


@query("kfold", f"WITH {CLEAN},{fold_sql('folded', 'clean', 5, '0')}\nSELECT {ID}, fold FROM folded")
def kfold(spark, sf_dir):
    return split.kfold(several_passes(clean(spark, sf_dir)), 5, None, [ID]).select(ID, "fold")


@query(
    "fold_sizes",
    f"WITH {FOLDED}\nSELECT fold, count(*) AS n_val, (SELECT count(*) FROM folded) - count(*) AS n_train FROM folded GROUP BY fold",
)
def fold_sizes(spark, sf_dir):
    return split.fold_sizes(folded(spark, sf_dir))


@query(
    "split_audit",
    f"WITH {SPLIT}, c AS (SELECT part, stratum, count(*) AS n_rows FROM parted GROUP BY 1, 2)\n"
    f"SELECT part, CAST(stratum AS INTEGER) AS stratum, n_rows, {r('CAST(n_rows AS DOUBLE) / sum(n_rows) OVER (PARTITION BY part)')} AS share FROM c",
)
def split_audit(spark, sf_dir):
    return round_all(split.split_audit(parted(spark, sf_dir), "part", "stratum"))


@query(
    "threshold_split",
    f"WITH {CLEAN}\nSELECT {ID}, CASE WHEN CAST('0x' || substr({hash_sql('test')}, 1, 13) AS BIGINT) / CAST({16**13} AS DOUBLE) < CAST(0.8 AS DOUBLE) "
    "THEN 'train' ELSE 'test' END AS part FROM clean",
)
def threshold_split(spark, sf_dir):
    return split.threshold_split(clean(spark, sf_dir), [ID]).select(ID, "part")


# --- metrics ---------------------------------------------------------------------------------

LINE = "CAST(20000 AS DOUBLE) + CAST(42000 AS DOUBLE) * median_income"


def metrics_sql(y: str = TARGET, p: str = "p") -> str:
    error = f"({p} - {y})"
    return (
        f"count(*) AS n_rows, CAST(0 AS BIGINT) AS n_bad, {r(f'sqrt(avg({error} * {error}))', 4)} AS rmse, "
        f"{r(f'avg(abs({error}))', 4)} AS mae, {r(f'1 - sum({error} * {error}) / (var_pop({y}) * count(*))', 4)} AS r2, "
        f"{r(f'avg({error} * {error})', 1)} AS mse"
    )


def _metrics_rounded(df):
    ones = [c for c in df.columns if "mse" in c and "rmse" not in c]
    rest = [c for c, t in df.dtypes if t == "double" and c not in ones]
    return df.withColumns(
        {**{c: F.round(c, 1) + F.lit(0.0) for c in ones}, **{c: F.round(c, 4) + F.lit(0.0) for c in rest}}
    )


@query("regression_metrics", f"WITH {SPLIT}, s AS (SELECT *, {LINE} AS p FROM parted WHERE part = 'test')\nSELECT {metrics_sql()} FROM s")
def regression_metrics(spark, sf_dir):
    test = scored(parted(spark, sf_dir).filter("part = 'test'"))
    return _metrics_rounded(evaluate.regression_metrics(test, TARGET))


MODELS_SQL = "m(model, a, b) AS (VALUES " + ", ".join(
    f"('{m}', CAST({a} AS DOUBLE), CAST({b} AS DOUBLE))" for m, a, b in SCORERS
) + ")"


@query(
    "metrics_by_fold",
    f"WITH {FOLDED}, {MODELS_SQL}, s AS (SELECT f.*, model, a + b * median_income AS p FROM folded f, m)\n"
    f"SELECT model, fold, {metrics_sql()} FROM s GROUP BY model, fold",
)
def metrics_by_fold(spark, sf_dir):
    scores = evaluate.regression_metrics(scored_by_models(folded(spark, sf_dir)), TARGET, by=["model", "fold"])
    return _metrics_rounded(scores)


FOLD_SCORES = f"""{FOLDED}, {MODELS_SQL}, s AS (SELECT f.*, model, a + b * median_income AS p FROM folded f, m),
x AS (SELECT model, fold, sqrt(avg((p - {TARGET}) * (p - {TARGET}))) AS rmse, avg(abs(p - {TARGET})) AS mae,
  1 - sum((p - {TARGET}) * (p - {TARGET})) / (var_pop({TARGET}) * count(*)) AS r2,
  avg((p - {TARGET}) * (p - {TARGET})) AS mse FROM s GROUP BY model, fold)"""
SUMMARY_COLUMNS = ", ".join(
    f"{r(f'{fn}({m})', 1 if m == 'mse' else 4)} AS validation_{k}_{m}"
    for m in ("rmse", "mae", "r2", "mse")
    for k, fn in (("mean", "avg"), ("std", "stddev_pop"))
)


def _summary(spark, sf_dir):
    scores = evaluate.regression_metrics(scored_by_models(folded(spark, sf_dir)), TARGET, by=["model", "fold"])
    return evaluate.cv_summary(scores)


@query("cv_summary", f"WITH {FOLD_SCORES}\nSELECT model, {SUMMARY_COLUMNS} FROM x GROUP BY model")
def cv_summary(spark, sf_dir):
    return _metrics_rounded(_summary(spark, sf_dir))


@query(
    "quality_gate",
    f"WITH {FOLD_SCORES}\nSELECT model, {r('avg(rmse)', 4)} AS validation_mean_rmse, avg(rmse) <= 60000 AS passed FROM x GROUP BY model",
)
def quality_gate(spark, sf_dir):
    gated = evaluate.quality_gate(_summary(spark, sf_dir), "rmse", 60000.0)
    return _metrics_rounded(gated.select("model", "validation_mean_rmse", "passed"))


TEST_SCORES = f"{SPLIT}, {MODELS_SQL}, s AS (SELECT t.*, model, a + b * median_income AS p FROM parted t, m WHERE part = 'test')"


def _test_scores(spark, sf_dir):
    test = scored_by_models(parted(spark, sf_dir).filter("part = 'test'"))
    return evaluate.regression_metrics(test, TARGET, by=["model"])


@query(
    "leaderboard",
    f"WITH {TEST_SCORES}, x AS (SELECT model, {metrics_sql()} FROM s GROUP BY model)\n"
    "SELECT *, CAST(rank() OVER (ORDER BY rmse) AS INTEGER) AS rank FROM x",
)
def leaderboard(spark, sf_dir):
    return _metrics_rounded(evaluate.leaderboard(_test_scores(spark, sf_dir)))


@query(
    "write_metrics",
    f"WITH {TEST_SCORES}\nSELECT 'test' AS set_name, model, {metrics_sql()} FROM s GROUP BY model",
)
def write_metrics(spark, sf_dir):
    path = fresh_dir(spark, "metrics")
    scores = _test_scores(spark, sf_dir).withColumn("set_name", F.lit("test"))
    writers.write_metrics(scores, path)
    return _metrics_rounded(readers.read_file(spark, path, scores.schema, "json"))


@query("batch_telemetry", f"WITH {CLEAN}\nSELECT count(*) AS n_rows, CAST(0 AS BIGINT) AS n_bad, TRUE AS timed FROM clean")
def batch_telemetry(spark, sf_dir):
    path = fresh_dir(spark, "telemetry")
    seen = evaluate.run_observed(
        scored(clean(spark, sf_dir)),
        lambda df: writers.write_predictions(writers.stamp(df, "prediction", "income_line_1", "0.1"), path),
    )
    timed = seen["seconds_total"] > 0 and seen["seconds_per_row"] > 0
    return spark.createDataFrame([(seen["n_rows"], seen["n_bad"], timed)], "n_rows bigint, n_bad bigint, timed boolean")
