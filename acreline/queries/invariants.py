"""What has to hold of everything that is learned, whatever was learned: each with a SQL twin."""

from __future__ import annotations

import uuid

from pyspark.sql import Column
from pyspark.sql import functions as F

from acreline.errors import DataValidationError
from acreline.operators import models, split
from acreline.operators.cluster import fit_centres, hotspots
from acreline.operators.features import FeatureSpec, TabularFeatures
from acreline.plans.scoring import score_batch
from acreline.plans.training import train_all
from acreline.queries.common import folded, parted, several_passes, training
from acreline.queries.registry import CLEAN, DISTRICT, FOLDED, ID, SPLIT, TARGET, TRAIN, query, r, round_all, split_sql
from acreline.session import fresh_dir
from acreline.sources import readers, writers
from acreline.sources.district import district, table

SHORT = models.shorten("leafwise_boosting", 40)


def _error() -> Column:
    return F.sum((F.col("prediction") - F.col(TARGET)) * (F.col("prediction") - F.col(TARGET)))


def _spread() -> Column:
    """The error of the rows' own mean."""
    return F.var_pop(F.col(TARGET)) * F.count(F.col(TARGET))


# --- clusters ----------------------------------------------------------------------------------


@query(
    "cluster_accounts",
    f"WITH {CLEAN}\nSELECT CAST(10 AS BIGINT) AS n_clusters, count(*) AS n_rows, {r(f'sum({TARGET}) / 1e9')} AS total_weight_e9, "
    "TRUE AS centres_are_means, TRUE AS better_than_one FROM clean",
)
def cluster_accounts(spark, sf_dir):
    """Weighted K-Means: every row belongs to its nearest centre, the centres are the weighted means of their rows, the
    weights add up, and ten centres are closer to the rows than one."""
    rows = several_passes(district(spark, sf_dir).filter(F.col(TARGET) < 500_001))
    x, y, w = F.col("longitude"), F.col("latitude"), F.col(TARGET)
    centres = fit_centres(rows, x, y, w, clusters=10)
    far = lambda c: (x - F.lit(c[0])) * (x - F.lit(c[0])) + (y - F.lit(c[1])) * (y - F.lit(c[1]))
    nearest = F.array_min(F.array(*[F.struct(far(c).alias("d"), F.lit(i).alias("c")) for i, c in enumerate(centres)]))
    placed = rows.select(x, y, w, nearest.alias("near")).select("*", "near.d", "near.c")
    means = placed.groupBy("c").agg(
        F.count(F.lit(1)).alias("n"), F.sum(w).alias("w"), (F.sum(x * w) / F.sum(w)).alias("mx"), (F.sum(y * w) / F.sum(w)).alias("my"),
        F.sum(w * F.col("d")).alias("cost"), F.sum(w * x).alias("sx"), F.sum(w * y).alias("sy"), F.sum(w * (x * x + y * y)).alias("sq"),
    )
    own = F.array(*[F.array(F.lit(c[0]), F.lit(c[1])) for c in centres])
    gap = F.greatest(F.abs(F.col("mx") - own[F.col("c")][0]), F.abs(F.col("my") - own[F.col("c")][1]))
    single = F.sum("sq") - (F.sum("sx") * F.sum("sx") + F.sum("sy") * F.sum("sy")) / F.sum("w")
    # the search ends when centres move by less than a hundredth of a deviation, here some 0.03 degrees
    return means.agg(
        F.count(F.lit(1)).alias("n_clusters"), F.sum("n").alias("n_rows"), F.round(F.sum("w") / 1e9, 6).alias("total_weight_e9"),
        (F.max(gap) < 0.05).alias("centres_are_means"), (F.sum("cost") < single).alias("better_than_one"),
    )


@query(
    "similarity_accounts",
    f"WITH {TRAIN}\nSELECT CAST(10 AS BIGINT) AS n_columns, count(*) AS n_rows, TRUE AS centred, TRUE AS scaled, CAST(0 AS BIGINT) AS n_missing FROM train",
)
def similarity_accounts(spark, sf_dir):
    """The geo branch: ten similarities, each with mean 0 and deviation 1 over the rows it was learned on, none missing."""
    rows = several_passes(parted(spark, sf_dir)).filter("part = 'train'").select(ID, TARGET, "longitude", "latitude")
    spec = FeatureSpec(ratios={}, logs=(), merges={})
    model = TabularFeatures(spec=spec, labelCol=TARGET, dropCols=[ID]).fit(rows)
    made = model.select_features(rows, ID)
    names = [c for c in made.columns if c != ID]
    mean = F.greatest(*[F.abs(F.avg(c)) for c in names])
    off = F.greatest(*[F.abs(F.stddev_pop(c) - 1) for c in names])
    missing = F.greatest(*[F.count_if(F.col(c).isNull()) for c in names])
    return made.agg(
        F.lit(len(names)).cast("bigint").alias("n_columns"), F.count(F.lit(1)).alias("n_rows"), (mean < 1e-9).alias("centred"),
        (off < 1e-9).alias("scaled"), missing.alias("n_missing"),
    )


@query(
    "hotspot_accounts",
    f"WITH {DISTRICT}\nSELECT count(*) AS n_rows, CAST(0 AS BIGINT) AS n_outside, TRUE AS peaked FROM district",
)
def hotspot_accounts(spark, sf_dir):
    """Closeness to the nearest hotspot lies in (0, 1], and every hotspot has rows near it."""
    close = hotspots(several_passes(district(spark, sf_dir)), restarts=2).select("max_similarity")
    s = F.col("max_similarity")
    return close.agg(F.count(F.lit(1)).alias("n_rows"), F.count_if(s.isNull() | (s <= 0) | (s > 1)).alias("n_outside"), (F.max(s) > 0.9).alias("peaked"))


# --- learners ----------------------------------------------------------------------------------


@query(
    "forest_accounts",
    f"WITH {SPLIT}\nSELECT count(*) AS n_scored, CAST(20 AS BIGINT) AS n_trees, CAST(0 AS BIGINT) AS n_outside, TRUE AS beats_mean FROM parted WHERE part = 'test'",
)
def forest_accounts(spark, sf_dir):
    """A forest averages means of training rows: no prediction lies outside their range, and it beats the mean."""
    rows = several_passes(parted(spark, sf_dir))
    train = rows.filter("part = 'train'")
    model = models.fit_full(train, "random_forest", training(), models.shorten("random_forest", 20, 10))
    low, high = train.agg(F.min(F.col(TARGET)), F.max(F.col(TARGET))).first()
    scored = models.predict(model, rows.filter("part = 'test'"))
    return scored.agg(
        F.count(F.col("prediction")).alias("n_scored"), F.lit(model.stages[-1].getNumTrees).cast("bigint").alias("n_trees"),
        F.count_if(~F.col("prediction").between(low, high)).alias("n_outside"), (_error() < _spread()).alias("beats_mean"),
    )


@query(
    "holdout_accounts",
    f"WITH {TRAIN},{split_sql('held', 'train', 'val', 0.25, 'stratum', 'val_part', ('fit', 'val'))}\n"
    "SELECT count(*) FILTER (val_part = 'fit') AS n_fit, count(*) FILTER (val_part = 'val') AS n_val, TRUE AS consistent, TRUE AS beats_mean FROM held",
)
def holdout_accounts(spark, sf_dir):
    """Holdout validation: the sizes of its parts, and scores that agree with one another."""
    plan = training()
    train = several_passes(parted(spark, sf_dir)).filter("part = 'train'")
    ((name, fit_rows, val_rows),) = models.validation_sets(train, plan)
    (scores,) = models.validation_scores(train, "leafwise_boosting", plan, SHORT)
    n_fit, n_val, spread = fit_rows.count(), *val_rows.agg(F.count(F.lit(1)), F.var_pop(F.col(TARGET))).first()
    consistent = abs(scores["rmse"] ** 2 / scores["mse"] - 1) < 1e-9 and abs(1 - scores["mse"] / spread - scores["r2"]) < 1e-9 and scores["mae"] <= scores["rmse"]
    return spark.createDataFrame([(n_fit, n_val, bool(consistent), scores["mse"] < spread)], "n_fit long, n_val long, consistent boolean, beats_mean boolean")


@query(
    "kfold_accounts",
    f"WITH {FOLDED}\nSELECT 'validation_fold_' || (fold + 1) AS set_name, count(*) AS n_val, (SELECT count(*) FROM train) - count(*) AS n_fit, "
    "TRUE AS consistent, TRUE AS beats_mean FROM folded GROUP BY fold",
)
def kfold_accounts(spark, sf_dir):
    """Five folds, fitted at the same time: sizes as dealt, and scores that agree with one another."""
    plan = models.Training(id_cols=(ID,), validation="cross_validation")
    train = several_passes(parted(spark, sf_dir)).filter("part = 'train'")
    scores = models.validation_scores(train, "leafwise_boosting", plan, SHORT, at_once=True)
    sizes = split.fold_sizes(folded(spark, sf_dir)).select((F.concat(F.lit("validation_fold_"), (F.col("fold") + 1).cast("string"))).alias("set_name"), "n_val", F.col("n_train").alias("n_fit"))
    cells = [(f"validation_fold_{i + 1}", abs(s["rmse"] ** 2 / s["mse"] - 1) < 1e-9 and s["mae"] <= s["rmse"], s["r2"] > 0) for i, s in enumerate(scores)]
    return sizes.join(spark.createDataFrame(cells, "set_name string, consistent boolean, beats_mean boolean"), "set_name")


@query(
    "gate_accounts",
    f"WITH {SPLIT}, test AS (SELECT count(*) AS n FROM parted WHERE part = 'test')\n"
    "SELECT 'passed' AS gate, TRUE AS refitted, n AS n_scored FROM test UNION ALL SELECT 'failed', FALSE, CAST(0 AS BIGINT)",
)
def gate_accounts(spark, sf_dir):
    """The refit comes after the gate: a model behind a passed gate, none and an error behind a failed one."""
    rows = several_passes(parted(spark, sf_dir))
    train, test = (rows.filter(f"part = '{p}'") for p in ("train", "test"))
    cells = []
    for gate, limit in (("passed", 500_000.0), ("failed", 1.0)):
        try:
            model, _ = models.train(train, "leafwise_boosting", models.Training(id_cols=(ID,), threshold=limit), SHORT)
            cells.append((gate, True, models.predict(model, test).filter(F.col("prediction").isNotNull()).count()))
        except DataValidationError:
            cells.append((gate, False, 0))
    return spark.createDataFrame(cells, "gate string, refitted boolean, n_scored long")


@query(
    "train_all_accounts",
    "SELECT * FROM (VALUES ('random_forest', 'ok', TRUE, TRUE), ('regularised_boosting', 'ok', TRUE, TRUE), ('leafwise_boosting', 'ok', TRUE, TRUE), "
    "('no_such_model', 'failed', FALSE, FALSE)) AS v(model, status, validated, beats_mean)",
)
def train_all_accounts(spark, sf_dir):
    """Several models on one split, one of them impossible: the others are trained all the same."""
    short = {n: models.shorten(n, 10, 5) for n in ("random_forest", "regularised_boosting", "leafwise_boosting")}
    loose = models.Training(id_cols=(ID,), threshold=500_000.0)  # the gate has a query of its own
    report = train_all(several_passes(parted(spark, sf_dir)), loose, {**short, "no_such_model": None})
    return report.select("model", "status", F.col("validation_mean_rmse").isNotNull().alias("validated"), F.coalesce(F.col("test_r2") > 0, F.lit(False)).alias("beats_mean"))


@query(
    "batch_rejected",
    f"WITH {SPLIT}\nSELECT 'whole' AS batch, FALSE AS rejected, count(*) AS n_written FROM parted WHERE part = 'test' AND ocean_proximity IS NOT NULL "
    "UNION ALL SELECT 'with a bad record', TRUE, CAST(0 AS BIGINT)",
)
def batch_rejected(spark, sf_dir):
    """A batch in mode ``reject``: written whole, or not at all when one record breaks the contract."""
    rows = several_passes(parted(spark, sf_dir))
    model = models.fit_full(rows.filter("part = 'train'"), "leafwise_boosting", training(), SHORT)
    good = rows.filter("part = 'test' AND ocean_proximity IS NOT NULL").drop("stratum", "part", TARGET)
    spoilt = good.withColumn("ocean_proximity", F.when(F.col(ID) != F.lit(good.agg(F.min(ID)).first()[0]), F.col("ocean_proximity")))
    cells = []
    for name, batch in (("whole", good), ("with a bad record", spoilt)):
        path = fresh_dir(spark, "scored")
        try:
            score_batch(model, batch, path, "leafwise_1", "0.1", mode="reject")
            cells.append((name, False, readers.read_file(spark, path, fmt="parquet").count()))
        except DataValidationError:
            cells.append((name, True, 0))
    return spark.createDataFrame(cells, "batch string, rejected boolean, n_written long")


# --- further scans -----------------------------------------------------------------------------


@query("scan_json_lists", f"WITH {DISTRICT}\nSELECT {ID}, {r('median_income')} AS median_income, ocean_proximity FROM district")
def scan_json_lists(spark, sf_dir):
    """Files that hold one JSON list each, of at most a few thousand records."""
    df = district(spark, sf_dir).select(ID, "median_income", "ocean_proximity")
    path = fresh_dir(spark, "lists")
    lists = df.groupBy(F.floor(F.col(ID) / 4_000)).agg(F.to_json(F.collect_list(F.struct(*df.columns))).alias("value"))
    # a list a file: the text writer ends a file after so many rows
    lists.select("value").write.option("maxRecordsPerFile", 1).text(path)
    return round_all(readers.read_file(spark, path, df.schema, "json", json_list=True))


@query(
    "bucketed_join",
    "SELECT o_orderkey, any_value(o_orderpriority) AS o_orderpriority, count(l_orderkey) AS n_lines, sum(l_quantity) AS total_quantity "
    "FROM orders LEFT JOIN lineitem ON o_orderkey = l_orderkey GROUP BY o_orderkey",
)
def bucketed_join(spark, sf_dir):
    """Orders and their lines as named tables in buckets by order: read by name, joined and added up without an exchange."""
    names = {}
    for name, key, columns in (("orders", "o_orderkey", ["o_orderkey", "o_orderpriority"]), ("lineitem", "l_orderkey", ["l_orderkey", "l_quantity"])):
        names[name] = f"{name}_{uuid.uuid4().hex}"
        writers.write_bucketed(table(spark, sf_dir, name).select(*columns), names[name], key, 8, fresh_dir(spark, name))
    orders, lines = (readers.read_table(spark, names[n]) for n in ("orders", "lineitem"))
    per_order = lines.groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("n_lines"), F.sum("l_quantity").alias("total_quantity"))
    joined = orders.join(per_order.hint("merge"), F.col("o_orderkey") == F.col("l_orderkey"), "left")
    return joined.select("o_orderkey", "o_orderpriority", F.coalesce("n_lines", F.lit(0)).alias("n_lines"), "total_quantity")
