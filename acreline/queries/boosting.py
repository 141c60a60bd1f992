"""Queries of the boosted trees with penalties, and a first tree in SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from acreline.operators import models
from acreline.operators.boosting import GRADIENT, Boosting, HistogramBoosting
from acreline.queries.common import parted, several_passes, training
from acreline.queries.registry import ID, SPLIT, TARGET, TRAIN, query, r, round_all

# --- whole learners ----------------------------------------------------------------------------


def _report(spark, rows):
    cells = [(name, *[m[k] for k in ("rmse", "mae", "r2", "mse")]) for name, m in rows]
    return spark.createDataFrame(cells, "set_name string, rmse double, mae double, r2 double, mse double")


def _trained(spark, sf_dir, name, settings=None):
    rows = several_passes(parted(spark, sf_dir))
    model = models.fit_full(rows.filter("part = 'train'"), name, training(), settings)
    return model, rows.filter("part = 'test'")


@query("train_regularised_boosting")
def train_regularised_boosting(spark, sf_dir):
    """All 1,188 rounds of the level-wise preset, on all training rows."""
    model, test = _trained(spark, sf_dir, "regularised_boosting")
    return _report(spark, [("test", models.score(model, test, "test", training()))])


@query("train_leafwise_boosting")
def train_leafwise_boosting(spark, sf_dir):
    """All 1,000 rounds of the leaf-wise preset, on all training rows."""
    model, test = _trained(spark, sf_dir, "leafwise_boosting")
    return _report(spark, [("test", models.score(model, test, "test", training()))])


@query("train_boosting_all_rows")
def train_boosting_all_rows(spark, sf_dir):
    """A few level-wise rounds on all training rows, which stay in Spark's partitions: a job a level."""
    settings = models.shorten("regularised_boosting", 5, 4) | {"held_rows": 1}
    model, test = _trained(spark, sf_dir, "regularised_boosting", settings)
    return _report(spark, [("test", models.score(model, test, "test", training()))])


@query("validate_kfold_at_once")
def validate_kfold_at_once(spark, sf_dir):
    """Five folds at the same time, 100 leaf-wise rounds each on all rows of the other folds."""
    train = several_passes(parted(spark, sf_dir)).filter("part = 'train'")
    plan = models.Training(id_cols=(ID,), validation="cross_validation")
    scores = models.validation_scores(train, "leafwise_boosting", plan, models.shorten("leafwise_boosting", 100), at_once=True)
    return _report(spark, [(f"validation_fold_{i + 1}", s) for i, s in enumerate(scores)])


@query(
    "boosting_accounts",
    f"""WITH {SPLIT}, test AS (SELECT * FROM parted WHERE part = 'test')
SELECT count(*) AS n_scored, CAST(20 AS BIGINT) AS n_trees, CAST(0 AS BIGINT) AS n_bad_parents, CAST(0 AS BIGINT) AS n_large_trees,
  (SELECT count(*) FROM parted WHERE part = 'train') AS n_learned, TRUE AS roots_hold_all, TRUE AS beats_mean FROM test""",
)
def boosting_accounts(spark, sf_dir):
    """What has to hold in any leaf-wise ensemble: children share out their parent's rows, no tree has more than its
    leaves, every root holds all rows learned from; and the model is closer to the test rows than their own mean."""
    rows = several_passes(parted(spark, sf_dir))
    train = rows.filter("part = 'train'")
    settings = models.shorten("leafwise_boosting", 20)
    model = models.fit_full(train, "leafwise_boosting", training(), settings)
    nodes = spark.createDataFrame(model.stages[-1].ensemble.table().to_pandas())
    child = nodes.select(F.col("node").alias("c"), F.col("n").alias("m"))
    inner = nodes.filter("feature >= 0").select("tree", "n", F.explode(F.array("left", "right")).alias("c"), "node")
    parents = inner.join(child, "c").groupBy("node", "n").agg(F.sum("m").alias("m"))
    trees = nodes.groupBy("tree").agg(F.count_if(F.col("feature") < 0).alias("leaves"), F.max("n").alias("n"))
    learned = train.agg(F.count(F.lit(1)).alias("n_learned"))
    held = trees.agg(F.count(F.lit(1)).alias("n_trees"), F.count_if(F.col("leaves") > 91).alias("n_large_trees"), F.min("n").alias("low"), F.max("n").alias("high"))
    value, guess = F.col(TARGET), F.col("prediction")
    error = F.sum((guess - value) * (guess - value))
    scored = models.predict(model, rows.filter("part = 'test'")).agg(
        F.count(guess).alias("n_scored"), (error < F.var_pop(value) * F.count(value)).alias("beats_mean")
    )
    bad = parents.agg(F.count_if(F.col("n") != F.col("m")).alias("n_bad_parents"))
    whole = scored.join(held).join(bad).join(learned)  # four tables of one row
    return whole.select(
        "n_scored", "n_trees", "n_bad_parents", "n_large_trees", "n_learned",
        ((F.col("low") == F.col("n_learned")) & (F.col("high") == F.col("n_learned"))).alias("roots_hold_all"), "beats_mean",
    )


# --- first trees, also in SQL ------------------------------------------------------------------

#: Few distinct values each, so that every cut between two of them is tried at any size.
PLAIN = {
    "age": "housing_median_age",
    "income": "floor(median_income * 4)",
    "row": "floor(latitude * 2)",
    "column": "floor(longitude * 2)",
    "bedrooms": "CASE WHEN total_bedrooms > 40 THEN 40 ELSE total_bedrooms END",
    "lines": "households",
}
LEVELS = Boosting(rounds=1, rate=1.0, depth=2, l2=1.0, gamma=0.19744075908778486, child_rows=3)
LEAVES = Boosting(rounds=1, rate=1.0, depth=11, leaves=4, l1=0.4494506741382034, l2=0.09541011649041131, child_rows=18)


def _first_tree_sql(s: Boosting) -> str:
    """The tree by trying every cut of every open node, on whole tables: a step for each level or each further leaf.

    Gradients are rounded to the same fixed point, so sums are equal to the last digit.
    """
    cells = ", ".join(f"coalesce(CAST({e} AS DOUBLE), CAST('-Infinity' AS DOUBLE)) AS x{i}" for i, e in enumerate(PLAIN.values()))
    long = "\nUNION ALL ".join(f"SELECT path, {i} AS f, x{i} AS v, g FROM at{{k}}" for i in range(len(PLAIN)))

    def part(g: str, n: str) -> str:
        t = f"greatest(abs(CAST({g} AS DOUBLE) / scale) - {s.l1!r}, 0)"
        return f"{t} * {t} / ({n} + CAST({s.l2!r} AS DOUBLE))"

    ctes = [
        f"{TRAIN}, raw AS (SELECT {ID}, CAST({TARGET} AS DOUBLE) AS y, {cells} FROM train)",
        "mean AS (SELECT CAST(CAST(avg(y) AS FLOAT) AS DOUBLE) AS base, count(*) AS n, min(y) AS low, max(y) AS high FROM raw)",
        f"""fixed AS (SELECT base, pow(CAST(2 AS DOUBLE), least({GRADIENT}, 62 - length(ltrim(bin(n), '0')))
  - ceil(log2(greatest(abs(high - base), abs(low - base)) * 4))) AS scale FROM mean)""",
        f"at0 AS MATERIALIZED (SELECT raw.*, 'root' AS path, CAST(round_even((base - y) * scale, 0) AS HUGEINT) AS g, base, scale FROM raw, fixed)",
        "cuts AS MATERIALIZED (SELECT f, v, lead(v) OVER (PARTITION BY f ORDER BY v) AS above FROM (SELECT DISTINCT f, v FROM (" + long.format(k=0) + ")))",
    ]
    steps = s.depth if not s.leaves else s.leaves - 1
    for k in range(steps):
        ctes.append(f"""best{k} AS MATERIALIZED (SELECT * FROM (
  SELECT *, row_number() OVER (PARTITION BY path ORDER BY gain DESC, f, v) AS place FROM (
    SELECT path, f, v, nl, n, ({part("gl", "nl")} + {part("(gt - gl)", "(n - nl)")} - {part("gt", "n")}) / 2 - CAST({s.gamma!r} AS DOUBLE) AS gain
    FROM (SELECT path, f, v, CAST(sum(c) OVER up AS BIGINT) AS nl, sum(gs) OVER up AS gl, CAST(sum(c) OVER whole AS BIGINT) AS n, sum(gs) OVER whole AS gt
      FROM (SELECT path, f, v, count(*) AS c, sum(g) AS gs FROM ({long.format(k=k)}) GROUP BY ALL)
      WINDOW up AS (PARTITION BY path, f ORDER BY v), whole AS (PARTITION BY path, f)), fixed
    WHERE nl >= {s.child_rows} AND n - nl >= {s.child_rows}) WHERE gain > 0) WHERE place = 1)""")
        # level by level all nodes are split, best leaf first only that of largest gain
        which = f"best{k}" if not s.leaves else f"(SELECT * FROM best{k} ORDER BY gain DESC, path LIMIT 1)"
        ctes.append(f"took{k} AS MATERIALIZED (SELECT b.*, c.above, CASE f {' '.join(f'WHEN {i} THEN {chr(39)}{n}{chr(39)}' for i, n in enumerate(PLAIN))} END AS feature FROM {which} b JOIN cuts c USING (f, v))")
        value = "CASE t.f " + " ".join(f"WHEN {i} THEN a.x{i}" for i in range(len(PLAIN))) + " END"
        split = f"a.path || CASE WHEN t.path IS NULL THEN '' WHEN {value} <= t.v THEN '.l' ELSE '.r' END AS path"
        ctes.append(f"at{k + 1} AS MATERIALIZED (SELECT a.* REPLACE ({split}) FROM at{k} a LEFT JOIN took{k} t ON a.path = t.path)")
    inner = "\nUNION ALL ".join(f"SELECT path, feature, CASE WHEN v = CAST('-Infinity' AS DOUBLE) THEN NULL ELSE v + (above - v) / 2 END AS cut, n, gain, CAST(0 AS DOUBLE) AS value FROM took{k}" for k in range(steps))
    shrunk = f"sign(CAST(sum(g) AS DOUBLE)) * greatest(abs(CAST(sum(g) AS DOUBLE) / any_value(scale)) - {s.l1!r}, 0)"
    leaf = f"SELECT path, NULL AS feature, CAST(NULL AS DOUBLE) AS cut, count(*) AS n, CAST(0 AS DOUBLE) AS gain, -({shrunk}) / (count(*) + CAST({s.l2!r} AS DOUBLE)) AS value FROM at{steps} GROUP BY path"
    return f"WITH {', '.join(ctes)}\nSELECT path, feature, cut, n, {r('gain / 1e9')} AS gain_e9, {r('value')} AS value FROM ({inner}\nUNION ALL {leaf})"


def _first_tree(spark, sf_dir, s: Boosting):
    train = several_passes(parted(spark, sf_dir)).filter("part = 'train'")
    x = F.array(*[F.expr(e).cast("double") for e in PLAIN.values()])
    table = train.select(x.alias("features"), F.col(TARGET).alias("label"), F.xxhash64(ID).alias("k"))
    nodes = HistogramBoosting(keyCol="k", settings=s).fit(table).ensemble.table().to_pylist()
    path = {0: "root"}
    for node in nodes:  # parents come first; a tree has a fixed number of leaves
        if node["feature"] >= 0:
            path |= {node["left"]: path[node["node"]] + ".l", node["right"]: path[node["node"]] + ".r"}
    names = list(PLAIN)
    rows = [(path[n["node"]], names[n["feature"]] if n["feature"] >= 0 else None, n["cut"], n["n"], n["gain"] / 1e9, n["value"]) for n in nodes]
    return round_all(spark.createDataFrame(rows, "path string, feature string, cut double, n long, gain_e9 double, value double"))


@query("boosting_level_tree", _first_tree_sql(LEVELS))
def boosting_level_tree(spark, sf_dir):
    """The first level-wise tree: splits, rows and leaf values."""
    return _first_tree(spark, sf_dir, LEVELS)


@query("boosting_leaf_tree", _first_tree_sql(LEAVES))
def boosting_leaf_tree(spark, sf_dir):
    """The first leaf-wise tree: splits, rows and leaf values."""
    return _first_tree(spark, sf_dir, LEAVES)
