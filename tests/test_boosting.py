"""Boosted trees against brute force: every split, every leaf value, both ways of growing and of holding rows."""

import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from acreline.errors import DataValidationError
from acreline.operators import models
from acreline.operators.boosting import Boosting, HistogramBoosting, bin_cuts, binned, drawn
from acreline.operators.features import FeatureSpec
from acreline.plans import training as plan
from acreline.sources.district import district

SF = "/root/testdata/sf0.001"


def sample(n=150, seed=3):
    rng = np.random.default_rng(seed)
    x = np.stack([rng.normal(size=n).round(1), rng.integers(0, 4, n).astype(float), rng.normal(size=n), rng.integers(0, 3, n) * 1.0], axis=1)
    x[rng.random((n, 4)) < 0.05] = np.nan
    y = 100 * np.nan_to_num(x[:, 0]) + 30 * np.nan_to_num(x[:, 1]) * (np.nan_to_num(x[:, 2]) > 0) + rng.normal(size=n)
    return x, y


def frame(spark, x, y):
    rows = [(i, [None if np.isnan(v) else float(v) for v in r], float(t)) for i, (r, t) in enumerate(zip(x, y))]
    return spark.createDataFrame(rows, "id long, features array<double>, label double").withColumn("k", F.xxhash64("id"))


def plain_split(x, g, rows, s):
    """(gain, feature, rows left) by trying every value of every feature; missing is below all numbers."""
    t = lambda v: np.sign(v) * max(abs(v) - s.l1, 0)
    part = lambda r: t(g[r].sum()) ** 2 / (len(r) + s.l2)
    best = None
    for f in range(x.shape[1]):
        v = np.where(np.isnan(x[rows, f]), -np.inf, x[rows, f])
        for cut in np.unique(v)[:-1]:
            left, right = rows[v <= cut], rows[v > cut]
            if min(len(left), len(right)) < s.child_rows:
                continue
            gain = (part(left) + part(right) - part(rows)) / 2 - s.gamma
            if gain > 0 and (best is None or gain > best[0] + 1e-9 * abs(gain)):
                best = (gain, f, left, right)
    return best


def plain_tree(x, g, s):
    """Leaves as (row set, value), and the gains taken."""
    leaves, gains, depth = [np.arange(len(x))], [], {tuple(range(len(x))): 0}
    done = []
    while leaves:
        found = [(plain_split(x, g, r, s) if depth[tuple(r)] < s.depth else None, r) for r in leaves]
        open_ = [(b, r) for b, r in found if b]
        done += [r for b, r in found if not b]
        if not open_ or (s.leaves and len(done) + len(open_) >= s.leaves):
            done += [r for _, r in open_]
            break
        chosen = [max(open_, key=lambda p: p[0][0])] if s.leaves else open_
        leaves = [r for b, r in open_ if all(r is not c[1] for c in chosen)]
        for b, r in chosen:
            gains.append(b[0])
            for child in b[2:]:
                depth[tuple(child)] = depth[tuple(r)] + 1
                leaves.append(child)
    t = lambda v: np.sign(v) * max(abs(v) - s.l1, 0)
    return {frozenset(r.tolist()): -t(g[r].sum()) / (len(r) + s.l2) for r in done}, sorted(gains)


@pytest.mark.parametrize(
    "s",
    [
        Boosting(rounds=4, rate=0.5, depth=3, l2=1.0, gamma=5.0, child_rows=3),
        Boosting(rounds=4, rate=0.5, depth=7, leaves=6, l1=20.0, l2=0.5, child_rows=2),
        Boosting(rounds=3, rate=1.0, depth=2, leaves=9, l2=0.0),
        Boosting(rounds=3, rate=0.3, depth=9, l2=0.0, gamma=1e9),
    ],
)
def test_every_tree_equals_brute_force(spark, s):
    x, y = sample()
    made = HistogramBoosting(keyCol="k", settings=s).fit(frame(spark, x, y)).ensemble
    bins, prediction = binned(x, made.cuts), np.full(len(y), made.base)
    ends = [*made.roots[1:].tolist(), len(made.nodes.feature)]
    for root, end in zip(made.roots.tolist(), ends):
        want, gains = plain_tree(x, prediction - y, s)
        at = np.full(len(x), root)
        for _ in range(s.depth):
            f = made.nodes.feature[at]
            left = bins[np.arange(len(x)), np.maximum(f, 0)] <= made.nodes.bin[at]
            at = np.where(f >= 0, np.where(left, made.nodes.left[at], made.nodes.right[at]), at)
        got = {frozenset(np.flatnonzero(at == k).tolist()): made.nodes.value[k] / s.rate for k in np.unique(at)}
        assert set(got) == set(want)
        assert all(got[k] == pytest.approx(want[k], rel=1e-5, abs=1e-5) for k in got)
        inner = made.nodes.feature[root:end] >= 0
        assert sorted(made.nodes.gain[root:end][inner].tolist()) == pytest.approx(gains, rel=1e-5)
        assert all(made.nodes.n[k] == len(r) for r, k in ((np.flatnonzero(at == k), k) for k in np.unique(at)))
        prediction += made.nodes.value[at]
    assert prediction == pytest.approx(made.predict(x))


@pytest.mark.parametrize(
    "s", [dict(rounds=3, depth=4, gamma=0.1, row_share=0.7, column_share=0.6), dict(rounds=3, depth=8, leaves=9, l1=3.0, child_rows=4, bins=9)]
)
def test_rows_in_partitions_give_the_same_trees(spark, s):
    x, y = sample(700)
    df = frame(spark, x, y)
    a = HistogramBoosting(keyCol="k", settings=Boosting(**s)).fit(df).ensemble
    b = HistogramBoosting(keyCol="k", settings=Boosting(**s, held_rows=1)).fit(df.repartition(5)).ensemble
    assert a.base == b.base and all(np.array_equal(p, q) for p, q in zip(a.cuts, b.cuts))
    for name in ("feature", "bin", "left", "right", "value", "gain", "n"):
        assert np.array_equal(getattr(a.nodes, name), getattr(b.nodes, name)), name


def test_a_wave_shuffles_a_row_a_node_and_task(spark):
    from acreline.operators import boosting

    x, y = sample(600)
    s = Boosting(rounds=1, depth=4, held_rows=1)
    df = frame(spark, x, y).repartition(50)
    plan = boosting._planned(df, F.col("features"), F.col("label"), F.col("k"), s)
    rows = boosting.SparkRows(plan.table, plan.rows, len(plan.cuts), plan.base, plan.scale, s, 1)
    assert rows.state.rdd.getNumPartitions() <= spark.sparkContext.defaultParallelism
    n, g = rows.start(0, np.arange(4))
    assert n.shape == (1, 4, 256) and n.sum(axis=2).tolist() == [[600] * 4]
    batch = rows.state.select("bins", "label", "key", "prediction").toArrow().to_batches()
    made = list(boosting._counted(iter(batch), rows.tree, [0], 0, plan.scale, s, 1, 4, np.arange(4)))
    assert sum(b.num_rows for b in made) == 1 and np.array_equal(np.frombuffer(made[0].column(1)[0].as_py(), np.int64).reshape(4, 256), n[0])
    rows.release()


def test_many_rounds_on_blocks_leave_no_plans_with_the_driver(spark, monkeypatch):
    from acreline.operators import boosting

    x, y = sample(500)
    s = dict(rounds=5, depth=6, leaves=14, l1=3.0, child_rows=4, row_share=0.8, column_share=0.8)
    df = frame(spark, x, y)
    held = HistogramBoosting(keyCol="k", settings=Boosting(**s)).fit(df).ensemble
    monkeypatch.setattr(boosting, "DIRECT", 0)  # sums go through ranges of cells
    monkeypatch.setattr(boosting, "CHECKPOINT", 2)
    runs = spark._jsparkSession.sharedState().statusStore()
    kept, runs_before, waves = spark.sparkContext._jsc.getPersistentRDDs().size(), runs.executionsCount(), []
    monkeypatch.setattr(boosting.SparkRows, "expand", lambda self, *a, f=boosting.SparkRows.expand: (waves.append(self.round), f(self, *a))[1])
    parts = HistogramBoosting(keyCol="k", settings=Boosting(**s, held_rows=1)).fit(df.repartition(6)).ensemble
    assert np.array_equal(held.predict(x), parts.predict(x)) and np.array_equal(np.sort(held.nodes.gain), np.sort(parts.nodes.gain))
    assert runs.executionsCount() - runs_before <= 4  # not one a wave, each with a plan longer than the last
    assert max(waves.count(r) for r in range(5)) <= 6  # a wave a level
    assert spark.sparkContext._jsc.getPersistentRDDs().size() == kept


def test_learns_from_a_bounded_number_of_rows(spark):
    x, y = sample(400)
    df = frame(spark, x, y)
    s = Boosting(rounds=2, depth=3, learn_rows=120)
    a, b = (HistogramBoosting(keyCol="k", settings=s).fit(d).ensemble for d in (df, df.repartition(7)))
    assert a.nodes.n[a.roots].tolist() == [120, 120] and np.array_equal(a.nodes.value, b.nodes.value)


@pytest.mark.parametrize("name", ["leafwise_boosting", "regularised_boosting"])
def test_presets_learn_from_all_rows(spark, name):
    """More rows than the 20,000 that the presets were once cut to; the last of them have values of their own."""
    value = F.when(F.col("id") < 20_500, F.col("id") % 100).otherwise(1000.0)
    rows = spark.range(21_000, numPartitions=3).select(F.array(value.cast("double")).alias("features"), (value * 7.0).alias("label"), F.col("id").alias("k"))
    made = HistogramBoosting(keyCol="k", settings=models.shorten(name, 2) | {"row_share": 1.0}).fit(rows).ensemble
    assert made.nodes.n[made.roots].tolist() == [21_000, 21_000]
    assert made.cuts[0].max() > 500 and made.predict(np.array([[1000.0]]))[0] > 1000


@pytest.mark.parametrize("hot", [False, True])
def test_first_rows_without_a_task_that_reads_the_table(spark, hot, tmp_path):
    from acreline.operators.boosting import first_rows

    key = F.xxhash64("id") if not hot else F.when(F.col("id") % 3 == 0, F.xxhash64("id")).when(F.col("id") % 3 == 1, F.lit(-(1 << 62)))
    rows = spark.range(40_000, numPartitions=40).select(key.alias("key"), F.pmod(F.hash("id"), F.lit(5000)).alias("label"), "id")
    rows.union(rows.filter("id < 500")).write.parquet(str(tmp_path / "rows"))
    rows = spark.read.parquet(str(tmp_path / "rows"))
    found = first_rows(rows, 150, "key", "label", "id")
    assert found.collect() == rows.orderBy("key", "label", "id").limit(150).collect()
    assert first_rows(rows, 50_000, "key", "label", "id").count() == 40_500
    # rows that meet in the last task: with a plain limit 150 of each of the 40 partitions did
    plan = found._jdf.queryExecution()
    assert plan.optimizedPlan().toString().count("Filter") >= 1
    before_last = plan.analyzed().children().head().children().head()
    assert spark._jvm.org.apache.spark.sql.classic.Dataset.ofRows(spark._jsparkSession, before_last).count() <= 4 * 150


def test_bins():
    v = np.array([3.0, 1.0, np.nan, 2.0, 2.0])
    assert bin_cuts(v, 255).tolist() == [1.5, 2.5]
    assert binned(v[:, None], [bin_cuts(v, 255)])[:, 0].tolist() == [3, 1, 0, 2, 2]
    many = np.arange(10_000.0)
    cuts = bin_cuts(many, 16)
    sizes = np.bincount(binned(many[:, None], [cuts])[:, 0])[1:]
    assert len(cuts) == 15 and sizes.max() - sizes.min() <= 1
    assert bin_cuts(np.array([np.nan]), 9).tolist() == [] and bin_cuts(np.full(50, 7.0), 9).tolist() == []
    heavy = np.concatenate([np.full(1000, 5.0), np.arange(300.0)])
    assert np.unique(binned(heavy[:, None], [bin_cuts(heavy, 4)])[:, 0]).size >= 2


@pytest.mark.parametrize("few", [256, 2])
def test_bin_cuts_come_from_all_rows(spark, monkeypatch, few):
    from acreline.operators import boosting

    rng = np.random.default_rng(5)
    n = 6000
    heavy = np.where(rng.random(n) < 0.6, 1.25, rng.normal(size=n))
    near = 1.0 + np.arange(n) * 2.0**-52  # values that differ in the last bits only
    odd = rng.choice(np.array([-np.inf, np.inf, -0.0, 0.0, 5e-324, -1e308, 1e308, *rng.normal(size=60)]), n)
    x = np.stack([rng.normal(size=n) ** 3, heavy, near, odd, rng.integers(0, 5, n) * 1.0, np.full(n, np.nan), rng.permutation(n) * 1.0 - 3000], axis=1)
    x[rng.random(x.shape) < 0.02] = np.nan
    df = frame(spark, x, np.arange(n) * 1.0).repartition(5)
    whole = [bin_cuts(x[:, f], 40) for f in range(x.shape[1])]
    monkeypatch.setattr(boosting, "CUT_ROWS", 1000)
    monkeypatch.setattr(boosting, "FEW", few)
    made = boosting._planned(df, F.col("features"), F.col("label"), F.col("k"), Boosting(bins=40)).cuts
    assert len(made) == len(whole) and all(np.array_equal(a, b) for a, b in zip(made, whole))


def test_draws_of_rows():
    key = np.arange(100_000)
    s = Boosting(row_share=0.3, row_every=2)
    a, b, c = (drawn(key, r, s, 1) for r in (0, 1, 2))
    assert abs(a.mean() - 0.3) < 0.01 and np.array_equal(a, b) and abs((a & c).mean() - 0.09) < 0.01
    assert drawn(key, 0, Boosting(row_share=0.3, row_every=0), 1).all()


def test_settings_and_labels_that_cannot_be_used(spark):
    for bad in (dict(rounds=0), dict(leaves=1), dict(bins=256), dict(row_share=0.0), dict(l1=-1.0), dict(held_rows=1 << 30)):
        with pytest.raises(ValueError):
            Boosting(**bad)
    x, y = sample(20)
    df = frame(spark, x, y)
    for rows in (df.limit(0), df.withColumn("label", F.when(F.col("id") > 3, F.col("label"))), df.withColumn("features", F.when(F.col("id") > 3, F.col("features")).otherwise(F.array(F.lit(1.0))))):
        with pytest.raises(DataValidationError):
            HistogramBoosting(keyCol="k").fit(rows)


def test_no_split_and_one_row(spark):
    rows = spark.createDataFrame([([1.0], 5.0)], "features array<double>, label double")
    model = HistogramBoosting(settings=Boosting(rounds=3)).fit(rows)
    assert [r.prediction for r in model.transform(rows).collect()] == [5.0]


@pytest.fixture(scope="module")
def parted(spark):
    training = models.Training(spec=FeatureSpec(clusters=3), folds=2)
    return plan.split(plan.prepare(district(spark, SF), training), training).persist()


def test_as_a_stage_of_a_saved_pipeline(spark, parted, tmp_path):
    training = models.Training(spec=FeatureSpec(clusters=3))
    train, test = (parted.filter(f"part = '{p}'") for p in ("train", "test"))
    model = models.fit_full(train, "leafwise_boosting", training, models.shorten("leafwise_boosting", 30))
    scores = models.score(model, test, "test", training)
    assert scores["r2"] > 0.9
    model.write().overwrite().save(str(tmp_path / "m"))
    loaded = PipelineModel.load(str(tmp_path / "m"))
    a, b = (models.predict(m, test).orderBy("district_id").collect() for m in (model, loaded))
    assert a == b
    assert "Exchange" not in models.predict(model, spark.read.schema(test.schema).parquet(_written(test, tmp_path)))._jdf.queryExecution().executedPlan().toString()


def _written(df, folder):
    df.write.parquet(str(folder / "rows"))
    return str(folder / "rows")


@pytest.mark.parametrize("name", ["regularised_boosting", "boosted_trees"])
def test_folds_at_once_score_as_one_after_another(parted, name):
    training = models.Training(spec=FeatureSpec(geo=()), validation="cross_validation", folds=2)
    train = parted.filter("part = 'train'")
    settings = models.shorten(name, 4, 3)
    one, all_ = (models.validation_scores(train, name, training, settings, at_once=w) for w in (False, True))
    for a, b in zip(one, all_):
        assert a == pytest.approx(b, rel=1e-9)


def test_presets_keep_rate_times_rounds():
    short = models.shorten("regularised_boosting", 100, 5)
    assert short["rounds"] * short["rate"] == pytest.approx(1188 * 0.019655684599424853) and short["depth"] == 5
    assert all(Boosting(**p) for p in models.BOOSTING_PRESETS.values())
