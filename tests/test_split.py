import hashlib
import math
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from acreline.errors import DataValidationError
from acreline.operators import split
from acreline.operators.keys import hash_sample, stable_layout


def table(rows, n=1000, seed=3):
    rng = random.Random(seed)
    return rows([(i, rng.choice([1, 1, 1, 2, 3])) for i in range(n)], "id bigint, s int")


def digest(i, salt):
    return hashlib.md5(f"42:{salt}:{i}".encode()).hexdigest()


def brute_split(data, size, salt):
    sizes = Counter(s for _, s in data)
    n = len(data)
    train = n - math.ceil(size * n)
    quota = {s: c * train // n for s, c in sizes.items()}
    spare = sorted(sizes, key=lambda s: (-(sizes[s] * train % n), s))[: train - sum(quota.values())]
    for s in spare:
        quota[s] += 1
    out = {}
    for s in sizes:
        for rank, i in enumerate(sorted((i for i, g in data if g == s), key=lambda i: digest(i, salt))):
            out[i] = "train" if rank < quota[s] else "test"
    return out


@pytest.mark.parametrize("n, size", [(1000, 0.2), (37, 0.25), (11, 0.4)])
def test_split_equals_brute_force_under_any_layout(rows, n, size):
    df = table(rows, n)
    want = brute_split([tuple(r) for r in df.collect()], size, "test")
    for laid in (df, df.repartition(1), df.repartition(17)):
        got = {r["id"]: r["part"] for r in split.stratified_split(laid, "s", ["id"], size).collect()}
        assert got == want


def test_refinement_of_crowded_buckets_gives_the_same_split(rows, monkeypatch):
    df = table(rows, 3000)
    want = brute_split([tuple(r) for r in df.collect()], 0.2, "test")
    monkeypatch.setattr(split, "PREFIX_STEP", 1)
    monkeypatch.setattr(split, "BUCKET_LIMIT", 2)
    assert {r["id"]: r["part"] for r in split.stratified_split(df, "s", ["id"]).collect()} == want


def test_folds_cover_every_row_once_and_are_level(rows):
    df = table(rows, 1003)
    folded = split.kfold(df, 5, "s", ["id"])
    got = folded.collect()
    assert sorted(r["id"] for r in got) == list(range(1003))
    for group in (None, 1, 2, 3):
        sizes = Counter(r["fold"] for r in got if group in (None, r["s"]))
        assert set(sizes) == set(range(5)) and max(sizes.values()) - min(sizes.values()) <= 1
    fit, val = split.fold_parts(folded, 2)
    assert fit.count() + val.count() == 1003
    report = {r["fold"]: (r["n_val"], r["n_train"]) for r in split.fold_sizes(folded).collect()}
    assert all(v + t == 1003 for v, t in report.values())


def test_more_folds_than_rows_in_a_stratum(rows):
    df = rows([(i, i % 2) for i in range(6)], "id bigint, s int")
    got = [r["fold"] for r in split.kfold(df, 4, "s", ["id"]).collect()]
    assert max(Counter(got).values()) - min(Counter(got).values()) <= 1


@pytest.mark.parametrize("block", [100_000, 7])
def test_a_third_of_the_rows_may_be_copies(rows, monkeypatch, block):
    monkeypatch.setattr(split, "COPY_BLOCK", block)
    values = [("copy", 1.0)] * 300 + [(f"r{i}", float(i)) for i in range(600)]
    df = rows(values, "k string, v double")
    parted = split.random_split(df, None, 0.5).collect()
    assert Counter(r["part"] for r in parted) == {"train": 450, "test": 450}
    assert Counter((r["k"], r["v"]) for r in parted) == Counter(values)
    folded = split.kfold(df, 5).collect()
    assert Counter(r["fold"] for r in folded) == {f: 180 for f in range(5)}
    assert Counter((r["k"], r["v"]) for r in folded) == Counter(values)


def test_all_rows_equal(rows):
    df = rows([("x", None)] * 100, "k string, v double")
    assert Counter(r["fold"] for r in split.kfold(df, 3).collect()) == {0: 34, 1: 33, 2: 33}


def test_salts_are_independent(rows):
    df = table(rows, 2000)
    a = split.random_split(df, ["id"], 0.5, salt="a", part_col="pa")
    both = split.random_split(a, ["id"], 0.5, salt="b", part_col="pb").collect()
    shared = sum(r["pa"] == r["pb"] for r in both) / 2000
    assert 0.45 < shared < 0.55


def test_gates(rows):
    df = rows([(1, 1), (2, 1), (3, None)], "id int, s int")
    with pytest.raises(DataValidationError, match="outside all bins"):
        split.require_strata(df, "s")
    with pytest.raises(DataValidationError, match="smallest stratum"):
        split.require_strata(df.filter("s = 1"), "s", 3)
    split.require_strata(df.filter("s = 1"), "s", 2)
    with pytest.raises(DataValidationError, match="no stratum"):
        split.stratified_split(df, "s", ["id"])


@pytest.mark.parametrize("size", [0.0, 1.0, -1, 2])
def test_bad_sizes_are_refused(rows, size):
    with pytest.raises(ValueError):
        split.random_split(table(rows, 5), ["id"], size)


def test_bad_folds_and_columns_are_refused(rows):
    with pytest.raises(ValueError):
        split.kfold(table(rows, 5), 1)
    with pytest.raises(ValueError):
        split.stratified_split(table(rows, 5), "nope", ["id"])


def test_threshold_split_is_near_its_size_and_needs_no_shuffle(rows):
    df = split.threshold_split(table(rows, 5000), ["id"], 0.2)
    assert 850 < df.filter("part = 'test'").count() < 1150
    assert "Exchange" not in df._jdf.queryExecution().executedPlan().toString()


def test_assignment_itself_does_not_shuffle_the_table(rows):
    df = split.stratified_split(table(rows, 500), "s", ["id"])
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "hashpartitioning" not in plan and "Window" not in plan


def test_sample_is_repeatable_and_of_exact_size(rows):
    df = table(rows, 500)
    a = [r["id"] for r in hash_sample(df, 20, ["id"]).collect()]
    b = [r["id"] for r in hash_sample(df.repartition(9), 20, ["id"]).collect()]
    assert a == b and len(a) == 20 and hash_sample(df, 900, ["id"]).count() == 500


def test_layout_depends_on_the_rows_alone(rows):
    df = table(rows, 5000)

    def shape(frame):
        tagged = stable_layout(frame, ["id"]).withColumn("p", F.spark_partition_id()).collect()
        return [(r["p"], r["id"]) for r in tagged]

    assert shape(df) == shape(df.repartition(13))
    copies = rows([("same", 1)] * 8000, "k string, v int")
    spread = stable_layout(copies, None).groupBy(F.spark_partition_id()).count().collect()
    assert sum(r["count"] for r in spread) == 8000 and max(r["count"] for r in spread) < 8000
