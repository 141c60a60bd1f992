"""The pipeline stage by stage, and the SQL twins of the queries that have one."""

import os
import sys

import duckdb
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))), "tools"))

import corpus_pipeline  # noqa: E402
from compare import canonical, connect  # noqa: E402

from acreline.llm import decontaminate  # noqa: E402
from acreline.llm.common import written  # noqa: E402
from acreline.llm.queries import ORACLES, QUERIES  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, name):
    df = QUERIES[name](spark, SF)
    cur = connect(SF).execute(ORACLES[name])
    assert canonical(df.columns, df.collect()) == canonical([d[0] for d in cur.description], cur.fetchall())


def one_of_each_group(rows):
    """The smallest id of each group that links of five-word Jaccard 0.8 or more make, by comparing all texts."""
    sets = [{tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if (w := t.lower().split()) else set() for _, t in rows]
    group = list(range(len(rows)))
    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            both = len(a & b)
            if 5 * both >= 4 * (len(a) + len(b) - both) and group[i] != group[j]:
                low, high = sorted((group[i], group[j]))
                group = [low if g == high else g for g in group]
    return {rows[g][0] for g in group}


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").cache()
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        out = written(stage(spark, docs, SF), name)
        kept[name] = (docs, out)
        if name != "sharding":
            assert out.columns == docs.columns and 0 < out.count() <= docs.count()
        docs = out
    before, after = kept["quality_classifier"]
    labels = duckdb.sql(f"select doc_id, quality from '{SF}/labels.parquet'").fetchall()
    ids = {r.doc_id for r in after.collect()}
    assert sum(q == 1 and d in ids for d, q in labels) >= 0.97 * sum(q == 1 for _, q in labels)
    assert sum(q == 0 and d in ids for d, q in labels) <= 0.2 * sum(q == 0 for _, q in labels)
    before, after = kept["simhash_near_dedup"]
    assert {r.doc_id for r in after.collect()} == one_of_each_group(sorted((r.doc_id, r.text or "") for r in before.collect()))
    before, after = kept["benchmark_decontamination"]
    found = decontaminate.find_contamination(before, spark.read.parquet(f"{SF}/benchmark.parquet")).collect()
    assert {r.doc_id for r in after.collect()} == {r.doc_id for r in found if not r.contamination.hits}
    before, after = kept["sharding"]
    sizes = [r["count"] for r in after.groupBy("shard").count().collect()]
    assert sum(sizes) == before.count() and max(sizes) - min(sizes) <= 1


def test_stages_of_nothing(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, SF).count() == 0


def test_stages_with_columns_of_their_own_names(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(60)
    odd = spark.createDataFrame([(None, None, None, None, None), (7, "", None, "x", 0), (7, "", None, "x", 0)], docs.schema)
    docs = docs.union(odd)
    for c in ("mix", "score", "quality", "contamination", "shard", "slot", "home_shard", "domain", "digest", "trie", "l", "n0", "id", "fp", "text_crc32"):
        docs = docs.withColumn(c, F.lit("kept"))
    for name, stage in corpus_pipeline.STAGES:
        out = written(stage(spark, docs, SF), name)
        assert out.count() >= 1
        if name != "sharding":
            assert out.columns == docs.columns and {r["mix"] for r in out.select("mix").distinct().collect()} == {"kept"}
        docs = out
