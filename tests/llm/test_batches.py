"""Texts reach Python functions in batches of bounded bytes."""

from __future__ import annotations

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from acreline.llm import common, line_winnow

SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"


def test_batches_are_bounded_by_bytes(spark):
    @F.arrow_udf("bigint")
    def handed(column: pa.Array) -> pa.Array:
        return pa.array([column.nbytes] * len(column))

    rows = spark.range(0, 3_000, 1, 1).select(F.repeat(F.lit("x"), 1_000).alias("t")).select(handed("t").alias("n"))
    assert rows.agg(F.max("n")).first()[0] > 1 << 20
    before = spark.conf.get(SETTING)
    with common.arrow_batches(spark, 1 << 17):
        assert rows.agg(F.max("n")).first()[0] < 1 << 18
    assert spark.conf.get(SETTING) == before


@pytest.mark.parametrize("held, used", [("64k", 1 << 16), ("67108864b", 1 << 20), ("1g", 1 << 20), ("5", 5)])
def test_a_smaller_setting_of_the_session_holds(spark, held, used):
    before = spark.conf.get(SETTING)
    spark.conf.set(SETTING, held)
    try:
        with pytest.raises(RuntimeError), common.arrow_batches(spark, 1 << 20):
            assert int(spark.conf.get(SETTING)) == used
            raise RuntimeError
        assert spark.conf.get(SETTING) == held
    finally:
        spark.conf.set(SETTING, before)


def test_texts_are_cut_in_small_batches(spark, monkeypatch):
    seen, write = [], line_winnow.written

    def written(df, name):
        seen.append(int(spark.conf.get(SETTING).rstrip("b")))
        return write(df, name)

    monkeypatch.setattr(line_winnow, "written", written)
    docs = spark.createDataFrame([(1, "one two three"), (2, "four")], "doc_id long, text string")
    assert line_winnow.find_repeats(docs).count() == 2
    assert seen[0] == line_winnow.BATCH_BYTES and seen[1] > seen[0]
