import pytest

from acreline import session


class Conf:
    def __init__(self, value):
        self.value = value

    def get(self, key, default=None):
        assert key == "spark.checkpoint.dir"
        return self.value or default


class Fake:
    """Stands for a session that only has a master and one setting."""

    def __init__(self, master, value):
        self.conf = Conf(value)
        self.sparkContext = type("Context", (), {"master": master})()


def test_shared_folder_comes_from_the_session():
    assert session.scratch_root(Fake("yarn", "hdfs:///shared")) == "hdfs:///shared"
    first, second = (session.fresh_dir(Fake("yarn", "hdfs:///shared"), "t") for _ in range(2))
    assert first.startswith("hdfs:///shared/t-") and first != second


def test_a_cluster_never_gets_a_local_folder():
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.scratch_root(Fake("spark://host:7077", None))


def test_a_local_session_may_use_a_temporary_folder(spark):
    assert session.scratch_root(spark)


def test_written_tables_read_back_the_same(spark, districts):
    from acreline.plans.training import materialize

    back = materialize(districts, "rows")
    assert back.dtypes == districts.dtypes and back.exceptAll(districts).isEmpty() and back.count() == districts.count()
