import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from acreline.session import local_session  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = local_session(8, shuffle_partitions=4)
    session.sparkContext.setLogLevel("ERROR")
    return session


@pytest.fixture(scope="session")
def districts(spark):
    """Cleaned, binned district rows of the smallest tables, kept for the whole run."""
    from acreline.operators.clean import add_stratum, clean_capped
    from acreline.sources.district import district

    df = add_stratum(clean_capped(district(spark, SF))).persist()
    df.count()
    return df


@pytest.fixture
def rows(spark):
    """rows(values, schema) -> DataFrame"""
    return lambda values, schema: spark.createDataFrame(values, schema)
