import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from headway.session import local_session
    session = local_session(4, shuffle_partitions=4, app_name="headway-tests")
    yield session
    session.stop()


@pytest.fixture
def scratch(tmp_path):
    return str(tmp_path)


def raw(spark, table, rows, columns):
    """A raw (all-STRING) feed table from Python rows."""
    from pyspark.sql import types as T
    schema = T.StructType([T.StructField(c, T.StringType(), True) for c in columns])
    return spark.createDataFrame([tuple(None if v is None else str(v) for v in r) for r in rows],
                                 schema)
