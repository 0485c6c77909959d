from __future__ import annotations

import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from scanpress.session import get_spark

    session = get_spark(app="scanpress-tests", master="local[4]", shuffle_partitions=8)
    # Tests set their own shared folder only when the session names none.
    if not session.conf.get("spark.checkpoint.dir", None):
        session.conf.set("spark.checkpoint.dir", tempfile.mkdtemp(prefix="scanpress-test-ckpt-"))
    yield session
    from scanpress.session import cleanup_scratch

    cleanup_scratch(session)
    session.stop()


@pytest.fixture
def tmp_dir():
    return tempfile.mkdtemp(prefix="scanpress-test-")


def col_values(spark, values, expr, schema="v string"):
    """Apply a Column function to one-column rows; return the results in order."""
    df = spark.createDataFrame([(v,) for v in values], schema)
    return [r[0] for r in df.select(expr("v")).collect()]
