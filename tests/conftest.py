import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tablestream.session import get_spark  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = get_spark("tests", master="local[8]", shuffle_partitions=4, **{"spark.sql.streaming.noDataMicroBatches.enabled": "true"})
    yield s
    s.stop()


@pytest.fixture
def hot(spark):
    """Make every key hot, so the chunked plans run."""
    spark.conf.set("spark.tablestream.hotKeyRows", "2")
    yield
    spark.conf.unset("spark.tablestream.hotKeyRows")


def rows(df, *cols, order=True):
    """Collected tuples, sorted unless ``order`` is off."""
    got = [tuple(r) for r in (df.select(*cols) if cols else df).collect()]
    return sorted(got, key=lambda r: tuple((x is not None, str(x)) for x in r)) if order else got
