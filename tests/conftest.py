import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from daycast.session import ensure_checkpoint_dir, get_spark
    s = get_spark("local[4]", "daycast-tests", {"spark.sql.shuffle.partitions": "8",
                                                "spark.sql.session.timeZone": "UTC"})
    ensure_checkpoint_dir(s)
    yield s


@pytest.fixture
def new_york(spark):
    """Run a test under a DST-observing session zone; results must not change."""
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    yield spark
    spark.conf.set("spark.sql.session.timeZone", old)


def ts(s):
    import datetime as dt
    return dt.datetime.fromisoformat(s)


def d(s):
    import datetime as dt
    return dt.date.fromisoformat(s)
