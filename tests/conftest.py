import os
import sys
from contextlib import contextmanager

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from starmart.session import get_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = get_session(
        "starmart-tests",
        **{
            "spark.master": "local[8]",
            "spark.sql.shuffle.partitions": "8",
            "spark.sql.session.timeZone": "UTC",
            "spark.ui.enabled": "false",
            "spark.driver.memory": "4g",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def with_conf(spark):
    """``with with_conf({"key": "value"}):`` sets session conf for the block."""

    @contextmanager
    def override(conf):
        before = {key: spark.conf.get(key, None) for key in conf}
        for key, value in conf.items():
            spark.conf.set(key, value)
        try:
            yield
        finally:
            for key, value in before.items():
                if value is None:
                    spark.conf.unset(key)
                else:
                    spark.conf.set(key, value)

    return override


def bag(df, columns=None):
    """Rows as a sorted list, NULLs first, so that order does not matter."""
    rows = df.select(*(columns or sorted(df.columns))).collect()
    return sorted(tuple((v is not None, str(v)) for v in row) for row in rows)


def plan(df):
    """The physical plan as text; after an action on ``df``, the final one."""
    return df._jdf.queryExecution().executedPlan().toString()
