import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from brooklet.operators.ordered import ROWS_PER_SLICE_CONF  # noqa: E402
from brooklet.session import build_session  # noqa: E402

DATA = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "local[8]",
        app="brooklet-tests",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "8g",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def tiny_slices(spark):
    """Makes every key with more than 20 rows a hot key."""
    spark.conf.set(ROWS_PER_SLICE_CONF, "20")
    yield
    spark.conf.unset(ROWS_PER_SLICE_CONF)


@pytest.fixture(scope="session")
def events(spark):
    return spark.read.parquet(f"{DATA}/events.parquet")


def rows(df, *columns):
    picked = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in picked.collect()), key=repr)
