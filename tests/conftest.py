import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from logtally.session import get_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"
SF_ORACLE = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    session = get_session(
        "local[4]",
        app_name="logtally-tests",
        shuffle_partitions=4,
        conf={"spark.ui.showConsoleProgress": "false"},
    )
    yield session
    session.stop()


@pytest.fixture
def lines_df(spark):
    """Build a ``line`` DataFrame from Python strings."""

    def make(lines):
        return spark.createDataFrame([(x,) for x in lines], "line string")

    return make
