import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from changefeed.session import build_session  # noqa: E402

SF_SMOKE = "/root/testdata/sf0.001"
SF_CHECK = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    warehouse = tmp_path_factory.mktemp("warehouse")
    session = build_session(
        "changefeed-tests",
        "local[*]",
        {"spark.sql.shuffle.partitions": "8", "spark.sql.warehouse.dir": str(warehouse)},
    )
    session.sparkContext.setLogLevel("ERROR")
    # Tests have no cluster checkpoint folder: give them one.
    if not session.sparkContext.getCheckpointDir():
        session.sparkContext.setCheckpointDir(str(tmp_path_factory.mktemp("checkpoints")))
    yield session


@pytest.fixture(scope="session")
def duck_check():
    from compare import duck

    return duck(SF_CHECK)


@pytest.fixture
def lines_df(spark):
    def make(lines):
        return spark.createDataFrame([(x,) for x in lines], "value string")

    return make
