import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from supplyloom.session import local_session

    session = local_session(8, memory="8g", app="supplyloom-tests")
    session.sparkContext.setCheckpointDir(str(tmp_path_factory.mktemp("shared")))
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf():
    return SF


@pytest.fixture
def edges_frame(spark):
    """Edge table from (src, dst) pairs, numbered in order."""

    def make(pairs):
        rows = [(i, int(s), int(d)) for i, (s, d) in enumerate(pairs)]
        return spark.createDataFrame(rows, "eid long, src_id long, dst_id long")

    return make
