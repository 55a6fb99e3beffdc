import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from candlewick.session import build_session, literal  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    # tests name their own shared folder, as a cluster would
    shared = str(tmp_path_factory.mktemp("shared"))
    session = build_session(master="local[4]", app="tests", shuffle_partitions=4, shared=shared)
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def table(spark):
    def make(schema, *rows):
        return literal(spark, list(rows), schema)

    return make
