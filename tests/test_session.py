import os

import pytest
from helpers import rows

from candlewick import session


def test_staged_tables_lie_in_the_named_folder(spark, table):
    named = spark.conf.get("spark.checkpoint.dir")
    assert session.shared_dir(spark) == named
    staged = session.stage(table("v int", (1,), (2,)), "t")
    assert rows(staged) == [(1,), (2,)]
    assert all(f.removeprefix("file://").startswith(named) for f in staged.inputFiles())


def test_dropping_staged_tables(spark, table, tmp_path, monkeypatch):
    monkeypatch.setattr(session, "shared_dir", lambda _: str(tmp_path))
    session.stage(table("v int", (1,)), "t")
    assert len(os.listdir(tmp_path)) == 1
    session.drop_staged(spark)
    assert os.listdir(tmp_path) == []


def test_a_cluster_must_name_its_folder():
    class Conf:
        def get(self, *_):
            return None

    class Context:
        master = "yarn"

        def getCheckpointDir(self):
            return None

    class Cluster:
        conf, sparkContext = Conf(), Context()

    with pytest.raises(ValueError):
        session.shared_dir(Cluster())


def test_constant_tables_have_exact_sizes(spark):
    plan = session.literal(spark, [(1, None)], "a int, b string")._jdf.queryExecution().executedPlan().toString()
    assert "LocalTableScan" in plan
