"""One key with a third of all rows: results stay whole, and shrink before they move."""

import pytest
from helpers import rows
from pyspark.sql import functions as F

from candlewick.operators.quality import Check, run_checks
from candlewick.operators.windows import group_rank, latest_per
from candlewick.operators.writes import append_new_only, upsert

N = 30_000


@pytest.fixture
def skewed(spark):
    """(k, seq, v): key 0 has a third of the rows, the others about fifteen each."""
    key = F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 1301 + 1)
    return spark.range(N).select(key.alias("k"), F.col("id").alias("seq"), (F.col("id") * 7 % 101).cast("double").alias("v"))


def expected(skewed, pick):
    out = {}
    for r in skewed.collect():
        if r.k not in out or pick(r.seq, out[r.k][0]):
            out[r.k] = (r.seq, r.v)
    return sorted((k, *v) for k, v in out.items())


def combined_before_shuffle(df):
    """The plan aggregates (partially) below every shuffle of the input."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    return "partial_max_by" in plan or "partial_min_by" in plan or "partial_count" in plan


def test_upsert(skewed):
    out = upsert(skewed.limit(0), skewed, keys=["k"], order_by="seq")
    assert rows(out, "k", "seq", "v") == expected(skewed, lambda a, b: a > b)
    assert combined_before_shuffle(out)


def test_append_new_only(skewed):
    _, new = append_new_only(skewed.limit(0), skewed, keys=["k"], order_by="seq")
    assert rows(new, "k", "seq", "v") == expected(skewed, lambda a, b: a < b)
    assert combined_before_shuffle(new)


def test_latest(skewed):
    out = latest_per(skewed, by="k", order="seq")
    assert rows(out, "k", "seq", "v") == expected(skewed, lambda a, b: a > b)
    assert combined_before_shuffle(out)


def test_rank_of_a_hot_group(skewed):
    out = group_rank(skewed, by="k", value="v", high="up", low="down")
    assert out.count() == N
    hot = [r for r in out.filter("k = 0").collect()]
    values = sorted(r.v for r in hot)
    for r in hot[:50]:
        assert r.up == 1 + sum(v > r.v for v in values) and r.down == 1 + sum(v < r.v for v in values)
    # only counts per value are gathered by the window, never the group's rows
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "partial_count" in plan.split("Window", 1)[1]


def test_checks_of_a_hot_key(skewed, spark):
    parent = spark.range(1, 2000).withColumnRenamed("id", "k")
    report = run_checks(
        {"child": skewed, "parent": parent},
        [Check("relationships", "child", "k", ("parent", "k")), Check("unique", "child", "k")],
    )
    assert rows(report, "check", "failures") == [("relationships", N // 3), ("unique", skewed.select("k").distinct().count())]
