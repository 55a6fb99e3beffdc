"""Joint boosting against one model at a time in plain Python."""

import random

import pytest
from pyspark.sql import functions as F

from candlewick.operators import boosting as B


def grow(rows, rounds, depth):
    """rows: (bins, label in units); returns predictions of any bins, and the trees."""
    residual = [y for _, y in rows]
    trees = []
    for _ in range(rounds):
        tree, at = {}, [1] * len(rows)
        for level in range(depth):
            for node in sorted(set(at)):
                own = [i for i, x in enumerate(at) if x == node]
                total = sum(residual[i] for i in own)

                def score(s, n):
                    return float(s) * float(s) / float(n + B.SHRINK)

                best = (0.0, None, None)
                for f in range(len(rows[0][0])):
                    for b in sorted({rows[i][0][f] for i in own}):
                        left = [i for i in own if rows[i][0][f] <= b]
                        ls, ln = sum(residual[i] for i in left), len(left)
                        if ln >= B.MIN_LEAF and len(own) - ln >= B.MIN_LEAF:
                            gain = score(ls, ln) + score(total - ls, len(own) - ln) - score(total, len(own))
                            if gain > best[0]:
                                best = (gain, f, b)
                tree[node] = best[1:]
            at = [2 * x + (tree[x][0] is not None and rows[i][0][tree[x][0]] > tree[x][1]) for i, x in enumerate(at)]
        leaves = {}
        for x in set(at):
            own = [i for i, y in enumerate(at) if y == x]
            leaves[x] = sum(residual[i] for i in own) // ((len(own) + B.SHRINK) * B.RATE)
        residual = [r - leaves[x] for r, x in zip(residual, at)]
        trees.append((tree, leaves))
    return trees


def predict(trees, bins, depth):
    out = 0
    for tree, leaves in trees:
        x = 1
        for _ in range(depth):
            f, b = tree.get(x, (None, None))
            x = 2 * x + (f is not None and bins[f] > b)
        out += leaves.get(x, 0)
    return out


@pytest.mark.parametrize("depth", [1, 3])
def test_joint_models_equal_each_alone(spark, depth):
    rnd = random.Random(depth)
    data = [(i, rnd.randint(0, 2), [rnd.randint(0, 7) for _ in range(4)]) for i in range(200)]
    data = [(i, m, b, 1000 * b[0] - 500 * b[1] * (b[2] > 3) + rnd.randint(-300, 300), rnd.random() < 0.8) for i, m, b in data]
    df = spark.createDataFrame(data, "id int, model int, _bins array<int>, label long, is_training boolean").repartition(3)
    made, trees = B.boost(df, rounds=3, depth=depth)
    got = {r.id: r.prediction for r in made.collect()}
    for m in range(3):
        own = grow([(b, y) for _, k, b, y, t in data if k == m and t], 3, depth)
        for i, k, b, _, _ in data:
            if k == m:
                assert got[i] == predict(own, b, depth)
    # stored trees give the same on the same rows
    again = {r.id: r.prediction for r in B.apply_trees(df, trees, rounds=3, depth=depth).collect()}
    assert again == got


def test_bins_hold_equally_many_rows_and_do_not_look_ahead(spark):
    df = spark.range(2000).select(F.col("id"), (F.col("id") * F.col("id")).cast("double").alias("x"), F.lit(1.0).alias("flat"))
    seen = F.col("id") < 1000
    out = B.bins(df, features=["x", "flat"], before=seen, count=8)
    sizes = [r["count"] for r in out.filter(seen).groupBy(F.col("_bins")[0]).count().collect()]
    assert len(sizes) == 8 and max(sizes) < 2 * min(sizes)
    assert {tuple(r._bins) for r in out.filter(~seen).collect()} == {(7, 0)}
    changed = df.withColumn("x", F.when(seen, F.col("x")).otherwise(-1e9))
    before = {r.id: r._bins for r in out.filter(seen).collect()}
    assert before == {r.id: r._bins for r in B.bins(changed, features=["x", "flat"], before=seen, count=8).filter(seen).collect()}


def test_no_rows_no_trees(spark):
    df = spark.createDataFrame([], "model int, _bins array<int>, label long, is_training boolean")
    made, trees = B.boost(df, rounds=5)
    assert made.count() == 0 and trees.count() == 0
