"""Boosted regression trees for many training windows at once, as joins and aggregates.

A model is one label learned from all rows before one cutoff. All models grow
together: a row stands once for each model that may see it, and a level of a
tree is one aggregate of residuals by (model, node, feature, bin) and one join with
the splits that come out of it. The number of jobs is ``rounds * (depth + 1)``
however many cutoffs and labels there are, and no group of rows is ever gathered.

All arithmetic is in whole numbers. Labels count units of 10^-6, residuals
and leaves stay in them, and sums do not depend on the order of rows; the only
fractions are gains, each computed from exact sums. So a run gives the same
trees everywhere, and SQL can follow it.

Features are cut into bins once, by a fine histogram of the rows before the
first cutoff, so that no model knows what lies after its own.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..session import stage

UNIT = 1_000_000
#: Cells of the fine histogram, and bins of about equally many rows made of them.
CELLS = 4096
BINS = 32
DEPTH = 3
#: A leaf moves the prediction by 1/RATE of its mean residual, shrunk by SHRINK rows of no residual.
RATE = 20
SHRINK = 1
#: Rows on either side of a split at least.
MIN_LEAF = 5


def whole(value: Column) -> Column:
    """A value with six decimals as a whole number."""
    return F.round(value * UNIT).cast("bigint")


def bins(rows: DataFrame, *, features: list[str], before: Column, count: int = BINS) -> DataFrame:
    """Adds ``_bins``: the bin of each feature, from the values of the rows ``before`` holds for.

    The range of these rows is cut into CELLS cells of one width, and cells are joined
    to bins of about equally many rows. Values outside fall into the outer cells. The
    table of cells has at most CELLS rows for each feature.
    """
    seen = rows.filter(before)
    ranges = seen.agg(*[f(c).alias(f"{n}_{i}") for i, c in enumerate(features) for n, f in (("lo", F.min), ("hi", F.max))])
    ranges = ranges.first()

    def cell(i: int) -> Column:
        lo, hi = ranges[f"lo_{i}"], ranges[f"hi_{i}"]
        if lo is None or hi <= lo:
            return F.lit(0)
        at = F.floor((F.col(features[i]).cast("double") - F.lit(float(lo))) / F.lit(float(hi) - float(lo)) * CELLS)
        return F.greatest(F.lit(0), F.least(F.lit(CELLS - 1), at)).cast("int")

    cells = F.array(*[cell(i) for i in range(len(features))])
    counted = seen.select(F.posexplode(cells).alias("feature", "cell")).groupBy("feature", "cell").agg(F.count(F.lit(1)).alias("n"))
    earlier = F.coalesce(F.sum("n").over(W.partitionBy("feature").orderBy("cell").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    total = F.sum("n").over(W.partitionBy("feature"))
    edges = counted.select("feature", "cell", F.floor(earlier * count / total).cast("int").alias("bin"))
    # of each feature, the first cell of each bin: at most ``count`` numbers
    firsts = edges.groupBy("feature", "bin").agg(F.min("cell").alias("cell")).collect()
    starts = [sorted(r.cell for r in firsts if r.feature == i) for i in range(len(features))]

    def binned(i: int) -> Column:
        return reduce(lambda a, b: a + b, [(cell(i) >= s).cast("int") for s in starts[i][1:]], F.lit(0))

    return rows.withColumn("_bins", F.array(*[binned(i) for i in range(len(features))]))


def _best_splits(rows: DataFrame) -> DataFrame:
    """(model, node, feature, bin, and sum and count on both sides) of the best split of each node.

    Without a split that gains anything everything goes to the left.
    """
    cells = rows.select("model", "node", "residual", F.posexplode("_bins").alias("feature", "bin"))
    sums = cells.groupBy("model", "node", "feature", "bin").agg(F.sum("residual").alias("s"), F.count(F.lit(1)).alias("n"))
    upto = W.partitionBy("model", "node", "feature").orderBy("bin").rowsBetween(W.unboundedPreceding, 0)
    whole_node = W.partitionBy("model", "node", "feature")
    sides = sums.select(
        "model", "node", "feature", "bin",
        F.sum("s").over(upto).alias("ls"), F.sum("n").over(upto).alias("ln"),
        F.sum("s").over(whole_node).alias("s"), F.sum("n").over(whole_node).alias("n"),
    )

    def score(s: Column, n: Column) -> Column:
        return s.cast("double") * s.cast("double") / (n + SHRINK).cast("double")

    ls, ln, s, n = (F.col(c) for c in ("ls", "ln", "s", "n"))
    gain = score(ls, ln) + score(s - ls, n - ln) - score(s, n)
    allowed = (ln >= MIN_LEAF) & (n - ln >= MIN_LEAF) & (gain > 0)
    split = F.struct(F.when(allowed, gain).otherwise(0.0).alias("gain"), (-F.col("feature")).alias("f"), (-F.col("bin")).alias("b"), "ls", "ln", "s", "n")
    best = sides.groupBy("model", "node").agg(F.max(split).alias("x"))
    found = F.col("x.gain") > 0
    return best.select(
        "model", "node",
        F.when(found, -F.col("x.f")).alias("feature"), F.when(found, -F.col("x.b")).alias("bin"),
        F.when(found, F.col("x.ls")).otherwise(F.col("x.s")).alias("ls"), F.when(found, F.col("x.ln")).otherwise(F.col("x.n")).alias("ln"),
        F.when(found, F.col("x.s") - F.col("x.ls")).otherwise(0).alias("rs"), F.when(found, F.col("x.n") - F.col("x.ln")).otherwise(0).alias("rn"),
    )


def _descend(rows: DataFrame, splits: DataFrame) -> DataFrame:
    """Rows at the children of their nodes."""
    known = splits.select(F.col("model").alias("_m"), F.col("node").alias("_n"), F.col("feature").alias("_f"), F.col("bin").alias("_b"))
    moved = rows.join(known, (F.col("model") == F.col("_m")) & (F.col("node") == F.col("_n")), "left")
    right = F.coalesce((F.element_at("_bins", F.col("_f") + 1) > F.col("_b")).cast("int"), F.lit(0))
    return moved.withColumn("node", F.col("node") * 2 + right).drop("_m", "_n", "_f", "_b")


def leaf(s: Column, n: Column) -> Column:
    """What a leaf adds to the prediction, rounded down."""
    part = (n + SHRINK) * RATE
    return F.call_function("div", s - F.pmod(s, part), part)


def boost(rows: DataFrame, *, rounds: int, depth: int = DEPTH) -> tuple[DataFrame, DataFrame]:
    """(predictions, trees) of all models.

    ``rows`` have ``model``, ``_bins``, ``label`` in units, ``is_training``, and other
    columns, which the predictions keep; a row of several models stands for each.
    Predictions have ``prediction`` in units. Trees are rows (round, model,
    node, feature, bin, left, right): values in the ``bin`` or a lower one go to node
    ``2 * node``, others to ``2 * node + 1``, without a feature all go left, and the nodes of
    the last level name what both of their leaves add.
    """
    start = {"prediction": F.lit(0).cast("bigint"), "residual": F.col("label"), "node": F.lit(1)}
    state = stage(rows.withColumns(start), "boost")
    none = state.limit(0).select(
        F.lit(0).alias("round"), "model", "node", *[F.lit(None).cast(kind).alias(c) for c, kind in (("feature", "int"), ("bin", "int"), ("left", "bigint"), ("right", "bigint"))]
    )
    trees = [none]
    for k in range(0 if state.isEmpty() else rounds):
        at, grown = state, []
        for level in range(depth):
            splits = stage(_best_splits(at.filter("is_training")), "splits")
            grown.append(splits)
            if level < depth - 1:
                at = _descend(at, splits)
        ends = grown[-1].select("model", "node", "feature", "bin", leaf(F.col("ls"), F.col("ln")).alias("left"), leaf(F.col("rs"), F.col("rn")).alias("right"))
        inner = [g.select("model", "node", "feature", "bin", F.lit(None).cast("bigint").alias("left"), F.lit(None).cast("bigint").alias("right")) for g in grown[:-1]]
        trees.append(reduce(DataFrame.unionByName, [*inner, ends]).select(F.lit(k).alias("round"), "*"))
        last = _descend(at, grown[-1])
        sides = ends.select(F.col("model").alias("_m"), F.inline(F.array(*[F.struct((F.col("node") * 2 + i).alias("_n"), F.col(side).alias("_add")) for i, side in ((0, "left"), (1, "right"))])))
        moved = last.join(sides, (F.col("model") == F.col("_m")) & (F.col("node") == F.col("_n")), "left")
        add = F.coalesce("_add", F.lit(0))
        state = stage(
            moved.withColumns({"prediction": F.col("prediction") + add, "residual": F.col("residual") - add, "node": F.lit(1)}).drop("_m", "_n", "_add"),
            "boost",
        )
    return state.drop("residual", "node"), reduce(DataFrame.unionByName, trees)


def apply_trees(rows: DataFrame, trees: DataFrame, *, rounds: int, depth: int = DEPTH) -> DataFrame:
    """Adds ``prediction``: stored trees on new rows of ``model`` and ``_bins``, by joins."""
    keyed = stage(rows.withColumn("_row", F.monotonically_increasing_id()), "apply")
    at = keyed.select("_row", "model", "_bins").withColumn("round", F.explode(F.sequence(F.lit(0), F.lit(rounds - 1)))).withColumn("node", F.lit(1))
    for level in range(depth):
        known = trees.select(F.col("round").alias("_r"), F.col("model").alias("_m"), F.col("node").alias("_n"), F.col("feature").alias("_f"), F.col("bin").alias("_b"), "left", "right")
        met = at.join(known, (F.col("round") == F.col("_r")) & (F.col("model") == F.col("_m")) & (F.col("node") == F.col("_n")), "left")
        right = F.coalesce(F.element_at("_bins", F.col("_f") + 1) > F.col("_b"), F.lit(False))
        at = met.select("_row", "model", "_bins", "round", (F.col("node") * 2 + right.cast("int")).alias("node"), F.when(right, F.col("right")).otherwise(F.col("left")).alias("_add"))
    sums = at.groupBy("_row").agg(F.sum(F.coalesce("_add", F.lit(0))).alias("prediction"))
    return keyed.join(sums, "_row").drop("_row")
