"""Window and per-key operators over daily series.

A panel holds one row per (symbol, date), so a window partitioned by symbol
is bounded by the calendar (some 365 rows a year) however many trades or
symbols there are. Operators that group by anything else, such as a date,
pre-aggregate first instead of gathering the group in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..session import stage


def _series(by: str | list[str], order: str):
    return W.partitionBy(by).orderBy(F.col(order).asc_nulls_first())


_FRAME_FUNCTIONS = {
    "avg": F.avg,
    "stddev": F.stddev_samp,
    "sum": F.sum,
    "min": F.min,
    "max": F.max,
    "count": F.count,
}


def rolling(
    df: DataFrame,
    *,
    by: str | list[str],
    order: str,
    frames: dict[str, tuple[str, str | None, int]],
    full_window: bool = False,
) -> DataFrame:
    """Add row-count windows: ``{name: (function, column, rows)}``.

    Frames are the current row and the ``rows - 1`` before it. All share one
    partitioning and order, so Spark sorts once and runs one Window node.
    ``full_window`` gives NULL until a frame holds ``rows`` values; without
    it, the partial frames at the start of a series are kept. A ``None``
    column counts rows.
    """
    series = _series(by, order)
    out = {}
    for name, (fn, column, rows) in frames.items():
        w = series.rowsBetween(-(rows - 1), 0)
        value = F.lit(1) if column is None else F.col(column)
        result = _FRAME_FUNCTIONS[fn](value).over(w)
        if full_window:
            result = F.when(F.count(value).over(w) == rows, result)
        out[name] = result
    return df.withColumns(out)


def _guarded_corr(x: Column, y: Column) -> Column:
    """Pearson correlation, NULL (not an error) for a constant side."""
    both = x.isNotNull() & y.isNotNull()
    x, y = F.when(both, x), F.when(both, y)
    return F.covar_pop(x, y) / F.nullif(F.stddev_pop(x) * F.stddev_pop(y), F.lit(0.0))


#: Values below this, in units of their last digit, are multiplied in whole numbers.
LIMB_BITS = 31
WHOLE_LIMIT = 1 << LIMB_BITS


def is_extreme(value: Column, digits: int = 4) -> Column:
    """Is a value too large for moments in whole numbers?"""
    return F.abs(value) >= WHOLE_LIMIT / 10**digits


def rolling_corr(
    df: DataFrame,
    *,
    by: list[str],
    order: str,
    x: str,
    y: str,
    rows: dict[str, int],
    counts: dict[str, int] | None = None,
    digits: int = 4,
    extreme: bool | None = None,
) -> DataFrame:
    """Add rolling Pearson correlations and row counts: ``{name: rows}`` each, of less than 65,536 rows.

    ``x`` and ``y`` have at most ``digits`` decimals, so in units of the last
    digit all moments are whole numbers. A frame's moments are then exactly
    the running totals at its end minus those before its start: the cost per
    row does not grow with the frame, nothing drifts, and a constant side is
    recognised by a variance of exactly zero, which gives NULL.

    Values under 2^31 units (a daily return of 214,748 percent) have products of
    62 bits, whose upper and lower 31 bits are summed apart. With ``extreme``
    every frame is computed from its own values instead, centred and scaled by
    its largest, which takes any finite number and time that grows with the
    frame. ``None`` looks for such values in ``df`` first, which is a pass over
    it; where its source is smaller, look there.
    """
    if extreme is None:
        extreme = not df.filter(is_extreme(F.col(x), digits) | is_extreme(F.col(y), digits)).isEmpty()
    series = _series(by, order)
    seen = {name: F.least(F.row_number().over(series), F.lit(n)).cast("bigint") for name, n in (counts or {}).items()}
    if extreme:
        out = df.withColumns(seen)
        for name, n in rows.items():
            out = _frame_corr(out, F.col(x), F.col(y), series.rowsBetween(1 - n, 0), name)
        return out

    both = F.col(x).isNotNull() & F.col(y).isNotNull()
    mask = F.lit(WHOLE_LIMIT - 1).cast("bigint")

    def upper(value: Column) -> Column:
        return F.shiftright(value, LIMB_BITS)

    def lower(value: Column) -> Column:
        return value.bitwiseAND(mask)

    def whole(c: str) -> Column:
        return F.coalesce(F.when(both, F.round(F.col(c) * 10**digits)).cast("bigint"), F.lit(0).cast("bigint"))

    units = df.withColumns({"_x": whole(x), "_y": whole(y)})
    products = {"_xx": F.col("_x") * F.col("_x"), "_yy": F.col("_y") * F.col("_y"), "_xy": F.col("_x") * F.col("_y")}
    moments = {"_n": both.cast("bigint"), "_sx": F.col("_x"), "_sy": F.col("_y")}
    for name, product in products.items():
        moments |= {f"{name}u": upper(product), f"{name}l": lower(product)}
    so_far = series.rowsBetween(W.unboundedPreceding, 0)
    running = units.withColumns({m: F.sum(value).over(so_far) for m, value in moments.items()} | seen)
    before = {f"{m}{n}": F.lag(m, n, 0).over(series) for n in rows.values() for m in moments}
    framed = running.withColumns(before)

    def corr(n: int) -> Column:
        def within(m: str) -> Column:
            return F.col(m) - F.col(f"{m}{n}")

        def spread(m: str, a: Column, b: Column) -> Column:
            """Exactly n * sum(a b) - sum(a) * sum(b), as a number of upper limbs and a lower one."""
            limbs = within("_n") * within(f"{m}u") - upper(a) * lower(b) - lower(a) * upper(b)
            low = within("_n") * within(f"{m}l") - lower(a) * lower(b)
            high = limbs - upper(a) * upper(b) * F.lit(WHOLE_LIMIT).cast("bigint") + upper(low)
            return high.cast("double") * float(WHOLE_LIMIT) + lower(low).cast("double")

        sx, sy = within("_sx"), within("_sy")
        vx, vy = spread("_xx", sx, sx), spread("_yy", sy, sy)
        return spread("_xy", sx, sy) / F.nullif(F.sqrt(vx) * F.sqrt(vy), F.lit(0.0))

    return framed.withColumns({name: corr(n) for name, n in rows.items()}).drop("_x", "_y", *moments, *before)


def _frame_corr(df: DataFrame, x: Column, y: Column, frame, name: str) -> DataFrame:
    """Add the Pearson correlation of a frame from its values, scaled by the largest of each side."""
    known = F.when(x.isNotNull() & y.isNotNull(), F.struct(x.alias("x"), y.alias("y")))
    both = F.col("_both")

    def total(values: Column) -> Column:
        return F.aggregate(values, F.lit(0.0), lambda s, v: s + v)

    df = df.withColumn("_both", F.collect_list(known).over(frame))
    for side in "xy":
        largest = F.array_max(F.transform(both, lambda r: F.abs(r[side])))
        df = df.withColumn(f"_m{side}", F.nullif(largest, F.lit(0.0)))
        df = df.withColumn(f"_d{side}", F.transform(both, lambda r: F.coalesce(r[side] / F.col(f"_m{side}"), F.lit(0.0))))
        df = df.withColumn(f"_m{side}", total(F.col(f"_d{side}")) / F.nullif(F.size(both), F.lit(0)))
        df = df.withColumn(f"_d{side}", F.transform(f"_d{side}", lambda v: v - F.col(f"_m{side}")))
    vx, vy = (total(F.transform(f"_d{side}", lambda v: v * v)) for side in "xy")
    product = total(F.zip_with("_dx", "_dy", lambda a, b: a * b))
    return df.withColumn(name, product / F.nullif(F.sqrt(vx) * F.sqrt(vy), F.lit(0.0))).drop("_both", "_mx", "_my", "_dx", "_dy")


def autocorrelation(df: DataFrame, *, by: str, order: str, col: str, lags: list[int]) -> DataFrame:
    """Per series and lag: correlation of ``col`` and |``col``| with their past."""
    series = _series(by, order)
    shifted = df.filter(F.col(col).isNotNull()).select(
        by, F.col(col).alias("_x"), *[F.lag(col, k).over(series).alias(f"_lag{k}") for k in lags]
    )
    aggs = []
    for k in lags:
        x, past = F.col("_x"), F.col(f"_lag{k}")
        aggs.append(
            F.struct(
                F.lit(k).alias("lag"),
                _guarded_corr(x, past).alias("autocorrelation"),
                _guarded_corr(F.abs(x), F.abs(past)).alias("abs_autocorrelation"),
                F.count(past).alias("observations"),
            )
        )
    wide = shifted.groupBy(by).agg(F.array(*aggs).alias("_lags"))
    return wide.select(by, F.inline("_lags"))


def latest_per(df: DataFrame, *, by: str | list[str], order: str) -> DataFrame:
    """The newest row per key.

    An aggregate rather than ``row_number() = 1``: each map task keeps one
    row per key, so a key with a third of all rows costs no more than others.
    """
    by = [by] if isinstance(by, str) else by
    rest = [c for c in df.columns if c not in by]
    row = F.struct(*rest)
    newest = df.groupBy(*by).agg(F.max_by(row, F.col(order)).alias("_row"))
    return newest.select(*by, "_row.*").select(*df.columns)


def group_rank(df: DataFrame, *, by: str, value: str, high: str, low: str) -> DataFrame:
    """Add both ``rank()``s of ``value`` inside each group, ties sharing a rank.

    ``high`` ranks descending with NULLs first, ``low`` ascending with NULLs
    last. A rank is one plus the number of rows that sort before, so it
    follows from counts per distinct value; only those counts are gathered
    per group, never the group's rows.
    """
    counts = df.groupBy(F.col(by).alias("_by"), F.col(value).alias("_value")).agg(
        F.count(F.lit(1)).alias("_n")
    )
    w = W.partitionBy("_by").orderBy(F.col("_value").desc_nulls_first())
    through = F.sum("_n").over(w.rowsBetween(W.unboundedPreceding, 0))
    total = F.sum("_n").over(W.partitionBy("_by"))
    ranks = counts.select(
        "_by",
        "_value",
        (through - F.col("_n") + 1).alias(high),
        (total - through + 1).alias(low),
    )
    # NULLs rank 1 going down and last going up, like any other value
    on = (df[by] == ranks["_by"]) & df[value].eqNullSafe(ranks["_value"])
    return df.join(ranks, on).drop("_by", "_value")


def number_rows(df: DataFrame, *, order_by: list[str], name: str, start: int = 1) -> DataFrame:
    """``row_number() over (order by ...)`` without a one-task window.

    Rows are range-partitioned and stored with their partition number, which
    makes the split final; row counts of the partitions (as many rows as
    partitions) then give each its offset.
    """
    ranged = df.repartitionByRange(*[F.col(c).asc_nulls_last() for c in order_by]).withColumn(
        "_part", F.spark_partition_id()
    )
    ranged = stage(ranged, "numbered")
    before = W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    sizes = ranged.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    offsets = sizes.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    inside = W.partitionBy("_part").orderBy(*[F.col(c).asc_nulls_last() for c in order_by])
    return (
        ranged.withColumn("_row", F.row_number().over(inside))
        .join(F.broadcast(offsets), "_part")
        .withColumn(name, (F.col("_offset") + F.col("_row") + (start - 1)).cast("bigint"))
        .drop("_part", "_row", "_offset")
    )
