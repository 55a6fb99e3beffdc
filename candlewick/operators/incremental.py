"""Look-back reprocessing, backfill windows and SCD2 dimensions."""

from __future__ import annotations

from datetime import date, timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .. import values as V
from .windows import number_rows


def high_water_mark(target: DataFrame, *, date: str) -> Column:
    """Latest date in ``target``, or the sentinel while it is empty.

    A scalar subquery: it runs first, and its value can then prune
    partitions and row groups of the scan that is compared with it.
    """
    latest = target.agg(F.max(date).alias("latest")).scalar()
    return F.coalesce(latest, F.lit(V.EPOCH_SENTINEL).cast("date"))


def incremental_filter(
    source: DataFrame,
    target: DataFrame,
    *,
    date: str,
    lookback_days: int,
    target_date: str | None = None,
    per_key: str | None = None,
) -> DataFrame:
    """Source rows no older than the target's mark minus the look-back.

    The mark is global. A key that lags further than the look-back loses its
    gap that way; ``per_key`` gives each key its own mark instead.
    """
    target_date = target_date or date
    if per_key is None:
        return source.filter(F.col(date) >= F.date_sub(high_water_mark(target, date=target_date), lookback_days))
    marks = target.groupBy(F.col(per_key).alias("_key")).agg(F.max(target_date).alias("_mark"))
    marked = source.join(marks, source[per_key] == marks["_key"], "left")
    mark = F.coalesce("_mark", F.lit(V.EPOCH_SENTINEL).cast("date"))
    return marked.filter(F.col(date) >= F.date_sub(mark, lookback_days)).drop("_key", "_mark")


def changed_rows(fresh: DataFrame, stored: DataFrame, *, keys: list[str], ignore: tuple[str, ...] = ()) -> DataFrame:
    """Fresh rows that are not stored yet with just these values.

    What is fetched again every day, and is the same as before, changes nothing
    downstream. ``ignore`` names columns that do not count, such as times of arrival.
    """
    values = [c for c in fresh.columns if c not in keys and c not in ignore]
    known = stored.select(*[F.col(k).alias(f"_k_{k}") for k in keys], *[F.col(v).alias(f"_v_{v}") for v in values])
    same = [F.col(k) == F.col(f"_k_{k}") for k in keys] + [F.col(v).eqNullSafe(F.col(f"_v_{v}")) for v in values]
    return fresh.join(known, reduce(lambda a, b: a & b, same), "left_anti")


def widened(series: DataFrame, changed: DataFrame, *, by: str, order: str, rows: int) -> DataFrame:
    """Rows of a series whose frame of ``rows`` rows up to them holds a changed row.

    ``changed`` has the columns ``by`` and ``order``; days that are no longer in
    the series count for the rows after them.
    """
    marks = changed.select(F.col(by).alias("_by"), F.col(order).alias("_at")).distinct().withColumn("_changed", F.lit(1))
    marked = series.join(marks, (series[by] == marks["_by"]) & (series[order] == marks["_at"]), "full_outer")
    marked = marked.withColumns({"_by": F.coalesce(F.col(by), "_by"), "_at": F.coalesce(F.col(order), "_at")})
    frame = W.partitionBy("_by").orderBy("_at").rowsBetween(1 - rows, 0)
    hit = marked.withColumn("_hit", F.max("_changed").over(frame))
    return hit.filter((F.col("_hit") == 1) & F.col(order).isNotNull()).select(*series.columns)


def series_before(read, changed: DataFrame, *, by: str, order: str, rows: int, first: date) -> DataFrame:
    """As much of a series as frames of ``rows`` rows over all rows from the first change on reach back.

    ``read(day)`` gives the series from a day on, and ``first`` is its oldest
    day. It is read back further and further, doubling the reach, until every changed
    symbol has ``rows - 1`` rows before its first change.
    """
    starts = changed.groupBy(F.col(by).alias("_by")).agg(F.min(order).alias("_start"))
    oldest = starts.agg(F.min("_start").alias("d")).first()["d"]
    reach = 2 * rows
    while oldest is not None:
        day = oldest - timedelta(days=reach)
        series = read(day)
        if day <= first:
            return series
        before = series.join(starts, (series[by] == starts["_by"]) & (series[order] < starts["_start"]), "right")
        short = before.groupBy("_by").agg(F.count(order).alias("_n")).filter(F.col("_n") < rows - 1)
        if short.isEmpty():
            return series
        reach *= 2
    return read(first)


def backfill_days(
    control: DataFrame,
    *,
    as_of: Column,
    min_days: int = V.MIN_BACKFILL_DAYS,
    max_days: int = V.MAX_BACKFILL_DAYS,
    override: int | None = None,
) -> DataFrame:
    """Add ``backfill_days``: how far back this run must fetch, and ``days_uncovered``.

    Covers the gap since the last load, within the limits; a first load
    takes the maximum and an override is taken as it is. What lies before the
    window and was never loaded is counted as uncovered.
    """
    last = F.col("last_load_timestamp").cast("date")
    gap = F.datediff(as_of, last) + 1
    first = F.coalesce(F.col("is_first_load"), F.lit(False)) | last.isNull()
    days = F.when(first, F.lit(max_days)).otherwise(
        F.greatest(F.lit(min_days), F.least(gap, F.lit(max_days)))
    )
    if override is not None:
        days = F.lit(override)
    uncovered = F.greatest(F.coalesce(gap - days, F.lit(0)), F.lit(0))
    return control.withColumns({"backfill_days": days.cast("int"), "days_uncovered": uncovered.cast("int")})


def advance_control(control: DataFrame, *, status: Column, now: Column) -> DataFrame:
    """The control row after a run; a failed run does not move the mark."""
    progressed = status != "FAILED"
    return control.withColumns(
        {
            "last_load_timestamp": F.when(progressed, now).otherwise(F.col("last_load_timestamp")),
            "is_first_load": F.col("is_first_load") & ~progressed,
            "last_run_status": status,
            "updated_at": now,
        }
    )


def scd2_apply(
    dim: DataFrame | None,
    snapshot: DataFrame,
    *,
    key: str,
    tracked: list[str],
    first_seen: str,
    last_seen: str,
    surrogate: str,
) -> DataFrame:
    """Bring a versioned dimension up to date with a snapshot.

    ``snapshot`` has one row per ``key`` with the tracked attributes and the
    first and last date the key was seen. Current versions whose attributes
    changed are closed at the last date, and a new version opens there, so
    versions never overlap. New keys open at their first date. Keys missing
    from the snapshot are left as they are. Surrogate keys continue from the
    largest one, in key order.
    """
    if dim is None:
        fresh = snapshot.select(key, *tracked, F.col(first_seen).cast("timestamp").alias("valid_from"))
        return _open_versions(fresh, key, tracked, surrogate, start=1)

    current = dim.filter("is_current").select(
        F.col(key).alias("_key"), *[F.col(c).alias(f"_was_{c}") for c in tracked]
    )
    compared = snapshot.join(current, snapshot[key] == current["_key"], "left")
    differs = reduce(lambda a, b: a | b, [~F.col(c).eqNullSafe(F.col(f"_was_{c}")) for c in tracked])
    changed = F.col("_key").isNotNull() & differs

    closing = compared.filter(changed).select(
        F.col("_key").alias("_closing"), F.col(last_seen).cast("timestamp").alias("_closed_at")
    )
    kept = dim.join(closing, (dim[key] == closing["_closing"]) & dim["is_current"], "left")
    hit = F.col("_closing").isNotNull()
    kept = kept.withColumns(
        {
            "valid_to": F.when(hit, F.col("_closed_at")).otherwise(F.col("valid_to")),
            "is_current": F.col("is_current") & ~hit,
        }
    ).select(*dim.columns)

    # A key may also be known only through versions closed earlier.
    known = dim.groupBy(F.col(key).alias("_known")).agg(F.max("valid_to").alias("_ended"))
    opening = compared.filter(F.col("_key").isNull() | changed)
    opening = opening.join(known, opening[key] == known["_known"], "left")
    opens = F.when(F.col("_known").isNull(), F.col(first_seen)).otherwise(F.col(last_seen)).cast("timestamp")
    fresh = opening.select(key, *tracked, F.greatest(opens, F.col("_ended")).alias("valid_from"))
    top = dim.agg(F.coalesce(F.max(surrogate), F.lit(0)).alias("top")).first()["top"]
    fresh = _open_versions(fresh, key, tracked, surrogate, start=top + 1)
    return kept.unionByName(fresh.select(*dim.columns))


def _open_versions(fresh: DataFrame, key: str, tracked: list[str], surrogate: str, start: int) -> DataFrame:
    numbered = number_rows(fresh, order_by=[key], name=surrogate, start=start)
    return numbered.select(
        surrogate,
        key,
        *[c for c in tracked if c != key],
        "valid_from",
        F.lit(None).cast("timestamp").alias("valid_to"),
        F.lit(True).alias("is_current"),
    )
