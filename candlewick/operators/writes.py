"""Keyed write semantics over Parquet tables.

Each operator is a pure function of DataFrames; ``merge_table`` applies one
to a stored table and touches only the month partitions the batch falls in.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, datetime
from urllib.parse import quote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..session import literal, stage


def _order(order_by: str | list[str]) -> Column:
    names = [order_by] if isinstance(order_by, str) else order_by
    return F.struct(*[F.col(c) for c in names])


def _one_per_key(batch: DataFrame, keys: list[str], order: Column | None, last: bool) -> DataFrame:
    # Aggregated map-side, so one key repeated many times stays cheap.
    rest = [c for c in batch.columns if c not in keys]
    if not rest:
        return batch.distinct()
    row = F.struct(*rest)
    # maps have no order of their own
    kinds = dict(batch.dtypes)
    ordered = [F.array_sort(F.map_entries(c)) if kinds[c].startswith("map") else F.col(c) for c in rest]
    rank = F.struct(*ordered) if order is None else F.struct(order, *ordered)
    pick = F.max_by(row, rank) if last else F.min_by(row, rank)
    return batch.groupBy(*keys).agg(pick.alias("_row")).select(*keys, "_row.*").select(*batch.columns)


def upsert(
    target: DataFrame, batch: DataFrame, *, keys: list[str], order_by: str | list[str] | None
) -> DataFrame:
    """Insert or replace by key; inside the batch the last row by ``order_by`` wins.

    Columns of ``order_by`` that the target lacks are dropped once the winner
    is known. ``None`` says that the batch has one row per key; it is then
    taken as it is, and needs no aggregate.
    """
    winners = batch if order_by is None else _one_per_key(batch, keys, _order(order_by), last=True)
    winners = winners.select(*target.columns)
    return target.join(batch.select(*keys).distinct(), keys, "left_anti").unionByName(winners)


def delete_insert(target: DataFrame, batch: DataFrame, *, keys: list[str]) -> DataFrame:
    """Drop target rows whose key is in the batch, then add the whole batch.

    Unlike ``upsert``, repeated keys inside the batch are all kept.
    """
    return target.join(batch.select(*keys).distinct(), keys, "left_anti").unionByName(batch)


def append_new_only(
    log: DataFrame, batch: DataFrame, *, keys: list[str], order_by: str | list[str] | None = None
) -> tuple[DataFrame, DataFrame]:
    """(new log, rows that were new): keys already logged are left alone."""
    order = None if order_by is None else _order(order_by)
    firsts = _one_per_key(batch, keys, order, last=False)
    new_rows = firsts.join(log.select(*keys), keys, "left_anti").select(*batch.columns)
    return log.unionByName(new_rows.select(*log.columns)), new_rows


def _files(spark: SparkSession, path: str):
    """File system of a path, and what makes paths of it."""
    make = spark._jvm.org.apache.hadoop.fs.Path
    return make(path).getFileSystem(spark._jsc.hadoopConfiguration()), make


def _move(fs, source, target) -> None:
    """Rename, or fail: Hadoop only returns false, and moves into a folder that is there already."""
    if fs.exists(target) or not fs.rename(source, target):
        raise OSError(f"cannot move {source} to {target}")


def _located(spark: SparkSession, path: str) -> str | None:
    """Where the rows of a table are: under its name, or where a broken-off replacement has them whole."""
    fs, at = _files(spark, path)
    if fs.exists(at(path)):
        return path
    return next((p for p in (f"{path}.new", f"{path}.old") if fs.exists(at(f"{p}/_SUCCESS"))), None)


def _pending(spark: SparkSession, path: str) -> tuple[list[str], str | None] | None:
    """Months that a stored change of a table still replaces, and the first of those it replaces altogether."""
    fs, at = _files(spark, path)
    if not fs.exists(at(f"{path}.pending/_SUCCESS")) or fs.exists(at(f"{path}.pending/_DONE")):
        return None
    names = [f.getPath().getName() for f in fs.listStatus(at(f"{path}.pending"))]
    months = sorted(n[6:] for n in names if n.startswith("month="))
    return months, next((n[6:] for n in names if n.startswith("_from-")), None)


def table_exists(spark: SparkSession, path: str) -> bool:
    """Is there a table? Looking changes nothing, so readers and a writer do not get into each other's way."""
    return _located(spark, path) is not None or _pending(spark, path) is not None


def _read(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Rows of a table that exists, with their ``month`` (NULL if it is not stored by month).

    A change that is stored whole counts already, whether or not its months
    have been put in their place.
    """
    names = StructType.fromDDL(schema).names
    reader = spark.read.schema(f"{schema}, month string")
    found, change = _located(spark, path), _pending(spark, path)
    rows = reader.parquet(found).select(*names, "month") if found else literal(spark, [], f"{schema}, month string")
    if change is None:
        return rows
    months, first = change
    if first is not None:
        rows = rows.filter(F.col("month") < first)
    rows = rows.filter(~F.col("month").isin(months))
    return rows.unionByName(reader.parquet(f"{path}.pending").select(*names, "month")) if months else rows


def _settle(spark: SparkSession, path: str) -> None:
    """Finish what a broken-off writer left behind. Writers begin with it."""
    fs, at = _files(spark, path)
    found = _located(spark, path)
    if found not in (None, path):
        _move(fs, at(found), at(path))
    _put(spark, path)
    for rest in ("new", "old", "pending"):
        fs.delete(at(f"{path}.{rest}"), True)


def _put(spark: SparkSession, path: str) -> None:
    """Put the months of a stored change in their place; doing it again gives the same."""
    change = _pending(spark, path)
    if change is None:
        return
    months, first = change
    fs, at = _files(spark, path)
    if months:
        rows = spark.read.parquet(f"{path}.pending").withColumn("month", F.col("month").cast("string"))
        _write_months(rows, path, "overwrite")
    if first is not None and fs.exists(at(path)):
        for status in fs.listStatus(at(path)):
            name = status.getPath().getName()
            if name.startswith("month=") and name[6:] >= first and name[6:] not in months:
                fs.delete(status.getPath(), True)


def _change(rows: DataFrame, path: str, first: str | None = None) -> None:
    """Replace the months of ``rows``, and with ``first`` all others from that month on.

    The change is stored beside the table first, and is valid from the moment it
    is whole: what is left is to put its months in their place, which the next
    writer does if this one dies. It stays there until then, for readers that
    have begun with it. The table is settled before ``rows`` read it.
    """
    spark = rows.sparkSession
    fs, at = _files(spark, path)
    if first is not None:
        fs.mkdirs(at(f"{path}.pending"))
        fs.create(at(f"{path}.pending/_from-{first}")).close()
    _write_months(rows, f"{path}.pending", "append")
    _put(spark, path)
    fs.create(at(f"{path}.pending/_DONE")).close()


def _swap(df: DataFrame, path: str, write: Callable[[DataFrame, str], None]) -> None:
    """Write a new table beside the old one, then put it in its place.

    A job that dies leaves the old table, or both whole under other names;
    ``_located`` then takes the new one.
    """
    spark = df.sparkSession
    _settle(spark, path)
    fs, at = _files(spark, path)
    write(df, f"{path}.new")
    if fs.exists(at(path)):
        _move(fs, at(path), at(f"{path}.old"))
    _move(fs, at(f"{path}.new"), at(path))
    fs.delete(at(f"{path}.old"), True)


def read_or_empty(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A stored table, or no rows of its schema before its first write."""
    if not table_exists(spark, path):
        return literal(spark, [], schema)
    return _read(spark, path, schema).drop("month")


def newest_stored(spark: SparkSession, path: str, schema: str, *, column: str):
    """Largest ``column`` of a table stored by month, or None without rows.

    The newest month is known from the partition names; only that month is
    scanned.
    """
    if not table_exists(spark, path):
        return None
    stored = _read(spark, path, schema)
    month = stored.agg(F.max("month").alias("month")).first()["month"]
    return stored.filter(F.col("month") == month).agg(F.max(column).alias("newest")).first()["newest"]


def read_since(spark: SparkSession, path: str, schema: str, *, date_col: str, since: date) -> DataFrame:
    """Rows from ``since`` on of a table stored by month; older months are not read."""
    if not table_exists(spark, path):
        return literal(spark, [], schema)
    stored = _read(spark, path, schema)
    return stored.filter((F.col("month") >= f"{since:%Y%m}") & (F.col(date_col) >= since)).drop("month")


def read_arrived(
    spark: SparkSession, path: str, schema: str, *, date_col: str, since: date, arrived: str, after: datetime | None
) -> DataFrame:
    """Rows of a table stored by month that are new: dated from ``since`` on, or arrived at ``after`` or later.

    ``since`` alone would lose what a symbol that lagged behind brings later.
    Months without new arrivals are skipped by the statistics of their files.
    Without ``after`` all rows are new.
    """
    if not table_exists(spark, path):
        return literal(spark, [], schema)
    stored = _read(spark, path, schema).drop("month")
    if after is None:
        return stored
    return stored.filter((F.col(date_col) >= since) | (F.col(arrived) >= after))


def replace_from(spark: SparkSession, path: str, batch: DataFrame, *, month_of: str, since: date) -> None:
    """Replace all rows from the day ``since`` on; older months are neither read nor rewritten.

    ``month_of`` is a date column or a yyyymmdd integer; ``batch`` does not read the table.
    """
    _settle(spark, path)
    fields, first = batch.schema, f"{since:%Y%m}"
    if not table_exists(spark, path):
        overwrite_table(batch, path, month_of=month_of)
        return
    ddl = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in fields)
    day = F.lit(since) if fields[month_of].dataType.typeName() == "date" else F.lit(int(f"{since:%Y%m%d}"))
    kept = _read(spark, path, ddl).filter((F.col("month") == first) & (F.col(month_of) < day)).drop("month")
    _change(kept.unionByName(batch).withColumn("month", _month(fields, month_of)), path, first)


def overwrite_table(df: DataFrame, path: str, *, month_of: str | None = None) -> None:
    """Full rebuild of a table that ``df`` does not read, by month if it has dates."""
    if month_of is None:
        _swap(df, path, lambda rows, to: rows.write.mode("overwrite").parquet(to))
    else:
        dated = df.withColumn("month", _month(df.schema, month_of))
        _swap(dated, path, lambda rows, to: _write_months(rows, to, "overwrite", "static"))


def replace_table(df: DataFrame, path: str) -> None:
    """Full rebuild from the table's own rows, staged before it is replaced."""
    overwrite_table(stage(df, "rebuild"), path)


def replace_slice(df: DataFrame, path: str, **values: str) -> None:
    """Replace the rows of a table that have these values, whatever was stored for them before.

    The slice is a folder of its own, so writing it again gives the same table
    and others are not touched.
    """
    where = "/".join(f"{name}={quote(value, safe='')}" for name, value in values.items())
    df.drop(*values).write.mode("overwrite").parquet(f"{path}/{where}")


def _month(fields: StructType, month_of: str) -> Column:
    if fields[month_of].dataType.typeName() == "date":
        return F.date_format(month_of, "yyyyMM")
    return F.floor(F.col(month_of) / 100).cast("string")


def _touched(spark: SparkSession, path: str, batch: DataFrame, schema: str) -> DataFrame:
    """Stored rows of the months in ``batch``; other months are not read."""
    if not table_exists(spark, path):
        return literal(spark, [], schema)
    # one row per month
    months = [r.month for r in batch.select("month").distinct().collect()]
    return _read(spark, path, schema).filter(F.col("month").isin(months)).drop("month")


def _write_months(rows: DataFrame, path: str, mode: str, overwrite: str = "dynamic") -> None:
    # one shuffle by month, split where a month is large
    rows.hint("rebalance", "month").write.mode(mode).option(
        "partitionOverwriteMode", overwrite
    ).partitionBy("month").parquet(path)


def append_to_log(
    spark: SparkSession,
    path: str,
    batch: DataFrame,
    *,
    schema: str,
    month_of: str,
    keys: list[str],
    order_by: str | None = None,
) -> DataFrame:
    """Append rows with new keys to a log stored by month; returns those rows.

    Repeating a batch appends nothing. The returned rows are staged, so they
    do not change once the log contains them.
    """
    fields = StructType.fromDDL(schema)
    batch = stage(batch.withColumn("month", _month(fields, month_of)), "batch")
    _settle(spark, path)
    log = _touched(spark, path, batch, schema)
    _, new_rows = append_new_only(log, batch.drop("month"), keys=keys, order_by=order_by)
    new_rows = stage(new_rows, "new_rows")
    months = new_rows.select(_month(fields, month_of).alias("month")).distinct()
    added = new_rows.select(*fields.names).withColumn("month", _month(fields, month_of))
    kept = log.withColumn("month", _month(fields, month_of)).join(months, "month", "left_semi")
    if not new_rows.isEmpty():
        _change(kept.select(*fields.names, "month").unionByName(added), path)
    return new_rows


def merge_table(
    spark: SparkSession,
    path: str,
    batch: DataFrame,
    *,
    schema: str,
    month_of: str,
    merge: Callable[[DataFrame, DataFrame], DataFrame],
) -> None:
    """Apply ``merge(target, batch)`` to a table partitioned by month.

    ``month_of`` is a date column of the key, or a yyyymmdd integer. Months
    the batch does not touch are neither read nor rewritten. A job that dies
    leaves the table as it was, or as it is afterwards, in all its months
    (``_change``); repeating the same batch gives the same table.
    """
    fields = StructType.fromDDL(schema)
    month = _month(fields, month_of)
    batch = stage(batch.select(*fields.names).withColumn("month", month), "batch")
    _settle(spark, path)
    merged = merge(_touched(spark, path, batch, schema), batch.drop("month"))
    _change(merged.select(*fields.names).withColumn("month", month), path)
