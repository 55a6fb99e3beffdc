"""Joins: point-in-time lookup, ticker mapping, and all-pairs by date.

No join here carries a broadcast hint. Dimensions are small in practice but
nothing proves it, so the choice is left to the size check Spark already
makes (``autoBroadcastJoinThreshold``, again at run time under AQE); beyond
it the same plan runs as a sort-merge join whose hot keys AQE splits.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .. import values as V
from ..session import literal, stage


def _validity(fact: DataFrame, dim: DataFrame, key: str, date: str) -> Column:
    # Half-open interval; the equality on the key keeps this a hash join.
    return (
        (fact[key] == dim["_pit_key"])
        & (fact[date] >= dim["_pit_from"])
        & (dim["_pit_to"].isNull() | (fact[date] < dim["_pit_to"]))
    )


def _versions(dim: DataFrame, dim_key: str, valid_from: str, valid_to: str, take: dict[str, str]) -> DataFrame:
    return dim.select(
        F.col(dim_key).alias("_pit_key"),
        F.col(valid_from).cast("date").alias("_pit_from"),
        F.col(valid_to).cast("date").alias("_pit_to"),
        *[F.col(c).alias(name) for c, name in take.items()],
    )


def pit_join(
    fact: DataFrame,
    dim: DataFrame,
    *,
    key: str,
    date: str,
    dim_key: str = "asset_id",
    take: dict[str, str] | None = None,
    valid_from: str = "valid_from",
    valid_to: str = "valid_to",
    how: str = "inner",
) -> DataFrame:
    """Each fact row with the dimension version valid on its date.

    ``take`` maps dimension columns to output names.
    """
    take = {"asset_key": "asset_key"} if take is None else take
    versions = _versions(dim, dim_key, valid_from, valid_to, take)
    joined = fact.join(versions, _validity(fact, versions, key, date), how)
    return joined.drop("_pit_key", "_pit_from", "_pit_to")


def pit_unmatched(
    fact: DataFrame,
    dim: DataFrame,
    *,
    key: str,
    date: str,
    dim_key: str = "asset_id",
    valid_from: str = "valid_from",
    valid_to: str = "valid_to",
) -> DataFrame:
    """Fact rows that no version covers, such as those before ``valid_from``."""
    versions = _versions(dim, dim_key, valid_from, valid_to, {})
    return fact.join(versions, _validity(fact, versions, key, date), "left_anti")


def map_symbols(
    df: DataFrame,
    tickers: DataFrame,
    *,
    col: str,
    to: str = "asset_id",
    keep_unmapped: bool = True,
    only_source: str | None = None,
) -> DataFrame:
    """Add ``to``: the asset id of an exchange ticker.

    ``keep_unmapped`` passes unknown tickers through under their own name;
    otherwise their rows are dropped. ``only_source`` limits the mapping to
    rows of that source.
    """
    lookup = tickers.select(F.col("ticker").alias("_ticker"), F.col("asset_id").alias("_mapped"))
    on = df[col] == lookup["_ticker"]
    if only_source is not None:
        on = on & (df["source"] == only_source)
    if keep_unmapped:
        out = df.join(lookup, on, "left").withColumn(to, F.coalesce("_mapped", F.col(col)))
    else:
        out = df.join(lookup, on, "inner").withColumn(to, F.col("_mapped"))
    return out.drop("_ticker", "_mapped")


def ticker_map(spark, rows: list[tuple[str, str]] | None = None) -> DataFrame:
    return literal(spark, V.TICKERS if rows is None else rows, "ticker string, asset_id string")


#: Most pair rows that one cell of the tiled pair join is planned to hold.
CELL_ROWS = 1 << 19


def pair_blocks(df: DataFrame, *, on: str, item: str, cell_rows: int = CELL_ROWS) -> tuple[DataFrame, int]:
    """The placement table of a pair join, (item, block), and the number of blocks.

    The rows of the join are known before it runs: a date with k items gives
    k (k - 1) / 2. Blocks are chosen so that a cell, which is one pair of
    blocks, holds ``cell_rows`` of them. Items are dealt to the blocks back and
    forth in order of their number of rows, so blocks are of equal size.
    The table has a row per item; the join has the square of that.
    """
    per_date = df.groupBy(on).agg(F.count(F.lit(1)).cast("double").alias("k"))
    rows = per_date.agg(F.sum(F.col("k") * (F.col("k") - 1) / 2)).first()[0] or 0.0
    blocks = max(1, math.ceil(math.sqrt(2 * rows / cell_rows)))
    return _dealt(df, item, blocks), blocks


def _dealt(df: DataFrame, item: str, blocks: int) -> DataFrame:
    sizes = df.groupBy(F.col(item).alias("_placed")).agg(F.count(F.lit(1)).alias("_n"))
    place = F.row_number().over(W.orderBy(F.col("_n").desc(), "_placed")) - 1
    forth = F.pmod(place, F.lit(blocks))
    back = F.floor(place / blocks) % 2 == 1
    return sizes.select("_placed", F.when(back, blocks - 1 - forth).otherwise(forth).cast("int").alias("_block"))


def pairs(
    df: DataFrame,
    *,
    on: str,
    item: str,
    values: list[str],
    blocks: int | None = None,
    cell_rows: int = CELL_ROWS,
) -> DataFrame:
    """Every unordered pair of items that share a value of ``on``.

    Output: ``cell``, ``on``, ``{item}_a < {item}_b`` and each value as
    ``{value}_a`` / ``{value}_b``.

    The result is quadratic in items, so the work is tiled. Items are dealt to
    blocks (``pair_blocks``) and each cell holds one pair of blocks, for all
    dates: a row is copied ``blocks + 1`` times, whatever the number of items,
    and every pair of items falls into exactly one cell. The cells are numbered
    and each is a task of its own, so their number and size follow from the data
    and not from the session. A window partitioned by (cell, pair) afterwards
    needs no second shuffle of the quadratic rows, and a busy date is spread
    over all cells instead of sitting in one task.
    """
    known = stage(df.select(on, item, *values), "pair_items")
    if blocks is None:
        placed, blocks = pair_blocks(known, on=on, item=item, cell_rows=cell_rows)
    else:
        placed = _dealt(known, item, blocks)
    rows = known.join(placed, F.col(item) == F.col("_placed")).drop("_placed")

    def cell(low: Column, high: Column) -> Column:
        """Numbers the pairs of blocks low <= high from 0."""
        return (low * blocks - (low * (low - 1) / 2).cast("int") + high - low).cast("int")

    last = F.lit(blocks - 1)
    left = rows.withColumn("_other", F.explode(F.sequence("_block", last))).select(
        cell(F.col("_block"), F.col("_other")).alias("cell"),
        (F.col("_block") == F.col("_other")).alias("_diagonal"),
        F.col(on),
        *[F.col(c).alias(f"_l_{c}") for c in [item, *values]],
    )
    right = rows.withColumn("_other", F.explode(F.sequence(F.lit(0), "_block"))).select(
        cell(F.col("_other"), F.col("_block")).alias("_r_cell"),
        F.col(on).alias("_r_on"),
        *[F.col(c).alias(f"_r_{c}") for c in [item, *values]],
    )
    cells = blocks * (blocks + 1) // 2
    left = left.repartitionById(cells, "cell")
    right = right.repartitionById(cells, "_r_cell")
    l_item, r_item = F.col(f"_l_{item}"), F.col(f"_r_{item}")
    joined = left.join(
        right,
        (F.col("cell") == F.col("_r_cell"))
        & (F.col(on) == F.col("_r_on"))
        # inside a diagonal cell both sides are the same rows
        & (~F.col("_diagonal") | (l_item < r_item)),
    )
    ordered = l_item < r_item
    out = [F.col("cell"), F.col(on)]
    for c in [item, *values]:
        left_c, right_c = F.col(f"_l_{c}"), F.col(f"_r_{c}")
        out.append(F.when(ordered, left_c).otherwise(right_c).alias(f"{c}_a"))
        out.append(F.when(ordered, right_c).otherwise(left_c).alias(f"{c}_b"))
    return joined.select(*out)
