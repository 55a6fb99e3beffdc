"""Shards of equal numbers of rows on a consistent-hash ring with bounded loads.

Every shard stands on a ring of 64-bit hashes at a fixed number of points, its
virtual nodes. A row belongs to the first point clockwise of the hash of its
group (equal texts). Shards hold at most their share of all rows: the quotient
of rows and shards, and one more for the first shards of the remainder. Rows
that find their shard full go on clockwise to the next shard that is not, so
counts differ by one at most whatever the groups, equal texts share a shard
unless it fills up, and one more shard moves few rows besides those it takes.

The loads are decided for arcs, the stretches between neighbouring points. All
rows of an arc meet the shards in one order, so the ring needs the row counts
of the arcs alone: at most ``shards * points + 1`` numbers, however many rows.
All arcs first fill their own shard, in ring order, then what is left over of
each tries the next one, and so on. That gives each arc a few runs of rows, each
with its shard and its first slot; rows are numbered along the ring by a sort
over range partitions, where a large group is cut like everything else.

Defined results: a null text has 0 bytes and the checksum of no bytes, and
forms a group of its own; a null doc_id stays null and comes first in its group;
repeated rows are counted while they are sorted and get a slot each; an empty
table gives no rows; further columns are not read; texts of any length are read
once, where they lie.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from candlewick.llm import text as T
from candlewick.session import literal

SHARDS = 24
#: Points of each shard on the ring.
POINTS = 128


def ring(shards: int, points: int = POINTS) -> tuple[np.ndarray, np.ndarray]:
    """Positions of all points in ascending order, and the shard of each. More shards only add points."""
    at = [(int.from_bytes(hashlib.blake2b(f"{s}/{p}".encode(), digest_size=8).digest(), "big", signed=True), s) for s in range(shards) for p in range(points)]
    at.sort()
    return np.array([a for a, _ in at], dtype=np.int64), np.array([s for _, s in at], dtype=np.int64)


def clockwise(owners: np.ndarray, shards: int) -> np.ndarray:
    """Of each arc, all shards in the order in which its rows meet them."""
    n = len(owners)
    order = np.empty((n + 1, shards), dtype=np.int64)
    now = list(dict.fromkeys(owners.tolist()))
    # going back from the last arc, a shard moves to the front where its point stands
    for arc in range(n - 1, -1, -1):
        shard = int(owners[arc])
        now.remove(shard)
        now.insert(0, shard)
        order[arc] = now
    order[n] = order[0]  # beyond the last point the ring begins again
    return order


def capacities(rows: int, shards: int) -> list[int]:
    return [rows // shards + (s < rows % shards) for s in range(shards)]


def place(counts: np.ndarray, order: np.ndarray) -> list[tuple[int, int, int, int, int]]:
    """Runs (arc, shard, first row, end row, first slot); rows are numbered along the ring."""
    shards = order.shape[1]
    room = capacities(int(counts.sum()), shards)
    used = [0] * shards
    at = (np.cumsum(counts) - counts).tolist()
    left = counts.tolist()
    waiting = [a for a, n in enumerate(left) if n]
    runs = []
    for turn in range(shards):
        for arc in waiting:
            shard = int(order[arc, turn])
            n = min(left[arc], room[shard])
            if n:
                runs.append((arc, shard, at[arc], at[arc] + n, used[shard]))
                used[shard] += n
                room[shard] -= n
                at[arc] += n
                left[arc] -= n
        waiting = [a for a in waiting if left[a]]
    return runs


def shard(docs: DataFrame, shards: int = SHARDS, points: int = POINTS) -> DataFrame:
    """doc_id, size, text_crc32, shard and slot of every row: counts of shards differ by one at most."""
    positions, owners = ring(shards, points)
    value = F.col("text").cast("string")
    measured = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (F.coalesce(F.octet_length(value), F.lit(0)) + F.lit(8)).cast("long").alias("size"),
        F.crc32(F.coalesce(value, F.lit("")).cast("binary")).alias("text_crc32"),
        F.xxhash64(value, value.isNull()).alias("spot"),
    )
    keys = ["spot", "doc_id", "size", "text_crc32"]
    counted = measured.groupBy(*keys).agg(F.count("*").alias("n"))

    def arcs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.searchsorted(positions, batch.column("spot").to_numpy(zero_copy_only=False))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, pa.int32())], names=[*batch.schema.names, "arc"])

    ranged = counted.repartitionByRange(*keys).mapInArrow(arcs, "spot long, doc_id long, size long, text_crc32 long, n long, arc int")
    ranged = T.staged(ranged.withColumn("part", F.spark_partition_id()), "ring")
    counts = np.zeros(len(positions) + 1, dtype=np.int64)
    for r in ranged.groupBy("arc").agg(F.sum("n").alias("n")).collect():  # at most shards * points + 1 rows
        counts[r.arc] = r.n
    runs = literal(docs.sparkSession, place(counts, clockwise(owners, shards)), "run_arc int, shard int, lo long, hi long, base long")

    before = W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)  # one row of each partition
    offsets = ranged.groupBy("part").agg(F.sum("n").alias("rows")).select(F.col("part").alias("of"), F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("offset"))
    inside = W.partitionBy("part").orderBy(*keys).rowsBetween(W.unboundedPreceding, -1)
    rows = ranged.withColumn("start", F.coalesce(F.sum("n").over(inside), F.lit(0)))
    rows = rows.join(F.broadcast(offsets), F.col("part") == F.col("of")).withColumn("start", F.col("start") + F.col("offset"))
    met = rows.join(F.broadcast(runs), (F.col("arc") == F.col("run_arc")) & (F.col("start") < F.col("hi")) & (F.col("start") + F.col("n") > F.col("lo")))
    first, end = F.greatest("start", "lo"), F.least(F.col("start") + F.col("n"), F.col("hi"))
    return met.select("doc_id", "size", "text_crc32", "shard", F.explode(F.sequence(F.col("base") + first - F.col("lo"), F.col("base") + end - F.col("lo") - 1)).alias("slot"))


def op13_sharding(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    placed = shard(docs).withColumns({"law": F.lit("rows"), "grown_shard": F.lit(None).cast("int")})
    return placed.select("doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard")
