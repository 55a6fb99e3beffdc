"""Exact top-k search by inner product, by distributed histogram selection.

Queries and candidates are packed into blocks; every query block meets every
candidate block once per round. A round counts scores in a histogram for each
query, over the range in which its k-th best score is known to lie, and keeps
the one bin that holds it. When the bins are one wide the k-th value is known
exactly. A last pass keeps what scores higher, and of what scores the same the
smallest ids. Histograms have a fixed size, so what a query gathers does not
depend on the number of candidates or on ties.

Defined results: vectors that are null, empty or hold a null or non-finite
component, and rows without an id, take no part; vectors meet only vectors of
their own length; a row does not meet rows of its own id; repeated candidates
are ranked each, repeated queries are answered each; further columns are not
read. Scores must fit into 63 bits.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candlewick.llm import text as T

QUERY_BLOCK = 512
CANDIDATE_BLOCK = 4096
BINS = 1024
#: Histograms of one query block that a task adds up.
FAN_IN = 64

BLOCK = "block long, dim int, ids binary, vectors binary, norm double"


def _blocks(size: int, scale: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {}
        number = TaskContext.get().partitionId() << 32

        def block(dim: int) -> pa.RecordBatch:
            nonlocal number
            ids = np.concatenate([x for x, _ in held[dim]])
            vectors = np.concatenate([v for _, v in held[dim]])
            held[dim] = [(ids[size:], vectors[size:])] if len(ids) > size else []
            ids, vectors = ids[:size], vectors[:size]
            norm = float(np.sqrt((vectors.astype(np.float64) ** 2).sum(axis=1)).max())
            number += 1
            return pa.RecordBatch.from_arrays(
                [pa.array([number], pa.int64()), pa.array([dim], pa.int32()), pa.array([ids.tobytes()], pa.binary()), pa.array([vectors.tobytes()], pa.binary()), pa.array([norm])],
                names=["block", "dim", "ids", "vectors", "norm"],
            )

        for batch in batches:
            vectors = batch.column("vector")
            ids = batch.column("id").to_numpy(zero_copy_only=False)
            lengths = vectors.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
            flat = vectors.flatten()
            values = flat.fill_null(float("nan")).to_numpy(zero_copy_only=False).astype(np.float64)
            starts = np.cumsum(lengths) - lengths
            for dim in np.unique(lengths[lengths > 0]).tolist():
                rows = np.flatnonzero(lengths == dim)
                found = values[starts[rows][:, None] + np.arange(dim)]
                good = np.isfinite(found).all(axis=1)
                whole = np.floor(found[good] * scale).astype(np.int64)
                held.setdefault(dim, []).append((ids[rows[good]].astype(np.int64), whole))
                while sum(len(x) for x, _ in held[dim]) >= size:
                    yield block(dim)
        for dim in held:
            if sum(len(x) for x, _ in held[dim]):
                yield block(dim)

    return run


def _scores(row: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Query ids, candidate ids, and the scores; a row's own id has the least score there is."""
    dim = row["dim"]
    q, c = (np.frombuffer(row[x], np.int64).reshape(-1, dim) for x in ("q_vectors", "vectors"))
    exact = row["q_norm"] * row["norm"] < 2**52
    scores = np.rint(q.astype(np.float64) @ c.T.astype(np.float64)).astype(np.int64) if exact else q @ c.T
    return np.frombuffer(row["q_ids"], np.int64), np.frombuffer(row["ids"], np.int64), scores


def _histograms(bins: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                q_ids, ids, scores = _scores(row)
                low, high, width = (np.frombuffer(row[x], np.int64)[:, None] for x in ("low", "high", "width"))
                at = (scores - low) // np.maximum(width, 1)
                at[(scores < low) | (scores >= high) | (q_ids[:, None] == ids)] = bins
                at += np.arange(len(q_ids))[:, None] * (bins + 1)
                counts = np.bincount(at.ravel(), minlength=len(q_ids) * (bins + 1))
                yield pa.RecordBatch.from_arrays([pa.array([row["q"]], pa.int32()), pa.array([row["block"] % FAN_IN], pa.int64()), pa.array([counts.tobytes()], pa.binary())], names=["q", "team", "counts"])

    return run


def _add(rows: pd.DataFrame) -> pd.DataFrame:
    total = sum(np.frombuffer(x, np.int64) for x in rows["counts"])
    return pd.DataFrame({"q": [rows["q"].iloc[0]], "team": [rows["team"].iloc[0]], "counts": [total.tobytes()]})


def _locate(bins: int, k: int):
    """The bin that holds the k-th best score; the whole range if there are fewer. A width of 0 says that it is known."""

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        row = rows.iloc[0]
        low, width, above = (np.frombuffer(row[x], np.int64) for x in ("low", "width", "above"))
        counts = np.frombuffer(row["counts"], np.int64).reshape(len(low), bins + 1)[:, :bins]
        upto = above[:, None] + np.cumsum(counts[:, ::-1], axis=1)[:, ::-1]
        enough = upto >= k
        few = ~enough.any(axis=1)
        at = np.where(few, 0, bins - 1 - np.argmax(enough[:, ::-1], axis=1))
        higher = upto[np.arange(len(low)), at] - counts[np.arange(len(low)), at]
        known = width == 0
        few &= ~known
        done = known | few | (width == 1)
        out = row[["q", "dim", "q_ids", "q_vectors", "q_norm"]].to_dict()
        out["high"] = (low + (at + 1) * width).astype(np.int64).tobytes()
        out["low"] = np.where(few, np.iinfo(np.int64).min, np.where(known, low, low + at * width)).astype(np.int64).tobytes()
        out["width"] = np.where(done, 0, -(-width // bins)).astype(np.int64).tobytes()
        out["above"] = np.where(known, above, higher).astype(np.int64).tobytes()
        out["open"] = bool((~done).any())
        return pd.DataFrame([out])

    return run


def _best(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                q_ids, ids, scores = _scores(row)
                low = np.frombuffer(row["low"], np.int64)
                order = np.argsort(ids, kind="stable")
                out = []
                for i, q_id in enumerate(q_ids):
                    own = scores[i, order]
                    other = ids[order] != q_id
                    more = order[other & (own > low[i])]
                    if len(more) > k:  # only where fewer than k candidates exist is low no bound
                        more = more[np.lexsort((ids[more], -scores[i, more]))[:k]]
                    same = order[other & (own == low[i])][:k]
                    out += [(row["q"], i, int(q_id), int(ids[j]), int(scores[i, j])) for j in (*more, *same)]
                if out:
                    q, i, a, b, s = zip(*out)
                    yield pa.RecordBatch.from_arrays([pa.array(q, pa.int32()), pa.array(i, pa.int32()), pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(s, pa.int64())], names=["q", "row", "query_id", "vec_id", "score"])

    return run


STATE = "q int, dim int, q_ids binary, q_vectors binary, q_norm double, low binary, high binary, width binary, above binary, open boolean"


def exact_top_k(queries: DataFrame, candidates: DataFrame, k: int, scale: int = 256, bins: int = BINS, query_block: int = QUERY_BLOCK, candidate_block: int = CANDIDATE_BLOCK) -> DataFrame:
    """(query_id, rank, vec_id, score) for tables (id, vector): the k highest integer scores, ties to smaller ids.

    A component x counts as floor(scale * x).
    """
    spark = queries.sparkSession
    both = [x.where("id IS NOT NULL AND vector IS NOT NULL").select(F.col("id").cast("long").alias("id"), F.col("vector").cast("array<double>").alias("vector")) for x in (queries, candidates)]
    cands = T.staged(both[1].mapInArrow(_blocks(candidate_block, scale), BLOCK), "candidates")
    asked = T.staged(both[0].mapInArrow(_blocks(query_block, scale), BLOCK), "queries")
    most = cands.agg(F.max("norm")).first()[0] or 0.0
    reach = 1

    def start(rows: pd.DataFrame) -> pd.DataFrame:
        row = rows.iloc[0]
        n = len(row["ids"]) // 8
        bound = int(row["norm"] * most) + 2
        width = max(1, -(-(2 * bound + 1) // bins))
        full = lambda x: np.full(n, x, np.int64).tobytes()
        return pd.DataFrame([{"q": row["q"], "dim": row["dim"], "q_ids": row["ids"], "q_vectors": row["vectors"], "q_norm": row["norm"], "low": full(-bound), "high": full(-bound + bins * width), "width": full(width), "above": full(0), "open": True}])

    numbered = asked.select("block").rdd.map(lambda r: r[0]).zipWithIndex().toDF("block long, q int")
    asked = T.staged(asked.join(numbered, "block"), "queries")
    reach = asked.count()
    if not reach:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    tiles = cands.select("*", F.explode(F.sequence(F.lit(0), F.lit(reach - 1))).alias("q"))
    state = T.staged(asked.groupBy("q").applyInPandas(start, STATE), "state")
    while state.where("open").limit(1).count():
        met = tiles.join(state, ["q", "dim"])
        parts = met.mapInArrow(_histograms(bins), "q int, team long, counts binary")
        sums = parts.groupBy("q", "team").applyInPandas(_add, "q int, team long, counts binary")
        sums = sums.groupBy("q").applyInPandas(_add, "q int, team long, counts binary").drop("team")
        state = T.staged(sums.join(state, "q").groupBy("q").applyInPandas(_locate(bins, k), STATE), "state")
    found = tiles.join(state, ["q", "dim"]).mapInArrow(_best(k), "q int, row int, query_id long, vec_id long, score long")
    from pyspark.sql import Window

    rank = F.row_number().over(Window.partitionBy("q", "row").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op8_exact_top_k(spark, sf_dir: str) -> DataFrame:
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select(F.col("vec_id").alias("id"), F.col("embedding").alias("vector"))
    return exact_top_k(rows.where("id % 50 = 0"), rows, k=5)


OP8_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS e
  FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id,
         CAST(list_sum(list_transform(list_zip(q.e, c.e), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id AND len(q.e) = len(c.e)
), r AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s
)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
"""
