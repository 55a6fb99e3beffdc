"""Substring dedup over bytes with a distributed suffix array.

Suffixes begin at anchors (see ``repeats``). They are dealt out by range of
their leading bytes: Spark samples the splitters. Splitters compare k bytes,
the shortest common prefix that a repeat around an anchor can have, so suffixes
that share a repeat never lie on two sides of a boundary, and a bucket's
neighbours need no second look. Spark sorts a bucket by these bytes and the
anchor's hash. The full sort is per anchor, not per bucket: the segments of one
anchor, 512 at most, are sorted by radix rounds that take eight bytes as one key
and treat all ties at once (numpy's lexsort); neighbours then give the longest
common prefixes, and the intervals of equal prefix are the repeats. Suffixes of
different anchors are not compared, as no repeat lies in both. Anchors with more
segments bypass the array: grouped aggregates find their repeats (``repeats``).

A window may begin left of its anchor. In each interval of common prefix r,
the rows sorted by their reversed left sides give the longest common left side
l of each row with any other: its windows that begin n - r to l bytes before
the anchor occur elsewhere.

Defined results: a null or empty text has no bytes and comes back empty; a row
without a doc_id takes no part; a repeated row is another place, so its
strings repeat; further columns pass through in ``doc``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candlewick.llm import repeats as R
from candlewick.llm import text as T

WINDOW = 400
LEADING = 32


def multikey_order(suffixes: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Order of the suffixes, and how many bytes each shares with the one before it in that order.

    Each round partitions all ties by the next eight bytes; what is alone
    leaves. Zero bytes that fill up the last key compare as equal, so the
    shared length is cut to the shorter suffix.
    """
    n = len(suffixes)
    lengths = np.array([len(s) for s in suffixes], dtype=np.int64)
    starts = np.zeros(n + 1, dtype=np.int64)
    widths = (lengths + 7) // 8 * 8
    np.cumsum(widths, out=starts[1:])
    data = np.frombuffer(b"".join(s.ljust(w, b"\0") for s, w in zip(suffixes, widths.tolist())), ">u8")
    order = np.arange(n)
    shared = np.zeros(n, dtype=np.int64)
    tied = [(0, n)] if n > 1 else []
    live = np.arange(n)  # places in the order that are still tied
    group = np.zeros(n, dtype=np.int64)
    depth = 0
    while len(tied) and len(live):
        rows = order[live]
        has = depth < widths[rows]
        key = np.zeros(len(rows), dtype=np.uint64)
        key[has] = data[(starts[rows[has]] + depth) // 8]
        by = np.lexsort((key, has, group))
        rows, key, has = rows[by], key[by], has[by]
        order[live] = rows
        old = group[1:] != group[:-1]  # groups are runs of places already
        new = (key[1:] != key[:-1]) | (has[1:] != has[:-1])
        split = np.flatnonzero(new & ~old)
        diff = key[split] ^ key[split + 1]
        same = np.zeros(len(split), dtype=np.int64)
        for b in range(1, 8):
            same += (diff >> np.uint64(64 - 8 * b)) == 0
        both = np.minimum(lengths[rows[split]], lengths[rows[split + 1]])
        shared[live[split + 1]] = np.minimum(depth + same, both)
        edge = np.concatenate([[True], new | old, [True]])
        alone = edge[:-1] & edge[1:]
        ended = ~has  # a tie of ended suffixes is equal throughout
        first = edge[:-1]
        tie = ended & ~first
        shared[live[tie]] = np.minimum(lengths[rows[tie]], lengths[order[live[tie] - 1]])
        number = np.cumsum(edge[:-1])
        keep = ~alone & ~ended
        live, group = live[keep], number[keep]
        depth += 8
    return order, shared


def common_prefix(a: bytes, b: bytes) -> int:
    most = min(len(a), len(b))
    if a[:most] == b[:most]:
        return most
    lo, hi = 0, most
    while hi - lo > 1:
        mid = (lo + hi) // 2
        if a[lo:mid] == b[lo:mid]:
            lo = mid
        else:
            hi = mid
    return lo


def intervals(order: np.ndarray, shared: np.ndarray, lo: int, hi: int) -> Iterator[tuple[int, np.ndarray]]:
    """Each interval of the suffix array: the length of its common prefix and its rows."""
    todo = [(lo, hi)]
    while todo:
        lo, hi = todo.pop()
        inner = shared[lo + 1 : hi]
        r = int(inner.min())
        yield r, order[lo:hi]
        cuts = [lo, *(np.flatnonzero(inner == r) + lo + 1).tolist(), hi]
        todo += [(a, b) for a, b in zip(cuts[:-1], cuts[1:]) if b - a > 1]


def _flagged(group: dict[str, list], n: int) -> list[tuple[int, int, int, int]]:
    """(gram, seg, from, to): windows of a segment that begin elsewhere too."""
    out = []
    size = len(group["seg"])
    right = [c[a:] for c, a in zip(group["context"], group["anchor"])]
    left = [c[a - 1 :: -1] if a else b"" for c, a in zip(group["context"], group["anchor"])]

    def flag(row: int, r: int, common: int) -> None:
        a, m = group["anchor"][row], group["windows"][row]
        lo, hi = max(0, a - common), min(m - 1, a - (n - r))
        if lo <= hi:
            out.append((group["gram"][row], group["seg"][row], lo, hi))

    if size == 2:
        r, common = common_prefix(*right), common_prefix(*left)
        if r + common >= n:
            flag(0, r, common)
            flag(1, r, common)
        return out
    order, shared = multikey_order(right)
    for r, rows in intervals(order, shared, 0, size):
        rows = sorted(rows.tolist(), key=lambda x: left[x])
        near = [common_prefix(left[a], left[b]) for a, b in zip(rows[:-1], rows[1:])]
        for i, row in enumerate(rows):
            best = max(near[i - 1] if i else -1, near[i] if i < len(near) else -1)
            if best + r >= n:
                flag(row, r, best)
    return out


def _array_windows(n: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple[int, int, int, int]] = []
        for group in R.by_group(batches, "gram"):
            if len(group["gram"]) > 1:
                out += _flagged(group, n)
            if len(out) > 20000:
                yield _ranges(out)
                out = []
        if out:
            yield _ranges(out)

    return lambda batches: T.given_back(run(batches))


def _ranges(rows: list[tuple[int, int, int, int]]) -> pa.RecordBatch:
    g, s, a, b = zip(*rows)
    return pa.RecordBatch.from_arrays([pa.array(g, pa.int64()), pa.array(s, pa.int64()), pa.array(a, pa.int32()), pa.array(b, pa.int32())], names=["gram", "seg", "a", "b"])


def repeated_strings(rows: DataFrame, n: int, k: int, rows_most: int = R.GROUP_ROWS) -> DataFrame:
    """(doc_id, t_key, lo, hi): first bytes of windows that begin elsewhere too."""
    spark = rows.sparkSession
    found = R.repeated_segments(rows, "bytes", n, k)
    segs, places = R.contested(found)
    read = R.read_segments(rows, places, "bytes", n, k, rows_most)
    few = read.where("context IS NOT NULL").select("gram", "seg", "windows", "anchor", "context")
    lead = F.substring("context", F.col("anchor") + 1, F.lit(k))
    buckets = max(2, int(spark.conf.get("spark.sql.shuffle.partitions")))
    few = few.withColumn("lead", lead).repartitionByRange(buckets, "lead").sortWithinPartitions("lead", "gram").drop("lead")
    few = few.mapInArrow(_array_windows(n), "gram long, seg long, a int, b int")
    own = few.unionByName(R.crowded(read, by_doc=False)).groupBy("gram", "seg").agg(F.collect_set(F.struct("a", "b")).alias("own"))
    # a segment that occurs twice repeats as a whole
    verdict = segs.select("gram", "seg", "n").join(own, ["gram", "seg"], "left").where("n > 1 OR own IS NOT NULL")
    hit = found.join(T.staged(verdict, "verdict"), ["gram", "seg"])
    spans = F.when(F.col("n") > 1, F.array(F.struct(F.lit(0).alias("a"), (F.col("windows") - 1).alias("b")))).otherwise(F.col("own"))
    hit = hit.select("doc_id", "t_key", "lo", F.explode(spans).alias("o"))
    return hit.select("doc_id", "t_key", (F.col("lo") + F.col("o.a")).alias("lo"), (F.col("lo") + F.col("o.b")).alias("hi"))


def _cut(n: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, removed, kept = [], [], []
            for value, marks in zip(batch.column("doc").field("text").to_pylist(), batch.column("marks").to_pylist()):
                raw = (value or "").encode()
                spans: list[list[int]] = []
                if marks:
                    lo, hi = R.merged(np.array([m["lo"] for m in marks]), np.array([m["hi"] for m in marks]) + n)
                    spans = [[int(a), int(b)] for a, b in zip(lo, hi)]
                at, rest = 0, []
                for a, b in spans:
                    rest.append(raw[at:a])
                    at = b
                rest.append(raw[at:])
                sizes.append(len(raw))
                removed.append(spans)
                kept.append(b"".join(rest))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc"), pa.array(sizes, pa.int64()), pa.array(removed, pa.list_(pa.list_(pa.int64()))), pa.array(kept, pa.binary())],
                names=["doc", "n_bytes", "spans", "kept_bytes"],
            )

    return lambda batches: T.given_back(run(batches))


def suffix_array_dedup(docs: DataFrame, n: int = WINDOW, k: int = LEADING, rows_most: int = R.GROUP_ROWS) -> DataFrame:
    """Each document (struct ``doc``) with n_bytes, removed byte spans [from, to) and kept_bytes."""
    rows = R.keyed(docs)
    done = R.cover(rows, T.staged(repeated_strings(rows, n, k, rows_most), "marks"))
    kind = rows.schema["doc"].dataType.simpleString()
    return done.mapInArrow(_cut(n), f"doc {kind}, n_bytes long, spans array<array<bigint>>, kept_bytes binary")


def op10_suffix_array_dedup(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    out = suffix_array_dedup(docs)
    gone = F.aggregate("spans", F.lit(0).cast("long"), lambda s, x: s + x[1] - x[0])
    return out.select(
        "doc.doc_id", "n_bytes", gone.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept_bytes", 256).alias("kept_sha256"),
    )
