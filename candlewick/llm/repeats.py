"""Suffixes worth sorting: a sample that no repeat of the wanted length misses.

Sorting the suffixes at every position of a corpus means moving hundreds of
bytes per position. Here each window of n tokens names one *anchor*: the k
tokens inside it with the smallest hash (the first of them, if several). The choice depends
on the window alone, so equal windows name the same anchor at the same place,
and only anchors have to be compared: two per n - k tokens on average. An
anchor stands for a *segment*, the run of windows that name it.

* Anchors whose k tokens occur once cannot lie in a repeat and are dropped
  after one count.
* Equal segments are merged by hash on the map side. Their windows all repeat;
  nothing about them is sorted.
* What is left - different segments around the same k tokens - is where
  repeats begin and end. One copy of each, with its text, goes to the
  operators' sorting step. An anchor with very many different segments is not
  gathered: its prefix is made longer, step by step, in grouped aggregates that
  combine on the map side. Its windows are taken in blocks by their distance
  from the anchor. Blocks that are equal throughout are one; blocks whose
  common core occurs once cannot repeat; only blocks that share a core and
  still differ - those in which a repeat begins or ends - are opened, and their
  windows compared at full length.

Hashes have 64 bits; a window or segment is keyed by two of them.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candlewick.llm import text as T

#: Different segments of one anchor that are gathered in a task; the windows of more are aggregated.
GROUP_ROWS = 512
#: Blocks into which the windows around a crowded anchor are cut.
BLOCKS = 12
#: Bytes of Arrow rows that are turned into Python objects at a time.
SLICE_BYTES = 4 << 20


def tokens_of(kind: str, data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Token hashes and each text's range of tokens."""
    if kind == "bytes":
        return T.BYTE_VALUES[data], offs
    starts, ends, ranges = T.words(data, offs)
    return T.word_hashes(data, starts, ends), ranges


def find_segments(hashes: np.ndarray, ranges: np.ndarray, n: int, k: int) -> dict[str, np.ndarray]:
    """Segments of all texts: text, first window, windows, anchor's place, its hash, the segment's hash."""
    total = len(hashes) - n + 1
    if total <= 0:
        return {x: np.zeros(0, np.int64) for x in ("text", "lo", "windows", "anchor", "gram", "seg")}
    sums = T.prefix_sums(hashes)
    _, down = T.powers(len(sums))
    gram = T.mixed((sums[k:] - sums[:-k]) * down[: len(sums) - k] + np.uint64(k))
    low = np.uint64((1 << 31) - 1)
    keyed = (gram & ~low) | np.arange(len(gram), dtype=np.uint64)  # ties go to the first
    least = T.sliding_min(keyed, n - k + 1)
    at = np.flatnonzero(T.across(ranges, n, total))
    anchor = (least[at] & low).astype(np.int64)
    new = np.ones(len(at), dtype=bool)
    new[1:] = (anchor[1:] != anchor[:-1]) | (at[1:] != at[:-1] + 1)
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(at)) - 1 if len(at) else first
    lo, hi, anchor = at[first], at[last], anchor[first]
    text = np.searchsorted(ranges, lo, "right") - 1
    seg = T.spans(sums, lo, hi + n) + (anchor - lo).astype(np.uint64)
    return {
        "text": text, "lo": lo - ranges[text], "windows": hi - lo + 1, "anchor": anchor - lo,
        "gram": gram[anchor].view(np.int64), "seg": T.mixed(seg).view(np.int64),
    }


def _scan(kind: str, n: int, k: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offs = T.utf8(batch.column("text"))
            for i, j, part, ends in T.pieces(data, offs):
                found = find_segments(*tokens_of(kind, part, ends), n, k)
                if not len(found["lo"]):
                    continue
                own = pa.array(found["text"] + i)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").take(own), batch.column("t_key").take(own), pa.array(found["gram"]), pa.array(found["seg"]), pa.array(found["lo"].astype(np.int32)), pa.array(found["windows"].astype(np.int32)), pa.array(found["anchor"].astype(np.int32))],
                    names=["doc_id", "t_key", "gram", "seg", "lo", "windows", "anchor"],
                )

    return lambda batches: T.given_back(run(batches))


def keyed(docs: DataFrame) -> DataFrame:
    """Documents with an id, whole rows aside, so that no column name can clash; t_key parts texts of one id."""
    return docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"),
        F.col("doc_id").cast("long").alias("doc_id"),
        F.xxhash64(F.col("text").cast("string")).alias("t_key"),
    )


def texts(rows: DataFrame) -> DataFrame:
    """Of the rows that take part, key and text."""
    return rows.where("doc_id IS NOT NULL").select("doc_id", "t_key", F.col("doc.text").cast("string").alias("text"))


def repeated_segments(rows: DataFrame, kind: str, n: int, k: int) -> DataFrame:
    """Segments whose anchor occurs at least twice, stored."""
    found = T.staged(
        texts(rows).mapInArrow(
            _scan(kind, n, k), "doc_id long, t_key long, gram long, seg long, lo int, windows int, anchor int"
        ),
        "segments",
    )
    # stored first: both sides of the join are then shuffled for it, and Spark can split a hot anchor's rows
    twice = T.staged(found.groupBy("gram").agg(F.count("*").alias("n")).where("n > 1").select("gram"), "anchors")
    return T.staged(found.join(twice, "gram", "left_semi"), "repeated")


def contested(found: DataFrame) -> tuple[DataFrame, DataFrame]:
    """All different segments, and of those that share an anchor with others a place to read each from."""
    segs = T.staged(
        found.groupBy("gram", "seg").agg(
            F.count("*").alias("n"), F.min("doc_id").alias("first"), F.max("doc_id").alias("last"),
            F.max("windows").alias("windows"), F.max("anchor").alias("anchor"),
        ),
        "different",
    )
    shared = T.staged(segs.groupBy("gram").agg(F.count("*").alias("members")).where("members > 1"), "shared")
    wanted = segs.join(shared, "gram").select("gram", "seg", "n", "members", F.col("first").alias("doc_id"))
    places = (
        found.join(wanted, ["gram", "seg", "doc_id"])
        .groupBy("gram", "seg", "doc_id", "windows", "anchor", "n", "members")
        .agg(F.min("t_key").alias("t_key"), F.min_by("lo", "t_key").alias("lo"))
    )
    return segs, places


def _blocks(sums: np.ndarray, start: int, windows: int, anchor: int, n: int, step: int) -> Iterator[tuple[int, int, int, int, np.ndarray]]:
    """Blocks of a segment's windows: number, first window, hash of the core, of the whole, of each window."""
    before = anchor - np.arange(windows)  # tokens of a window that stand before the anchor
    number = before // step
    for block in np.unique(number).tolist():
        own = np.flatnonzero(number == block)
        lo, hi = start + own[0], start + own[-1]
        place = start + anchor
        edges = np.array([[place - block * step, place - block * step - step + 1 + n], [lo, hi + n]])
        core, full = T.spans(sums, edges[:, 0], edges[:, 1])
        full = T.mixed(np.array([full + np.uint64(before[own[0]])], dtype=np.uint64))[0]
        at = np.arange(lo, hi + 1)
        yield block, int(own[0]), int(core.view(np.int64)), int(full.view(np.int64)), T.spans(sums, at, at + n).view(np.int64)


def _read_segments(kind: str, n: int, k: int, rows_most: int) -> Callable:
    """Text of ordinary segments, hashes of the blocks of crowded ones."""
    step = max(1, min((n - k + BLOCKS) // BLOCKS, n // 2))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offs = T.utf8(batch.column("text"))
            ids, lists = batch.column("doc_id").to_pylist(), batch.column("places")
            flat = lists.flatten()
            cols = {f: flat.field(f).to_pylist() for f in ("gram", "seg", "lo", "windows", "anchor", "members", "n")}
            bounds = np.concatenate([[0], np.cumsum(lists.value_lengths().to_numpy(zero_copy_only=False))]).astype(np.int64)
            for i, j, part, ends in T.pieces(data, offs):
                if kind == "words":
                    starts, stops, ranges = T.words(part, ends)
                raw = part.tobytes()
                out = {f: [] for f in SEGMENT_TYPES}
                sums = None
                for row in range(i, j):
                    base = int(ranges[row - i]) if kind == "words" else int(ends[row - i])
                    for p in range(bounds[row], bounds[row + 1]):
                        a, m = base + cols["lo"][p], cols["windows"][p]
                        z = a + m + n - 1
                        own = {f: cols[f][p] for f in ("gram", "seg", "windows", "anchor", "n")} | {"doc_id": ids[row]}
                        if cols["members"][p] > rows_most:  # the same for all segments of an anchor
                            if sums is None:
                                sums = T.prefix_sums(tokens_of(kind, part, ends)[0])
                            found = [dict(zip(("block", "off", "core", "full", "wholes"), b)) for b in _blocks(sums, a, m, own["anchor"], n, step)]
                        elif kind == "words":
                            found = [{"context": b" ".join(raw[starts[a] : stops[z - 1]].split())}]
                        else:
                            found = [{"context": raw[a:z]}]
                        for one in found:
                            for f in out:
                                out[f].append(own[f] if f in own else one.get(f))
                if out["gram"]:
                    yield pa.RecordBatch.from_arrays([pa.array(out[f], t) for f, t in SEGMENT_TYPES.items()], names=list(SEGMENT_TYPES))

    return lambda batches: T.given_back(run(batches))


SEGMENT_TYPES = {
    "gram": pa.int64(), "seg": pa.int64(), "doc_id": pa.int64(), "n": pa.int64(), "windows": pa.int32(), "anchor": pa.int32(),
    "context": pa.binary(), "block": pa.int32(), "off": pa.int32(), "core": pa.int64(), "full": pa.int64(), "wholes": pa.list_(pa.int64()),
}
SEGMENTS = (
    "gram long, seg long, doc_id long, n long, windows int, anchor int, context binary, block int, off int, core long, full long, wholes array<long>"
)


def read_segments(rows: DataFrame, places: DataFrame, kind: str, n: int, k: int, rows_most: int = GROUP_ROWS) -> DataFrame:
    """Contested segments with their text, or the hashes of their blocks where an anchor has too many. Stored."""
    per_doc = places.groupBy("doc_id", "t_key").agg(
        F.collect_list(F.struct("gram", "seg", "lo", "windows", "anchor", "members", "n")).alias("places")
    )
    joined = texts(rows).join(per_doc, ["doc_id", "t_key"]).select("doc_id", "text", "places")
    return T.staged(joined.mapInArrow(_read_segments(kind, n, k, rows_most), SEGMENTS), "contexts")


def crowded(read: DataFrame, by_doc: bool) -> DataFrame:
    """(gram, seg, a, b): windows of crowded segments that occur in a smaller document, or else anywhere else."""
    blocks = read.where("context IS NULL").select("gram", "seg", "doc_id", "n", "block", "off", "core", "full", "wholes")
    key = ["gram", "block", "full"]
    same = T.staged(
        blocks.groupBy(*key, "core").agg(F.min("doc_id").alias("least"), F.sum("n").alias("places"), F.first("wholes").alias("wholes")),
        "blocks",
    )
    differ = same.groupBy("gram", "block", "core").agg(F.count("*").alias("kinds")).where("kinds > 1")
    opened = same.join(differ, ["gram", "block", "core"], "left_semi").select(*key, "least", "places", F.posexplode("wholes").alias("w", "whole"))
    met = opened.groupBy("gram", "whole").agg(F.min("least").alias("w_least"), F.sum("places").alias("w_places")).where("w_places > 1")
    hits = opened.join(met, ["gram", "whole"]).where("w_least < least" if by_doc else "w_places > 1")
    hits = T.staged(hits.groupBy(*key).agg(F.collect_set("w").alias("ws")), "hits")
    verdict = same.select(*key, "least", "places").join(hits, key, "left")
    whole = F.col("doc_id") > F.col("least") if by_doc else F.col("places") > 1
    span = F.array(F.struct(F.col("off").alias("a"), (F.col("off") + F.size("wholes") - 1).alias("b")))
    some = F.transform("ws", lambda w: F.struct((F.col("off") + w).alias("a"), (F.col("off") + w).alias("b")))
    found = blocks.join(verdict, key).select("gram", "seg", F.explode(F.when(whole, span).otherwise(some)).alias("o"))
    return found.select("gram", "seg", "o.a", "o.b")


def sliced(batches: Iterator[pa.RecordBatch], most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The rows in slices of about ``most`` bytes, so that no more of them are Python objects at a time."""
    for batch in batches:
        step = max(1, batch.num_rows * most // max(1, batch.nbytes))
        for i in range(0, batch.num_rows, step):
            yield batch.slice(i, step)


def by_group(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[dict[str, list]]:
    """Rows of each run of equal keys, of sorted batches."""
    held: dict[str, list] = {}
    for batch in sliced(batches):
        keys = batch.column(key).to_numpy()
        cols = {f: batch.column(f).to_pylist() for f in batch.schema.names}
        cuts = [0, *(np.flatnonzero(keys[1:] != keys[:-1]) + 1).tolist(), len(keys)]
        for a, b in zip(cuts[:-1], cuts[1:]):
            if held and held[key][0] == keys[a]:
                for f in held:
                    held[f] += cols[f][a:b]
            else:
                if held:
                    yield held
                held = {f: v[a:b] for f, v in cols.items()}
    if held:
        yield held


def cover(rows: DataFrame, removed: DataFrame) -> DataFrame:
    """Documents, each with its intervals (lo, hi) of repeated windows; null where it has none."""
    marks = removed.groupBy("doc_id", "t_key").agg(F.collect_set(F.struct("lo", "hi")).alias("marks"))
    return rows.join(marks, ["doc_id", "t_key"], "left").select("doc", "marks")


def merged(lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Maximal runs of the union of the half-open intervals."""
    order = np.argsort(lo, kind="stable")
    lo, hi = lo[order], np.maximum.accumulate(hi[order])
    new = np.ones(len(lo), dtype=bool)
    new[1:] = lo[1:] > hi[:-1]
    first = np.flatnonzero(new)
    return lo[first], hi[np.append(first[1:], len(lo)) - 1]
