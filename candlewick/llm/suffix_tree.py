"""Substring dedup by sorted windows, grouped by prefixes; no suffix tree is built.

Suffixes are split by prefixes of variable length. The short prefix is the k
words of an anchor (see ``repeats``): a group is all segments of an anchor,
small enough for a task's memory. A group that is not is split by longer and
longer prefixes, up to the n words of a whole window, whose only question - the
smallest document - is a plain aggregate.

In a group the windows, cut to exactly n words, are sorted; runs of equal ones
are repeats, and of a run's documents the smallest keeps the words. These runs
are what a suffix tree has below its nodes at depth n. Common prefixes, nodes of
other depths and maximal repeats are not computed: longer repeats come out as
windows one after the other, merged where words are removed.

Defined results: a null or empty text has no words and comes back empty; a row
without a doc_id takes no part and keeps all its words; repeated rows of one
doc_id do not remove each other's words; further columns pass through in
``doc``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candlewick.llm import repeats as R
from candlewick.llm import text as T

WINDOW = 50
PREFIX = 10


def deep_nodes(suffixes: list[tuple[bytes, int]]) -> Iterator[list[int]]:
    """Runs of at least two equal windows, as a suffix tree would have them below its nodes at that depth.

    A suffix is its first n words and its number.
    """
    order = sorted(range(len(suffixes)), key=lambda x: suffixes[x][0])
    run = order[:1]
    for i in order[1:]:
        if suffixes[i][0] == suffixes[run[0]][0]:
            run.append(i)
        else:
            if len(run) > 1:
                yield run
            run = [i]
    if len(run) > 1:
        yield run


def _first_windows(n: int):
    """Of each group, the windows that a smaller document has too."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple[int, int, int]] = []
        for g in R.by_group(batches, "gram"):
            if min(g["doc_id"]) == max(g["doc_id"]):
                continue
            suffixes, owner = [], []
            for row, (context, count) in enumerate(zip(g["context"], g["windows"])):
                cuts = np.flatnonzero(np.frombuffer(context, np.uint8) == 0x20)
                starts = [0, *(cuts + 1).tolist()]
                ends = [*cuts.tolist(), len(context)]
                for w in range(count):
                    suffixes.append((context[starts[w] : ends[w + n - 1]], w))
                    owner.append(row)
            for node in deep_nodes(suffixes):
                least = min(g["doc_id"][owner[x]] for x in node)
                out += [(g["gram"][0], g["seg"][owner[x]], suffixes[x][1]) for x in node if g["doc_id"][owner[x]] > least]
            if len(out) > 20000:
                yield _flags(out)
                out = []
        if out:
            yield _flags(out)

    return lambda batches: T.given_back(run(batches))


def _flags(rows: list[tuple[int, int, int]]) -> pa.RecordBatch:
    cols = list(zip(*rows))
    return pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int64()), pa.array(cols[2], pa.int32())], names=["gram", "seg", "off"])


def repeated_windows(rows: DataFrame, n: int, k: int, rows_most: int = R.GROUP_ROWS) -> DataFrame:
    """(doc_id, t_key, lo, hi): starts of windows that also begin in a smaller document."""
    found = R.repeated_segments(rows, "words", n, k)
    segs, places = R.contested(found)
    read = R.read_segments(rows, places, "words", n, k, rows_most)
    few = read.where("context IS NOT NULL").select("gram", "seg", "doc_id", "windows", "context")
    few = few.repartition("gram").sortWithinPartitions("gram").mapInArrow(_first_windows(n), "gram long, seg long, off int")
    few = few.select("gram", "seg", F.col("off").alias("a"), F.col("off").alias("b"))
    own = few.unionByName(R.crowded(read, by_doc=True)).groupBy("gram", "seg").agg(F.collect_set(F.struct("a", "b")).alias("own"))
    # a segment's windows are all removed from later documents, and from the first one as ``own`` says
    verdict = segs.select("gram", "seg", "first", "last").join(own, ["gram", "seg"], "left").where("first < last OR own IS NOT NULL")
    hit = found.join(T.staged(verdict, "verdict"), ["gram", "seg"]).where("doc_id > first OR own IS NOT NULL")
    spans = F.when(F.col("doc_id") > F.col("first"), F.array(F.struct(F.lit(0).alias("a"), (F.col("windows") - 1).alias("b")))).otherwise(F.col("own"))
    hit = hit.select("doc_id", "t_key", "lo", F.explode(spans).alias("o"))
    return hit.select("doc_id", "t_key", (F.col("lo") + F.col("o.a")).alias("lo"), (F.col("lo") + F.col("o.b")).alias("hi"))


def _remove(n: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, removed, kept = [], [], []
            for value, marks in zip(batch.column("doc").field("text").to_pylist(), batch.column("marks").to_pylist()):
                ws = (value or "").encode().split()
                spans: list[list[int]] = []
                if marks:
                    lo, hi = R.merged(np.array([m["lo"] for m in marks]), np.array([m["hi"] for m in marks]) + n)
                    spans = [[int(a), int(b)] for a, b in zip(lo, hi)]
                at, rest = 0, []
                for a, b in spans:
                    rest += ws[at:a]
                    at = b
                rest += ws[at:]
                counts.append(len(ws))
                removed.append(spans)
                kept.append(b" ".join(rest).decode())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc"), pa.array(counts, pa.int64()), pa.array(removed, pa.list_(pa.list_(pa.int64()))), pa.array(kept, pa.string())],
                names=["doc", "n_words", "spans", "kept_text"],
            )

    return lambda batches: T.given_back(run(batches))


def substring_dedup(docs: DataFrame, n: int = WINDOW, k: int = PREFIX, rows_most: int = R.GROUP_ROWS) -> DataFrame:
    """Each document (struct ``doc``) with n_words, removed word spans [from, to) and kept_text."""
    rows = R.keyed(docs)
    done = R.cover(rows, T.staged(repeated_windows(rows, n, k, rows_most), "marks"))
    kind = rows.schema["doc"].dataType.simpleString()
    return done.mapInArrow(_remove(n), f"doc {kind}, n_words long, spans array<array<bigint>>, kept_text string")


def op2_substring_dedup(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    out = substring_dedup(docs)
    gone = F.aggregate("spans", F.lit(0).cast("long"), lambda s, x: s + x[1] - x[0])
    return out.select("doc.doc_id", "n_words", gone.alias("n_removed"), F.sha2("kept_text", 256).alias("kept_sha256"))
