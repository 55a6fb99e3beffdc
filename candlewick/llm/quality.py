"""Quality classifier: a factorisation machine.

Features are a text's distinct words, hashed, and statistics of its structure
and the n_chars column, each cut into bins. A pair of features has the inner
product of two short vectors as its weight; the sum over all pairs of a
document takes linear time, as half of the squared sum less the sum of squares
of those vectors.

The model is fitted on a sample of labelled documents whose size is the
parameter ``sample``, the first by the hash of their id. It has a fixed size
and is sent to all tasks; scoring reads every whole text.

Defined results: a null or empty text is scored by its structure alone; a null
label or doc_id is not learned from; of labels for one id the least counts;
repeated rows are scored each; further columns pass through.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candlewick.llm import text as T

BUCKETS = 1 << 16
FACTORS = 8
SAMPLE = 6000
EPOCHS = 6
THRESHOLD = 0.3
STAT_BINS = 16
_UPPER = T._table(range(0x41, 0x5B))
_LOWER = T._table(range(0x61, 0x7B))
_DIGIT = T._table(range(0x30, 0x3A))
_SIGN = T._table([*range(0x21, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x7F)])
_CLOSE = T._table(b".,;:!?")
N_STATS = 13


def structure(data: np.ndarray, offs: np.ndarray, starts: np.ndarray, ends: np.ndarray, ranges: np.ndarray, hashes: np.ndarray, n_chars: np.ndarray) -> np.ndarray:
    """Statistics of each text, a row per text."""
    share = lambda a, b: a / np.maximum(b, 1)
    size, words = np.diff(offs), np.diff(ranges)
    letters_up, letters = T.totals(_UPPER[data], offs), T.totals(_LOWER[data], offs)
    signs, close = T.totals(_SIGN[data], offs), T.totals(_CLOSE[data], offs)
    lines, dup = T.repeated_lines(data, offs, starts)
    own = T.own_keys(hashes, T.owners(ranges))
    again = T.repeated(own)
    distinct = np.full(len(words), 0)
    if len(own):
        _, first = np.unique(own, return_index=True)
        distinct = np.bincount(np.searchsorted(ranges, first, "right") - 1, minlength=len(words))
    return np.column_stack([
        np.log1p(words), np.log1p(np.maximum(n_chars, 0)), share(ends_sum(starts, ends, ranges), words), share(letters_up, letters_up + letters),
        share(signs - close, size), share(close, words), share(T.totals(_DIGIT[data], offs), size), share(T.totals(data >= 0x80, offs), size),
        share(distinct, words), share(dup, lines), share(T.totals(T.repeated_words(hashes, ranges, 5), ranges), words),
        share(words, lines), share(T.totals(again, ranges), words),
    ])


def ends_sum(starts: np.ndarray, ends: np.ndarray, ranges: np.ndarray) -> np.ndarray:
    return T.totals(ends - starts, ranges)


def _features(batch: pa.RecordBatch, buckets: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]]:
    """Of each piece: first row, end, hashed distinct words, each text's range of them, statistics."""
    chars = batch.column("n_chars").fill_null(0).to_numpy(zero_copy_only=False)
    for i, j, data, offs in T.pieces(*T.utf8(batch.column("text"))):
        starts, ends, ranges = T.words(data, offs)
        hashes = T.word_hashes(data, starts, ends)
        text = T.owners(ranges)
        bucket = (hashes >> np.uint64(64 - (buckets.bit_length() - 1))).astype(np.int64)
        both = np.unique(text * buckets + bucket)
        yield i, j, both % buckets, np.searchsorted(both, np.arange(j - i + 1) * buckets), structure(data, offs, starts, ends, ranges, hashes, chars[i:j])


class Machine:
    """Bias, weights and factors over words, then over bins of statistics."""

    def __init__(self, cuts: np.ndarray, buckets: int, factors: int):
        rng = np.random.default_rng(7)
        self.cuts, self.buckets = cuts, buckets  # cuts: a row per statistic
        size = buckets + cuts.shape[0] * (cuts.shape[1] + 1)
        self.bias = 0.0
        self.weights = np.zeros((size, 1 + factors), dtype=np.float32)
        self.weights[:, 1:] = rng.normal(0, 0.01, (size, factors))

    def rows(self, words: np.ndarray, ranges: np.ndarray, stats: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Features, their values, and each text's range of them."""
        n, m = stats.shape
        wide = self.cuts.shape[1] + 1
        bins = np.column_stack([np.searchsorted(c, stats[:, k]) for k, c in enumerate(self.cuts)]) + self.buckets + np.arange(m) * wide
        counts = np.diff(ranges)
        out = np.zeros(n + 1, dtype=np.int64)
        np.cumsum(counts + m, out=out[1:])
        feature, value = np.empty(out[-1], dtype=np.int64), np.empty(out[-1], dtype=np.float32)
        place = np.arange(len(words)) + np.repeat(np.arange(n) * m, counts)
        feature[place] = words
        value[place] = np.repeat(1 / np.sqrt(np.maximum(counts, 1)), counts)
        at = (out[1:, None] - m + np.arange(m)).ravel()
        feature[at], value[at] = bins.ravel(), 1 / np.sqrt(m)
        return feature, value, out

    def sums(self, feature: np.ndarray, value: np.ndarray, ranges: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Score before the logistic function, and the factors' sums."""
        x = self.weights[feature] * value[:, None]
        total = np.add.reduceat(x, ranges[:-1], axis=0)
        squares = np.add.reduceat((x[:, 1:] ** 2).sum(axis=1), ranges[:-1])
        pairs = 0.5 * ((total[:, 1:] ** 2).sum(axis=1) - squares)
        return self.bias + total[:, 0] + pairs, total[:, 1:]

    def fit(self, texts: list[tuple[np.ndarray, np.ndarray, int]], epochs: int, step: float = 0.15, penalty: float = 1e-5, batch: int = 64) -> None:
        """Adaptive gradient steps on logistic loss."""
        rng = np.random.default_rng(11)
        seen, seen_bias = np.full(self.weights.shape, 1e-6, dtype=np.float32), 1e-6
        for _ in range(epochs):
            order = rng.permutation(len(texts))
            for a in range(0, len(order), batch):
                own = [texts[i] for i in order[a : a + batch]]
                ranges = np.concatenate([[0], np.cumsum([len(w) for w, _, _ in own])])
                feature, value, ranges = self.rows(np.concatenate([w for w, _, _ in own]), ranges, np.array([s for _, s, _ in own]))
                score, total = self.sums(feature, value, ranges)
                slope = (1 / (1 + np.exp(-np.clip(score, -30, 30))) - np.array([y for _, _, y in own])).astype(np.float32)
                size = np.diff(ranges)
                pull = np.repeat(slope, size) * value
                grad = np.empty((len(feature), self.weights.shape[1]), dtype=np.float32)
                grad[:, 0] = pull
                grad[:, 1:] = pull[:, None] * (np.repeat(total, size, axis=0) - self.weights[feature, 1:] * value[:, None])
                by = np.argsort(feature, kind="stable")
                where = np.flatnonzero(np.diff(feature[by], prepend=-1))
                ids = feature[by][where]
                step_grad = np.add.reduceat(grad[by], where, axis=0) / len(own) + penalty * self.weights[ids]
                seen[ids] += step_grad**2
                self.weights[ids] -= step * step_grad / np.sqrt(seen[ids])
                seen_bias += float(slope.mean()) ** 2
                self.bias -= step * float(slope.mean()) / np.sqrt(seen_bias)


def _extract(buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j, words, ranges, stats in _features(batch, buckets):
                rows = [words[a:b].astype(np.int32).tobytes() for a, b in zip(ranges[:-1], ranges[1:])]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(i, j - i), batch.column("label").slice(i, j - i), pa.array(rows, pa.binary()), pa.array([s.tobytes() for s in stats], pa.binary())],
                    names=["doc_id", "label", "words", "stats"],
                )

    return lambda batches: T.given_back(run(batches))


def _inputs(docs: DataFrame) -> list:
    n_chars = F.col("n_chars").cast("long") if "n_chars" in docs.columns else F.lit(None).cast("long")
    return [F.col("text").cast("string").alias("text"), n_chars.alias("n_chars")]


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, buckets: int = BUCKETS, factors: int = FACTORS, epochs: int = EPOCHS) -> Machine:
    """Fit on the first ``sample`` labelled documents by hash of their id; labels: doc_id, label (0 or 1)."""
    chosen = labels.where("doc_id IS NOT NULL AND label IS NOT NULL").groupBy("doc_id").agg(F.min("label").cast("int").alias("label"))
    chosen = chosen.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)  # so the broadcast is bounded
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), *_inputs(docs)).join(F.broadcast(chosen), "doc_id").dropDuplicates(["doc_id"])
    found = rows.mapInArrow(_extract(buckets), "doc_id long, label int, words binary, stats binary").collect()
    found.sort(key=lambda r: r["doc_id"])
    stats = np.array([np.frombuffer(r["stats"]) for r in found]).reshape(len(found), N_STATS)
    cuts = np.quantile(stats, np.linspace(0, 1, STAT_BINS + 1)[1:-1], axis=0).T if len(found) else np.zeros((N_STATS, STAT_BINS - 1))
    machine = Machine(np.ascontiguousarray(cuts), buckets, factors)
    machine.fit([(np.frombuffer(r["words"], np.int32), s, r["label"]) for r, s in zip(found, stats)], epochs)
    return machine


def score(docs: DataFrame, machine: Machine) -> DataFrame:
    """Every document (struct ``doc``) with its score from 0 to 1."""
    shared = docs.sparkSession.sparkContext.broadcast(pickle.dumps(machine))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = pickle.loads(shared.value)
        for batch in batches:
            inputs = pa.RecordBatch.from_arrays([batch.column("doc").field("text"), batch.column("n_chars")], names=["text", "n_chars"])
            for i, j, words, ranges, stats in _features(inputs, model.buckets):
                found, _ = model.sums(*model.rows(words, ranges, stats))
                yield pa.RecordBatch.from_arrays([batch.column("doc").slice(i, j - i), pa.array(1 / (1 + np.exp(-np.clip(found.astype(np.float64), -30, 30))))], names=["doc", "score"])

    typed = [F.col(f"`{c}`").cast("string").alias(c) if c == "text" else F.col(f"`{c}`") for c in docs.columns]
    rows = docs.select(F.struct(*typed).alias("doc"), _inputs(docs)[1])  # the text goes to Python once
    return rows.mapInArrow(lambda batches: T.given_back(run(batches)), f"doc {rows.schema['doc'].dataType.simpleString()}, score double")


def held_out(doc_id):
    return F.crc32(doc_id.cast("string")) % 5 == 0


def quality_model(spark, docs: DataFrame, sf_dir: str) -> Machine:
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", F.col("quality").alias("label"))
    return train(docs, labels.where(~held_out(F.col("doc_id"))))


def op4_quality_classifier(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "n_chars")
    out = score(docs, quality_model(spark, docs, sf_dir))
    return out.select("doc.doc_id", held_out(F.col("doc.doc_id")).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
