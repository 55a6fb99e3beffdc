"""Collocations of two to four words, counted in depth-truncated suffix subtrees.

Every word begins a suffix that ends with its piece, or after DEPTH words. The
suffixes of a corpus make one tree; it is built in parts that fit into memory:

1. Texts become runs of word numbers, with a list of words of each run (``coded``).
2. Vertical partitioning: suffixes are counted by hash buckets of their first
   word. Buckets of more than a share of the memory budget are extended by one
   word and counted again, and so on. What is left are prefixes of one to DEPTH
   words; buckets of them are joined into groups of at most BUDGET suffixes.
   The bucket table has a fixed size per group (``buckets``): eight bytes for
   each BUDGET / 16 words of the corpus.
3. Each run adds up its equal suffixes and sends them to their groups, a row for
   each group. A prefix that was extended lies above the subtrees; its count is
   summed as a row of its own.
4. A group sorts its suffixes by word numbers. Neighbours with fewer than d common
   words are the borders of the nodes of depth d, and the count of a node is
   the sum of its leaves.

A word or phrase is joined with the counts of its parts. Very frequent parts, at
most HOT_PARTS of them per depth, are broadcast; any other part occurs in at most
its count / MIN_COUNT candidates, so no key of the join is large.

Defined results: a null lang is ``und``; a null or empty text has no words; texts
of any length count whole; repeated rows count each; ties are in order of the
phrase's bytes; an empty table gives no rows; further columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from candlewick.llm import text as T

DEPTH = 4
MIN_COUNT = 30
#: A candidate goes if a longer one around it has this percentage of its count.
WITHIN_PERCENT = 80
TOP = 2000
SCORE = 2_000_000
UNKNOWN_LANG = "und"
#: Suffixes of a group, after runs have added up theirs: some 60 bytes each while they are sorted.
BUDGET = 1 << 20
#: Prefixes of more than this part of the budget are extended.
SHARE = 8
MIN_BUCKETS = 1 << 18
RUN_BYTES = 8 << 20
#: Parts above a 1/HOT_PARTS of all words are looked up by broadcast.
HOT_PARTS = 4096

_BREAK = T._table([*b".,;:!?", *range(0x0A, 0x0E)])
_WORD = ~(T._table([0x20, 0x09]) | _BREAK)
_STEP = np.uint64(0x9E3779B97F4A7C15)

CODED = "lang string, words binary, codes binary"


# --- 1. texts as word numbers ------------------------------------------------------------------


def _strings(data: np.ndarray, sizes: np.ndarray) -> pa.Array:
    offsets = np.zeros(len(sizes) + 1, dtype=np.int64)
    np.cumsum(sizes, out=offsets[1:])
    return pa.Array.from_buffers(pa.large_binary(), len(sizes), [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(data.tobytes())])


def coded_run(data: np.ndarray, offs: np.ndarray) -> tuple[pa.Array, np.ndarray]:
    """Different words of a run of texts, and the texts as their numbers from 1; 0 ends a piece."""
    data = T.lowered(data)
    starts, ends, ranges = T.words(data, offs, _WORD)
    encoded = _strings(data[_WORD[data]], ends - starts).dictionary_encode()
    codes = encoded.indices.to_numpy().astype(np.int32) + 1
    breaks = np.zeros(len(data) + 1, dtype=np.int64)
    np.cumsum(_BREAK[data], out=breaks[1:])
    piece = breaks[starts] + np.repeat(np.arange(len(ranges) - 1), np.diff(ranges))  # grows at breaks and between texts
    jumps = np.flatnonzero(np.diff(piece)) + 1
    return encoded.dictionary, np.append(np.insert(codes, jumps, 0), np.int32(0)).astype(np.int32)


def _packed(values: bytes) -> bytes:
    return len(values).to_bytes(8, "little") + pa.compress(values, codec="zstd", asbytes=True)


def _unpacked(values: bytes) -> bytes:
    return pa.decompress(values[8:], int.from_bytes(values[:8], "little"), codec="zstd", asbytes=True)


def _listed(words: pa.Array) -> bytes:
    """Words in one blob: no word has a blank in it."""
    return _packed(b" ".join(words.to_pylist()))


def _words(blob: bytes) -> list[bytes]:
    return _unpacked(blob).split(b" ")


def _code(run_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs = batch.column("lang")
            for lang in pc.unique(langs).to_pylist():
                data, offs = T.utf8(pc.filter(batch.column("text"), pc.equal(langs, lang)))
                for _, _, some, at in T.pieces(data, offs, run_bytes):
                    words, codes = coded_run(some, at)
                    if len(words):
                        yield pa.RecordBatch.from_arrays([pa.array([lang]), pa.array([_listed(words)], pa.binary()), pa.array([_packed(codes.tobytes())], pa.binary())], names=["lang", "words", "codes"])

    return run


def coded(docs: DataFrame, run_bytes: int = RUN_BYTES) -> DataFrame:
    lang = F.coalesce(F.col("lang").cast("string"), F.lit(UNKNOWN_LANG)).alias("lang")
    return docs.select(lang, F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")).mapInArrow(_code(run_bytes), CODED)


# --- 2. prefixes and their groups --------------------------------------------------------------


def _word_hashes(lang: str, words: list[bytes]) -> np.ndarray:
    """Of each word number a hash that depends on the language; that of no word is 0."""
    data = np.frombuffer(b"".join(words), np.uint8)
    ends = np.cumsum([len(w) for w in words])
    seed = T.word_hashes(np.frombuffer(lang.encode() + b"\0", np.uint8), np.array([0]), np.array([len(lang.encode()) + 1]))[0]
    return np.append(np.uint64(0), T.mixed(T.word_hashes(data, np.append(0, ends[:-1]), ends) ^ seed))


class Suffixes:
    """All suffixes of one run: the numbers of their words, 0 beyond the end of their piece."""

    def __init__(self, lang: str, words: bytes, codes: bytes, depth: int = DEPTH):
        self.lang, self.words = lang, _words(words)
        all_codes = np.frombuffer(_unpacked(codes), np.int32)
        at = np.flatnonzero(all_codes)
        padded = np.append(all_codes, np.zeros(depth, np.int32))
        self.columns = [padded[at]]
        for d in range(1, depth):
            self.columns.append(np.where(self.columns[-1] != 0, padded[at + d], 0))
        self.hashes = _word_hashes(lang, self.words)

    def prefix_hashes(self) -> Iterator[np.ndarray]:
        h = np.zeros(len(self.columns[0]), dtype=np.uint64)
        for column in self.columns:
            h = T.mixed(h * _STEP + self.hashes[column])
            yield h


def _bucket(h: np.ndarray, buckets: int) -> np.ndarray:
    return (h >> np.uint64(20)).astype(np.int64) & (buckets - 1)


def _loads(extended: list[np.ndarray], buckets: int):
    """Suffixes of each bucket of prefixes one word longer than those in ``extended`` buckets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        loads = np.zeros(buckets, dtype=np.int64)
        for batch in batches:
            for lang, words, codes in zip(*(batch.column(c).to_pylist() for c in ("lang", "words", "codes"))):
                suffixes = Suffixes(lang, words, codes)
                inside = np.ones(len(suffixes.columns[0]), dtype=bool)
                for d, h in enumerate(suffixes.prefix_hashes()):
                    inside &= suffixes.columns[d] != 0
                    if d == len(extended):
                        loads += np.bincount(_bucket(h[inside], buckets), minlength=buckets)
                        break
                    inside &= extended[d][_bucket(h, buckets)]
        some = np.flatnonzero(loads)
        yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(loads[some])], names=["bucket", "n"])

    return run


class Partition:
    """Which buckets of prefixes are extended, and the group of each other bucket. Prefixes of a group are equally long."""

    def __init__(self, extended: list[np.ndarray], groups: list[np.ndarray], ends: list[int]):
        self.extended, self.groups, self.ends = extended, groups, ends
        self.buckets = len(groups[0])


def vertical_partition(runs: DataFrame, total: int, budget: int = BUDGET) -> Partition:
    """Extend prefixes until each bucket holds a share of the budget at most, and fill groups with them."""
    buckets = max(MIN_BUCKETS, 1 << (16 * total // budget).bit_length())
    extended: list[np.ndarray] = []
    groups: list[np.ndarray] = []
    ends: list[int] = []
    group = 0
    for depth in range(1, DEPTH + 1):
        room = budget
        loads = np.zeros(buckets, dtype=np.int64)
        found = runs.mapInArrow(_loads(extended, buckets), "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n")).toPandas()  # at most one row of each bucket
        loads[found["bucket"].to_numpy(dtype=np.int64)] = found["n"].to_numpy(dtype=np.int64)
        # a whole truncated suffix cannot be extended: it is one leaf, however often it occurs
        over = (loads > budget // SHARE) if depth < DEPTH else np.zeros(buckets, dtype=bool)
        own = np.zeros(buckets, dtype=np.int32)
        for b in np.flatnonzero((loads > 0) & ~over).tolist():
            load = min(int(loads[b]), budget // SHARE)
            if load > room:
                group, room = group + 1, budget
            own[b] = group
            room -= load
        extended.append(over)
        groups.append(own)
        group += 1
        ends.append(group)
        if not over.any():
            break
    return Partition(extended, groups, ends)


# --- 3. suffixes of the groups, and prefixes above them ----------------------------------------


def _distinct(keys: list[np.ndarray], weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted order of the first of equal rows of keys, and the sum of their weights."""
    order = np.lexsort(keys[::-1])
    new = np.ones(len(order), dtype=bool)
    new[1:] = False
    for k in keys:
        k = k[order]
        new[1:] |= k[1:] != k[:-1]
    first = np.flatnonzero(new)
    return order[first], np.add.reduceat(weights[order], first) if len(first) else np.zeros(0, np.int64)


def _paired(columns: list[np.ndarray]) -> list[np.ndarray]:
    """Two 32-bit columns in one, so that there is half as much to sort."""
    wide = [c.astype(np.int64) for c in columns]
    return [(wide[i] << 32) | wide[i + 1] for i in range(0, len(wide) - 1, 2)] + wide[len(wide) // 2 * 2 :]


def _sent(partition: Partition):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lang, words, codes in zip(*(batch.column(c).to_pylist() for c in ("lang", "words", "codes"))):
                s = Suffixes(lang, words, codes)
                group = np.full(len(s.columns[0]), -1, dtype=np.int32)
                inside = s.columns[1] != 0  # a word alone is counted as a word
                for d, h in enumerate(s.prefix_hashes()):
                    if d == len(partition.groups):
                        break
                    inside &= s.columns[d] != 0
                    bucket = _bucket(h, partition.buckets)
                    over = partition.extended[d][bucket]
                    done = inside & ~over
                    group[done] = partition.groups[d][bucket[done]]
                    inside &= over
                at = np.flatnonzero(group >= 0)
                if not len(at):
                    continue
                first, n = _distinct([group[at], *_paired([c[at] for c in s.columns])], np.ones(len(at), np.int64))
                at = at[first]
                edges = np.append(np.flatnonzero(np.diff(group[at], prepend=-1)), len(at))
                names = pa.array(s.words, pa.binary())
                rows = []
                for lo, hi in zip(edges[:-1].tolist(), edges[1:].tolist()):
                    used, local = np.unique(np.stack([c[at[lo:hi]] for c in s.columns]), return_inverse=True)
                    # number 0 stays that of no word
                    local = local.reshape(len(s.columns), -1).astype(np.int32) + (used[0] != 0)
                    listed = _listed(names.take(pa.array(used[used != 0] - 1)))
                    rows.append((int(group[at[lo]]), lang, listed, _packed(local.astype(np.int32).tobytes()), _packed(n[lo:hi].astype(np.int64).tobytes())))
                for i in range(0, len(rows), 64):
                    cols = list(zip(*rows[i : i + 64]))
                    yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int32()), pa.array(cols[1], pa.string()), *[pa.array(c, pa.binary()) for c in cols[2:]]], names=["group", "lang", "words", "codes", "counts"])

    return run


def _phrases(names: pa.Array, columns: list[np.ndarray]) -> pa.Array:
    parts = [names.take(pa.array(c - 1)) for c in columns]
    return pc.binary_join_element_wise(*parts, b" ") if len(parts) > 1 else parts[0]


def _nodes(lang: str, names: pa.Array, columns: list[np.ndarray], n: np.ndarray, depth: int) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([lang] * len(n), pa.string()), _phrases(names, columns).cast(pa.string()), pa.array([depth] * len(n), pa.int32()), pa.array(n, pa.int64())],
        names=["lang", "phrase", "depth", "f"],
    )


NODES = "lang string, phrase string, depth int, f long"


def _above(partition: Partition):
    """Counts of the prefixes of two words and more that were extended."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lang, words, codes in zip(*(batch.column(c).to_pylist() for c in ("lang", "words", "codes"))):
                s = Suffixes(lang, words, codes)
                names = pa.array(s.words, pa.binary())
                inside = np.ones(len(s.columns[0]), dtype=bool)
                for d, h in enumerate(s.prefix_hashes()):
                    if d == len(partition.extended):
                        break
                    inside &= (s.columns[d] != 0) & partition.extended[d][_bucket(h, partition.buckets)]
                    at = np.flatnonzero(inside)
                    if d and len(at):
                        columns = [c[at] for c in s.columns[: d + 1]]
                        first, n = _distinct(_paired(columns), np.ones(len(at), np.int64))
                        yield _nodes(lang, names, [c[first] for c in columns], n, d + 1)

    return run


def _word_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for lang, words, codes in zip(*(batch.column(c).to_pylist() for c in ("lang", "words", "codes"))):
            names = pa.array(_words(words), pa.binary())
            n = np.bincount(np.frombuffer(_unpacked(codes), np.int32), minlength=len(names) + 1)[1:]
            yield _nodes(lang, names, [np.arange(1, len(names) + 1)], n, 1)


# --- 4. subtrees -------------------------------------------------------------------------------


def subtree(least: int, ends: list[int]):
    """Nodes of one group's subtree that occur often enough: its prefixes, if of two words or more, and all below."""

    def run(key: tuple, rows: pa.Table) -> pa.Table:
        found = []
        prefix = 1 + int(np.searchsorted(ends, key[0].as_py(), "right"))
        langs = rows.column("lang")
        for lang in pc.unique(langs).to_pylist():
            own = rows.filter(pc.equal(langs, lang))
            lists = [_words(w) for w in own.column("words").to_pylist()]
            encoded = pa.array([w for x in lists for w in x], pa.binary()).dictionary_encode()
            number = encoded.indices.to_numpy().astype(np.int32) + 1
            columns, counts, at = [[] for _ in range(DEPTH)], [], 0
            for x, codes, n in zip(lists, own.column("codes").to_pylist(), own.column("counts").to_pylist()):
                numbers = np.append(np.int32(0), number[at : at + len(x)])
                for d, c in enumerate(np.frombuffer(_unpacked(codes), np.int32).reshape(DEPTH, -1)):
                    columns[d].append(numbers[c])
                counts.append(np.frombuffer(_unpacked(n), np.int64))
                at += len(x)
            whole = [np.concatenate(c) for c in columns]
            order = np.lexsort(_paired(whole)[::-1])
            whole = [c[order] for c in whole]
            leaves = np.concatenate(counts)[order]
            border = np.zeros(len(leaves), dtype=bool)
            border[:1] = True
            for depth, c in enumerate(whole, 1):
                border[1:] |= c[1:] != c[:-1]
                first = np.flatnonzero(border)
                n = np.add.reduceat(leaves, first)
                often = (n >= least) & (c[first] != 0)
                if depth >= max(prefix, 2) and often.any():
                    first = first[often]
                    found.append(_nodes(lang, encoded.dictionary, [x[first] for x in whole[:depth]], n[often], depth))
        none = np.zeros(0, np.int64)
        return pa.Table.from_batches(found or [_nodes("", pa.array([], pa.binary()), [none, none], none, 2)])

    return run


def phrase_counts(docs: DataFrame, least: int = MIN_COUNT, budget: int = BUDGET, run_bytes: int = RUN_BYTES) -> tuple[DataFrame, DataFrame]:
    """Words and phrases (lang, phrase, depth, f) that occur ``least`` times, and all words of each lang (lang, n)."""
    runs = T.staged(coded(docs, run_bytes), "coded")
    words = T.staged(runs.mapInArrow(_word_counts, NODES).groupBy("lang", "phrase", "depth").agg(F.sum("f").alias("f")), "words")
    sizes = T.staged(words.groupBy("lang").agg(F.sum("f").alias("n")), "sizes")
    total = sizes.agg(F.sum("n")).first()[0] or 0
    partition = vertical_partition(runs, total, budget)
    sent = runs.mapInArrow(_sent(partition), "group int, lang string, words binary, codes binary, counts binary")
    nodes = sent.groupBy("group").applyInArrow(subtree(least, partition.ends), NODES)
    out = words.where(F.col("f") >= least).unionByName(nodes)
    if len(partition.extended) > 1:
        above = runs.mapInArrow(_above(partition), NODES).groupBy("lang", "phrase", "depth").agg(F.sum("f").alias("f"))
        out = out.unionByName(above.where(F.col("f") >= least))
    return T.staged(out, "nodes"), sizes


def _parts(n: int) -> list[tuple[int, int]]:
    """Where phrases of two words and more lie inside one of n words, itself left out: first word and length."""
    return [(i, k) for k in range(2, n) for i in range(1, n - k + 2)]


def collocations(docs: DataFrame, least: int = MIN_COUNT, within: int = WITHIN_PERCENT, top: int = TOP, budget: int = BUDGET, run_bytes: int = RUN_BYTES) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: the best phrases of each language."""
    nodes, sizes = phrase_counts(docs, least, budget, run_bytes)
    candidates = nodes.where("depth > 1")
    # a phrase goes if it lies inside a longer one that is nearly as frequent
    words = F.split("phrase", " ")
    inside = candidates.where("depth > 2").select("lang", "f", F.explode(
        F.when(F.col("depth") == 3, F.array(*[F.array_join(F.slice(words, i, k), " ") for i, k in _parts(3)]))
        .otherwise(F.array(*[F.array_join(F.slice(words, i, k), " ") for i, k in _parts(4)]))
    ).alias("phrase"))
    around = inside.groupBy("lang", "phrase").agg(F.max("f").alias("longer"))
    kept = candidates.join(around, ["lang", "phrase"], "left")
    wide = "decimal(20,0)"
    kept = kept.where(F.col("longer").isNull() | (F.col("longer").cast(wide) * 100 < F.col("f").cast(wide) * within)).drop("longer")
    # every cut, with the counts of its two parts
    cut = F.explode(F.sequence(F.lit(1), F.col("depth") - 1)).alias("k")
    cuts = kept.select("lang", "phrase", F.col("f").alias("a"), words.alias("words"), "depth", cut)
    cuts = cuts.select("lang", "phrase", "a", "k", F.array_join(F.slice("words", F.lit(1), F.col("k")), " ").alias("head"), F.array_join(F.slice("words", F.col("k") + 1, F.col("depth") - F.col("k")), " ").alias("tail"))
    total = sizes.agg(F.sum("n")).first()[0] or 0
    cuts = T.staged(cuts, "cuts")
    for part, count in (("head", "l"), ("tail", "r")):
        cuts = _counted(cuts, nodes, part, count, max(1, total // HOT_PARTS))
    score = F.call_function("div", F.col("a").cast(wide) * F.lit(SCORE).cast("decimal(8,0)"), (F.col("l") + F.col("r")).cast(wide)).cast("long")
    worst = F.min(F.struct(score.alias("score"), "k", "l", "r"))
    scored = cuts.groupBy("lang", "phrase", "a").agg(worst.alias("cut")).select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score")
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase").asc()]
    # slices of a language rank on their own first, so that one task ranks few rows of a large language
    sliced = scored.withColumn("slice", F.pmod(F.xxhash64("phrase"), F.lit(64)))
    best = sliced.withColumn("rank", F.row_number().over(W.partitionBy("lang", "slice").orderBy(*order))).where(F.col("rank") <= top).drop("slice")
    ranked = best.withColumn("rank", F.row_number().over(W.partitionBy("lang").orderBy(*order)).cast("long")).where(F.col("rank") <= top)
    return ranked.join(F.broadcast(sizes), "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def _counted(cuts: DataFrame, nodes: DataFrame, part: str, count: str, hot: int) -> DataFrame:
    """Adds the count of a part, which occurs at least as often as its phrase and so is a node too."""
    table = nodes.where(f"depth < {DEPTH}").select(F.col("lang").alias("of"), F.col("phrase").alias("what"), F.col("f").alias(count))
    on = (F.col("lang") == F.col("of")) & (F.col(part) == F.col("what"))
    # no more than HOT_PARTS phrases of a length occur so often
    known = cuts.join(F.broadcast(table.where(F.col(count) > hot)), on, "left").drop("of", "what")
    rest = known.where(F.col(count).isNull()).drop(count).join(table.where(F.col(count) <= hot), on).drop("of", "what")
    return known.where(F.col(count).isNotNull()).unionByName(rest)


def op11_phrase_collocations(spark, sf_dir: str) -> DataFrame:
    return collocations(spark.read.parquet(f"{sf_dir}/documents.parquet").select("lang", "text"))


OP11_SQL = r"""
WITH piece AS (
  SELECT coalesce(lang, 'und') AS lang,
    unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS t
  FROM documents
), w AS (SELECT lang, regexp_extract_all(t, '[^\x20\x09]+') AS ws FROM piece),
g AS (
  SELECT lang, k, array_to_string(ws[i:i + k - 1], ' ') AS phrase
  FROM (SELECT lang, ws, k, unnest(range(1, len(ws) - k + 2)) AS i FROM w, (VALUES (1), (2), (3), (4)) x(k))
), f AS (SELECT lang, k, phrase, count(*) AS a FROM g GROUP BY ALL HAVING count(*) >= 30),
size AS (SELECT lang, sum(len(ws)) AS n FROM w GROUP BY lang),
c AS (SELECT lang, k, phrase, a, string_split(phrase, ' ') AS ws FROM f WHERE k > 1),
gone AS (
  SELECT DISTINCT s.lang, s.phrase FROM (
    SELECT lang, a AS longer, array_to_string(ws[i:i + m - 1], ' ') AS phrase
    FROM (SELECT lang, a, ws, m, unnest(range(1, k - m + 2)) AS i FROM c, (VALUES (2), (3)) y(m) WHERE m < k)
  ) s JOIN c ON c.lang = s.lang AND c.phrase = s.phrase WHERE 100 * s.longer >= 80 * c.a
), cut AS (
  SELECT c.lang, c.phrase, c.a, j, l.a AS l, r.a AS r, 2000000::HUGEINT * c.a // (l.a + r.a) AS score
  FROM (SELECT *, unnest(range(1, k)) AS j FROM c) c
  JOIN f l ON l.lang = c.lang AND l.phrase = array_to_string(c.ws[1:j], ' ')
  JOIN f r ON r.lang = c.lang AND r.phrase = array_to_string(c.ws[j + 1:c.k], ' ')
  ANTI JOIN gone ON gone.lang = c.lang AND gone.phrase = c.phrase
), worst AS (SELECT * FROM cut QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) = 1)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase,
  a, l, r, CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score
FROM worst JOIN size USING (lang)
QUALIFY row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) <= 2000
"""
