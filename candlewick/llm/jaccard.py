"""Join of documents whose word n-gram sets are similar (Jaccard), by adaptive multi-match prefixes.

Tokens are n-grams, in one global order: those of rare words before those of
frequent ones, as a count sketch of fixed size tells, then by hash. Any order
gives right results; this one keeps frequent n-grams out of the prefixes. Words
that the sketch cannot tell apart have at most the share of one counter each,
and an n-gram of them the product of n such shares, so the order stays good
when the corpus grows and the sketch does not. Two sets of similarity t or
more share at least l tokens within their first ``size - ceil(t * size) + l``
ones, for every l. Each document lengthens its prefix to the l whose
candidates are estimated to cost least, from the documents counted at each of
its tokens; a pair then has to share as many tokens as the smaller of its two l.

Equal sets are one document from the start, and tokens that the same documents
have are one list. Lists are of two kinds. Pairs of a short list are counted
over all lists, and those that share enough tokens are candidates. Documents of
long lists are a crowd: near copies, or texts that share no more than a common
passage. The crowd's pairs are looked for once more, in an order of its own: all
its tokens are counted, and those that many of its documents have go last, by
their counts. So a common passage leaves the prefixes of what is different
otherwise. Documents whose lists are long even then form blocks, and so do
families of candidates that have many pairs. A block is cut into parts, and each pair of
parts is compared in one task, which returns no more links than connect its
documents, and for each document the number of those it links with. The other
candidates are verified pair by pair. So the rows that
move grow with a short list's bound or a block's number of parts, and no link
between classes is lost.

Defined results: a null or empty text has no tokens and links with nothing; a
text of fewer words than n is one token; rows without a doc_id link with
nothing; repeated rows get the same class and count once; further columns are
not read. The rows of one doc_id have one text.
Tokens are 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candlewick.llm import text as T
from candlewick.llm.components import components
from candlewick.llm.repeats import by_group, sliced

GRAM = 3
PERCENT = 90
#: Counters of the frequency sketch (a power of two), and slices in which it is summed.
COUNTERS = 1 << 20
SLICES = 64
#: Partial sketches that one task adds up.
FAN_IN = 256
#: Tokens that a pair may be required to share: so many, and of a long document this part of its tokens.
MOST_SHARED = 8
LONG_PART = 40
#: Numbers of shared tokens to choose from.
LEVELS = [1 << i for i in range(11)]
#: Cost of comparing a token of a candidate against that of reading a list entry.
VERIFY_COST = 0.05
#: Times that tokens and documents without partners are left out before documents are compared.
PRUNINGS = 2
#: Documents of a list from which it is a long one, and of a part of a block.
SHORT_LIST = 64
PART = 768
#: Tokens of the crowd that one task counts.
SLICE_TOKENS = 1 << 20
#: Tokens of the crowd that are put in an order of their own, at most: the most frequent ones.
HEAVY = 1 << 17
#: Set members of a part: fewer documents make a part where they are long.
PART_TOKENS = 1_500_000
#: Tokens of a tile that are sorted at a time.
TILE_TOKENS = 1 << 18
#: Comparisons with one document that a task makes.
TASK_ROWS = 2000
#: A link between a and b, and numbers of documents that a and b link with.
LINKS = "a long, b long, n_a long, n_b long"


def _word_hashes(part: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    data = T.lowered(part)
    starts, stops, ranges = T.words(data, ends)
    return T.word_hashes(data, starts, stops), ranges


def _counter(hashes: np.ndarray, counters: int) -> np.ndarray:
    return (hashes >> np.uint64(64 - (counters.bit_length() - 1))).astype(np.int64)


def _tokens(part: np.ndarray, ends: np.ndarray, n: int, classes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each text's n-grams (a shorter text is one) as numbers that sort in the global order, and its range of them."""
    words, ranges = _word_hashes(part, ends)
    counts = np.diff(ranges)
    many = np.where(counts >= n, counts - n + 1, (counts > 0).astype(np.int64))
    out = np.zeros(len(counts) + 1, dtype=np.int64)
    np.cumsum(many, out=out[1:])
    lo = np.repeat(ranges[:-1] - out[:-1], many) + np.arange(out[-1])
    hi = lo + np.repeat(np.minimum(counts, n), many)
    logs = np.zeros(len(words) + 1, dtype=np.int64)
    np.cumsum(classes[_counter(words, len(classes))], out=logs[1:])
    order = np.minimum(63, (logs[hi] - logs[lo]) * 2 // n).astype(np.uint64)
    return (order << np.uint64(58)) | (T.mixed(T.spans(T.prefix_sums(words), lo, hi)) >> np.uint64(6)), out


def _sketch(counters: int, slices: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(counters, dtype=np.int64)
        for batch in batches:
            for _, _, part, ends in T.pieces(*T.utf8(batch.column("text")), most=(2 << 20) - 1):
                total += np.bincount(_counter(_word_hashes(part, ends)[0], counters), minlength=counters)
        if total.any():
            parts = np.minimum(total, 2**32 - 1).astype(np.uint32).reshape(slices, -1)
            yield pa.RecordBatch.from_arrays([pa.array(range(slices), pa.int32()), pa.array([p.tobytes() for p in parts], pa.binary())], names=["slice", "counts"])

    return lambda batches: T.given_back(run(batches))


def _add(rows: pd.DataFrame) -> pd.DataFrame:
    total = sum(np.frombuffer(x, np.uint32).astype(np.uint64) for x in rows["counts"])
    return pd.DataFrame({"slice": [rows["slice"].iloc[0]], "counts": [np.minimum(total, 2**32 - 1).astype(np.uint32).tobytes()]})


def frequency_classes(texts: DataFrame, counters: int = COUNTERS, slices: int = SLICES) -> np.ndarray:
    """For each counter of words the logarithm of its count; its size is that of the sketch, whatever the corpus."""
    kind = "slice int, counts binary"
    parts = texts.select("text").mapInArrow(_sketch(counters, slices), kind).withColumn("team", F.spark_partition_id() % FAN_IN)
    sums = parts.groupBy("slice", "team").applyInPandas(lambda rows: _add(rows), kind)
    rows = sums.groupBy("slice").applyInPandas(lambda rows: _add(rows), kind).collect()
    total = np.zeros(counters, dtype=np.uint32)
    for row in rows:
        total.reshape(slices, -1)[row["slice"]] = np.frombuffer(row["counts"], np.uint32)
    return np.ceil(np.log2(total.astype(np.float64) + 1)).astype(np.uint8)


def _prefixes(shared, n: int, percent: int, most: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        classes = np.frombuffer(shared.value, np.uint8)
        for batch in batches:
            for i, j, part, ends in T.pieces(*T.utf8(batch.column("text"))):
                tokens, ranges = _tokens(part, ends, n, classes)
                sizes, one, two, firsts = [], [], [], []
                for a, b in zip(ranges[:-1].tolist(), ranges[1:].tolist()):
                    own = np.unique(tokens[a:b])
                    size = len(own)
                    sizes.append(size)
                    if not size:
                        one.append(None), two.append(None), firsts.append([])
                        continue
                    spread = T.mixed(own)
                    one.append(int(spread.sum().view(np.int64)))
                    two.append(int(np.bitwise_xor.reduce(T.mixed(spread + np.uint64(size))).view(np.int64)))
                    firsts.append(own[: size - (percent * size + 99) // 100 + max(most, size // LONG_PART)].view(np.int64))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(i, j - i), pa.array(sizes, pa.int64()), pa.array(one, pa.int64()), pa.array(two, pa.int64()), pa.array(firsts, pa.list_(pa.int64()))],
                    names=["doc_id", "size", "one", "two", "tokens"],
                )

    return lambda batches: T.given_back(run(batches))


def _sets(shared, n: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        classes = np.frombuffer(shared.value, np.uint8)
        for batch in batches:
            for i, j, part, ends in T.pieces(*T.utf8(batch.column("text"))):
                tokens, ranges = _tokens(part, ends, n, classes)
                own = [np.unique(tokens[a:b]).tobytes() for a, b in zip(ranges[:-1].tolist(), ranges[1:].tolist())]
                yield pa.RecordBatch.from_arrays([batch.column("doc").slice(i, j - i), batch.column("weight").slice(i, j - i), pa.array(own, pa.binary())], names=["doc", "weight", "members"])

    return lambda batches: T.given_back(run(batches))


def _token_counts(slices: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            data, ends = T.utf8(batch.column("members"))
            tokens, counts = np.unique(np.frombuffer(data[ends[0] : ends[-1]].tobytes(), np.uint64), return_counts=True)
            own = (tokens % np.uint64(slices)).astype(np.int64)
            order = np.argsort(own, kind="stable")
            tokens, counts = tokens[order], counts[order].astype(np.uint32)
            some, begins = np.unique(own[order], return_index=True)
            cuts = [*zip(begins.tolist(), [*begins[1:].tolist(), len(tokens)])]
            yield pa.RecordBatch.from_arrays(
                [pa.array(some, pa.int64()), pa.array([tokens[i:j].tobytes() for i, j in cuts], pa.binary()), pa.array([counts[i:j].tobytes() for i, j in cuts], pa.binary())],
                names=["slice", "tokens", "counts"],
            )

    return lambda batches: T.given_back(run(batches))


def _frequent(rows: pd.DataFrame, short: int) -> pd.DataFrame:
    tokens = np.concatenate([np.frombuffer(x, np.int64) for x in rows["tokens"]])
    order = np.argsort(tokens)
    tokens = tokens[order]
    starts = np.flatnonzero(np.concatenate([[True], tokens[1:] != tokens[:-1]]))
    n = np.add.reduceat(np.concatenate([np.frombuffer(x, np.uint32) for x in rows["counts"]])[order].astype(np.int64), starts)
    return pd.DataFrame({"token": tokens[starts][n > short], "n": n[n > short]})


def heavy_tokens(sets: DataFrame, short: int, most: int = HEAVY) -> tuple[np.ndarray, np.ndarray]:
    """Tokens in more than ``short`` of the sets, in order, and the logarithm of their counts: of the greatest counts, ``most`` tokens at most."""
    total = sets.agg(F.sum(F.length("members") / 8).cast("long")).first()[0] or 0
    slices = max(SLICES, total // SLICE_TOKENS)
    parts = sets.select("members").mapInArrow(_token_counts(slices), "slice long, tokens binary, counts binary")
    counts = parts.groupBy("slice").applyInPandas(lambda rows: _frequent(rows, short), "token long, n long")
    counts = T.staged(counts.withColumn("bin", F.floor(4 * F.log2("n")).cast("int")), "heavy")
    least, many = None, 0
    for row in counts.groupBy("bin").agg(F.count("*").alias("tokens")).orderBy(F.desc("bin")).collect():
        many += row["tokens"]
        if many > most:
            break
        least = row["bin"]
    rows = counts.where(F.col("bin") >= least).select("token", "bin").toArrow() if least is not None else None
    T.done_with(counts)
    if rows is None:
        return np.zeros(0, np.uint64), np.zeros(0, np.uint8)
    tokens = rows["token"].to_numpy().view(np.uint64)
    order = np.argsort(tokens)
    return tokens[order], rows["bin"].to_numpy()[order].astype(np.uint8)


def _reordered(shared, percent: int, most: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        heavy, bins = shared.value
        for batch in sliced(batches):
            firsts, sizes = [], []
            for members in batch.column("members").to_pylist():
                own = np.frombuffer(members, np.uint64)
                size = len(own)
                if len(heavy):
                    at = np.minimum(np.searchsorted(heavy, own), len(heavy) - 1)
                    own = own[np.argsort(np.where(heavy[at] == own, bins[at], 0), kind="stable")]
                sizes.append(size)
                firsts.append(own[: size - (percent * size + 99) // 100 + max(most, size // LONG_PART)].view(np.int64))
            yield pa.RecordBatch.from_arrays([batch.column("doc"), pa.array(sizes, pa.int64()), pa.array(firsts, pa.list_(pa.int64()))], names=["doc", "size", "tokens"])

    return lambda batches: T.given_back(run(batches))


def _verify(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        centre, held, many = None, None, 0
        for batch in sliced(batches):
            out = []
            cols = (batch.column(c).to_pylist() for c in ("centre", "salt", "doc", "weight", "members"))
            for c, salt, doc, weight, members in zip(*cols):
                own = np.frombuffer(members, np.uint64)
                if doc is None:
                    centre, held, many = (c, salt), own, weight
                    continue
                assert centre == (c, salt)
                both = len(np.intersect1d(held, own, assume_unique=True))
                if 100 * both >= percent * (len(held) + len(own) - both):
                    out.append((c, doc, weight, many))
            if out:
                yield _links(out)

    return lambda batches: T.given_back(run(batches))


def _links(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*rows)], names=["a", "b", "n_a", "n_b"])


def verified(pairs: DataFrame, sets: DataFrame, percent: int, task_rows: int = TASK_ROWS) -> DataFrame:
    """Of the pairs (centre, doc) those that are similar, and how many documents each side links with. A centre's set is sent once for so many pairs."""
    counts = pairs.groupBy("centre").agg(F.ceil(F.count("*") / task_rows).cast("int").alias("salts"))
    salted = pairs.join(counts, "centre").select("centre", F.pmod(F.xxhash64("doc"), "salts").cast("int").alias("salt"), "doc")
    members = salted.join(sets, "doc").select("centre", "salt", "doc", "weight", "members")
    heads = counts.join(sets.withColumnRenamed("doc", "centre"), "centre").select(
        "centre", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"), F.lit(None).cast("long").alias("doc"), "weight", "members"
    )
    rows = members.unionByName(heads).repartition("centre", "salt").sortWithinPartitions("centre", "salt", F.col("doc").asc_nulls_first())
    return rows.mapInArrow(_verify(percent), LINKS)


def _shared_tokens(sets: list[np.ndarray], most: int = TILE_TOKENS) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Tokens of two sets or more, as numbers from 0 in order, each with its set: a range of about ``most`` tokens at a time.

    The sets are sorted. The ranges' bounds come from tokens drawn at random; any bounds give the same pairs.
    """
    ends = np.cumsum([len(x) for x in sets])
    total = int(ends[-1])
    drawn = np.random.default_rng(5).integers(0, max(1, total), 64 * (total // most))
    own = np.searchsorted(ends, drawn, "right")
    bounds = np.unique(np.sort(np.array([sets[i][at - ends[i]] for i, at in zip(own.tolist(), drawn.tolist())], dtype=np.uint64))[64::64])
    cuts = [[0, *np.searchsorted(x, bounds).tolist(), len(x)] for x in sets]
    for k in range(len(bounds) + 1):
        tokens = np.concatenate([x[c[k] : c[k + 1]] for x, c in zip(sets, cuts)])
        row = np.repeat(np.arange(len(sets)), [c[k + 1] - c[k] for c in cuts])
        by = np.argsort(tokens, kind="stable")
        tokens, row = tokens[by], row[by]
        edge = np.concatenate([[True], tokens[1:] != tokens[:-1], [True]])
        shared = ~(edge[:-1] & edge[1:])[: len(tokens)]
        if shared.any():
            yield np.cumsum(edge[:-1][shared]) - 1, row[shared]


def tile_links(
    docs: list[int], sets: list[np.ndarray], parts: list[int], percent: int, weights: list[int], homes: list[int | None], room: int = 1 << 21
) -> tuple[list[tuple[int, int]], list[tuple[int, int]]]:
    """Links that connect what is similar among documents of one part, or of two different ones.

    Also the weight of all that each document is similar to, but for documents
    of its own home, which are counted there.
    """
    order = np.argsort(parts, kind="stable")
    docs, sets = [docs[i] for i in order], [sets[i] for i in order]
    cut = int(np.searchsorted(np.array(parts)[order], max(parts))) if min(parts) < max(parts) else 0
    left = len(sets) if cut == 0 else cut
    both = np.zeros((left, len(sets) - cut), dtype=np.float64)
    width = max(1, room // len(sets))
    for number, row in _shared_tokens(sets):
        for a in range(0, int(number[-1]) + 1, width):  # a slice of the tokens at a time
            lo, hi = np.searchsorted(number, [a, a + width])
            has = np.zeros((len(sets), min(width, int(number[-1]) + 1 - a)), dtype=np.float32)
            has[row[lo:hi], number[lo:hi] - a] = 1
            both += has[:left] @ has[cut:].T
    sizes = np.array([len(x) for x in sets])
    similar = 100 * both >= percent * (sizes[:left, None] + sizes[None, cut:] - both)
    root = list(range(len(sets)))

    def find(x: int) -> int:
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    out = []
    for x in range(left):
        for y in np.flatnonzero(similar[x]).tolist():
            p, q = find(x), find(y + cut)
            if p != q:
                root[q] = p
                out.append((docs[x], docs[y + cut]))
    weight = np.array(weights, dtype=np.int64)[order]
    home = np.array([homes[i] or 0 for i in order], dtype=np.int64)
    housed = np.array([homes[i] is not None for i in order])
    similar &= ~((home[:left, None] == home[None, cut:]) & housed[:left, None] & housed[None, cut:])
    if cut:
        counts = np.concatenate([similar @ weight[cut:], weight[:cut] @ similar])
    else:
        np.fill_diagonal(similar, False)
        counts = similar @ weight
    return out, [(doc, n) for doc, n in zip(docs, counts.tolist()) if n]


def _tiles(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for g in by_group(batches, "tile"):
            if not g["within"][0] and min(g["part"]) == max(g["part"]):
                continue  # the other part is empty
            links, counts = tile_links(g["doc"], [np.frombuffer(x, np.uint64) for x in g["members"]], g["part"], percent, g["weight"], g["home"])
            out = [(a, b, 0, 0) for a, b in links] + [(doc, doc, n, 0) for doc, n in counts]
            if out:
                yield _links(out)

    return lambda batches: T.given_back(run(batches))


def block_links(blocks: DataFrame, sets: DataFrame, percent: int, part: int = PART) -> DataFrame:
    """Links within blocks (doc, block, home): each pair of a block's parts is one task's work, and a set goes to as many tasks as its block has parts."""
    measured = blocks.select("doc", "block").join(sets.select("doc", "tokens"), "doc")
    parts = F.greatest(F.ceil(F.count("*") / part), F.ceil(F.sum("tokens") / PART_TOKENS))
    counts = measured.groupBy("block").agg(parts.cast("int").alias("parts"))
    rows = blocks.join(counts, "block").withColumn("part", F.pmod(F.xxhash64("doc"), "parts").cast("int"))
    meets = F.transform(F.sequence(F.lit(0), F.col("parts") - 1), lambda o: F.struct(F.least("part", o).alias("i"), F.greatest("part", o).alias("j")))
    tiles = rows.select("doc", "block", "home", "part", F.explode(meets).alias("m"))
    tiles = tiles.select("doc", "home", "part", (F.col("m.i") == F.col("m.j")).alias("within"), F.xxhash64("block", "m.i", "m.j").alias("tile")).join(sets.drop("tokens"), "doc")
    return tiles.repartition("tile").sortWithinPartitions("tile").mapInArrow(_tiles(percent), LINKS)


def token_lists(prefixes: DataFrame, percent: int, most: int) -> DataFrame:
    """(token, weight, n, centre, doc, size, l): the n documents of each token, from prefixes (doc, size, tokens), which are deleted.

    Each document's prefix ends at the l of least estimated cost. Tokens of the same documents are one list, of so much weight.
    """
    need = F.floor((percent * F.col("size") + 99) / 100).cast("long")
    most_of = F.greatest(F.lit(most), F.floor(F.col("size") / LONG_PART))
    sizes = T.staged(prefixes.select("doc", "size", need.alias("need"), F.least(need, most_of).alias("most")), "sizes")
    entries = prefixes.select("doc", F.posexplode("tokens").alias("pos", "token"))
    spent: list[DataFrame] = [prefixes]
    for _ in range(PRUNINGS):
        # a token of one document links nothing, nor does a document with fewer tokens of others than a pair has to share
        counts = T.staged(entries.groupBy("token").agg(F.count("*").alias("n")).where("n > 1"), "counts")
        entries = T.staged(entries.select("doc", "pos", "token").join(counts, "token"), "entries")
        able = entries.groupBy("doc").agg(F.count("*").alias("shared")).join(sizes, "doc")
        able = T.staged(able.where("shared >= most").select("doc", "size", "need", "most"), "able")
        T.done_with(*spent)
        spent = [counts, entries, able]
        entries = entries.join(able, "doc")
    entries = T.staged(entries, "entries")
    T.done_with(*spent, sizes)

    # the l of least estimated cost, for each document
    first = F.col("size") - F.col("need")
    sums = entries.groupBy("doc", "size", "need", "most").agg(
        *[F.sum(F.when(F.col("pos") < first + l, F.col("n") - 1).otherwise(0)).alias(f"s{l}") for l in LEVELS]
    )
    costs = [
        F.when(F.col("most") >= l, F.struct((F.col(f"s{l}") * (1 + F.col("size") * VERIFY_COST / l)).alias("cost"), F.lit(l).alias("l")))
        for l in LEVELS
    ]
    levels = T.staged(sums.select("doc", F.array_min(F.array_compact(F.array(*costs)))["l"].alias("l")), "levels")
    lists = entries.select("doc", "size", "need", "pos", "token").join(levels, "doc").where(F.col("pos") < first + F.col("l"))
    lists = T.staged(lists.select("token", "doc", "size", "l"), "lists")

    same = lists.groupBy("token").agg(F.count("*").alias("n"), F.sum(F.xxhash64("doc").cast("decimal(20,0)")).alias("sum"), F.min("doc").alias("centre"))
    same = same.where("n > 1").groupBy("n", "sum", "centre").agg(F.min("token").alias("token"), F.count("*").alias("weight"))
    same = T.staged(same.drop("sum"), "same")
    spent = [entries, levels, lists, same]
    lists = T.staged(lists.join(same, "token"), "lists")
    T.done_with(*spent)
    return lists


def candidates(lists: DataFrame, blocks: DataFrame, percent: int, short: int) -> DataFrame:
    """Pairs (centre, doc) that share enough tokens of short lists and are not of one block (doc, block)."""
    rows = lists.where(F.col("n") <= short).join(blocks, "doc", "left").select("token", "weight", "doc", "size", "l", "block")
    other = rows.select("token", *[F.col(c).alias(f"o_{c}") for c in ("doc", "size", "l", "block")])
    near = (F.col("size") * percent <= F.col("o_size") * 100) & (F.col("o_size") * percent <= F.col("size") * 100)
    apart = F.col("block").isNull() | F.col("o_block").isNull() | (F.col("block") != F.col("o_block"))
    pairs = rows.join(other, "token").where((F.col("o_doc") < F.col("doc")) & near & apart)
    # documents that share a long list are of one block, so what others share is in short ones
    pairs = pairs.groupBy(F.col("o_doc").alias("centre"), "doc").agg(F.sum("weight").alias("shared"), F.min(F.least("l", "o_l")).alias("least"))
    return T.staged(pairs.where("shared >= least").select("centre", "doc"), "pairs")


def crowd_lists(crowd: DataFrame, percent: int, most: int, short: int) -> DataFrame:
    """``token_lists`` of the sets (doc, members) of a crowd, which are deleted; tokens that many of them have come last."""
    shared = crowd.sparkSession.sparkContext.broadcast(heavy_tokens(crowd, short))
    prefixes = crowd.select("doc", "members").mapInArrow(_reordered(shared, percent, most), "doc long, size long, tokens array<long>")
    prefixes = T.staged(prefixes, "sets")
    T.done_with(crowd)
    return token_lists(prefixes, percent, most)


def similar_classes(docs: DataFrame, n: int = GRAM, percent: int = PERCENT, most: int = MOST_SHARED, short: int = SHORT_LIST, part: int = PART) -> DataFrame:
    """(doc_id, n_shingles, component_id, n_links) of every row: the smallest doc_id that links reach, and how many other documents are similar."""
    spark = docs.sparkSession
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    shared = spark.sparkContext.broadcast(frequency_classes(texts).tobytes())
    prefixes = T.staged(
        texts.mapInArrow(_prefixes(shared, n, percent, most), "doc_id long, size long, one long, two long, tokens array<long>"),
        "prefixes",
    )
    found = T.staged(prefixes.drop("tokens"), "found")
    whole = "doc_id IS NOT NULL AND size > 0"
    sets = prefixes.where(whole).groupBy("size", "one", "two").agg(F.min("doc_id").alias("doc"), F.min_by("tokens", "doc_id").alias("tokens"))
    sets = T.staged(sets, "sets")
    T.done_with(prefixes)
    reps = T.staged(sets.drop("tokens"), "reps")
    twins = found.where(whole).distinct().groupBy("size", "one", "two").agg(F.count("*").alias("weight")).where("weight > 1")
    twins = T.staged(twins.join(reps, ["size", "one", "two"]).select("doc", "weight"), "twins")

    def members(wanted: DataFrame, name: str) -> DataFrame:
        own = texts.select(F.col("doc_id").alias("doc"), "text").join(T.staged(wanted, "wanted"), "doc").dropDuplicates(["doc"])
        own = own.mapInArrow(_sets(shared, n), "doc long, weight long, members binary")
        return T.staged(own.withColumn("tokens", F.length("members") / 8), name)

    lists = token_lists(sets.select("doc", "size", "tokens"), percent, most)
    crowd = T.staged(lists.where(F.col("n") > short).select("doc").distinct().withColumn("block", F.lit(0).cast("long")), "crowd")
    pairs = candidates(lists, crowd, percent, short)
    T.done_with(lists)
    blocks = crowd
    if not crowd.isEmpty():
        lists = crowd_lists(members(crowd.select("doc", F.lit(1).cast("long").alias("weight")), "crowd_sets"), percent, most, short)
        again = lists.where(F.col("n") > short)
        blocks = components(again.select(F.col("doc").alias("a"), F.col("centre").alias("b"))).withColumnsRenamed({"node": "doc", "root": "block"})
        blocks = T.staged(blocks, "blocks")
        pairs = pairs.unionByName(candidates(lists, blocks, percent, short))
        T.done_with(lists)

    # a family of candidates is compared as a block if that sends fewer sets than its pairs
    families = T.staged(components(pairs.select(F.col("doc").alias("a"), F.col("centre").alias("b"))), "families")
    docs_of = families.groupBy("root").agg(F.count("*").alias("m"))
    pairs_of = pairs.join(families.withColumnRenamed("node", "doc"), "doc").groupBy("root").agg(F.count("*").alias("e"))
    dense = docs_of.join(pairs_of, "root").where(F.col("e") > F.col("m") * F.ceil(F.col("m") / part)).select("root")
    dense = T.staged(families.join(dense, "root").select(F.col("node").alias("doc"), F.xxhash64(F.lit("family"), "root").alias("block")), "dense")
    pairs = T.staged(pairs.join(dense.select("doc"), "doc", "left_anti"), "pairs")
    # a pair of one block and one family is compared in both, and counted in the block
    dense = dense.join(blocks.select("doc", F.col("block").alias("home")), "doc", "left")
    blocks = blocks.withColumn("home", F.lit(None).cast("long")).unionByName(dense)

    wanted = pairs.select("doc").union(pairs.select("centre")).union(blocks.select("doc")).distinct()
    wanted = wanted.join(twins, "doc", "left").select("doc", F.coalesce("weight", F.lit(1)).cast("long").alias("weight"))
    sets = members(wanted, "members")
    links = verified(pairs, sets, percent).unionByName(block_links(blocks, sets, percent, part))
    links = T.staged(links, "links")
    T.done_with(sets, pairs, families)
    roots = components(links.select("a", "b"))
    ends = F.explode(F.array(F.struct(F.col("a").alias("rep"), F.col("n_a").alias("n")), F.struct(F.col("b").alias("rep"), F.col("n_b").alias("n"))))
    others = links.select(ends.alias("e")).select("e.rep", "e.n").groupBy("rep").agg(F.sum("n").alias("others"))
    keys = reps.select("size", "one", "two", F.col("doc").alias("rep"))
    out = found.join(keys, ["size", "one", "two"], "left").join(roots.withColumnRenamed("node", "rep"), "rep", "left")
    own_class = F.when(F.col("doc_id").isNotNull(), F.coalesce("root", "rep", "doc_id"))
    out = out.join(others, "rep", "left").join(twins.withColumnRenamed("doc", "rep"), "rep", "left")
    n_links = F.when(F.col("doc_id").isNotNull(), F.coalesce("others", F.lit(0)) + F.coalesce("weight", F.lit(1)) - 1).otherwise(0)
    return out.select("doc_id", F.col("size").alias("n_shingles"), own_class.alias("component_id"), n_links.cast("long").alias("n_links"))


def op5_ngram_jaccard_join(spark, sf_dir: str) -> DataFrame:
    return similar_classes(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")).drop("n_links")
