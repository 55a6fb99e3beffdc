"""Token sequences of a fixed size, packed online with bounded space.

Each partition reads its documents once. A document's full windows leave at
once; its rest goes to the open window it fits best. If none of the fixed
number of open windows has room, the fullest is topped up with the head of the
rest and emitted, and the tail is placed anew. At the end of a partition the
open windows are joined end to end and cut into full windows; the last piece
of each partition (under one window) is merged with those of a bounded number
of other partitions. What then remains is cut into sequences whose lengths
are powers of two, which need no padding.

Defined results: a null or empty text is its end token alone; a null doc_id
stays null; repeated rows are packed each; further columns are not read.
"""

from __future__ import annotations

import bisect
import os
import re
import zlib
from array import array
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candlewick.llm import text as T

SIZE = 1024
OPEN_WINDOWS = 64
END_TOKEN = 0
#: Partitions whose last pieces are merged in one task.
MERGE_PARTITIONS = 256

#: Bytes of text whose different words are encoded together.
RUN_BYTES = 8 << 20
#: Words whose ids are gathered at once.
GATHERED = 1 << 18
#: Words joined to one text for the tokenizer, and such texts handed over at once.
JOINED, AT_ONCE = 200, 64

_loaded: dict[str, "ByteEncoder"] = {}
#: A space that does not begin a word: there the tokenizer's own cuts may differ.
_ODD_SPACE = re.compile(r" (?:\s|\Z)")
#: How byte-level vocabularies write a space.
_SPACE = "\u0120"


class ByteEncoder:
    """Ids of a byte-level BPE tokenizers file, as little-endian unsigned 32-bit bytes.

    The tokenizer always cuts before a single space that begins a word. So the
    different words of a run of texts are encoded once, joined to texts of
    their own, whose ids are parted where a token begins with a space; the ids of
    the run are then gathered from those of its words. Nothing is kept from one
    run to the next. Texts with other runs of white space are encoded whole.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        vocab = self.tokenizer.get_vocab(with_added_tokens=True)
        self.begins = np.zeros(max(vocab.values()) + 1, dtype=bool)
        self.begins[[i for token, i in vocab.items() if token.startswith(_SPACE)]] = True

    @classmethod
    def load(cls, path: str) -> "ByteEncoder":
        if path not in _loaded:
            _loaded[path] = cls(path)
        return _loaded[path]

    def whole(self, values: list[str]) -> list[np.ndarray]:
        done = []
        for i in range(0, len(values), AT_ONCE):
            done += [np.array(e.ids, dtype=np.uint32) for e in self.tokenizer.encode_batch_fast(values[i : i + AT_ONCE], add_special_tokens=False)]
        return done

    def words(self, values: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of words that follow a space, end to end, and how many each has."""
        groups = [values[i : i + JOINED] for i in range(0, len(values), JOINED)]
        ids, sizes = [], []
        for group, got in zip(groups, self.whole(["".join(" " + w for w in g) for g in groups])):
            at = np.flatnonzero(self.begins[got])
            if len(at) == len(group):
                ids.append(got)
                sizes.append(np.diff(at, append=len(got)))
            else:
                alone = self.whole([" " + w for w in group])
                ids += alone
                sizes.append(np.array([len(x) for x in alone]))
        return np.concatenate([np.zeros(0, np.uint32), *ids]), np.concatenate([np.zeros(0, np.int64), *sizes])

    def run(self, data: np.ndarray, offs: np.ndarray) -> Iterator[bytes]:
        """Ids of texts with single spaces."""
        space = data == 0x20
        at = np.flatnonzero(space)
        first = np.arange(len(offs)) + np.searchsorted(at, offs)  # number of each text's first word
        first[-1] = len(at) + len(offs) - 1
        sizes = np.zeros(first[-1] + 1, dtype=np.int64)
        sizes[1:] = np.sort(np.concatenate([at, offs[1:]]), kind="stable")  # ends of the words
        sizes[1:] -= np.sort(np.concatenate([offs[:-1], at + 1]), kind="stable")
        np.cumsum(sizes, out=sizes)
        kept = data[~space]
        encoded = pa.Array.from_buffers(pa.large_string(), len(sizes) - 1, [None, pa.py_buffer(sizes), pa.py_buffer(kept)]).dictionary_encode()
        del space, at, sizes, kept
        listed, codes = encoded.dictionary, encoded.indices.to_numpy()
        # a first word has no space before it, so it is a word of its own
        inner = np.ones(len(codes), dtype=bool)
        inner[first[:-1]] = False
        after = np.flatnonzero(np.bincount(codes[inner], minlength=len(listed)))
        heads = np.unique(codes[first[:-1]])
        ids, counts = self.words(listed.take(pa.array(after)).to_pylist())
        alone = self.whole(listed.take(pa.array(heads)).to_pylist())
        place = np.zeros((2, len(listed)), dtype=np.int32)
        place[0, after] = np.arange(len(after))
        place[1, heads] = len(after) + np.arange(len(heads))
        ids = np.concatenate([ids, *alone])
        counts = np.concatenate([counts, np.array([len(x) for x in alone], dtype=np.int64)])
        begin = np.cumsum(counts) - counts
        i = 0
        while i < len(first) - 1:
            j = max(i + 1, int(np.searchsorted(first, first[i] + GATHERED, "right")) - 1)
            lo, hi = first[i], first[j]
            entry = np.where(inner[lo:hi], place[0, codes[lo:hi]], place[1, codes[lo:hi]])
            many = counts[entry]
            upto = np.zeros(len(many) + 1, dtype=np.int64)
            np.cumsum(many, out=upto[1:])
            got = ids[np.repeat(begin[entry] - upto[:-1], many) + np.arange(upto[-1])]
            cuts = upto[first[i : j + 1] - lo].tolist()
            yield from (got[a:b].tobytes() for a, b in zip(cuts[:-1], cuts[1:]))
            i = j

    def encode(self, values: list[str]) -> Iterator[bytes]:
        """Ids of each text, in order."""
        return self.batch(pa.array(values, pa.large_string()))

    def batch(self, texts: pa.Array) -> Iterator[bytes]:
        """Ids of each text of a column, in order; a null is an empty text."""
        _, offs = T.utf8(texts)
        i = 0
        while i < len(texts):
            j = max(i + 1, int(np.searchsorted(offs, offs[i] + RUN_BYTES, "right")) - 1)
            yield from self._encoded([x or "" for x in texts.slice(i, j - i).to_pylist()])
            i = j

    def _encoded(self, values: list[str]) -> list[bytes]:
        odd = [_ODD_SPACE.search(v) is not None for v in values]
        out = [b""] * len(values)
        for k, ids in zip([k for k, o in enumerate(odd) if o], self.whole([v for v, o in zip(values, odd) if o])):
            out[k] = ids.tobytes()
        rest = [k for k, o in enumerate(odd) if not o]
        if rest:
            data, offs = T.utf8(pa.array([values[k] for k in rest], pa.large_string()))
            for k, ids in zip(rest, self.run(data[offs[0] : offs[-1]], offs - offs[0])):
                out[k] = ids
        return out


Piece = tuple  # doc_id, start, tokens of the document, ids as bytes


class Packer:
    """Open windows of one partition; emitted pieces get a sequence number and an offset."""

    def __init__(self, size: int, most: int):
        self.size, self.most = size, most
        self.free: list[tuple[int, int]] = []  # room and number of each open window, sorted
        self.open: dict[int, list[Piece]] = {}
        self.number = 0
        self.sequence = 0

    def emit(self, pieces: list[Piece]) -> Iterator[tuple]:
        at = 0
        for piece in pieces:
            yield (*piece, self.sequence, at)
            at += len(piece[3]) // 4
        self.sequence += 1

    def place(self, piece: Piece) -> Iterator[tuple]:
        need = len(piece[3]) // 4
        while need:
            i = bisect.bisect_left(self.free, (need, -1))
            if i < len(self.free):
                room, w = self.free.pop(i)
                self.open[w].append(piece)
                if room > need:
                    bisect.insort(self.free, (room - need, w))
                else:
                    yield from self.emit(self.open.pop(w))
                return
            if len(self.free) < self.most:
                self.number += 1
                self.open[self.number] = [piece]
                bisect.insort(self.free, (self.size - need, self.number))
                return
            room, w = self.free.pop(0)
            head, piece = split(piece, room)
            yield from self.emit([*self.open.pop(w), head])
            need -= room

    def add(self, doc_id, ids: bytes) -> Iterator[tuple]:
        total, wide = len(ids) // 4, 4 * self.size
        whole = len(ids) // wide
        for i in range(whole):
            yield from self.emit([(doc_id, i * self.size, total, ids[i * wide : (i + 1) * wide])])
        if len(ids) > whole * wide:
            yield from self.place((doc_id, whole * self.size, total, ids[whole * wide :]))

    def rest(self) -> list[Piece]:
        out = [p for w in sorted(self.open) for p in self.open[w]]
        self.open, self.free = {}, []
        return out


def split(piece: Piece, tokens: int) -> tuple[Piece, Piece]:
    doc, start, total, ids = piece
    return (doc, start, total, ids[: 4 * tokens]), (doc, start + tokens, total, ids[4 * tokens :])


def joined(pieces: list[Piece], sizes: Callable[[int], int]) -> Iterator[list[Piece]]:
    """Pieces end to end, cut into runs; ``sizes`` says how long the next is when so many tokens are left."""
    left = sum(len(p[3]) // 4 for p in pieces)
    todo = pieces[::-1]
    while todo and (want := sizes(left)):
        left -= want
        run = []
        while want:
            piece = todo.pop()
            have = len(piece[3]) // 4
            if have > want:
                piece, tail = split(piece, want)
                todo.append(tail)
                have = want
            run.append(piece)
            want -= have
        yield run
    if todo:
        yield todo[::-1]


PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, part int, ids binary"


def _batch(rows: list[tuple], part: int, left: bool, with_ids: bool) -> pa.RecordBatch:
    doc, start, total, ids, seq, at = zip(*rows)
    high = part << 32
    return pa.RecordBatch.from_arrays(
        [pa.array(doc, pa.int64()), pa.array(start, pa.int64()), pa.array([len(x) // 4 for x in ids], pa.int64()),
         pa.array([zlib.crc32(x) for x in ids], pa.int64()), pa.array(total, pa.int64()),
         pa.array([None if left else high + s for s in seq], pa.int64()), pa.array(at, pa.int64()), pa.array([part] * len(doc), pa.int32()),
         pa.array(ids if left or with_ids else [None] * len(doc), pa.binary())],
        names=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "part", "ids"],
    )


def _pack(path: str, size: int, most: int, end: int | None, with_ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, encoder = TaskContext.get().partitionId(), ByteEncoder.load(path)
        packer, rows = Packer(size, most), []
        stop = b"" if end is None else array("I", [end]).tobytes()
        for batch in batches:
            texts = batch.column("text")
            for doc_id, ids in zip(batch.column("doc_id").to_pylist(), encoder.batch(texts)):
                rows += packer.add(doc_id, ids + stop)
                if len(rows) > 4000:
                    yield _batch(rows, part, False, with_ids)
                    rows = []
        last: list[Piece] = []
        for pieces in joined(packer.rest(), lambda left: size if left >= size else 0):
            if sum(len(p[3]) for p in pieces) == 4 * size:
                rows += packer.emit(pieces)
            else:
                last = pieces
        if rows:
            yield _batch(rows, part, False, with_ids)
        if last:
            yield _batch([(*p, 0, i) for i, p in enumerate(last)], part, True, True)

    return lambda batches: T.given_back(run(batches))


def _merge(size: int, with_ids: bool):
    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["part", "offset"])
        pieces = [(None if pd.isna(d) else int(d), int(s), int(t), bytes(x)) for d, s, t, x in zip(rows.doc_id, rows.start, rows.doc_tokens, rows.ids)]
        packer, out = Packer(size, 0), []
        for run in joined(pieces, lambda left: size if left >= size else 1 << (left.bit_length() - 1) if left else 0):
            out += packer.emit(run)
        high = (1 << 62) + (int(key[0]) << 32)
        return pd.DataFrame(
            [(d, s, len(x) // 4, zlib.crc32(x), t, high + n, at, x if with_ids else None) for d, s, t, x, n, at in out],
            columns=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "ids"],
        ).astype({"doc_id": "Int64"})

    return run


def pack(docs: DataFrame, tokenizer: str, size: int = SIZE, open_windows: int = OPEN_WINDOWS, end_token: int | None = END_TOKEN, with_ids: bool = True, merge: int = MERGE_PARTITIONS) -> DataFrame:
    """Pieces of documents: where they stand in their document and in a sequence; ids as little-endian bytes."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    found = T.staged(rows.mapInArrow(_pack(tokenizer, size, open_windows, end_token, with_ids), PIECES), "pieces")
    cols = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "ids"]
    left = found.where("sequence_id IS NULL").withColumn("team", F.floor(F.col("part") / merge))
    schema = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, ids binary"
    tail = left.groupBy("team").applyInPandas(_merge(size, with_ids), schema)
    return found.where("sequence_id IS NOT NULL").select(cols).unionByName(tail.select(cols))


def op9_packing(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return pack(docs, public_tokenizers.path("byte_bpe_50k.json"), with_ids=False).drop("ids")
