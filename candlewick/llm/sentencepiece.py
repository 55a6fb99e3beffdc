"""SentencePiece encoding and decoding.

An Aho-Corasick automaton over all pieces reads a text once. At each position
its output links name the pieces that end there, longest first; each relaxes
the best score of that position from the position where it begins. A character
that no piece covers costs ten less than the worst piece and becomes bytes.

Pieces never go on past a word into the space behind it, so the best path of a
text is that of its words (a run of spaces and what follows it), and a word's
path is found once while it is cached.

Defined results: a null text has null ids; an empty text has none. Decoding
returns the text as it was, but U+2581 comes back as a space. Further columns
pass through.
"""

from __future__ import annotations

import re
import zlib
from array import array
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candlewick.llm.wordcache import WordCache

SPACE = "▁"
#: How much less than the worst piece an unknown character scores.
UNKNOWN_COST = 10.0

_WORD = re.compile(f"{SPACE}*[^{SPACE}]*")
_loaded: dict[str, "Pieces"] = {}


class Pieces:
    """The pieces of a model file, their automaton, and the paths of recent words."""

    def __init__(self, pieces: list[tuple[str, float, str]]):
        """Of each id: text, score, and kind: normal, byte, unknown or control."""
        import ahocorasick

        self.automaton = ahocorasick.Automaton()
        self.single = set()
        self.bytes = [0] * 256
        self.texts: list[bytes] = []
        least = 0.0
        self.parted = True
        for i, (piece, score, kind) in enumerate(pieces):
            text = piece.replace(SPACE, " ").encode()
            if kind == "normal" and piece:
                self.automaton.add_word(piece, (i, len(piece), score))
                least = min(least, score)
                if len(piece) == 1:
                    self.single.add(piece)
                self.parted &= re.search(f"[^{SPACE}]{SPACE}", piece) is None
            elif kind == "byte":
                self.bytes[int(piece[3:5], 16)] = i
                text = bytes([int(piece[3:5], 16)])
            else:
                text = b""
            self.texts.append(text)
        self.automaton.make_automaton()
        self.unknown = least - UNKNOWN_COST
        self.words = WordCache(lambda words: [array("I", self.path(w)).tobytes() for w in words])

    @classmethod
    def load(cls, path: str) -> "Pieces":
        if path not in _loaded:
            import sentencepiece

            m = sentencepiece.SentencePieceProcessor(model_file=path)
            kinds = ["byte" if m.is_byte(i) else "control" if m.is_control(i) or m.is_unused(i) else "unknown" if m.is_unknown(i) else "normal" for i in range(m.get_piece_size())]
            _loaded[path] = cls([(m.id_to_piece(i), m.get_score(i), k) for i, k in enumerate(kinds)])
        return _loaded[path]

    def released(self, rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The rows of a task; the words it kept are given back when it ends, as its process goes on to others."""
        try:
            yield from rows
        finally:
            self.words.clear()

    def path(self, word: str) -> list[int]:
        """Ids of the best path over a word."""
        n = len(word)
        best, back = [0.0] + [float("-inf")] * n, [(-1, 0)] * (n + 1)
        at = 0

        def unknown(upto: int) -> None:
            nonlocal at
            while at < upto:
                if word[at] not in self.single and best[at] + self.unknown > best[at + 1]:
                    best[at + 1], back[at + 1] = best[at] + self.unknown, (-1, at)
                at += 1

        for end, (i, size, score) in self.automaton.iter(word):
            unknown(end)
            begin = end + 1 - size
            if best[begin] + score > best[end + 1]:
                best[end + 1], back[end + 1] = best[begin] + score, (i, begin)
            if size == 1:
                at = max(at, end + 1)
        unknown(n)
        out: list[int] = []
        while n:
            i, begin = back[n]
            out += [i] if i >= 0 else [self.bytes[b] for b in reversed(word[begin:n].encode())]
            n = begin
        return out[::-1]

    def encode(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit bytes."""
        if not text:
            return b""
        if not self.parted:
            return array("I", self.path(SPACE + text.replace(" ", SPACE))).tobytes()
        if "  " in text or SPACE in text or text[0] == " " or text[-1] == " ":
            words = [w for w in _WORD.findall(SPACE + text.replace(" ", SPACE)) if w]
        else:
            words = [SPACE + w for w in text.split(" ")]
        return b"".join(self.words.all(words))

    def decode(self, ids: bytes) -> bytes:
        raw = b"".join(map(self.texts.__getitem__, array("I", ids)))
        return raw[1:] if raw[:1] == b" " else raw


def encode(docs: DataFrame, model: str, text: str = "text", out: str = "ids") -> DataFrame:
    """Adds the ids of a text as a binary column of little-endian unsigned 32-bit numbers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = Pieces.load(model)
        yield from pieces.released(rows(pieces, batches))

    def rows(pieces: Pieces, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = [None if x is None else pieces.encode(x) for x in batch.column("value").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(ids, pa.binary())], names=["row", "ids"])

    return _with_column(docs, run, f"`{text}`", "ids binary", out)


def decode(docs: DataFrame, model: str, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """Adds the text of a binary column of ids; byte pieces that are no UTF-8 become U+FFFD."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = Pieces.load(model)
        for batch in batches:
            texts = [None if x is None else pieces.decode(x).decode("utf-8", "replace") for x in batch.column("value").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(texts, pa.string())], names=["row", "ids"])

    return _with_column(docs, run, f"`{ids}`", "ids string", out)


def _with_column(docs: DataFrame, run, value: str, kind: str, out: str) -> DataFrame:
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col(value).alias("value"))
    done = rows.mapInArrow(run, f"row {rows.schema['row'].dataType.simpleString()}, {kind}")
    return done.select(*[F.col("row").getField(c).alias(c) for c in docs.columns if c != out], F.col("ids").alias(out))


def op3_sentencepiece(spark, sf_dir: str) -> DataFrame:
    """Ids of every whole text as a checksum, and whether decoding them gives the text back."""
    import public_tokenizers

    model = public_tokenizers.path("piece_bpe_32k.model")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = Pieces.load(model)
        yield from pieces.released(rows(pieces, batches))

    def rows(pieces: Pieces, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, crc, same = [], [], []
            for value in batch.column("text").to_pylist():
                ids = pieces.encode(value or "")
                n.append(len(ids) // 4)
                crc.append(zlib.crc32(ids))
                same.append(pieces.decode(ids) == (value or "").replace(SPACE, " ").encode())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(crc, pa.int64()), pa.array(same)], names=["doc_id", "n_tokens", "ids_crc32", "round_trip"])

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return docs.mapInArrow(run, "doc_id long, n_tokens long, ids_crc32 long, round_trip boolean")
