import collections
import random
import struct
import zlib
from array import array

import pytest

from candlewick.llm import packing as P
from candlewick.llm import sentencepiece as SP
from candlewick.llm.wordcache import ENTRY, WordCache

tokenizers = pytest.importorskip("public_tokenizers")
BPE, PIECES = tokenizers.path("byte_bpe_50k.json"), tokenizers.path("piece_bpe_32k.model")
HARD = ["a  b", "  x", " x ", "a\n b", "a \nb", "　b c  d", "x<|endoftext|> y <|endoftext|>", "it's  'll 's", "a\t b   c", "é ñ 日本 \U0001f600 z", "", " ", "a ", "\n\n a\n", "\x1c \x85a", "Ab12 c3.d!"]


def strange(n):
    rnd = random.Random(1)
    return ["".join(rnd.choice(" \n\ta'sb1.! 　éß") for _ in range(rnd.randint(0, 30))) for _ in range(n)]


def whole(encoder, texts):
    return [array("I", e.ids).tobytes() for e in encoder.tokenizer.encode_batch(texts, add_special_tokens=False)]


def test_words_are_encoded_as_in_their_text():
    encoder = P.ByteEncoder(BPE)
    texts = HARD + strange(3000) + ["word " * 400_000 + "end"]
    for text, got, want in zip(texts, encoder.encode(texts), whole(encoder, texts)):
        assert got == want, text[:80]
    # one at a time, and many runs
    assert [b"".join(encoder.encode([t])) for t in HARD] == whole(encoder, HARD)


def test_runs_of_texts_do_not_matter(monkeypatch):
    encoder, texts = P.ByteEncoder(BPE), strange(300)
    monkeypatch.setattr(P, "RUN_BYTES", 40)
    monkeypatch.setattr(P, "JOINED", 3)
    assert list(encoder.encode(texts)) == whole(encoder, texts)
    assert list(encoder.encode([])) == []


def test_word_cache_is_bounded():
    calls = []
    cache = WordCache(lambda words: calls.append(len(words)) or [w.encode() for w in words], most=10 * (ENTRY + 4), longest=3)
    for i in range(200):
        assert cache.all(["a", str(i), "long word"]) == [b"a", str(i).encode(), b"long word"]
        assert len(cache.young) + len(cache.old) < 30
    assert sum(calls) <= 420
    cache.clear()
    assert not cache.young and not cache.old and cache.all(["b"]) == [b"b"]


def packed(documents, docs, **options):
    rows = P.pack(documents(docs, clash=["part", "ids", "team"]), BPE, **options).collect()
    sequences = collections.defaultdict(list)
    for r in rows:
        sequences[r.sequence_id].append(r)
    for own in sequences.values():
        at = 0
        for r in sorted(own, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at == options["size"] or at & (at - 1) == 0  # full, or of a length that needs no padding
    return rows, sequences


@pytest.mark.parametrize("windows", [1, 3, 64])
def test_every_token_lies_in_one_piece(documents, windows):
    rnd = random.Random(windows)
    docs = [(i, " ".join(rnd.choice(["the", "of", "and", "it's"]) for _ in range(rnd.randint(0, 60)))) for i in range(80)] + [(98, None), (99, ""), (97, "x " * 500)]
    rows, sequences = packed(documents, docs, size=32, open_windows=windows)
    encoder = P.ByteEncoder(BPE)
    own = collections.defaultdict(list)
    for r in rows:
        own[r.doc_id].append(r)
    for i, text in docs:
        ids = whole(encoder, [text or ""])[0] + struct.pack("<I", 0)
        pieces = sorted(own[i], key=lambda r: r.start)
        assert b"".join(bytes(r.ids) for r in pieces) == ids
        assert [r.start for r in pieces] == [sum(p.length for p in pieces[:k]) for k in range(len(pieces))]
        assert all(r.ids_crc32 == zlib.crc32(bytes(r.ids)) and r.doc_tokens == len(ids) // 4 for r in pieces)
    total = sum(r.length for r in rows)
    assert sum(sum(r.length for r in s) < 32 for s in sequences.values()) <= 5
    assert len(sequences) <= total // 32 + 5


def test_null_ids_and_repeated_rows(documents):
    rows, _ = packed(documents, [(None, "a b"), (1, "c"), (1, "c")], size=32)
    assert sorted((r.doc_id or 0, r.doc_tokens) for r in rows if r.start == 0) == [(0, 3), (1, 2), (1, 2)]


def test_empty_table(documents):
    assert P.pack(documents([]), BPE).count() == 0


def brute(pieces, text):
    """Best path by trying every piece at every place, and its score."""
    table = {p: (i, s) for i, (p, s, k) in enumerate(pieces) if k == "normal"}
    least = min(s for _, s in table.values()) - SP.UNKNOWN_COST
    best = [(0.0, [])]
    for end in range(1, len(text) + 1):
        found = []
        for begin in range(end):
            if text[begin:end] in table:
                i, s = table[text[begin:end]]
                found.append((best[begin][0] + s, best[begin][1] + [i]))
        if text[end - 1] not in table:
            found.append((best[end - 1][0] + least, best[end - 1][1] + [-1]))
        best.append(max(found, key=lambda x: x[0]))
    return best[-1][0]


def test_viterbi_against_brute_force():
    rnd = random.Random(9)
    for _ in range(20):
        names = {"a", "b", SP.SPACE} | {"".join(rnd.choice("abc") for _ in range(rnd.randint(1, 4))) for _ in range(12)} | {SP.SPACE + "ab", SP.SPACE + "c"}
        table = [("<unk>", 0.0, "unknown")] + [(f"<0x{b:02X}>", 0.0, "byte") for b in range(256)] + [(x, -rnd.random() * 10, "normal") for x in sorted(names)]
        model = SP.Pieces(table)
        score = {i: s for i, (_, s, k) in enumerate(table) if k == "normal"}
        for _ in range(40):
            text = "".join(rnd.choice("abc d") for _ in range(rnd.randint(1, 14)))
            ids = array("I", model.encode(text)).tolist()
            whole = SP.SPACE + text.replace(" ", SP.SPACE)
            got = sum(score.get(i, model.unknown) for i in ids)
            assert got == pytest.approx(brute(table, whole))
            assert model.decode(model.encode(text)).decode() == text


def test_no_path_of_the_library_scores_better():
    """The library's own search over the same scores rounds its sums, so it may miss the best path; it never beats it."""
    sp = pytest.importorskip("sentencepiece")
    pb = pytest.importorskip("sentencepiece.sentencepiece_model_pb2")
    proto = pb.ModelProto()
    with open(PIECES, "rb") as f:
        proto.ParseFromString(f.read())
    proto.trainer_spec.model_type = 1  # best path by score, as for unigram models
    library, own = sp.SentencePieceProcessor(model_proto=proto.SerializeToString()), SP.Pieces.load(PIECES)
    scores = [p.score for p in proto.pieces]
    rnd, same = random.Random(4), 0
    for _ in range(500):
        text = " ".join("".join(rnd.choice("theandofingr") for _ in range(rnd.randint(1, 12))) for _ in range(rnd.randint(1, 20)))
        got, theirs = array("I", own.encode(text)).tolist(), library.encode(text)
        assert sum(scores[i] for i in got) >= sum(scores[i] for i in theirs)
        same += got == theirs
    assert same >= 480


def test_round_trip(documents):
    texts = [t for t in HARD + strange(200) if SP.SPACE not in t]
    docs = documents([*enumerate(texts), (9999, None)], clash=["row", "value"])
    out = SP.decode(SP.encode(docs, PIECES), PIECES).collect()
    assert len(out) == len(texts) + 1
    assert all(r.text == r.decoded for r in out) and {r.row for r in out} == {"x"}
