import collections
import hashlib

import pytest

from candlewick.llm import suffix_array as A
from candlewick.llm import suffix_tree as S


def by_words(docs, n):
    words = {i: (t or "").encode().split() for i, t in docs}
    first = {}
    for i, w in sorted(words.items()):
        for s in range(len(w) - n + 1):
            first.setdefault(tuple(w[s : s + n]), i)
    out = {}
    for i, w in words.items():
        gone = [0] * len(w)
        for s in range(len(w) - n + 1):
            if first[tuple(w[s : s + n])] < i:
                gone[s : s + n] = [1] * n
        out[i] = (len(w), sum(gone), b" ".join(x for x, g in zip(w, gone) if not g).decode())
    return out


def by_bytes(docs, n):
    counts = collections.Counter()
    for _, t in docs:
        b = (t or "").encode()
        counts.update(b[s : s + n] for s in range(len(b) - n + 1))
    out = []
    for i, t in docs:
        b = (t or "").encode()
        gone = bytearray(len(b))
        for s in range(len(b) - n + 1):
            if counts[b[s : s + n]] > 1:
                gone[s : s + n] = b"\1" * n
        spans = sum(1 for x in range(len(b)) if gone[x] and (x == 0 or not gone[x - 1]))
        out.append((i, len(b), sum(gone), spans, bytes(x for x, g in zip(b, gone) if not g)))
    return sorted(out, key=repr)


@pytest.mark.parametrize("most", [512, 2])  # 2: nearly every anchor is too crowded for a group
def test_words_against_brute_force(documents, passages, most):
    docs = passages(5)
    out = S.substring_dedup(documents(docs, clash=["gram", "seg", "marks", "spans", "lo"]), n=8, k=3, rows_most=most).collect()
    want = by_words(docs, 8)
    assert len(out) == len(docs)
    assert {r.doc.doc_id: (r.n_words, sum(b - a for a, b in r.spans), r.kept_text) for r in out} == want
    assert sum(x[1] for x in want.values()) > 300
    assert all(r.doc.gram == "x" for r in out)


@pytest.mark.parametrize("most", [512, 2])
def test_bytes_against_brute_force(documents, passages, most):
    docs = passages(6) + [(200, "é" * 30 + "ab"), (201, "b" + "é" * 31)]
    docs += [docs[3], docs[3]]  # repeated rows are further places
    out = A.suffix_array_dedup(documents(docs, clash=["gram", "lead", "doc_text"]), n=20, k=5, rows_most=most).collect()
    got = sorted(((r.doc.doc_id, r.n_bytes, sum(b - a for a, b in r.spans), len(r.spans), bytes(r.kept_bytes)) for r in out), key=repr)
    assert got == by_bytes(docs, 20)


def test_repeated_rows_keep_their_words(documents):
    text = " ".join(f"w{i}" for i in range(30))
    out = S.substring_dedup(documents([(1, text), (1, text), (2, text), (None, text)]), n=8, k=3).collect()
    assert sorted((r.doc.doc_id or 0, sum(b - a for a, b in r.spans)) for r in out) == [(0, 0), (1, 0), (1, 0), (2, 30)]


def test_one_id_with_two_texts(documents):
    one, two = (" ".join(f"{c}{i}" for i in range(30)) for c in "ab")
    out = S.substring_dedup(documents([(1, one), (2, one), (2, two)]), n=8, k=3).collect()
    assert sorted((r.doc.doc_id, r.kept_text) for r in out) == [(1, one), (2, ""), (2, two)]


def test_empty_table(documents):
    assert S.substring_dedup(documents([])).count() == 0
    assert A.suffix_array_dedup(documents([])).count() == 0


def test_long_text(documents):
    long = " ".join(f"w{i % 5000}" for i in range(200_000))
    out = {r.doc.doc_id: r for r in S.substring_dedup(documents([(1, long), (2, "x " + long[:1000])])).collect()}
    words = long[:1000].split()
    tail = 0 if words[-1] in long.split()[:300] else 1
    assert out[1].spans == [] and out[2].spans == [[1, 1 + len(words) - tail]]


def test_multikey_order_is_sorted_order():
    import random

    rnd = random.Random(3)
    rows = [bytes(rnd.choice(b"\0a\xff") for _ in range(rnd.randint(0, 40))) for _ in range(300)]
    rows += rows[:40] + [b"a" * 64, b"a" * 64, b"a" * 65, b""]
    order, shared = A.multikey_order(rows)
    got = [rows[i] for i in order]
    for a, b, n in zip(got, got[1:], shared[1:]):
        same = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
        assert n == same
    # zero bytes sort with the end of a text; everything else in byte order
    assert [x.rstrip(b"\0") for x in got] == sorted(x.rstrip(b"\0") for x in rows)


def test_digest_of_kept_words(spark, tmp_path, documents):
    documents([(1, "a b  c\x0bd")]).write.parquet(f"{tmp_path}/documents.parquet")
    row = S.op2_substring_dedup(spark, str(tmp_path)).first()
    assert (row.n_words, row.kept_sha256) == (3, hashlib.sha256("a b c d".encode()).hexdigest())
