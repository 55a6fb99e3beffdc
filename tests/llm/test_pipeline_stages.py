"""Stages of the pipeline, each alone, against brute force."""

import random

import pytest

pipeline = pytest.importorskip("corpus_pipeline")


def similar(a, b, n=5, percent=80):
    x, y = (frozenset(zip(*(t.split()[i:] for i in range(n)))) for t in (a, b))
    both = len(x & y)
    return 100 * both >= percent * (len(x) + len(y) - both)


def kept(docs):
    """Smallest id of each group of similar texts."""
    root = {i: i for i, _ in docs}
    for _ in docs:
        for i, a in docs:
            for j, b in docs:
                if similar(a, b):
                    root[i] = min(root[i], root[j])
    return {i for i in root if root[i] == i}


def edited(seed):
    """Texts, and copies of them with one passage added, cut or replaced."""
    rnd = random.Random(seed)
    out = []
    for g in range(8):
        words = [f"{g}w{rnd.randint(0, 300)}" for _ in range(100)]
        out.append(" ".join(words))
        for share in (5, 10, 14, 18, 22, 30):
            at = rnd.randrange(100 - share)
            new = [f"e{rnd.randint(0, 10**6)}" for _ in range(share)]
            out.append(" ".join(rnd.choice([words[:at] + new + words[at:], words[:at] + words[at + share :], words[: at] + new + words[at + share :]])))
    rnd.shuffle(out)
    return list(enumerate(out))


def test_near_copies_with_one_passage_changed(spark, documents):
    docs = edited(3)
    assert any(similar(a, b) and not similar(a, b, 3, 90) for i, a in docs for j, b in docs[:i])
    rows = pipeline.near_duplicates(spark, documents(docs), "").collect()
    assert {r.doc_id for r in rows} == kept(docs) and len(rows) == len(kept(docs)) < len(docs)


def test_different_texts_of_one_id_are_different_documents(spark, documents):
    a, b, c, d = (" ".join(f"{x}{i}" for i in range(60)) for x in "abcd")
    near = a + " more"
    docs = [(5, a), (5, b), (5, b), (3, near), (9, b), (9, c), (7, d), (7, None), (7, ""), (None, a), (None, a), (2, c)]
    rows = pipeline.near_duplicates(spark, documents(docs), "").collect()
    want = [(3, near), (5, b), (2, c), (7, d), (7, None), (7, ""), (None, a), (None, a)]
    assert sorted(map(repr, ((r.doc_id, r.text) for r in rows))) == sorted(map(repr, want))


def test_packed_corpus_holds_the_tokens(spark, documents):
    import zlib

    import public_tokenizers
    from tokenizers import Tokenizer

    docs = [(i, f"text {i} " + "of some words " * (i * 40)) for i in range(20)] + [(20, ""), (21, None)]
    pieces = {}
    for r in pipeline.pack(spark, documents(docs), "").collect():
        assert len(r.ids) == 4 * r.length and zlib.crc32(bytes(r.ids)) == r.ids_crc32
        pieces.setdefault(r.doc_id, []).append((r.start, bytes(r.ids)))
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    for i, text in docs:
        ids = memoryview(b"".join(x for _, x in sorted(pieces[i]))).cast("I").tolist()
        assert ids[-1] == 0 and tokenizer.decode(ids[:-1], skip_special_tokens=False) == (text or "")


def test_rows_go_to_python_in_small_batches(spark, documents):
    from candlewick.llm import text as T

    docs = documents([(i, "word " * 1000) for i in range(6000)]).coalesce(1)
    pipeline.quality_rules(spark, docs.limit(1), "")

    def sizes(batches):
        import pyarrow as pa

        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([b.nbytes]), pa.array([b.num_rows])], names=["bytes", "n"])

    got = docs.mapInArrow(sizes, "bytes long, n long").collect()
    assert sum(r.n for r in got) == 6000 and max(r.bytes for r in got) < 1.5 * T.BATCH_BYTES


def test_a_task_gives_the_heap_back():
    import gc
    import re
    import sys

    from candlewick.llm import text as T

    if not sys.platform.startswith("linux"):
        pytest.skip("memory is read from /proc")

    def held():
        return int(re.search(r"VmRSS:\s+(\d+)", open("/proc/self/status").read())[1]) / 1024

    def task():
        import numpy as np

        arrays = [np.ones(8192, np.uint8) for _ in range(20000)]
        kept.append(arrays[-1])  # in use above the others, so that the heap's end cannot move down
        yield 1

    kept, before = [], held()
    run = T.given_back(task())
    next(run)
    assert held() > before + 100
    assert list(run) == []
    gc.collect()
    assert held() < before + 60
