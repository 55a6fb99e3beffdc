import random
import tracemalloc
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest

from candlewick.llm import jaccard as J
from candlewick.llm.components import components
from candlewick.llm.repeats import by_group, sliced
from candlewick.session import _staging_dir


def shingles(text, n=3):
    words = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "").encode().split()
    if len(words) < n:
        return frozenset([tuple(words)] if words else [])
    return frozenset(zip(*(words[i:] for i in range(n))))


def classes(docs, percent=90, n=3):
    sets = {i: shingles(t, n) for i, t in docs}
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[:k]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {i: (len(sets[i]), find(i)) for i in ids}


def copies(seed, n, edits):
    """Groups of near copies, some similar to each other only through a third."""
    rnd = random.Random(seed)
    out = []
    for g in range(6):
        words = [f"{g}w{rnd.randint(0, 400)}" for _ in range(rnd.choice([20, 60, 150]))]
        for _ in range(n):
            own = list(words)
            for _ in range(rnd.randint(0, edits)):
                own[rnd.randrange(len(own))] = f"e{rnd.randint(0, 10**6)}"
            if rnd.random() < 0.3:
                words = own  # the group drifts
            out.append(" ".join(own))
    rnd.shuffle(out)
    return list(enumerate(out))


@pytest.mark.parametrize("short, part", [(64, 256), (3, 5)])  # also with blocks and tiles of a few documents
@pytest.mark.parametrize("seed", [1, 2])
def test_classes_against_brute_force(documents, seed, short, part):
    docs = copies(seed, 18, 6) + [(1000, None), (1001, ""), (1002, "A"), (1003, "a"), (1004, "a B"), (1005, "A b"), (1006, "b a"), (1007, " ")]
    rows = J.similar_classes(documents(docs, clash=["size", "root", "token"]), short=short, part=part).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in rows} == classes(docs)
    assert len({c for _, c in classes(docs).values()}) < len(docs) - 25


def test_lower_similarity(documents):
    docs = copies(5, 10, 8)
    rows = J.similar_classes(documents(docs), percent=70).collect()
    assert {r.doc_id: r.component_id for r in rows} == {i: c for i, (_, c) in classes(docs, 70).items()}


def test_repeated_and_nameless_rows(documents):
    rows = J.similar_classes(documents([(4, "a b c d"), (4, "a b c d"), (7, "a b c d"), (None, "a b c d"), (2, "x")])).collect()
    assert sorted((r.doc_id or 0, r.n_shingles, r.component_id or 0) for r in rows) == [(0, 2, 0), (2, 1, 2), (4, 2, 4), (4, 2, 4), (7, 2, 4)]


def test_empty_table(documents):
    assert J.similar_classes(documents([])).count() == 0


def test_components_of_long_paths_and_stars(spark):
    edges = [(i, i + 1) for i in range(100, 160)] + [(0, i) for i in range(1, 60)] + [(200, 200), (301, 300), (301, 302)]
    rows = components(spark.createDataFrame(edges, "a long, b long")).collect()
    assert {r.node: r.root for r in rows} == {**{i: 100 for i in range(100, 161)}, **{i: 0 for i in range(60)}, 300: 300, 301: 300, 302: 300}
    assert len(rows) == 61 + 60 + 3


@pytest.mark.parametrize("short, part", [(64, 256), (3, 5), (12, 5)])
def test_numbers_of_links_against_brute_force(documents, short, part):
    docs = copies(7, 18, 4)
    docs += [(300 + i, t) for i, t in docs[::5]] + [(900, docs[0][1]), (1000, None), (1001, ""), (1002, "a b")]
    sets = {i: shingles(t) for i, t in docs}
    similar = lambda x, y: bool(x & y) and 100 * len(x & y) >= 90 * len(x | y)
    want = {i: sum(similar(x, y) for j, y in sets.items() if j != i) for i, x in sets.items()}
    assert len(set(want.values())) > 3
    rows = J.similar_classes(documents(docs + docs[:3] + [(None, docs[0][1])]), short=short, part=part).collect()
    assert {(r.doc_id, r.n_links) for r in rows} == {*want.items(), (None, 0)}
    assert {r.doc_id: r.component_id for r in rows if r.doc_id is not None} == {i: c for i, (_, c) in classes(docs).items()}


def common_passage(seed, groups, n):
    """Small groups of near copies; all texts have a passage of rare words."""
    rnd = random.Random(seed)
    passage = " ".join(f"rare{i}" for i in range(24))
    out = []
    for _ in range(groups):
        words = [f"w{rnd.randint(0, 30)}" for _ in range(70)]
        for _ in range(n):
            own = list(words)
            own[rnd.randrange(len(own))] = f"w{rnd.randint(0, 30)}"
            out.append(" ".join(own[:35]) + f" {passage} " + " ".join(own[35:]))
    rnd.shuffle(out)
    return list(enumerate(out))


def blocks_seen(monkeypatch):
    """The numbers of documents of the blocks that are compared."""
    seen = []
    links = J.block_links

    def spy(blocks, *args):
        seen.extend(r["count"] for r in blocks.groupBy("block").count().collect())
        return links(blocks, *args)

    monkeypatch.setattr(J, "block_links", spy)
    return seen


def test_common_passage_makes_no_block(documents, monkeypatch):
    docs, seen = common_passage(3, 16, 3), blocks_seen(monkeypatch)
    rows = J.similar_classes(documents(docs), short=6).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in rows} == classes(docs)
    assert max(seen, default=0) <= 3  # all 48 in one block before


def test_token_tables_are_deleted(documents, spark):
    staged = lambda: {p for p in Path(_staging_dir(spark).removeprefix("file:")).glob("*/*") if any(p.iterdir())}
    before = staged()
    J.similar_classes(documents(common_passage(6, 8, 2)), short=6).collect()
    names = {p.name for p in staged() - before}
    assert "found" in names and not names & {"prefixes", "sets", "crowd_sets", "heavy", "counts", "entries", "lists", "members"}


def test_crowd_with_groups_of_its_own(documents, monkeypatch):
    """Groups longer than a short list are found in spite of the passage, each in a block of its own."""
    docs, seen = common_passage(4, 4, 9) + [(100 + i, t) for i, t in common_passage(5, 9, 2)], blocks_seen(monkeypatch)
    rows = J.similar_classes(documents(docs), short=6).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in rows} == classes(docs)
    assert 4 <= max(seen) <= 9


@pytest.mark.parametrize("most", [4, 1000])
def test_most_frequent_tokens_of_a_crowd(spark, most):
    sets = [np.array([i, 100, *([200] if i < 9 else []), *([300] if i < 5 else [])], np.int64) for i in range(40)]
    tokens, bins = J.heavy_tokens(spark.createDataFrame([(x.tobytes(),) for x in sets], "members binary"), 5, most)
    assert dict(zip(tokens.tolist(), bins.tolist())) == {100: int(4 * np.log2(40)), 200: int(4 * np.log2(9))}
    assert len(J.heavy_tokens(spark.createDataFrame([(x.tobytes(),) for x in sets], "members binary"), 5, 0)[0]) == 0


@pytest.mark.parametrize("two_parts", [False, True])
def test_large_tile_takes_little_memory(two_parts):
    rng = np.random.default_rng(3)
    bases = [np.unique(rng.integers(0, 2**63, 3000).astype(np.uint64)) for _ in range(4)]
    sets = [np.sort(rng.permutation(np.concatenate([bases[i % 4], bases[3][:50]]))[:-20]) for i in range(480)]
    sets = [np.unique(x) for x in sets]
    docs, parts = list(range(480)), [(i // 240 if two_parts else 0) for i in range(480)]
    tracemalloc.start()
    links, counts = J.tile_links(docs, sets, parts, 90, [1] * 480, [None] * 480)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert all(a % 4 == b % 4 for a, b in links) and len(links) == 480 - 4
    assert counts == [(i, 60 if two_parts else 119) for i in range(480)]
    assert peak < 60e6  # the tokens alone are 11 MB


def test_rows_become_objects_in_slices():
    rows = pa.table({"tile": pa.array([i // 300 for i in range(1000)], pa.int64()), "members": [bytes(20_000)] * 1000}).to_batches()
    parts = list(sliced(iter(rows)))
    assert max(p.num_rows for p in parts) <= 210 and pa.Table.from_batches(parts).equals(pa.Table.from_batches(rows))
    assert [len(g["tile"]) for g in by_group(iter(rows), "tile")] == [300, 300, 300, 100]
