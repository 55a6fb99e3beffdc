"""Divergence of sources against dense counts in plain Python."""

import re
from collections import Counter, defaultdict

import pytest

from candlewick.llm import divergence as D

SCHEMA = "lang string, source string, text string"
TERM = re.compile(rb"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


def brute(rows, least=3, top=200, scale=D.SCALE):
    docs = [(a or "", b or "", Counter(TERM.findall(bytes(c | 32 if 65 <= c <= 90 else c for c in (t or "").encode())))) for a, b, t in rows]
    df = Counter((lang, w) for lang, _, n in docs for w in n)
    kept = defaultdict(list)
    for (lang, w), n in df.items():
        if n >= least:
            kept[lang].append(w)
    group, whole = defaultdict(Counter), defaultdict(Counter)
    for lang, source, n in docs:
        group[lang, source].update(n)
        whole[lang].update(n)

    def p(counts, lang):
        v = kept[lang]
        total = sum(counts[w] for w in v)
        return {w: 1 + scale * (counts[w] + 1) // (total + len(v)) for w in v}

    out = []
    for lang, source in group:
        mine = p(group[lang, source], lang)
        found = [("pair", b, sum((mine[w] - q) ** 2 // q for w, q in p(group[lang, b], lang).items())) for a, b in group if a == lang and b != source]
        terms = [("term", w.decode(), (mine[w] - q) ** 2 // q) for w, q in p(whole[lang], lang).items() if group[lang, source][w] and mine[w] > q]
        for part, most in ((found, None), (terms, top)):
            part.sort(key=lambda x: (-x[2], x[1].encode()))
            out += [(lang, source, *x, i) for i, x in enumerate(part[:most], 1)]
    return sorted(out)


def got(df, **kw):
    return sorted(tuple(r) for r in D.divergence(df, **kw).collect())


def corpus(seed=3, n=120):
    import random

    rnd = random.Random(seed)
    words = [f"w{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(60)] + ["Été", "日本", "A-b"]
    rows = []
    for _ in range(n):
        source = rnd.choice(["s0", "s0", "s0", "s1", "s2", "S é"])
        shift = {"s1": 20, "s2": 35}.get(source, 0)
        rows.append((rnd.choice(["en", "de"]), source, " ".join(words[min(62, int(rnd.expovariate(0.08)) + shift)] for _ in range(rnd.randint(0, 30)))))
    return rows


@pytest.mark.parametrize("held", [1, 10**6])
def test_against_brute_force(spark, monkeypatch, held):
    rows = corpus()
    run = D.counts
    monkeypatch.setattr(D, "counts", lambda docs: run(docs, held))
    assert got(spark.createDataFrame(rows, SCHEMA).repartition(3)) == brute(rows)
    assert got(spark.createDataFrame(rows, SCHEMA), top=4) == brute(rows, top=4)


def test_nulls_empty_texts_and_groups_without_terms(spark):
    rows = [(None, None, None), (None, "a", "x y x"), (None, "b", ""), ("en", "a", None), ("en", "b", "1 2 3 !"), ("", "a", "X x y z"), ("", "c", "x y z")]
    assert got(spark.createDataFrame(rows, SCHEMA)) == brute(rows)
    assert [r for r in brute(rows) if r[0] == "en"] == [("en", "a", "pair", "b", 0, 1), ("en", "b", "pair", "a", 0, 1)]


def test_repeated_rows_ties_long_texts_and_clashing_columns(spark):
    from pyspark.sql import functions as F

    rows = [("en", "a", "same words here")] * 5 + [("en", "b", "same words there other")] * 4 + [("en", "c", "long " * 300_000 + "here there")] + [("fr", "a", "seul")]
    df = spark.createDataFrame(rows, SCHEMA)
    for name in ("term", "n", "docs", "part", "value", "rank", "p", "q", "zero"):
        df = df.withColumn(name, F.lit("x"))
    assert got(df) == brute(rows)


def test_empty_table(spark):
    assert got(spark.createDataFrame([], SCHEMA)) == []


def test_terms_of_bytes():
    assert D.terms("Ab1cD é\tÉ,x\x00y".encode()) == Counter({b"ab": 1, b"cd": 1, "é".encode(): 1, "É".encode(): 1, b"x": 1, b"y": 1})
