"""Collocations against counts of all phrases in plain Python."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from candlewick.llm import collocations as C

SCHEMA = "lang string, text string"


def brute(rows, least, within=80, top=2000):
    f, total = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        low = bytes(c | 32 if 65 <= c <= 90 else c for c in (text or "").encode())
        for piece in re.split(rb"[.,;:!?\x0A-\x0D]", low):
            ws = re.findall(rb"[^\x20\x09]+", piece)
            total[lang] += len(ws)
            f.update((lang, *ws[i : i + k]) for k in range(1, 5) for i in range(len(ws) - k + 1))
    often = {p: n for p, n in f.items() if n >= least and len(p) > 2}
    gone = set()
    for p, n in often.items():
        for k in range(2, len(p) - 1):
            for i in range(1, len(p) - k + 1):
                part = (p[0], *p[i : i + k])
                if 100 * n >= within * f[part]:
                    gone.add(part)
    found = defaultdict(list)
    for p, a in often.items():
        if p not in gone:
            cuts = [(2_000_000 * a // (f[p[: k + 1]] + f[(p[0], *p[k + 1 :])]), k) for k in range(1, len(p) - 1)]
            score, k = min(cuts)
            found[p[0]].append((-score, -a, b" ".join(p[1:]), f[p[: k + 1]], f[(p[0], *p[k + 1 :])]))
    return sorted((lang, i, w.decode(), -a, left, right, total[lang], -s) for lang, x in found.items() for i, (s, a, w, left, right) in enumerate(sorted(x)[:top], 1))


def got(df, least, **kw):
    return sorted(tuple(r) for r in C.collocations(df, least, **kw).collect())


def corpus(seed=1, n=90):
    rnd = random.Random(seed)
    words = ["the", "of", "New", "York", "city", "état", "日本", "x\x01y"]
    rows = []
    for _ in range(n):
        text = []
        for _ in range(rnd.randint(0, 25)):
            text.append(rnd.choice(["new york city", "the", "of the", "of the state of", rnd.choice(words), rnd.choice(words)]))
            text.append(rnd.choice([" ", " ", "  ", "\t", ". ", ",", "\n"]))
        rows.append((rnd.choice(["en", "en", "fr", None]), "".join(text)))
    return rows


@pytest.fixture
def few_buckets(monkeypatch):
    monkeypatch.setattr(C, "MIN_BUCKETS", 64)  # so that prefixes share buckets, and many are extended


@pytest.mark.parametrize("budget, run_bytes", [(1 << 20, 8 << 20), (400, 500), (40, 200)])
def test_against_brute_force(spark, few_buckets, budget, run_bytes):
    rows = corpus()
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    assert got(df, 5, budget=budget, run_bytes=run_bytes) == brute(rows, 5)


def test_best_of_each_language_and_ties(spark):
    rows = corpus(5)
    assert got(spark.createDataFrame(rows, SCHEMA), 3, top=7) == brute(rows, 3, top=7)
    rows = [("en", "b a. a b. d c. c d")] * 4
    assert got(spark.createDataFrame(rows, SCHEMA), 4, top=3) == brute(rows, 4, top=3)


def test_hot_parts_are_looked_up_by_broadcast(spark, monkeypatch):
    rows = corpus(9)
    monkeypatch.setattr(C, "HOT_PARTS", 20)
    assert got(spark.createDataFrame(rows, SCHEMA), 4) == brute(rows, 4)


def test_nulls_empty_long_and_repeated_rows_with_clashing_columns(spark):
    from pyspark.sql import functions as F

    rows = [(None, None), ("en", None), ("en", ""), ("en", " \t. ,"), ("und", "one two"), (None, "one two"), ("", "one two")] + [("en", "alpha beta gamma")] * 40
    rows += [("en", "very long text, " * 60_000), ("fr", "a" * 300_000 + " b")]
    df = spark.createDataFrame(rows, SCHEMA)
    for name in ("phrase", "f", "n", "a", "l", "r", "k", "group", "codes", "words", "depth"):
        df = df.withColumn(name, F.lit("x"))
    assert got(df, 2) == brute(rows, 2)


def test_empty_table(spark):
    assert got(spark.createDataFrame([], SCHEMA), 30) == []


def test_groups_keep_the_budget(spark, few_buckets):
    rows = corpus(2, 200)
    runs = C.coded(spark.createDataFrame(rows, SCHEMA), 2000).cache()
    total = sum(b[6] for b in {(r[0], r[6]): r for r in brute(rows, 1)}.values())
    part = C.vertical_partition(runs, total, 500)
    assert part.ends[-1] > 3 and len(part.extended) > 1
    sent = runs.mapInArrow(C._sent(part), "group int, lang string, words binary, codes binary, counts binary").collect()
    held = Counter()
    for r in sent:
        held[r["group"]] += len(np.frombuffer(C._unpacked(r["counts"]), np.int64))
    assert max(held.values()) <= 500 and set(held) <= set(range(part.ends[-1]))
    runs.unpersist()
