"""Licence scans with a generalised suffix automaton.

The automaton accepts every run of words of every template. A text's words go
through it once; at each word it tells the longest run ending there that
stands in a template (matching statistics), and where. Runs that cannot grow
are matches. A template's matches are chained in the order of both the text
and the template, and the words they cover, against the template's length,
are its cover. Phrases are templates that have to match as a whole; each
place of one is a base place.

A word that is in no template ends every run, so words are first looked up as
hashes for a whole batch, and only runs of template words reach the automaton.

Defined results: a null or empty text has no words, no labels and score 0; a
null doc_id is kept; repeated rows are scanned each; further columns pass
through.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candlewick.llm import text as T

# Phrases that are base matches, and their labels.
PHRASES = [
    ("gnu general public license", "gpl"),
    ("apache license", "apache"),
    ("cc by", "cc-by"),
    ("mit license", "mit"),
]

# Notices and conditions of public licences, as they are printed in files.
TEMPLATES = [
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("gpl", "This work is licensed under the GNU General Public License, version 3."),
    ("lgpl", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version."),
    ("agpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("apache", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"),
    ("apache", "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied."),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so"),
    ("mit", "Released under the MIT License."),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("mpl", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0."),
    ("cc-by-sa", "Licensed under CC BY-SA 4.0."),
    ("unlicense", "This is free and unencumbered software released into the public domain."),
]

#: Fewest words of a match that is chained, and cover from which a template's label holds.
LEAST_MATCH = 3
LEAST_COVER = 0.8


def split(value: str) -> list[bytes]:
    """Words of a text, as the scan sees them."""
    data = T.lowered(np.frombuffer(value.encode(), np.uint8))
    starts, ends, _ = T.words(data, np.array([0, len(data)]), T.ALNUM)
    raw = data.tobytes()
    return [raw[a:b] for a, b in zip(starts, ends)]


class SuffixAutomaton:
    """All runs of words of several templates; a state is a set of runs that end at the same places."""

    def __init__(self, templates: list[list[int]]):
        self.next: list[dict[int, int]] = [{}]
        self.link, self.size = [-1], [0]
        self.ends: list[dict[int, int]] = [{}]  # template: the first word after a run of this state
        for t, words in enumerate(templates):
            last = 0
            for i, w in enumerate(words):
                last = self._extend(last, w)
                self.ends[last].setdefault(t, i + 1)
        for state in sorted(range(1, len(self.size)), key=lambda s: -self.size[s]):
            for t, end in self.ends[state].items():
                up = self.ends[self.link[state]]
                up[t] = min(up.get(t, end), end)

    def _new(self, size: int, link: int, follow: dict[int, int]) -> int:
        self.size.append(size)
        self.link.append(link)
        self.next.append(follow)
        self.ends.append({})
        return len(self.size) - 1

    def _split(self, state: int, word: int, to: int) -> int:
        """The state for the runs of ``to`` that are one longer than ``state``."""
        if self.size[to] == self.size[state] + 1:
            return to
        copy = self._new(self.size[state] + 1, self.link[to], dict(self.next[to]))
        self.link[to] = copy
        while state >= 0 and self.next[state].get(word) == to:
            self.next[state][word] = copy
            state = self.link[state]
        return copy

    def _extend(self, last: int, word: int) -> int:
        if word in self.next[last]:  # another template went this way
            return self._split(last, word, self.next[last][word])
        state = self._new(self.size[last] + 1, 0, {})
        at = last
        while at >= 0 and word not in self.next[at]:
            self.next[at][word] = state
            at = self.link[at]
        if at >= 0:
            self.link[state] = self._split(at, word, self.next[at][word])
        return state

    def step(self, state: int, length: int, word: int) -> tuple[int, int]:
        """The longest run that ends with this word, given the longest that ended before it."""
        while state and word not in self.next[state]:
            state = self.link[state]
            length = self.size[state]
        if word in self.next[state]:
            return self.next[state][word], length + 1
        return 0, 0


class Scanner:
    def __init__(self, phrases: list[tuple[str, str]], templates: list[tuple[str, str]], least: int, cover: float):
        self.least, self.cover = least, cover
        words = [split(x) for x, _ in phrases] + [split(x) for _, x in templates]
        self.labels = [y for _, y in phrases] + [y for y, _ in templates]
        self.phrases = len(phrases)
        vocabulary = sorted({w for t in words for w in t})
        number = {w: i for i, w in enumerate(vocabulary)}
        self.sizes = [len(t) for t in words]
        self.automaton = SuffixAutomaton([[number[w] for w in t] for t in words])
        raw = b" ".join(vocabulary)
        data = np.frombuffer(raw, np.uint8)
        starts, ends, _ = T.words(data, np.array([0, len(data)]))
        hashes = T.word_hashes(data, starts, ends)
        order = np.argsort(hashes)
        self.hashes, self.numbers = hashes[order], order
        self.single = np.array([number[w[0]] for w in words[: self.phrases] if len(w) == 1], dtype=np.int64)
        # phrases whose last word a run in this state may be, shortest first
        self.whole: list[list[tuple[int, int]]] = [[] for _ in self.automaton.size]
        for p in range(self.phrases):
            state = 0
            for w in words[p]:
                state = self.automaton.next[state][number[w]]
            self.whole[state].append((self.sizes[p], p))
        for state in sorted(range(1, len(self.whole)), key=lambda s: self.automaton.size[s]):
            self.whole[state] = self.whole[self.automaton.link[state]] + self.whole[state]

    def known(self, hashes: np.ndarray) -> np.ndarray:
        """Numbers of the words that stand in a template, else -1."""
        at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
        return np.where(self.hashes[at] == hashes, self.numbers[at], -1)

    def scan(self, runs: list[tuple[int, list[int]]]) -> tuple[list[tuple[int, int]], list[tuple[int, int, int, float]]]:
        """Of runs of known words (first word's place, words): base places (phrase, place), and spans (template, first word, end, cover)."""
        a, base = self.automaton, []
        matches: dict[int, list[tuple[int, int, int]]] = {}  # template: place in text, in template, words
        for first, words in runs:
            state = length = 0
            for i, w in enumerate([*words, -1]):
                after, grown = a.step(state, length, w) if w >= 0 else (0, 0)
                if length >= self.least and grown <= length:
                    for t, end in a.ends[state].items():
                        if t >= self.phrases:
                            matches.setdefault(t, []).append((first + i - length, end - length, length))
                state, length = after, grown
                base += [(p, first + i + 1 - size) for size, p in self.whole[state] if size <= length]
        spans = []
        for t, found in matches.items():
            spans += [(t, first, end, covered / self.sizes[t]) for covered, first, end in chains(found, self.sizes[t], self.cover * self.sizes[t])]
        return base, spans


def chains(matches: list[tuple[int, int, int]], size: int, least: float) -> list[tuple[int, int, int]]:
    """(template words covered, first text word, end) of the best chain, and of others beside it of ``least`` words or more.

    ``matches`` are (place in text, place in template, words). Words of the text
    belong to the first match that holds them. Chains share no words of the text and
    come in its order.
    """
    parts, upto = [], 0
    for x, y, n in sorted(set(matches)):
        cut = max(0, upto - x)
        if cut < n:
            parts.append((x + cut, y + cut, n - cut))
            upto = x + n
    out, todo = [], [parts]
    while todo:
        part = todo.pop()
        found = chain(part, size)
        if found and (not out or found[0] >= least):
            out.append(found)
            todo += [[m for m in part if m[0] + m[2] <= found[1]], [m for m in part if m[0] >= found[2]]]
    return sorted(out, key=lambda c: c[1])


def chain(matches: list[tuple[int, int, int]], size: int) -> tuple[int, int, int] | None:
    """The chain in the order of both sequences that covers most of a template; the first of several.

    ``matches`` are in text order and share no words there. For each place in the
    template the best chain that ends there is kept, so a match looks at ``size``
    places, and not at the matches before it. A match that has the same place and
    length as an earlier one changes nothing unless some place did since, and a
    place changes ``size`` times at most: long texts of one phrase cost a lookup each.
    """
    best, start, seen, version = [0] * (size + 1), [0] * (size + 1), {}, 0
    top = None
    for x, y, n in matches:
        if seen.get((y, n)) == version:
            continue
        end, covered, first = y + n, n, x
        for k in range(1, end):
            if best[k] and best[k] + min(n, end - k) > covered:
                covered, first = best[k] + min(n, end - k), start[k]
        if covered > best[end]:
            best[end], start[end] = covered, first
            version += 1
            if top is None or covered > top[0]:
                top = (covered, first, x + n)
        seen[y, n] = version
    return top


OUT = "n_words long, places array<struct<phrase:int,word:bigint>>, spans array<struct<template:int,label:string,first:bigint,last:bigint,cover:double>>"


def _scan(scanner_args: tuple):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(*scanner_args)
        for batch in batches:
            for i, j, part, offs in T.pieces(*T.utf8(batch.column("text"))):
                data = T.lowered(part)
                starts, ends, ranges = T.words(data, offs, T.ALNUM)
                known = scanner.known(T.word_hashes(data, starts, ends))
                text = T.owners(ranges)
                good = known >= 0
                alone = np.ones(len(known), dtype=bool)
                if len(known) > 1:
                    next_to = good[1:] & good[:-1] & (text[1:] == text[:-1])
                    alone[1:] &= ~next_to
                    alone[:-1] &= ~next_to
                at = np.flatnonzero(good & (~alone | np.isin(known, scanner.single)))
                places, spans = [[] for _ in range(j - i)], [[] for _ in range(j - i)]
                if len(at):
                    new = np.ones(len(at), dtype=bool)
                    new[1:] = (at[1:] != at[:-1] + 1) | (text[at[1:]] != text[at[:-1]])
                    cuts = [*np.flatnonzero(new).tolist(), len(at)]
                    runs: dict[int, list] = {}
                    for a, b in zip(cuts[:-1], cuts[1:]):
                        row = int(text[at[a]])
                        runs.setdefault(row, []).append((int(at[a] - ranges[row]), known[at[a:b]].tolist()))
                    for row, own in runs.items():
                        base, found = scanner.scan(own)
                        places[row] = [{"phrase": p, "word": w} for p, w in base]
                        spans[row] = [{"template": t, "label": scanner.labels[t], "first": a, "last": b - 1, "cover": cover} for t, a, b, cover in found]
                kinds = (pa.list_(pa.struct([("phrase", pa.int32()), ("word", pa.int64())])), pa.list_(pa.struct([("template", pa.int32()), ("label", pa.string()), ("first", pa.int64()), ("last", pa.int64()), ("cover", pa.float64())])))
                yield pa.RecordBatch.from_arrays([batch.column("doc").slice(i, j - i), pa.array(np.diff(ranges).astype(np.int64)), pa.array(places, kinds[0]), pa.array(spans, kinds[1])], names=["doc", "n_words", "places", "spans"])

    return run


def scan_licenses(docs: DataFrame, phrases: list[tuple[str, str]] = PHRASES, templates: list[tuple[str, str]] = TEMPLATES, least_match: int = LEAST_MATCH, least_cover: float = LEAST_COVER) -> DataFrame:
    """Every document (struct ``doc``) with its words, base places, template spans, labels and score.

    The score is the best cover of a template, and 1 where a phrase stands.
    """
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"), F.col("text").cast("string").alias("text"))
    found = rows.mapInArrow(_scan((phrases, templates, least_match, least_cover)), f"doc {rows.schema['doc'].dataType.simpleString()}, {OUT}")
    names = F.array(*[F.lit(y) for _, y in phrases])
    base = F.array_sort(F.array_distinct(F.transform("places", lambda p: F.get(names, p.phrase))))
    own = F.transform(F.filter("spans", lambda s: s.cover >= least_cover), lambda s: s.label)
    score = F.greatest(F.when(F.size("places") > 0, 1.0).otherwise(0.0), F.coalesce(F.array_max(F.transform("spans", lambda s: s.cover)), F.lit(0.0)))
    return found.withColumns({"base_labels": base, "labels": F.array_sort(F.array_distinct(F.concat(base, own))), "score": score})


def op6_license_scan(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    word = F.transform("places", lambda p: p.word)
    return scan_licenses(docs).select(
        "doc.doc_id", "n_words", F.size("places").cast("long").alias("n_base"), F.array_min(word).alias("first_word"), F.array_max(word).alias("last_word"),
        F.array_join("base_labels", ",").alias("base_labels"), F.array_join("labels", ",").alias("labels"), "score",
    )
