"""How far the sources of a language differ in their words, and by which words.

A text is turned into terms by one ``bytes.translate`` (capital letters become
small, everything but letters and bytes beyond ASCII becomes a blank) and
``bytes.split``; a ``Counter`` of each document gives frequencies, and the sum of
its keys the number of documents. Tasks add up documents of one language and
source and hand over sparse rows (term, occurrences, documents), which Spark
sums. Nothing is dense: terms that a source does not have are never rows.

With ``p = 1 + floor(SCALE * (count + 1) / (N + V))`` of two groups and
``f = floor((p - q)^2 / q)``, the sum over all kept terms of a pair of sources is
taken from what occurs. Let p0 and q0 be the values of terms that occur nowhere
in a group: terms of the first group add ``f(p, q0)``, terms of the second
``f(p0, q)``, terms of both ``f(p, q) - f(p, q0) - f(p0, q)``, and all others
``f(p0, q0)`` each. Terms of one group alone come down to how many terms it has
of each count, so only terms of both are compared, and those sums combine on the
map side. Numbers stay whole: counts and their multiples are decimals until they
are divided, and ``f`` of values up to SCALE + 1 fits 64 bits.

Defined results: null text, lang and source are empty strings; an empty text has
no terms, but its group occurs; texts of any length count whole; repeated rows
are documents each; ties of values are in order of the item's bytes; an empty
table gives no rows; a language without kept terms has pairs of value 0; further
columns, whatever their names, are not read.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from candlewick.llm import text as T

SCALE = 1_000_000_000
MIN_DOCUMENTS = 3
TOP_TERMS = 200
#: Terms a task holds before it hands them over.
HELD = 400_000

_KEPT = [*range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]
TRANSLATE = bytes(b | 0x20 if b in range(0x41, 0x5B) else b if b in _KEPT else 0x20 for b in range(256))

COUNTS = "lang string, source string, term binary, n long, docs long"


def terms(value: bytes) -> Counter:
    """Occurrences of each term of a text."""
    return Counter(value.translate(TRANSLATE).split())


def _rows(groups: dict[tuple[str, str], tuple[Counter, Counter]]) -> Iterator[pa.RecordBatch]:
    for (lang, source), (n, docs) in groups.items():
        words = [b"", *n]  # the empty term stands for the group itself
        many = [0, *n.values()]
        of = [0, *map(docs.__getitem__, n)]
        fields = [pa.array([lang] * len(words), pa.string()), pa.array([source] * len(words), pa.string()), pa.array(words, pa.binary()), pa.array(many, pa.int64()), pa.array(of, pa.int64())]
        yield pa.RecordBatch.from_arrays(fields, names=["lang", "source", "term", "n", "docs"])


def _count(held: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        groups: dict[tuple[str, str], tuple[Counter, Counter]] = {}
        size = 0
        for batch in batches:
            for lang, source, value in zip(batch.column("lang").to_pylist(), batch.column("source").to_pylist(), batch.column("text")):
                n, docs = groups.setdefault((lang, source), (Counter(), Counter()))
                found = terms(value.as_buffer().to_pybytes())
                size -= len(n)
                n.update(found)
                docs.update(found.keys())
                size += len(n)
                if size >= held:
                    yield from _rows(groups)
                    groups, size = {}, 0
        yield from _rows(groups)

    return run


def counts(docs: DataFrame, held: int = HELD) -> DataFrame:
    """Occurrences and documents of each (lang, source, term); the empty term names groups that occur."""

    def named(c: str) -> Column:
        return F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c)

    rows = docs.select(named("lang"), named("source"), F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary").alias("text"))
    parts = rows.mapInArrow(_count(held), COUNTS)
    # placed by term, so that the sums of a term over its sources need no further shuffle
    placed = parts.repartition("lang", "term")
    return placed.groupBy("lang", "term", "source").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def _p(count: Column, total: Column, kept: Column) -> Column:
    """1 + floor(SCALE * (count + 1) / (total + kept)), exactly."""
    return F.lit(1) + F.call_function("div", (count + F.lit(1)).cast("decimal(20,0)") * F.lit(SCALE).cast("decimal(11,0)"), (total + kept).cast("decimal(20,0)"))


def _f(p: Column, q: Column) -> Column:
    return F.call_function("div", (p - q) * (p - q), q)


def divergence(docs: DataFrame, least: int = MIN_DOCUMENTS, top: int = TOP_TERMS) -> DataFrame:
    """lang, source, part, item, value, rank: other sources by distance, and terms that mark a source."""
    found = counts(docs)
    term = W.partitionBy("lang", "term")
    found = found.withColumns({"lang_n": F.sum("n").over(term), "lang_docs": F.sum("docs").over(term), "nth": F.row_number().over(term.orderBy("source"))})
    found = T.staged(found.where((F.col("lang_docs") >= least) | (F.col("term") == F.lit(b""))).drop("lang_docs", "docs"), "terms")

    named = F.col("term") != F.lit(b"")
    groups = found.groupBy("lang", "source").agg(F.sum("n").alias("total"), F.sum(named.cast("long")).alias("own"))
    langs = found.groupBy("lang").agg(F.sum(F.when(F.col("nth") == 1, F.col("lang_n")).otherwise(0)).alias("lang_total"), F.sum((named & (F.col("nth") == 1)).cast("long")).alias("kept"))
    groups = groups.join(langs, "lang")
    groups = groups.withColumn("zero", F.when(F.col("kept") > 0, _p(F.lit(0).cast("long"), F.col("total"), F.col("kept"))))
    groups = T.staged(groups, "groups")
    sizes = groups.select("lang", "source", "total", "kept", "lang_total", "zero")
    valued = found.where(named).join(sizes, ["lang", "source"]).select(
        "lang", "source", "term", "n", _p(F.col("n"), F.col("total"), F.col("kept")).alias("p"), "zero", _p(F.col("lang_n"), F.col("lang_total"), F.col("kept")).alias("q")
    )
    valued = T.staged(valued, "values")

    marks = valued.where("p > q").select("lang", "source", F.lit("term").alias("part"), F.col("term").cast("string").alias("item"), _f(F.col("p"), F.col("q")).alias("value"))
    order = [F.col("value").desc(), F.col("item").asc()]
    by_group = W.partitionBy("lang", "source").orderBy(*order)
    # every slice of a group keeps its best, so that no task ranks all terms of a large source
    sliced = marks.withColumn("slice", F.pmod(F.xxhash64("item"), F.lit(64)))
    best = sliced.withColumn("rank", F.row_number().over(W.partitionBy("lang", "source", "slice").orderBy(*order))).where(F.col("rank") <= top).drop("slice")
    marks = best.withColumn("rank", F.row_number().over(by_group)).where(F.col("rank") <= top)

    ranked = _pairs(groups, valued).withColumn("rank", F.row_number().over(by_group))
    return ranked.unionByName(marks)


def _pairs(groups: DataFrame, valued: DataFrame) -> DataFrame:
    """Sum of f over all kept terms, of each source against every other one of its language."""
    one = groups.select("lang", F.col("source").alias("a"), F.col("own").alias("own_a"), F.col("zero").alias("zero_a"), "kept")
    other = groups.select("lang", F.col("source").alias("b"), F.col("own").alias("own_b"), F.col("zero").alias("zero_b"))
    pairs = one.join(other, "lang").where("a <> b")
    # terms of one group, by value: f against what the other group has of terms it lacks
    values = valued.groupBy("lang", "source", "p").agg(F.count("*").alias("many"))
    mine = values.join(other, "lang").where("source <> b").groupBy("lang", F.col("source").alias("a"), "b").agg(F.sum(F.col("many") * _f(F.col("p"), F.col("zero_b"))).alias("only_a"))
    theirs = values.join(one, "lang").where("source <> a").groupBy("lang", "a", F.col("source").alias("b")).agg(F.sum(F.col("many") * _f(F.col("zero_a"), F.col("p"))).alias("only_b"))
    x = valued.select("lang", "term", F.col("source").alias("a"), F.col("p").alias("pa"), F.col("zero").alias("za"))
    y = valued.select("lang", "term", F.col("source").alias("b"), F.col("p").alias("pb"), F.col("zero").alias("zb"))
    shared = x.join(y, ["lang", "term"]).where("a <> b").groupBy("lang", "a", "b").agg(
        F.count("*").alias("both"), F.sum(_f(F.col("pa"), F.col("pb"))).alias("f_both"), F.sum(_f(F.col("pa"), F.col("zb"))).alias("f_a"), F.sum(_f(F.col("za"), F.col("pb"))).alias("f_b")
    )
    on = ["lang", "a", "b"]
    every = pairs.join(mine, on, "left").join(theirs, on, "left").join(shared, on, "left")

    def exact(c: str) -> Column:
        return F.coalesce(F.col(c), F.lit(0)).cast("decimal(38,0)")

    absent = F.col("kept") - F.col("own_a") - F.col("own_b") + F.coalesce(F.col("both"), F.lit(0))
    zeros = F.when(F.col("kept") > 0, absent * _f(F.col("zero_a"), F.col("zero_b"))).otherwise(0)
    value = exact("only_a") + exact("only_b") + exact("f_both") - exact("f_a") - exact("f_b") + zeros.cast("decimal(20,0)")
    return every.select("lang", F.col("a").alias("source"), F.lit("pair").alias("part"), F.col("b").alias("item"), value.cast("long").alias("value"))


def op12_source_divergence(spark, sf_dir: str) -> DataFrame:
    return divergence(spark.read.parquet(f"{sf_dir}/documents.parquet").select("lang", "source", "text"))


OP12_SQL = r"""
WITH d AS (SELECT coalesce(lang, '') AS lang, coalesce(source, '') AS source, coalesce(text, '') AS text, row_number() OVER () AS r FROM documents),
occ AS (
  SELECT lang, source, r, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM d
), kept AS (SELECT lang, term, count(*) AS n FROM occ GROUP BY lang, term HAVING count(DISTINCT r) >= 3),
grp AS (SELECT DISTINCT lang, source FROM d),
c AS (SELECT lang, source, term, count(*) AS n FROM occ JOIN kept USING (lang, term) GROUP BY lang, source, term),
dense AS (
  SELECT grp.lang, grp.source, kept.term, coalesce(c.n, 0) AS n FROM grp JOIN kept ON kept.lang = grp.lang
  LEFT JOIN c ON c.lang = grp.lang AND c.source = grp.source AND c.term = kept.term
), sized AS (SELECT *, sum(n) OVER (PARTITION BY lang, source) AS total, count(*) OVER (PARTITION BY lang, source) AS v FROM dense),
p AS (SELECT lang, source, term, n, CAST(1 + 1000000000::HUGEINT * (n + 1) // (total + v) AS BIGINT) AS p FROM sized),
q AS (SELECT lang, term, CAST(1 + 1000000000::HUGEINT * (n + 1) // (sum(n) OVER (PARTITION BY lang) + count(*) OVER (PARTITION BY lang)) AS BIGINT) AS q FROM kept),
pair AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item,
    CAST(coalesce((SELECT sum((x.p - y.p) * (x.p - y.p) // y.p) FROM p x JOIN p y ON x.lang = y.lang AND x.term = y.term
      WHERE x.lang = a.lang AND x.source = a.source AND y.source = b.source), 0) AS BIGINT) AS value
  FROM grp a JOIN grp b ON a.lang = b.lang AND a.source <> b.source
), term AS (
  SELECT p.lang, p.source, 'term' AS part, p.term AS item, (p - q) * (p - q) // q AS value FROM p JOIN q ON p.lang = q.lang AND p.term = q.term WHERE n > 0 AND p > q
), ranked AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank
  FROM (SELECT * FROM pair UNION ALL SELECT * FROM term)
)
SELECT lang, source, part, item, value, rank FROM ranked WHERE part = 'pair' OR rank <= 200
"""
