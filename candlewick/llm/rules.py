"""Quality rules with adaptive thresholds.

Each statistic of a document is counted in logarithmic buckets: a quantile
sketch with a relative error of one per cent, whose merge is the addition of
counts, so any partitioning gives the same result. Sketches are kept per
language and source, and merged into one per language and one of everything
for groups with too few documents. A statistic's limits are its quartiles
moved out by a multiple of their distance, and by a least slack, so a group
without spread does not reject what hardly differs. The limits are joined to
the documents by language and source (null being a value of its own).

Next to them stand fixed rules that hold everywhere: a least number of words,
and a greatest share of words in repeated windows.

Defined results: a null or empty text has no words and fails; a null doc_id is
kept as such; repeated rows are judged each; further columns pass through.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from candlewick.llm import text as T

WINDOW = 5
MIN_WORDS = 10
REPEATED_PERCENT = 20
#: Growth of the sketch's buckets; documents a group needs for limits of its own; how far limits lie outside the quartiles.
GROWTH = 1.02
GROUP_ROWS = 200
SPREADS = 4.0
#: Statistic: the least distance of its lower and its upper limit from the quartile (None: no such limit).
RULES: dict[str, tuple[float | None, float | None]] = {
    "symbol_share": (None, 0.06),
    "word_length": (3.0, 6.0),
    "dup_line_share": (None, 0.5),
}
SYMBOLS = T._table(b"#*$%&|<>")
MEASURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines"]


def _measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i, j, data, offs in T.pieces(*T.utf8(batch.column("text"))):
            starts, ends, ranges = T.words(data, offs)
            hashes = T.word_hashes(data, starts, ends)
            lines, dup = T.repeated_lines(data, offs, starts)
            found = {
                "n_words": np.diff(ranges),
                "word_chars": T.totals(T.PLAIN[data] & ((data & 0xC0) != 0x80), offs),
                "n_symbols": T.totals(SYMBOLS[data], offs),
                "n_dup_lines": dup,
                "n_repeat_words": T.totals(T.repeated_words(hashes, ranges, WINDOW), ranges),
                "n_lines": lines,
            }
            yield pa.RecordBatch.from_arrays([batch.column("doc").slice(i, j - i), *[pa.array(found[m].astype(np.int64)) for m in MEASURES]], names=["doc", *MEASURES])


def measured(docs: DataFrame, carry: list[str] | None = None) -> DataFrame:
    """Counts of every whole text, and of the row the columns ``carry`` (all, if not given) as struct ``doc``."""
    kept = F.struct(*[F.col(f"`{c}`") for c in carry or docs.columns])
    rows = docs.select(kept.alias("doc"), F.col("text").cast("string").alias("text"))
    kind = rows.schema["doc"].dataType.simpleString()
    return rows.mapInArrow(_measure, f"doc {kind}, " + ", ".join(f"{m} long" for m in MEASURES))


def statistics() -> dict[str, F.Column]:
    ratio = lambda a, b: F.when(F.col(b) > 0, F.col(a) / F.col(b)).otherwise(F.lit(0.0))
    return {"symbol_share": ratio("n_symbols", "word_chars"), "word_length": ratio("word_chars", "n_words"), "dup_line_share": ratio("n_dup_lines", "n_lines")}


def limits(rows: DataFrame, spreads: float = SPREADS, group_rows: int = GROUP_ROWS, growth: float = GROWTH) -> DataFrame:
    """Per language and source a low and a high limit for each statistic, from merged sketches."""
    stats = statistics()
    bucket = lambda v: F.when(v <= 0, F.lit(None)).otherwise(F.ceil(F.log(v) / math.log(growth))).cast("int")
    long = rows.select(
        F.col("doc.lang").alias("lang"), F.col("doc.source").alias("source"),
        F.explode(F.array(*[F.struct(F.lit(s).alias("stat"), bucket(v).alias("bucket")) for s, v in stats.items()])).alias("x"),
    ).select("lang", "source", "x.stat", "x.bucket")
    fine = T.staged(long.groupBy("lang", "source", "stat", "bucket").agg(F.count("*").alias("n")), "sketches")

    def quartiles(by: list[str]) -> DataFrame:
        merged = fine.groupBy(*by, "stat", "bucket").agg(F.sum("n").alias("n"))
        whole = Window.partitionBy(*by, "stat")
        merged = merged.withColumn("total", F.sum("n").over(whole))
        merged = merged.withColumn("upto", F.sum("n").over(whole.orderBy(F.col("bucket").asc_nulls_first())))
        middle = F.when(F.col("bucket").isNull(), 0.0).otherwise(F.pow(F.lit(growth), F.col("bucket") - 0.5))
        at = lambda q: F.min(F.when(F.col("upto") >= F.col("total") * q, middle))
        return merged.groupBy(*by, "stat").agg(F.max("total").alias("rows"), at(0.25).alias("q1"), at(0.75).alias("q3"))

    one, two, three = (
        quartiles(by).select(*by, "stat", F.struct("rows", "q1", "q3").alias(f"g{len(by)}")) for by in (["lang", "source"], ["lang"], [])
    )
    same = F.col("a.stat") == F.col("b.stat")
    every = one.alias("a").join(two.alias("b"), same & F.col("a.lang").eqNullSafe(F.col("b.lang"))).select("a.*", "b.g1")
    every = every.join(three, "stat")
    enough = lambda g: F.when(F.col(f"{g}.rows") >= group_rows, F.col(g))
    every = every.withColumn("g", F.coalesce(enough("g2"), enough("g1"), F.col("g0")))
    out = every.groupBy("lang", "source")
    sides = []
    for s, (below, above) in RULES.items():
        pick = lambda c, s=s: F.max(F.when(F.col("stat") == s, F.col(f"g.{c}")))
        spread = (pick("q3") - pick("q1")) * spreads
        if below is not None:
            sides.append((pick("q1") - F.greatest(spread, F.lit(below))).alias(f"{s}_low"))
        if above is not None:
            sides.append((pick("q3") + F.greatest(spread, F.lit(above))).alias(f"{s}_high"))
    return T.staged(out.agg(*sides), "limits")


def judged(rows: DataFrame, bounds: DataFrame) -> DataFrame:
    """Measured rows with base_failed, the failed adaptive rules, and kept."""
    b = bounds.withColumnsRenamed({"lang": "b_lang", "source": "b_source"})
    out = rows.join(b, F.col("doc.lang").eqNullSafe(F.col("b_lang")) & F.col("doc.source").eqNullSafe(F.col("b_source")), "left")
    failed = []
    for s, (below, above) in RULES.items():
        v = statistics()[s]
        if below is not None:
            failed.append(F.when(v < F.col(f"{s}_low"), F.lit(f"{s} low")))
        if above is not None:
            failed.append(F.when(v > F.col(f"{s}_high"), F.lit(f"{s} high")))
    base = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > REPEATED_PERCENT * F.col("n_words"))
    out = out.withColumn("base_failed", base).withColumn("failed", F.array_compact(F.array(*failed)))
    return out.select("doc", *MEASURES, "base_failed", "failed", (~base & (F.size("failed") == 0)).alias("kept"))


def with_groups(docs: DataFrame) -> DataFrame:
    """Documents with a lang and a source column, null where there is none."""
    for c in ("lang", "source"):
        if c not in docs.columns:
            docs = docs.withColumn(c, F.lit(None).cast("string"))
    return docs


def quality_rules(docs: DataFrame) -> DataFrame:
    """Every document (struct ``doc``) with its counts, failed rules and verdict."""
    docs = with_groups(docs)
    return judged(measured(docs), limits(measured(docs, ["lang", "source"])))


def op7_quality_rules(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang", "source")
    rows = T.staged(measured(docs, ["doc_id", "lang", "source"]), "measures")
    out = judged(rows, limits(rows))
    return out.select("doc.doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", F.array_join("failed", ",").alias("failed_rules"))
