"""A training corpus from raw documents, in five stages of one operator each.

Each stage reads all its predecessor kept, and its decisions take effect:
documents that the classifier or the rules reject go, one document of each
group of near copies stays (the one with the smallest doc_id), words that an
earlier document has already go, and the rest is packed into sequences. All
but the last return the columns of ``documents``.

Rows without a doc_id are judged like others but link with nothing and lose no
words. Of repeated rows of one doc_id and text the near-copy stage keeps one;
different texts under one doc_id are different documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from candlewick.llm import jaccard, packing, quality, rules, suffix_tree
from candlewick.llm.text import small_batches, staged

#: Near copies are of this similarity or more, over shingles of so many words. (op5 has values of its own.)
SHINGLE = 5
PERCENT = 80


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop what the classifier scores below its threshold."""
    small_batches(spark)
    model = quality.quality_model(spark, spark.read.parquet(f"{sf_dir}/documents.parquet"), sf_dir)
    return quality.score(docs, model).where(F.col("score") >= quality.THRESHOLD).select("doc.*")


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop what fails a rule."""
    small_batches(spark)
    return rules.quality_rules(docs).where("kept").select("doc.*")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the document with the smallest doc_id of each group; different texts of one doc_id are documents of their own."""
    small_batches(spark)
    key = F.when(F.col("doc_id").isNotNull(), F.xxhash64("doc_id", F.col("text").cast("string")))
    keyed = docs.select(F.struct(*docs.columns).alias("doc"), "doc_id", "text", key.alias("key"))
    found = jaccard.similar_classes(keyed.select(F.col("key").alias("doc_id"), "text"), n=SHINGLE, percent=PERCENT)
    found = found.select(F.col("doc_id").alias("key"), "component_id").where("key IS NOT NULL")
    ids = keyed.where("key IS NOT NULL").groupBy("key").agg(F.min("doc_id").alias("doc_id"))
    classes = staged(found.groupBy("key").agg(F.min("component_id").alias("class"), F.count("*").alias("n")).join(ids, "key"), "classes")
    first = classes.groupBy("class").agg(F.min(F.struct("doc_id", "key"))["key"].alias("first")).select("first")
    marks = classes.join(first, classes["key"] == first["first"], "left").select(F.col("key").alias("marked"), F.col("first").isNull().alias("copy"), "n")
    rows = keyed.join(staged(marks.where("copy OR n > 1"), "marks"), F.col("key") == F.col("marked"), "left")
    alone = rows.where("marked IS NULL").select("doc.*")
    again = rows.where("NOT copy").dropDuplicates(["doc_id", "key"]).select("doc.*")
    return alone.unionByName(again)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Remove passages that an earlier document has; other texts stay as they are."""
    small_batches(spark)
    found = suffix_tree.substring_dedup(docs)
    text = F.when(F.size("spans") > 0, F.col("kept_text")).otherwise(F.col("doc.text"))
    new = {"text": text, "n_chars": F.when(F.size("spans") > 0, F.length("kept_text").cast("long")).otherwise(F.col("doc.n_chars"))}
    return found.select(*[new.get(c, F.col("doc").getField(c)).alias(c) for c in docs.columns])


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of token sequences with their tokens: ``ids`` as little-endian unsigned 32-bit bytes."""
    small_batches(spark)
    import public_tokenizers

    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("quality_classifier", quality_classifier),
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("substring_dedup", substring_dedup),
    ("packing", pack),
]

#: SQL has neither the classifier nor the tokenizer.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply every stage to the documents of a folder; each result is stored and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), name)
    return docs
