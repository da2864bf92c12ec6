"""A corpus pipeline in five stages: each one's rows are written and read again by the next.

Every stage works on all rows its predecessor kept. Stages that drop documents keep the rows
of all others as they are; rows without a doc_id cannot be named in a decision and stay.

Defined cases, in every stage: decisions hold for a doc_id together with its text, so rows that
repeat an id with another text are documents of their own; a null or empty text is neither
toxic, nor a near copy, nor contaminated, holds no personal data and is packed as a piece of 0
words; texts are taken whole, however long; columns beyond those of documents stay as they
are, whatever their names; an empty table stays empty.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from traceframe.llm import decontaminate, neardup, packing, pii, toxicity
from traceframe.llm.common import Scratch, fresh, split_mod, table

SENT_IDS = 1_000_000  # names sent to all executors (16 MB); more are joined by a shuffle


def _digest() -> Column:
    """Names a row's text beside its doc_id: rows that agree in both are copies."""
    return F.xxhash64("doc_id", "text")


def _without(docs: DataFrame, gone: DataFrame) -> DataFrame:
    """Documents whose (doc_id, digest) is not in ``gone``. Few names are sent, so that texts need not move."""
    own = fresh("__digest", docs)
    stored = Scratch(docs.sparkSession, "pipeline").save(gone.where("doc_id is not null").select("doc_id", F.col("digest").alias(own)).distinct(), "names")
    marked = docs.withColumn(own, _digest())
    return marked.join(F.broadcast(stored) if stored.count() <= SENT_IDS else stored, ["doc_id", own], "left_anti").select(docs.columns)


def toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents whose worst window is toxic; learns from labelled rows outside the held-out third."""
    held = F.coalesce(split_mod("doc_id", 3) == 1, F.lit(False))
    model = toxicity.fit(docs.where(~held).select("doc_id", "text"), table(spark, sf_dir, "labels"))
    return toxicity.toxicity(docs, model).where(~F.col("is_toxic")).select(docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document with the smallest id of every group linked by 5-word shingles at 0.8.

    Rows that share an id but not the text are documents of their own: one keeps the id in the
    search, the others get unused ones behind all ids. Rows that agree in both are copies.
    """
    scratch = Scratch(spark, "pipeline")
    search = lambda rows: neardup.near_duplicates(rows, words=5, percent=80).where(~F.col("kept")).select("doc_id")
    repeated = scratch.save(docs.where("doc_id is not null").groupBy("doc_id").agg(F.count("*").alias("n")).where("n > 1").select("doc_id"), "repeated")
    if repeated.limit(1).count() == 0:
        gone = scratch.save(search(docs.select("doc_id", "text")), "gone")
        return docs.join(F.broadcast(gone) if gone.count() <= SENT_IDS else gone, "doc_id", "left_anti").select(docs.columns)
    own = fresh("__key", docs)
    texts = docs.join(repeated, "doc_id", "left_semi").select("doc_id", _digest().alias("digest")).distinct()
    first = scratch.save(texts.groupBy("doc_id").agg(F.min("digest").alias("digest")), "first")
    behind = docs.agg(F.coalesce(F.max("doc_id"), F.lit(0)) + 1).first()[0]
    # Stored, so that a repeated task finds the same keys.
    others = texts.join(first, ["doc_id", "digest"], "left_anti").withColumn("key", F.monotonically_increasing_id() + F.lit(behind))
    keys = scratch.save(others.unionByName(first.withColumn("key", F.col("doc_id").cast("long"))), "keys").select("doc_id", F.col("digest").alias(f"{own}_digest"), F.col("key").alias(own))
    keyed = docs.withColumn(f"{own}_digest", _digest()).join(keys, ["doc_id", f"{own}_digest"], "left")
    # Rows without an id have no key either and stay; of copies under one key one stays.
    keyed = keyed.withColumn(own, F.coalesce(own, F.col("doc_id").cast("long")))
    one = keyed.where(F.col(own).isNotNull()).dropDuplicates([own])
    kept = scratch.save(one.unionByName(keyed.where(F.col(own).isNull())).select(*docs.columns, own), "keyed")
    gone = scratch.save(search(kept.select(F.col(own).alias("doc_id"), "text")), "gone").withColumnRenamed("doc_id", own)
    return kept.join(F.broadcast(gone) if gone.count() <= SENT_IDS else gone, own, "left_anti").select(docs.columns)


def benchmark_items(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents in which a window of a benchmark item occurs."""
    found = decontaminate.contamination(docs, table(spark, sf_dir, "benchmark"))
    return _without(docs, found.where("contaminated").select("doc_id", "digest"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Puts the kind in place of every span of personal data; n_chars follows the text."""
    found = pii.find(docs)
    masked = found.withColumn("text", pii.mask(F.col("text"), F.col("pii")))
    if "n_chars" in docs.columns:
        changed = F.size("pii") > 0
        masked = masked.withColumn("n_chars", F.when(changed, F.length("text").cast("long")).otherwise(F.col("n_chars")))
    return masked.select(docs.columns)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Training sequences of what is left: doc_id, piece and place of every piece."""
    return packing.pack(docs)


STAGES = [
    ("toxicity", toxic),
    ("near_duplicates", near_duplicates),
    ("decontamination", benchmark_items),
    ("personal_data", personal_data),
    ("packing", packed),
]

#: A trained classifier and a sequential packing are beyond SQL; see tests/llm/test_pipeline.py.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    scratch = Scratch(spark, "pipeline")
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = scratch.save(stage(spark, docs, sf_dir), name)
    return docs
