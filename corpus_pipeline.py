"""The corpus pipeline: language, quality, near-duplicates, repeated passages, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes every result as Parquet and reads it again as the
next stage's documents. All but the last return the columns of ``documents``. Texts may be NULL, empty or repeated; a
NULL text has no language, so it leaves in the first stage. Tables without rows pass through. Input columns beyond those of
``documents`` pass through too.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sunledger.llm import langid, minhash, packing, quality, repeats
from sunledger.llm.common import fresh
from sunledger.session import materialize

LEAST_ADVANTAGE = 0.05  # of the way from an even share for each language to certainty; short clean documents stay, unknown scripts go
LEAST_QUALITY_SCORE = 0.5
REPEATED_BYTES = 200  # below the length of any passage of more than 50 words (51 short words of the given tables have about 300 bytes)


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose text has a letter and for one language more evidence than an even share of all."""
    model = langid.train(docs, ~langid.held_out(F.col("doc_id")))
    label, score = fresh(docs.columns, "__language"), fresh(docs.columns, "__score")
    scored = langid.predict(docs, model, label=label, score=score)
    even = 1 / max(1, len(model.languages))
    return scored.where((F.col(label) != langid.UNKNOWN) & (F.col(score) >= even + LEAST_ADVANTAGE * (1 - even))).select(*docs.columns)


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier holds for label 1."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = quality.train(docs, labels, ~quality.held_out(F.col("doc_id")))
    name = fresh(docs.columns, "__quality")
    return quality.score(docs, model, name=name).where(F.col(name) >= LEAST_QUALITY_SCORE).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class: the one that is read first."""
    # Written with its numbers, as another job may read the documents in other splits.
    row = fresh(docs.columns, "__row")
    numbered = materialize(docs.withColumn(row, F.monotonically_increasing_id()), "numbered")
    found = minhash.classes(numbered.select(F.col(row).alias("id"), "text"), threshold=0.8)
    gone = materialize(found.where("class_id <> id").select(F.col("id").alias(row)), "near-duplicates")
    return numbered.join(gone, row, "left_anti").select(*docs.columns)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the byte strings of ``REPEATED_BYTES`` and more that stand anywhere else too; half characters at a cut go as well.

    Columns of ``docs`` whose names ``remove_repeats`` gives to its own results step aside while it runs.
    """
    aside = {c: fresh(docs.columns, f"{c}_aside") for c in docs.columns if c.lower() in ("__n_bytes", "__n_removed", "__n_spans", "__text")}
    cut = repeats.remove_repeats(docs.withColumnsRenamed(aside), size=REPEATED_BYTES, as_text=True)
    changed = F.col("__n_removed") > 0
    out = cut.withColumn("text", F.when(changed, F.col("__text")).otherwise(F.col("text")))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(changed, F.length("text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars")))
    return out.select(*[F.col(aside.get(c, c)).alias(c) for c in docs.columns])


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of at most 1,024 ids, with the ids."""
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"), capacity=1024, end_id=0)


STAGES = [
    ("language", language),
    ("quality", good_quality),
    ("near_duplicates", near_duplicates),
    ("repeated_passages", repeated_passages),
    ("packing", packed),
]

ORACLE_SQL = None  # trained models and tokenizers cannot be stated in SQL; tests compare the stages with brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
