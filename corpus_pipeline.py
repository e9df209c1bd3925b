"""The corpus pipeline: each stage applies one operator to all documents that the stage before it kept.

Toxic documents go, one document of each group of near duplicates stays, documents that leak benchmark items
go, personal data is masked, and what is left is packed into windows of 2048 tokens. The stages keep the
columns of ``documents``; the last returns one row per packed piece with its token ids. Null and empty texts
pass every filter and pack to the end id; empty tables give empty results.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sourcelens.llm import decontam, near_dup, packing, pii, toxicity
from sourcelens.llm.common import prepare, scratch, table
from sourcelens.session import release_tables, written_tables

#: Near duplicates: words of a shingle, and similarity in percent.
SHINGLE, SIMILAR = 5, 80
TOKENIZER, CUT, END_ID, WINDOW = "word_bpe_49k.json", "word", 1, 2048


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the subsequence-kernel machine scores below 0.5."""
    prepare(spark)
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return toxicity.score(docs, model, "__toxic").where(F.col("__toxic") < 0.5).drop("__toxic")


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, the one of least doc_id."""
    prepare(spark)
    return near_dup.keep_one(docs, SHINGLE, SIMILAR)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    prepare(spark)
    return decontam.clean(docs, table(spark, sf_dir, "benchmark"))


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data replaced by its kind; ``n_chars`` follows the text."""
    prepare(spark)
    found = scratch(pii.candidates(docs, out="__pii_spans"), "pipeline-pii")  # texts are searched once
    masked = pii.mask(found, pii.fit(found, "__pii_spans"), found="__pii_spans")
    if "n_chars" in masked.columns:
        kind = dict(masked.dtypes)["n_chars"]
        masked = masked.withColumn("n_chars", F.coalesce(F.length("text").cast(kind), F.col("n_chars")))
    return masked


def pack_windows(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents with their ids and their places in windows."""
    prepare(spark)
    return packing.pack(docs, TOKENIZER, CUT, END_ID, WINDOW)


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_copies),
    ("decontamination", drop_leaks),
    ("personal_data", mask_personal_data),
    ("packing", pack_windows),
]

#: No stage but the second can be said in SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``; each result is written as Parquet and read again by the next.

    What a stage wrote on its way, and the result before it, are deleted once its own result is written.
    """
    prepare(spark)
    docs, mark = table(spark, sf_dir, "documents"), written_tables(spark)
    for name, stage in STAGES:
        docs = scratch(stage(spark, docs, sf_dir), f"pipeline-{name}")
        release_tables(spark, since=mark, but_last=1)
    return docs
