"""The corpus pipeline: score, deduplicate, decontaminate, replace, encode."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.llm.common import prepare, stage
from ledgerloom.llm.decontaminate import drop_contaminated
from ledgerloom.llm.quality_cnn import fit, keep_good
from ledgerloom.llm.sentencepiece_codec import encoding_digests
from ledgerloom.llm.superminhash import one_of_each
from ledgerloom.llm.surrogates import replace_personal_data


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the byte-level network scores 0.3 or more."""
    prepare(spark)
    return keep_good(docs, fit(docs, _table(spark, sf_dir, "labels")))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every group of near duplicates (five-word shingles,
    similarity 0.8 or more)."""
    prepare(spark)
    return one_of_each(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark item."""
    prepare(spark)
    return drop_contaminated(docs, _table(spark, sf_dir, "benchmark"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with surrogates for personal data; n_chars follows the text."""
    prepare(spark)
    out = replace_personal_data(docs)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.char_length("text").cast("long"))
    return out.select(*docs.columns)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of the ids, the decoded texts and the byte spans."""
    prepare(spark)
    model = public_tokenizers.path("piece_bpe_32k.model")
    return encoding_digests(docs, model)


STAGES = [("quality", quality), ("near_dedup", near_dedup), ("decontaminate", decontaminate),
          ("personal_data", personal_data), ("encode", encode)]

#: The scores, verified similarities and token ids have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply every stage to ``documents``; each result is written as Parquet
    and read again as the next stage's documents."""
    prepare(spark)
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for i, (name, step) in enumerate(STAGES):
        docs = step(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = stage(docs, f"pipeline-{name}")
    return docs
