"""A training corpus from documents: five stages, each over all that the one before kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from annoforge.llm import byte_bpe, line_dedup, mixing, near_dup, toxicity
from annoforge.llm.shared import BATCH_SETTING, cut, forget, named, scope, table
from annoforge.llm.vocabularies import vocabulary

#: Text bytes of an Arrow batch: less than an operator by itself takes, as workers of several stages live side by side.
BATCH_BYTES = 1 << 20


def small_batches(spark: SparkSession) -> None:
    spark.conf.set(BATCH_SETTING, str(BATCH_BYTES))


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity scores below the production threshold."""
    small_batches(spark)
    return toxicity.reject_toxic(docs, table(spark, sf_dir, "labels").where(~toxicity.held_out()))


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that occur earlier; n_chars follows. Emptied documents go."""
    small_batches(spark)
    out = line_dedup.dedup_lines(docs)
    return out.withColumn("n_chars", F.when(F.col("text").isNotNull(), F.length("text").cast("long")))


def near_dup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, that of the least id."""
    small_batches(spark)
    return near_dup.keep_one(docs)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the budgets of their sources take them."""
    small_batches(spark)
    return mixing.mix(docs).select(*map(named, docs.columns))


def encoding_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every text, checked by decoding them."""
    small_batches(spark)
    rows = byte_bpe.encode_documents(docs, vocabulary("byte_bpe_multi_50k.tiktoken"))
    return rows.select("doc_id", "n_tokens", "ids", F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [
    ("toxicity", toxicity_stage),
    ("line dedup", line_stage),
    ("near duplicates", near_dup_stage),
    ("mixing", mixing_stage),
    ("byte-level BPE", encoding_stage),
]

#: SQL can express neither the learned stage nor the vocabulary's merges. tests/llm/test_tables.py holds every stage
#: against a brute-force version over the smallest tables.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each stage's rows are written and read again before the next.

    What a stage has written for itself goes with it, its rows once the next stage has written its own; the
    last stage's input stays until the driver ends."""
    docs, before = table(spark, sf_dir, "documents"), None
    with scope() as all_:
        for name, stage in STAGES[:-1]:
            with scope() as own:
                docs = own.keep(cut(stage(spark, docs, sf_dir), f"stage-{name.replace(' ', '-')}"))
            if before is not None:
                forget(before)
            before = docs
        all_.keep(docs)
    return STAGES[-1][1](spark, docs, sf_dir)
