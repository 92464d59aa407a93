"""From raw documents to token ids: five stages, each over all rows that the one before it kept, written as Parquet in between."""

from __future__ import annotations

from uuid import uuid4

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from corpusmill.llm import bpe, exact_dedup, mixing, neardup, toxicity
from corpusmill.llm.common import checkpoint_dir, remove

#: The columns that all stages but the last return.
COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that the toxicity model rejects; it is fitted on the labels of ``docs`` that are not held out.

    Null, empty and blank texts are clean; every row is judged by its own whole text, so repeated rows go together and rows
    without an id are judged as others; without labels nothing is dropped; an empty table stays empty. As in all stages, columns
    that ``documents`` does not have are left out, whatever their names.
    """
    return toxicity.keep_clean(docs.select(*COLUMNS), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one row of each group of texts that are equal but for blanks: the longest, then the least id (null last).

    Null, empty and blank texts are one group; rows that repeat id and text are copies as any other; an empty table stays empty.
    """
    return exact_dedup.keep_first(docs.select(*COLUMNS))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one row of each group of near copies (five-word shingles, similarity 0.85): that of the least id (null last).

    Texts without words stand alone and stay, with or without an id; an empty table stays empty.
    """
    return neardup.keep_one(docs.select(*COLUMNS))


def mix_to_targets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Samples documents so that the expected tokens have the target shares of sources, languages and topics.

    Null source or language is a value of its own (``unknown``), texts without words belong to the topic ``none``; rows that
    repeat id and text go together; an empty table stays empty.
    """
    return mixing.keep_sampled(docs.select(*COLUMNS))


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every whole text, decoded again to check them; null counts as empty, and an empty text has no ids. One row
    per row, repeated ones too; an empty table stays empty."""
    return bpe.tokenized(docs, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)


STAGES = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_copies),
    ("minhash_neardup", drop_near_copies),
    ("mixing", mix_to_targets),
    ("byte_bpe", tokenize),
]

#: The first stage is a trained model and the fourth a fixpoint: SQL can't express them. tests/llm compares run() stage by stage.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``. What a stage keeps is written to the shared checkpoint folder and read again by the next;
    it is deleted once that has written its own."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    base = f"{checkpoint_dir(spark)}/corpus-pipeline-{uuid4().hex}"
    for k, (name, stage) in enumerate(STAGES):
        out = stage(spark, docs, sf_dir)
        if k == len(STAGES) - 1:
            return out
        out.write.parquet(f"{base}/{k}-{name}")
        docs = spark.read.parquet(f"{base}/{k}-{name}")
        if k:
            remove(spark, f"{base}/{k - 1}-{STAGES[k - 1][0]}")
    raise ValueError("STAGES is empty")
