"""The corpus pipeline: documents to token files in five stages, each an operator of packloom.llm.

Each stage works on all that its predecessor kept. A stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as
Parquet and read again as the next one's docs; all but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from packloom.llm import decontam, langid, mixing, neardup, tokens
from packloom.llm._store import cut, freed, remove_dir, scratch
from packloom.llm.entries import tokenizer_path

#: Documents whose best language scores less go. Those of none of the learned languages are und with score 0, see langid; the best of k languages scores 1 / k at least.
MIN_SCORE = 0.2


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without letters, or of none of the learned languages, go."""
    return langid.identified(docs, MIN_SCORE)


def deduplicated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates the document with the smallest doc_id stays."""
    return neardup.without_duplicates(docs)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return decontam.without_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each text becomes what the mix takes of it."""
    return mixing.mixed_documents(docs)


def tokenized(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files of the mix, read back: doc_id, start, n_tokens, ids_crc32."""
    folder = scratch(spark, "tokens")
    out = cut(tokens.token_rows(docs, folder, tokenizer_path()))
    remove_dir(folder)
    return out


STAGES = [
    ("language ID", language),
    ("MinHash near-dedup", deduplicated),
    ("benchmark decontamination", decontaminated),
    ("mixing sources to target weights", mixed),
    ("token-ID / binary output", tokenized),
]

#: SQL can't express string kernels, drawn mixtures or a tokenizer.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages in a row over the documents of ``sf_dir``.

    Null texts, empty ones and such without letters go in the first stage, so that the later ones see none; null doc_ids are carried through and come first in the
    token files; null sources are one source; rows of one doc_id are one document to near-dedup and apart to all other stages; very long texts are worked on whole. Columns beyond those of
    documents pass all stages but the last. Without any document each stage writes an empty table and the result has no rows.
    """
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    previous = None
    for _, stage in STAGES[:-1]:
        folder = scratch(spark, "stage")
        with freed():
            out = stage(spark, docs, sf_dir)
            out.write.parquet(folder)
        docs = spark.read.schema(out.schema).parquet(folder)
        if previous:
            remove_dir(previous)
        previous = folder
    out = STAGES[-1][1](spark, docs, sf_dir)
    if previous:
        remove_dir(previous)  # the last stage has kept its result
    return out
