"""A training-text pipeline: language, near copies, benchmark passages, mix of sources, token files.

Each stage takes the session, the documents its predecessor kept, and the folder of
the tables, and returns a frame that is written and read again before the next one.
All but the last return documents with the columns they came with.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from eventpulse.llm.common import table, written
from eventpulse.llm.decontaminate import without_leaks
from eventpulse.llm.jaccard_join import one_of_each
from eventpulse.llm.language import fit_models, held_out, without_rejected
from eventpulse.llm.mixing import mixed
from eventpulse.llm.token_files import read_documents, write_token_files
from eventpulse.session import lean_workers


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Fits the languages on the documents' own labels and leaves out what is unlike all of them."""
    lean_workers(spark)
    return without_rejected(docs, fit_models(docs.where(~held_out("doc_id"))))


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of near copies."""
    lean_workers(spark)
    return one_of_each(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Leaves out documents that hold a passage of the benchmark."""
    lean_workers(spark)
    return without_leaks(docs, table(spark, sf_dir, "benchmark"), whole_words=True)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Leaves out and repeats documents so that sources come near their targets."""
    return mixed(docs)


def token_files(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Writes the token files and lists their documents."""
    lean_workers(spark)
    return read_documents(write_token_files(docs, public_tokenizers.path("byte_bpe_50k.json"), added_tokens=True))


STAGES = [
    ("language_id", language_id),
    ("near_copies", near_copies),
    ("decontaminate", decontaminate),
    ("mix_sources", mix_sources),
    ("token_files", token_files),
]

# Models and a tokenizer cannot be written in SQL; tests compare each stage with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
