"""From raw documents to token ids, stage by stage; each stage reads what the one before wrote."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from runsift.llm.decontaminate import decontaminate
from runsift.llm.frames import settled, table
from runsift.llm.near import drop_near_duplicates
from runsift.llm.pieces import with_tokens
from runsift.llm.secrets import redact
from runsift.llm.toxicity import drop_toxic


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without documents that are toxic with a probability of 0.7 or more."""
    return drop_toxic(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of copies: shingles of five words, a similarity of 0.8 or more."""
    return drop_near_duplicates(docs, size=5, percent=80)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without benchmark passages, and without documents that mostly consist of them."""
    return decontaminate(docs, table(spark, sf_dir, "benchmark"), length="n_chars")


def secret_scans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """With a mark instead of each secret."""
    return redact(docs, length="n_chars")


def sentencepiece(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """With the ids of the text, their number, and whether they decode to it."""
    return with_tokens(docs, public_tokenizers.path("piece_bpe_32k.model"))


STAGES = [
    ("toxicity", toxicity),
    ("near_duplicates", near_duplicates),
    ("benchmark_decontamination", benchmark_decontamination),
    ("secret_scans", secret_scans),
    ("sentencepiece", sentencepiece),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stage(spark, docs, sf_dir)
        if name != STAGES[-1][0]:
            docs = settled(docs)
    return docs


#: The learned and the similarity stages are beyond SQL.
ORACLE_SQL = None

QUERIES = {"pipeline": run}
SQL: dict[str, str] = {}
