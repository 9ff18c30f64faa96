"""A corpus pipeline: documents to packed token rows.

Each stage takes (spark, docs, sf_dir), where docs is what the stage before it kept, and returns what it keeps. All but the last
return the columns of the documents.

1. language: documents without a recognisable language go, and those told to be in another language than ``lang`` says.
2. near_dedup: of each group of near duplicates (shingles of five words, similarity of at least 0.8) one document stays.
3. decontaminate: documents that hold ten consecutive words of a benchmark item go.
4. mix: sources are brought to their target shares; a row for each whole copy or part that the mix takes.
5. pack: the texts become token ids in packed rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from caseflow.llm import decontaminate, language, mixing, neardup, packing
from caseflow.llm.queries import END_OF_TEXT, VOCABULARY
from caseflow.llm.tables import materialize, table


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return language.keep_identified(docs, as_stated=True)


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return neardup.deduplicate(docs)


def decontaminate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def mix_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mix(docs)


def pack_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs, VOCABULARY, pad_id=END_OF_TEXT)


STAGES = [
    ("language", language_stage),
    ("near_dedup", near_dedup_stage),
    ("decontaminate", decontaminate_stage),
    ("mix", mix_stage),
    ("pack", pack_stage),
]

#: Token ids and language vectors are not for SQL; tests/llm/test_corpus_operators.py checks run() by brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
