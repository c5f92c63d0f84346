"""From raw documents to token files: quality, near duplicates, benchmark leaks, mixing, token ids.

Every stage takes (spark, docs, sf_dir) and works on all documents that the stage before kept. All
but the last return the columns of ``documents``; other columns are carried along. Null texts, ids
and sources, empty texts, equal rows and empty tables pass as the operators of the stages state:
documents without words are scored like others, are nobody's near duplicate, and take no words.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexmill.llm import decontaminate, jaccard, mixing, quality, tokens
from lexmill.llm.common import read
from lexmill.llm.queries import quality_model
from lexmill.operators.lineage import cut


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier accepts."""
    return quality.score(docs, quality_model(spark, sf_dir, docs)).where("predicted = 1").select("doc.*")


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of linked documents: the one of the lowest id."""
    return jaccard.first_of_each(docs, jaccard.jaccard_join(docs))


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no test item."""
    return decontaminate.find_leaks(docs, read(spark, sf_dir, "benchmark")).where(F.size("hits") == 0).select("doc.*")


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix takes it."""
    return mixing.repeated(mixing.mix(docs, weights=(3, 1, 2), share=1.5, ceiling=2.0))


def write_token_files(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The ids in token files, and what is read back from them: (doc_id, start, n_tokens, ids_crc32)."""
    return tokens.read_tokens(tokens.write_tokens(docs, tokens.default_tokenizer(), end_id=0))


STAGES = [
    ("quality", keep_quality),
    ("near_duplicates", drop_near_duplicates),
    ("benchmark_leaks", drop_leaks),
    ("mix", mix_sources),
    ("token_files", write_token_files),
]

#: near-duplicate search by hashing, the classifier, the solver and the tokenizer have no SQL form
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``; each result is written and read again as the next stage's input."""
    docs = read(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
