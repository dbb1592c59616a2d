"""A training corpus from raw documents: classify, deduplicate, mix and pack.

Each stage takes (spark, docs, sf_dir) and works on all rows that the stage
before it kept. The first four return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ticklake.llm.exact_dedup import exact_dedup_rows
from ticklake.llm.mixing import mixed_rows
from ticklake.llm.ngram_join import one_of_each
from ticklake.llm.packing import default_tokenizer, pack
from ticklake.llm.quality import fit_on_table
from ticklake.llm.shared import read_table, written


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier scores 0.3 or more; the others go."""
    return fit_on_table(docs, spark, sf_dir).keep(docs)


def distinct_texts(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each text: the one of largest doc_id."""
    return exact_dedup_rows(docs)


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate class: the one of least doc_id."""
    return one_of_each(docs)


def mixed_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix of sources 1 : 2 : 3, repeating; a document that the mix uses k times comes in k rows."""
    return mixed_rows(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences of up to 2048 tokens."""
    return pack(docs, default_tokenizer())


STAGES = [
    ("quality classifier", good_documents),
    ("exact dedup", distinct_texts),
    ("n-gram Jaccard join", without_near_copies),
    ("mixing sources", mixed_sources),
    ("packing", packed),
]

#: The classifier and the packing can't be stated in SQL; the tests use brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The packed pieces of ``documents`` after all stages, each written before the next reads it.

    Null texts and ids, empty texts, repeated rows and other columns go through
    as the operators define; an empty table gives no rows.
    """
    docs = read_table(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        docs = written(stage(spark, docs, sf_dir), f"stage{i}")
    return docs
