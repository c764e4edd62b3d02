"""The corpus pipeline: toxic documents go, one document of each near-duplicate
group stays, repeated passages are cut, sources are mixed to their target
weights, and the mix is packed into batches by length.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is
written as Parquet and reread as the next stage's ``docs``.  All but the last
return the columns of ``documents``.

Defined cases, in every stage: decisions are made row by row, so rows that share
an id, or have none, are documents of their own; further columns, whatever
their names, are carried along up to packing; an empty table stays empty.
Toxicity keeps rows without words (score 0).  Near-dedup keeps all rows without
words and one row of each group, equal rows included: the smallest id (null
last), then the least text hash.  Substring dedup keeps every row and judges
repeats within and across rows on the stage's input; a null text stays null.
Mixing leaves out rows that it takes no word of, those without words among
them.  Packing makes no piece of rows without words.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from carepath.llm.common import cut, table
from carepath.llm.minhash_dedup import unique_documents
from carepath.llm.mixing import mixed_texts
from carepath.llm.packing import pack
from carepath.llm.substring_dedup import deduped_texts
from carepath.llm.toxicity import clean_documents


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that aren't found toxic."""
    return clean_documents(docs, table(spark, sf_dir, "labels"))


def minhash_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each near-duplicate group (five-word shingles, similarity 0.8)."""
    return unique_documents(docs)


def substring_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the words of repeated 35-word windows."""
    return deduped_texts(docs)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: a row per whole pass of a document and one for its part."""
    return mixed_texts(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the mix, with their bucket, batch and slot."""
    return pack(docs)


STAGES = [
    ("toxicity", toxicity_stage),
    ("minhash near-dedup", minhash_stage),
    ("substring dedup", substring_stage),
    ("mixing to target weights", mixing_stage),
    ("packing", packing_stage),
]

#: A trained classifier and seeded hashes choose the rows; tests/llm holds the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir), name.split()[0])
    return STAGES[-1][1](spark, docs, sf_dir)
