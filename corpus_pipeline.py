"""From raw documents to packed training sequences, in five stages.

1. ``language_id`` drops documents whose language cannot be told: no letters, or letters
   whose trigrams and scripts are mostly unknown to the languages learned.
2. ``exact_dedup`` keeps, of equal texts, the document with the largest id.
3. ``simhash_dedup`` keeps, of documents linked by fingerprints that differ in at most
   three bits, the one with the smallest id.
4. ``repeat_removal`` cuts out every string of 200 bytes or more that starts elsewhere
   too. All documents stay, some with a shorter or empty text.
5. ``packing`` encodes the texts and places all pieces in sequences of 4096 tokens.

Each stage works on all that its predecessor kept. All but the last return the columns
of documents. Nulls, empty texts, repeated rows and extra columns are handled as the
operators state; an empty table gives no sequences.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from lakebook.llm.exact import drop_duplicates
from lakebook.llm.langid import keep_identified
from lakebook.llm.packing import pack_documents
from lakebook.llm.shared import Scratch, held_out, stored, table
from lakebook.llm.simhash import drop_near_duplicates
from lakebook.llm.suffix import without_repeats

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return keep_identified(docs, docs.where(~held_out("doc_id")))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_duplicates(docs)


def simhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_near_duplicates(docs)


def repeat_removal(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return without_repeats(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pack_documents(docs)


STAGES: list[tuple[str, Stage]] = [
    ("language_id", language_id),
    ("exact_dedup", exact_dedup),
    ("simhash_dedup", simhash_dedup),
    ("repeat_removal", repeat_removal),
    ("packing", packing),
]

#: SQL can express neither the model, the fingerprints, nor the tokenizer.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, each on the stored table of the one before. What a stage stores on its
    way goes when its table is written, and the tables go when the last one is."""
    with Scratch(spark):
        docs = table(spark, sf_dir, "documents")
        for name, stage in STAGES:
            with Scratch(spark):
                docs = stored(stage(spark, docs, sf_dir), name, outlive=True)
        return stored(docs, "sequences", outlive=True)
