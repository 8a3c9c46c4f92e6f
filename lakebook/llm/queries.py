"""One query per operator, over the whole of its table, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakebook.llm.bpe import roundtrip
from lakebook.llm.exact import duplicate_report
from lakebook.llm.infill import fill_in_middle, restored
from lakebook.llm.langid import language_id
from lakebook.llm.packing import pack_documents
from lakebook.llm.phrases import collocations
from lakebook.llm.quality import quality_rules
from lakebook.llm.sharding import assign_shards
from lakebook.llm.shared import held_out, table
from lakebook.llm.simhash import near_duplicates
from lakebook.llm.suffix import repeat_report
from lakebook.llm.toxicity import toxicity
from lakebook.llm.warc import archive_roundtrip
from lakebook.llm.windows import pack_windows

Query = Callable[[SparkSession, str], DataFrame]

SHARDS = 8
TOXIC_FROM = 0.3


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(table(spark, sf_dir, "documents"))


def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return archive_roundtrip(table(spark, sf_dir, "pages"))


def op3_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    sized = table(spark, sf_dir, "documents").select(
        "doc_id",
        (F.length(text) + 1).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"),
    )
    order = [F.col("doc_id"), F.col("size"), F.col("text_crc32")]
    return assign_shards(sized, order, SHARDS).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"), "row",
    )


def op4_suffix_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeat_report(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256")
    )


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    scored = toxicity(documents, labels, ~held_out("doc_id"))
    return scored.select(
        "doc_id", held_out("doc_id").alias("held_out"), "score",
        (F.col("score") >= TOXIC_FROM).cast("int").alias("predicted"),
    )


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"))


def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return duplicate_report(table(spark, sf_dir, "documents"))


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


def op9_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return roundtrip(table(spark, sf_dir, "documents")).select(
        "doc_id",
        F.floor(F.length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    found = language_id(documents, documents.where(~held_out("doc_id")))
    return found.select("doc_id", held_out("doc_id").alias("held_out"), "lang_pred", "score")


def op11_fim(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = fill_in_middle(table(spark, sf_dir, "documents"))
    return cut.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars",
        F.sha2(F.col("output").cast("binary"), 256).alias("output_sha256"),
        F.sha2(restored(F.col("output"), F.col("form")).cast("binary"), 256).alias("restored_sha256"),
    )


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents"))


def op13_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_windows(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Query] = {
    "op1_quality_rules": op1_quality_rules,
    "op2_warc": op2_warc,
    "op3_sharding": op3_sharding,
    "op4_suffix_array": op4_suffix_array,
    "op5_toxicity": op5_toxicity,
    "op6_packing": op6_packing,
    "op7_exact_dedup": op7_exact_dedup,
    "op8_simhash": op8_simhash,
    "op9_bpe": op9_bpe,
    "op10_language_id": op10_language_id,
    "op11_fim": op11_fim,
    "op12_collocations": op12_collocations,
    "op13_packing": op13_packing,
}
