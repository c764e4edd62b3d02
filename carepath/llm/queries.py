"""Registered queries of the corpus operators: each applies its operator,
with production parameters, to its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .chat_format import as_messages, format_chat, probe, read_back
from .common import table
from .hard_negatives import hard_negatives
from .hilbert_ann import hilbert_ann
from .html_extract import html_extract
from .minhash_dedup import minhash_dedup
from .mixing import mix
from .packing import pack
from .quality import quality
from .rp_forest import rp_forest_dedup
from .substring_dedup import substring_dedup
from .token_align import align_tokens
from .toxicity import toxicity
from .warc import archive


def op1_rp_forest_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rp_forest_dedup(table(spark, sf_dir, "embeddings"))


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (substring_dedup(table(spark, sf_dir, "documents"))
            .select("doc_id", "n_words", "n_removed", "kept_sha256"))


def op3_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    back = read_back(format_chat(as_messages(rows.unionByName(probe(spark, rows)))))
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return back.select("conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(said, 256).alias("turns_sha256"),
                       F.length("loss_text").cast("long").alias("loss_chars"), F.sha2("loss_text", 256).alias("loss_sha256"),
                       F.length("formatted").cast("long").alias("formatted_chars"))


def op4_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash_dedup(table(spark, sf_dir, "documents"), shingle=2, percent=80)


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"))


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    number = lambda c: F.expr(f"try_cast(substr({c}, 10) AS bigint)")  # noqa: E731  after urn:page:
    return archive(table(spark, sf_dir, "pages")).select(
        number("record_id").alias("page_id"), F.col("payload_length").alias("payload_bytes"), "payload_digest", "record_type",
        number("refers_to").alias("refers_to"))


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op8_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract(table(spark, sf_dir, "pages"))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op10_hilbert_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hilbert_ann(table(spark, sf_dir, "embeddings"))


def op11_token_align(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align_tokens(table(spark, sf_dir, "documents"))


def op12_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hard_negatives(table(spark, sf_dir, "embeddings"))


QUERIES = {f.__name__: f for f in (
    op1_rp_forest_dedup, op2_substring_dedup, op3_chat_format, op4_minhash_dedup, op5_packing, op6_warc, op7_mixing,
    op8_html_extract, op9_toxicity, op10_hilbert_ann, op11_token_align, op12_quality,
    op13_hard_negatives)}
