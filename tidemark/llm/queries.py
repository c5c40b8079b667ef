"""The registered queries of this subpackage."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.llm import (
    best_fit, chat_format, context_mixing, decontaminate, html_text, license_scan, merkle, packing, quality_rules, sharding, substring_dedup, whitening,
)
from tidemark.llm.ngram_join import NgramJoin

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    """Where the installed vocabulary files lie; any other path may be given to the operators."""
    import public_tokenizers

    return public_tokenizers.path(name)


def query(function: Callable[[SparkSession, str], DataFrame]):
    QUERIES[function.__name__] = function
    return function


@query
def op1_ngram_join(spark: SparkSession, folder: str) -> DataFrame:
    """Near copies of whole texts: five words, Jaccard similarity 0.75."""
    return NgramJoin(table(spark, folder, "documents")).grouped().select("doc_id", "n_shingles", "component_id")


@query
def op3_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    """Measures, failure bits and the verdict of the current policy for every document."""
    ledger = quality_rules.ledger(table(spark, folder, "documents"), ["doc_id"])
    return ledger.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        (~quality_rules.passes("base")).alias("base_failed"),
        (quality_rules.passes("base") & quality_rules.passes("v2")).alias("kept"), "failures",
    )


@query
def op6_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    """Benchmark windows of ten words in whole documents."""
    return decontaminate.report(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


@query
def op8_packing(spark: SparkSession, folder: str) -> DataFrame:
    """Documents cut into powers of two, each piece a sequence without padding."""
    return packing.pieces(table(spark, folder, "documents"), tokenizer_path())


@query
def op2_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Texts without sentences of repeated spans."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    cut = substring_dedup.dedup(docs, report=True)
    return cut.select("doc_id", "text", F.char_length("text").cast("long").alias("n_chars"), "n_words", "n_removed")


@query
def op7_html_text(spark: SparkSession, folder: str) -> DataFrame:
    """Main text of every page."""
    return html_text.extract(table(spark, folder, "pages"))


@query
def op5_chat_format(spark: SparkSession, folder: str) -> DataFrame:
    """Every dialogue once for each of its participants."""
    return chat_format.rotated(table(spark, folder, "conversations")).select(
        "conv_id", "perspective", "turn", "speaker", "kind", "mask", "rendered", F.col("train_from").cast("long").alias("train_from"),
        F.col("train_to").cast("long").alias("train_to"), "tie",
    )


ORACLES["op5_chat_format"] = r"""
WITH said AS (SELECT conv_id, turn, coalesce(role, 'unknown') AS speaker, replace(coalesce(text, ''), '<|', '< |') AS text FROM conversations),
who AS (SELECT DISTINCT conv_id, speaker AS perspective FROM said WHERE speaker <> 'system'),
kinds AS (SELECT s.*, w.perspective, CASE WHEN s.speaker = w.perspective THEN 'assistant' WHEN s.speaker = 'system' THEN 'system'
    ELSE 'user' END AS kind FROM said s JOIN who w ON s.conv_id IS NOT DISTINCT FROM w.conv_id),
heads AS (SELECT *, '<|' || kind || CASE WHEN kind = 'user' THEN ' name=' || replace(replace(regexp_replace(speaker, '[\x00-\x1F\x7F]+', ' ', 'g'),
    '<|', '< |'), '|>', '| >') ELSE '' END || '|>' || chr(10) AS head FROM kinds)
SELECT conv_id, perspective, turn, speaker, kind, speaker = perspective AS mask, head || text || '<|end|>' || chr(10) AS rendered,
    CASE WHEN speaker = perspective THEN length(head) END AS train_from,
    CASE WHEN speaker = perspective THEN length(head) + length(text) + 8 END AS train_to,
    md5(length(speaker) || ':' || speaker || text) AS tie
FROM heads"""


@query
def op9_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    """License notices in whole documents: base phrases and templates."""
    return license_scan.scan(table(spark, folder, "documents"))


@query
def op10_sharding(spark: SparkSession, folder: str) -> DataFrame:
    """All documents in eight shards of equal counts, equal texts together as far as they fit."""
    placed = sharding.sharded(table(spark, folder, "documents"))
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


@query
def op4_context_mixing(spark: SparkSession, folder: str) -> DataFrame:
    """Probabilities of all documents under a model of four fifths of them."""
    return context_mixing.scored(table(spark, folder, "documents"))


@query
def op12_best_fit(spark: SparkSession, folder: str) -> DataFrame:
    """Documents in sequences of 2048 tokens by best-fit decreasing."""
    return best_fit.packed(table(spark, folder, "documents"), tokenizer_path("byte_bpe_50k.json"))


@query
def op11_merkle_manifest(spark: SparkSession, folder: str) -> DataFrame:
    """Every document's leaf, proof, and the root of its version after a chosen fifth of the texts were lower-cased."""
    return merkle.Manifest(table(spark, folder, "documents")).report()


ORACLES["op11_merkle_manifest"] = merkle.oracle()


@query
def op13_whitening(spark: SparkSession, folder: str) -> DataFrame:
    """The first eight whitened components of every usable embedding."""
    return whitening.whiten(table(spark, folder, "embeddings"))
