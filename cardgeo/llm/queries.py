"""One query per operator, bound to the test tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import ann, bpe, chat, dialogue, html_text, lm, merkle, packing, pii, quality, secret_scan, toxicity
from .common import table
from .near_dedup import near_duplicates


def op1_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


def op2_byte_bpe(spark: SparkSession, sf_dir: str, vocabulary: str | None = None) -> DataFrame:
    path = vocabulary or public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    model = bpe.load_model(path, public_tokenizers.PATTERN)
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    both = bpe.decode(bpe.encode(docs, model), model)
    return both.select("doc_id", F.floor(F.octet_length("ids") / 4).alias("n_tokens"),
                       F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op3_pack_concat_cut(spark: SparkSession, sf_dir: str, vocabulary: str | None = None) -> DataFrame:
    path = vocabulary or public_tokenizers.path("byte_bpe_50k.json")
    tokenizer = packing.load_tokenizer(path, public_tokenizers.PATTERN, added_tokens=True)
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer)


def op4_hilbert_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest(table(spark, sf_dir, "embeddings"), lambda vec_id: vec_id % 100 == 0)


def op5_quality_perplexity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality(table(spark, sf_dir, "documents"))


def op6_elias_fano_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.score(table(spark, sf_dir, "documents"))


def op7_chat_tool_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.format_chat(table(spark, sf_dir, "conversations"))


def op8_toxicity_pu(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op9_secret_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.secrets(table(spark, sf_dir, "documents"))


def op10_html_path_ratios(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = html_text.extract(table(spark, sf_dir, "pages").select("page_id", "url", "html"))
    return pages.select("page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars"))


def op11_dialogue_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = table(spark, sf_dir, "conversations")
    return dialogue.repair_report(conversations, dialogue.damage(conversations))


def op12_disclosure_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.personal_data(table(spark, sf_dir, "documents"))


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.verified(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (
        op1_minhash_near_dedup, op2_byte_bpe, op3_pack_concat_cut, op4_hilbert_nearest, op5_quality_perplexity,
        op6_elias_fano_lm, op7_chat_tool_links, op8_toxicity_pu, op9_secret_links, op10_html_path_ratios,
        op11_dialogue_repair, op12_disclosure_pii, op13_merkle_manifest)
}

ORACLE: dict[str, str] = {
    "op9_secret_links": secret_scan.oracle_sql(),
    "op12_disclosure_pii": pii.oracle_sql(),
    "op13_merkle_manifest": merkle.oracle_sql(),
}
