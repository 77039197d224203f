"""A pipeline from raw documents to packed training sequences.

``STAGES`` lists (name, function); each function takes (spark, docs, sf_dir)
and returns a DataFrame, which is written as Parquet and read again as the
next one's docs. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cardgeo.llm import packing, quality, secret_scan, toxicity
from cardgeo.llm.common import materialize, table
from cardgeo.llm.near_dedup import near_duplicates


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score is below 0.5 stay."""
    model = toxicity.train(docs, table(spark, sf_dir, "labels"))
    return toxicity.score(docs, model, "text", "__score").where("__score < 0.5").drop("__score")


def drop_low_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep stay."""
    return quality.judge(docs).where("__q.kept").select(*docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group stays: the smallest id.
    Repeated rows of one id leave one row; a null id stays."""
    found = materialize(near_duplicates(docs), "pipeline-classes")
    drop = found.where("not kept").select("doc_id").distinct()
    kept = docs.join(drop, "doc_id", "left_anti").select(*docs.columns)
    again = found.where("doc_id is not null").groupBy("doc_id").count().where("count > 1").select("doc_id")
    if again.isEmpty():
        return kept
    return (kept.join(again, "doc_id", "left_anti").select(*docs.columns)
            .unionByName(kept.join(again, "doc_id", "left_semi").dropDuplicates(["doc_id"]).select(*docs.columns)))


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every span that the scan reports is masked in its text."""
    return secret_scan.masked(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The remaining texts as pieces of sequences of 1024 ids."""
    path = public_tokenizers.path("byte_bpe_50k.json")
    return packing.pack(docs, packing.load_tokenizer(path, public_tokenizers.PATTERN, added_tokens=True))


STAGES = [
    ("toxicity", drop_toxic),
    ("quality rules", drop_low_quality),
    ("near-duplicates", drop_near_copies),
    ("secret scans", mask_secrets),
    ("packing", pack_sequences),
]

#: A trained classifier, a language model and tokenizer ids: not SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages in turn over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}")
    return STAGES[-1][1](spark, docs, sf_dir)
