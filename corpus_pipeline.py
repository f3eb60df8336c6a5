"""Documents to training ids: quality rules, line dedup, near duplicates, source mix, token ids.

Nulls: a null text has no words, so the first stage drops it; ids, sources and the other columns may be null in
any stage. Empty tables give empty results. Repeated rows: one of them stays after near duplicates.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strataline.llm import jaccard_join, line_dedup, quality_rules, sentencepiece_codec, source_mixing
from strataline.session import discard, materialise


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep; null and empty texts go."""
    return quality_rules.filtered(docs)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that repeat an earlier one; a document that loses all its lines goes.

    Copies and near copies of a document are for the next stage to judge, as whole documents: a line stays if
    the document where it stands first is a near copy. Without that, what is left of a near copy would be unlike
    all others and stay. Null texts, which the stage before drops, would stay.
    """
    out = line_dedup.deduplicated(docs, unless_alike=jaccard_join.PERCENT)
    return out.filter(F.col("text").isNull() | F.col("text").rlike(r"[^\x20\x09-\x0D]"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near duplicates, that of the smallest id (nulls last); texts without words stay."""
    return jaccard_join.one_of_each(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them, twice at most; a null source is a source."""
    return source_mixing.mixed(docs)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Number of ids of each document's text, and digests of the ids and of the text they decode to; a null
    text has the end id alone."""
    path = sentencepiece_codec.default_model_path()
    return sentencepiece_codec.encode_digests(docs, path)


STAGES = [("quality_rules", quality), ("line_dedup", lines), ("near_duplicates", near_duplicates), ("source_mix", mix), ("token_ids", token_ids)]
#: Neither links of near duplicates over whole tables nor merges are practical in SQL; tests compare with plain code.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents, each written and read again; what a stage has read is deleted."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (name, stage) in enumerate(STAGES):
        before, docs = docs, stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = materialise(docs, f"pipeline-{name}")
            if k:
                discard(before)
    return docs
