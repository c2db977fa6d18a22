"""Training-corpus pipeline: quality rules, near duplicates, repeated passages, packing.

Every stage takes (spark, docs, sf_dir) and works on all rows its predecessor
kept.  All but the last return the columns of ``documents``; doc_id, text and
n_chars are those of the row, n_chars counts what is left of the text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from urbanflow.llm.near_duplicates import near_duplicates
from urbanflow.llm.packing import pack
from urbanflow.llm.quality import quality
from urbanflow.llm.queries import TOKENIZERS
from urbanflow.llm.staging import staged
from urbanflow.llm.substring_dedup import remove_repeats

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and reach the quality threshold; the rest goes."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    out = quality(docs, labels, carry=("lang", "source", "n_chars"), with_text=True)
    return out.where("kept").select("doc_id", "text", "carried.*")


#: Similarity of five-word sets from which documents are near duplicates.  A pair at 0.8 shares none of 30 bands of 4
#: values with a probability of 1.4e-7; ``slack`` is over 5 standard errors of 120 values.
NEAR = {"k": 5, "percent": 80, "bands": 30, "rows": 4, "slack": 0.19}


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, at a similarity of 0.8: the one with the least doc_id.

    Rows that repeat a doc_id are one document and stay together; rows without an id stay.
    """
    verdict = near_duplicates(docs, **NEAR).where("kept or doc_id is null").select("doc_id").distinct()
    kept = F.expr("doc_id <=> kept_id")
    # the kept ids grow with the corpus, so this is a sort-merge join at every size
    return docs.join(verdict.withColumnRenamed("doc_id", "kept_id").hint("merge"), kept, "left_semi").select(*COLUMNS)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without passages of 13 words that an earlier document has; a document that loses all its words goes."""
    out = remove_repeats(docs, carry=("lang", "source"))
    out = out.where("n_words > n_removed or n_words = 0")
    return out.select("doc_id", "text", "carried.*", F.char_length("text").cast("long").alias("n_chars"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What is left, as token ids in sequences of 4096."""
    return pack(docs, f"{TOKENIZERS}/word_bpe_49k.json")


STAGES = [
    ("quality_rules", quality_rules),
    ("near_dedup", near_dedup),
    ("substring_dedup", substring_dedup),
    ("packing", packing),
]

#: Hashed likelihood ratios, signatures and token ids are beyond SQL; tests/llm compares every stage with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``; each one's result is written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), name)
    return docs
