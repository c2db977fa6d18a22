"""Queries of the operators over whole tables, with SQL where SQL can express them."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .html_extraction import main_text
from .language_model import score_texts
from .near_duplicates import near_duplicates
from .packing import pack
from .phrase_mining import collocations
from .phrase_queries import SQL as PHRASE_SQL
from .prefix_trie import numbered, rebuilt, trie
from .quality import quality
from .sentencepiece_codec import decode_ids, encode_texts
from .substring_dedup import remove_repeats
from .tokens import token_counts
from .trie_queries import SQL as TRIE_SQL
from .url_filters import url_filter
from .url_queries import SQL as URL_SQL
from .url_queries import captures, entries
from .vector_search import top_k
from .window_filling import fill_windows

Query = Callable[[SparkSession, str], DataFrame]

#: The folder of the public tokenizer files on every machine.
TOKENIZERS = os.environ.get("TOKENIZERS_DIR", "/opt/tokenizers")

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def add(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query("op1_superminhash")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near duplicates of all documents at a Jaccard similarity of 0.85."""
    return near_duplicates(table(spark, sf_dir, "documents"))


@query("op2_temporal_list_join", URL_SQL)
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages against dated lists of domains and path prefixes, as of their fetch times."""
    pages = table(spark, sf_dir, "pages")
    out = url_filter(captures(pages), entries(pages))
    return out.withColumn("fetched", F.col("fetched").cast("timestamp_ntz")).withColumn("lists", F.array_join("lists", ","))


@query("op3_sentencepiece")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of all documents by the SentencePiece file, their parity with its library, and whether they decode to the text."""
    docs, model = table(spark, sf_dir, "documents"), f"{TOKENIZERS}/piece_bpe_32k.model"
    coded = encode_texts(docs, model)
    read = decode_ids(coded, model)
    digest = F.crc32(F.col("ids")).alias("ids_crc32")
    length = (F.octet_length("ids") / 4).cast("long").alias("n_ids")
    return read.select("doc_id", length, digest, "parity", F.sha2("text", 256).alias("decoded_sha256"))


@query("op4_site_style_tree")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of all pages."""
    return main_text(table(spark, sf_dir, "pages"))


SEPARATORS = r"[\x20\x09-\x0D]+"


@query("op5_difference_cover")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents without passages of 13 words that an earlier document has."""
    out = remove_repeats(table(spark, sf_dir, "documents"))
    kept = F.trim(F.regexp_replace(F.coalesce("text", F.lit("")), SEPARATORS, " "))
    return out.select("doc_id", "n_words", "n_removed", F.sha2(kept, 256).alias("kept_sha256"))


@query("op6_token_counts")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of all documents by the byte-level file of 50,257 ids."""
    return token_counts(table(spark, sf_dir, "documents"), f"{TOKENIZERS}/byte_bpe_50k.json")


@query("op7_minimum_bin_slack")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of 4096 ids."""
    return pack(table(spark, sf_dir, "documents"), f"{TOKENIZERS}/word_bpe_49k.json")


@query("op9_ngram_ratio")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base counts and verdict of all documents; trusted text is what the labels call good."""
    out = quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return out.drop("carried")


@query("op8_va_file")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 best of all vectors for every vector whose id is divisible by 20."""
    vectors = table(spark, sf_dir, "embeddings")
    return top_k(vectors, vectors.where("vec_id % 20 = 0"))


@query("op10_attention")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of all documents by word counts and by the attention model, learnt from the documents not held out."""
    return score_texts(table(spark, sf_dir, "documents"), f"{TOKENIZERS}/byte_bpe_50k.json")


@query("op11_prefix_trie", TRIE_SQL)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The trie of all conversations, rebuilt so that neighbouring ones begin alike."""
    return trie(*rebuilt(numbered(table(spark, sf_dir, "conversations"))))


@query("op12_slack_windows")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in sequences of 4096 ids, cut so that none needs padding."""
    out = fill_windows(table(spark, sf_dir, "documents"), f"{TOKENIZERS}/word_bpe_49k.json")
    return out.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


@query("op13_setm_phrases", PHRASE_SQL)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 2000 tightest phrases of each language in all documents."""
    return collocations(table(spark, sf_dir, "documents"))
