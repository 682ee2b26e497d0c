"""The registered queries of this subpackage: thin, over whole tables."""

from __future__ import annotations

import functools
import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paystrata.llm import (
    jaccard,
    language,
    lattice,
    lengths,
    mixing,
    negatives,
    pieces,
    prefix_trie,
    quality,
    suffixes,
    topk,
    toxicity,
    warc,
)
from paystrata.llm.common import Query, held_out, use_llm_conf

QUERIES: dict[str, Query] = {}

#: Folder with the public vocabulary files.
TOKENIZERS = os.environ.get("TOKENIZER_DIR", "/opt/tokenizers")
PIECE_MODEL = f"{TOKENIZERS}/piece_bpe_32k.model"
BYTE_RANKS = f"{TOKENIZERS}/byte_bpe_50k.tiktoken"


def byte_pattern() -> str:
    """How the byte-level vocabulary's owner splits texts, from its package."""
    import public_tokenizers

    return public_tokenizers.PATTERN


def query(function: Query) -> Query:
    """Register ``function`` under its name, run with this subpackage's settings."""

    @functools.wraps(function)
    def run(spark: SparkSession, folder: str) -> DataFrame:
        return function(use_llm_conf(spark), folder)

    QUERIES[function.__name__] = run
    return run


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


@query
def op1_warc(spark: SparkSession, folder: str) -> DataFrame:
    """Every page written to WARC archives and read back through the capture index."""
    pages = table(spark, folder, "pages")
    directory = warc.archive_pages(pages)
    return warc.lookup(directory, pages.select(warc.surt(F.col("url")).alias("surt"))).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


@query
def op2_quality(spark: SparkSession, folder: str) -> DataFrame:
    """Quality score of every document by the factorisation machine."""
    docs = table(spark, folder, "documents")
    machine = quality.train(docs, table(spark, folder, "labels"))
    return quality.score_documents(docs, machine).select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= quality.THRESHOLD).cast("int").alias("predicted"),
    )


@query
def op3_lattice(spark: SparkSession, folder: str) -> DataFrame:
    """Near-duplicate vectors by lattice hashing: links and components."""
    return lattice.near_duplicates(table(spark, folder, "embeddings"))


@query
def op4_topk(spark: SparkSession, folder: str) -> DataFrame:
    """Five largest inner products of every 50th vector with all others."""
    return topk.top_inner_products(table(spark, folder, "embeddings"))


@query
def op5_suffixes(spark: SparkSession, folder: str) -> DataFrame:
    """Bytes of every document that repeat in strings of 400, and what is left."""
    return suffixes.remove_repeats(table(spark, folder, "documents"))


@query
def op6_language(spark: SparkSession, folder: str) -> DataFrame:
    """Language of every document by word-first backoff."""
    docs = table(spark, folder, "documents")
    return language.predict(docs, language.train(docs)).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score"
    )


@query
def op7_mixing(spark: SparkSession, folder: str) -> DataFrame:
    """How often the mix takes every document, and its source's target."""
    mixed = mixing.mix_sources(table(spark, folder, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken", "copies")


@query
def op8_pieces(spark: SparkSession, folder: str) -> DataFrame:
    """Digest of every document's pieces, and of what they decode to."""
    encoded = pieces.encode_documents(table(spark, folder, "documents"), PIECE_MODEL)
    return encoded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@query
def op9_jaccard(spark: SparkSession, folder: str) -> DataFrame:
    """Components of documents whose three-word shingle sets are 90 % alike."""
    found = jaccard.similar_sets(table(spark, folder, "documents"))
    return found.select("doc_id", "n_shingles", "component_id")


@query
def op10_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    """The histogram of all documents' token counts with its suffix sums."""
    counts = lengths.encoded_lengths(table(spark, folder, "documents"), BYTE_RANKS, byte_pattern())
    return lengths.suffix_sums(lengths.length_histogram(counts))


@query
def op11_negatives(spark: SparkSession, folder: str) -> DataFrame:
    """Hard negatives of every 50th vector, where every 7th has changed its label."""
    vectors = table(spark, folder, "embeddings")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.hard_negatives(vectors.withColumn("label", moved))


@query
def op12_prefix_trie(spark: SparkSession, folder: str) -> DataFrame:
    """Every distinct beginning of the rebuilt conversations, with its subtree's sums."""
    return prefix_trie.prefix_trie(prefix_trie.rebuilt_paths(table(spark, folder, "conversations")))


@query
def op13_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    """Toxicity score of every document by the convolutional classifier."""
    docs = table(spark, folder, "documents")
    net = toxicity.train(docs, table(spark, folder, "labels"))
    return toxicity.score_documents(docs, net).select(
        "doc_id",
        toxicity.in_fold(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted"),
        "flagged",
    )
