"""The registered queries of this subpackage: each applies one operator, with
production parameters, to a whole table and derives the columns of its result."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (byte_bpe, decontaminate, fingerprint, language, lexical_search, line_dedup, oracle, piece_bpe, sharding,
               simhash, suffix_dedup, token_align, toxicity, url_filter)
from .common import held_out, read

RANK_FILE = public_tokenizers.path("byte_bpe_50k.tiktoken")
BYTE_LEVEL_FILE = public_tokenizers.path("byte_bpe_50k.json")
PIECE_FILE = public_tokenizers.path("piece_bpe_32k.model")

#: Scores from here on count as toxic.
TOXIC = 0.3

#: host, path, verdict
URL_RULES = [
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
]


def rank_file(path: str = RANK_FILE) -> bytes:
    """The content of a vocabulary file."""
    with open(path, "rb") as f:
        return f.read()


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SimHash fingerprint and near-duplicate component of each document."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return simhash.near_duplicates(docs).select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of benchmark windows in each document."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    hits = decontaminate.benchmark_hits(docs, read(spark, sf_dir, "benchmark"))
    return hits.select("doc_id", "hits.n_words", decontaminate.hit_words().alias("n_hit"),
                       F.size("hits.items").cast("long").alias("n_items"),
                       F.sha2(F.array_join("hits.items", ","), 256).alias("items_sha256"),
                       decontaminate.contaminated().alias("contaminated"))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of each document."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    members = toxicity.train(docs, read(spark, sf_dir, "labels"))
    return toxicity.with_score(docs, members, out="score").select(
        "doc_id", held_out("doc_id").alias("held_out"), "score",
        (F.col("score") >= TOXIC).cast("int").alias("predicted"))


def op4_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rule and verdict of each page's URL."""
    pages = read(spark, sf_dir, "pages").select("page_id", "url")
    return url_filter.judge_urls(pages, URL_RULES).select("page_id", "judged.*")


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document without the boilerplate lines of its source."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return line_dedup.drop_boilerplate(docs).select(
        "doc_id", "deduped.n_lines", "deduped.n_dropped",
        F.sha2("deduped.text", 256).alias("text_sha256"))


def op6_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids of each document, and the bytes decoded from them."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    coded = byte_bpe.encode_decode(docs, rank_file(), public_tokenizers.PATTERN)
    return digests(coded.select("doc_id", "bpe"))


def digests(coded: DataFrame) -> DataFrame:
    """Token count and digests of what ``encode_decode`` gives."""
    return coded.select(*[c for c in coded.columns if c != "bpe"],
                        F.size("bpe.ids").cast("long").alias("n_tokens"),
                        F.sha2(F.concat_ws(" ", F.col("bpe.ids").cast("array<string>")), 256).alias("ids_sha256"),
                        F.sha2("bpe.decoded", 256).alias("decoded_sha256"))


def op7_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of each document."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = language.train(docs)
    return language.with_language(docs.select("doc_id", "text"), model).select(
        "doc_id", held_out("doc_id").alias("held_out"), F.col("guess.lang").alias("lang_pred"), "guess.score")


def op8_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document without the bytes of repeated 400-byte strings."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return suffix_dedup.without_repeats(docs).select(
        "doc_id", "cut.n_bytes", "cut.n_removed", "cut.n_spans", F.sha2("cut.kept", 256).alias("kept_sha256"))


def op9_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sketch of each document, of an edit of it, and their likeness."""
    docs = (read(spark, sf_dir, "documents")
            .select("doc_id", F.coalesce("text", F.lit("")).alias("text")))
    follow = fingerprint.with_next(docs, "doc_id", ["text", "sketch"],
                                   prepare=lambda df: fingerprint.with_sketch(df, "text", "sketch"))
    n = F.length("text")
    half = F.expr("length(text) div 2").cast("int")
    edit = follow.select("doc_id", "sketch", F.col("next.sketch").alias("next_sketch"),
                         n.cast("long").alias("n_chars"),
                         F.concat(F.left("text", n - half), F.left("next.text", half)).alias("edited"))
    return fingerprint.with_sketch(edit, "edited", "edited_sketch").select(
        "doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"),
        fingerprint.rendered("sketch").alias("fingerprint"),
        fingerprint.rendered("edited_sketch").alias("edited_fingerprint"),
        fingerprint.likeness("sketch", "edited_sketch").alias("near_edited"),
        fingerprint.likeness("sketch", "next_sketch").alias("near_next"))


def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shard and slot of each document; equal texts stay together."""
    text = F.coalesce("text", F.lit(""))
    rows = sharding.materialize(read(spark, sf_dir, "documents").select(
        "doc_id", (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"), F.unhex(F.sha2(text, 256)).alias("same")))
    return sharding.shard_groups(rows, "same", "size", shards=8).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"),
        "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op11_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best documents for each benchmark item."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return lexical_search.ranked(docs, read(spark, sf_dir, "benchmark"))


def op12_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Piece ids of each document, and the text decoded from them."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return piece_bpe.encode_decode(docs, rank_file(PIECE_FILE)).select(
        "doc_id", F.size("pieces.ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(",", F.col("pieces.ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2("pieces.decoded", 256).alias("decoded_sha256"))


def op13_token_align(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups and links between the tokens of two tokenizers in each document."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    aligned = token_align.aligned(docs, rank_file(BYTE_LEVEL_FILE), public_tokenizers.PATTERN, rank_file(PIECE_FILE))
    return aligned.select("doc_id", *[f"aligned.{c}" for c in (
        "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")])


QUERIES = {f.__name__: f for f in (
    op1_simhash, op2_decontaminate, op3_toxicity, op4_url_filter, op5_line_dedup,
    op6_byte_bpe, op7_language, op8_suffix_dedup, op9_fingerprint,
    op10_sharding, op11_lexical_search, op12_sentencepiece, op13_token_align)}
ORACLE_SQL = oracle.SQL
