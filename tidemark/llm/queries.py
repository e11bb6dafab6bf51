"""One query per operator over its whole table, with SQL counterparts."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import (
    decontaminate,
    gru_lm,
    jaccard_join,
    language_id,
    packing,
    periodic_runs,
    piece_codec,
    quality_rules,
    secrets,
    sql,
    token_files,
    url_rules,
    warc,
    whitening,
)

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}

BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")
URL_RULES = [
    ("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"), ("block", "net/es/"), ("block", "net/fr/"),
]


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


@query
def op1_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    """Counts and verdict of all documents, with cutoffs chosen per language."""
    return quality_rules.quality_report(table(spark, folder, "documents"), table(spark, folder, "labels"))


@query
def op2_packing(spark: SparkSession, folder: str) -> DataFrame:
    """Pieces of all documents in sequences of 2048 tokens."""
    return packing.pack(table(spark, folder, "documents"), BYTE_BPE, 2048, 1)


@query
def op3_warc(spark: SparkSession, folder: str) -> DataFrame:
    """Pages written as archives and read back."""
    return warc.archived(table(spark, folder, "pages")).drop("url")


@query
def op4_url_rules(spark: SparkSession, folder: str) -> DataFrame:
    """Verdicts on all pages' addresses."""
    return url_rules.judged(table(spark, folder, "pages"), URL_RULES)


@query
def op5_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    """Secrets in all documents, judged by a forest."""
    return secrets.secret_report(table(spark, folder, "documents"))


@query
def op6_ngram_jaccard(spark: SparkSession, folder: str) -> DataFrame:
    """Groups of all documents whose 3-word shingles are 90 % alike."""
    return jaccard_join.near_groups(table(spark, folder, "documents"), 3, 90)


@query
def op7_token_files(spark: SparkSession, folder: str) -> DataFrame:
    """Token ids of all documents, read back from their files."""
    return token_files.token_files(table(spark, folder, "documents"), BYTE_BPE, 0)


@query
def op8_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    """Benchmark passages in all documents."""
    found = decontaminate.contamination(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    return found.drop("spans")


@query
def op9_language_id(spark: SparkSession, folder: str) -> DataFrame:
    """Languages of all documents."""
    return language_id.identify(table(spark, folder, "documents"), PIECES)


@query
def op10_gru_scores(spark: SparkSession, folder: str) -> DataFrame:
    """Log probabilities of all documents under a recurrent model and a smoothed unigram."""
    return gru_lm.language_scores(table(spark, folder, "documents"))


@query
def op11_whitening(spark: SparkSession, folder: str) -> DataFrame:
    """The embeddings' four leading whitened components."""
    rows = whitening.whitened(table(spark, folder, "embeddings").select("vec_id", "embedding"), "embedding", 4)
    each = F.posexplode(F.arrays_zip("whitened", "explained")).alias("at", "c")
    return rows.select("*", each).select(
        "vec_id", (F.col("at") + 1).alias("component"), "n", "deviation", "c.whitened", "c.explained", "identity_error"
    )


@query
def op12_sentencepiece(spark: SparkSession, folder: str) -> DataFrame:
    """Piece ids of all documents and the texts they stand for, as digests."""
    encoded = piece_codec.encode(table(spark, folder, "documents").select("doc_id", "text"), PIECES)
    return piece_codec.decode(encoded.drop("text"), PIECES).select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@query
def op13_periodic_runs(spark: SparkSession, folder: str) -> DataFrame:
    """Runs of repeated words in all documents, every tenth of them made periodic first."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    docs = docs.withColumn("text", periodic_runs.planted(F.col("doc_id"), F.col("text")))
    return periodic_runs.find_runs(docs).select("doc_id", *periodic_runs.digest())


SQL |= {
    "op3_warc": sql.WARC,
    "op4_url_rules": sql.url_verdicts(URL_RULES),
    "op6_ngram_jaccard": sql.JACCARD,
    "op8_decontamination": sql.DECONTAMINATION,
}
