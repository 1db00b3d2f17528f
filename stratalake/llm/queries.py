"""The operators as registered queries with production parameters over their whole tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratalake.llm import (
    bpe, cells, centroids, line_quality, line_spread, lm_scoring, packing, pii, secret_scan, simhash,
    substring, url_filter, whitening)
from stratalake.llm.common import digest
from stratalake.llm.oracles import ORACLES  # noqa: F401

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(build: Callable[[SparkSession, str], DataFrame]):
    QUERIES[build.__name__] = build
    return build


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def joined_spans(spans: str | F.Column) -> F.Column:
    """``kind:start:end`` of all spans, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def of_kinds(spans: str | F.Column, kinds: tuple[str, ...]) -> F.Column:
    return F.filter(spans, lambda s: s["kind"].isin(*kinds))


@query
def op3_line_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_quality.verdicts(table(spark, sf_dir, "documents"))


@query
def op7_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan.scan(table(spark, sf_dir, "documents"))
    kinds = tuple(rule.kind for rule in secret_scan.BASE_RULES)
    return found.select(
        "doc_id", *(F.size(of_kinds("secrets", (k,))).cast("long").alias(f"n_{k}") for k in kinds),
        digest(joined_spans(of_kinds("secrets", kinds))).alias("base_sha256"),
        joined_spans("secrets").alias("spans"))


@query
def op4_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed(
        table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


@query
def op8_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = bpe.encoded(
        table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
    decimal = F.array_join(F.col("ids").cast("array<string>"), " ")
    return found.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        digest(decimal).alias("ids_sha256"), digest(F.col("decoded")).alias("decoded_sha256"))


@query
def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = substring.without_repeats(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", "n_words", "n_removed", digest(F.col("kept_text")).alias("kept_sha256"))


@query
def op2_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", F.lpad(F.lower(F.hex("print")), 16, "0").alias("fingerprint"), "component_id")


@query
def op6_line_spread(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    found = line_spread.without_boilerplate(docs, removed_col="n_removed_lines")
    return found.select(
        "doc_id", "n_removed_lines", F.length(F.coalesce("text", F.lit(""))).cast("long").alias(
            "n_kept_chars"), digest(F.col("text")).alias("kept_sha256"))


@query
def op9_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cells.near_duplicates(table(spark, sf_dir, "embeddings"))


@query
def op10_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judged(table(spark, sf_dir, "pages"))


@query
def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.scan(table(spark, sf_dir, "documents"))
    base = F.filter("spans", lambda s: ~s["added"])
    return found.select(
        "doc_id",
        *(F.size(of_kinds(base, (k,))).cast("long").alias(f"n_{k}") for k in pii.KINDS),
        digest(joined_spans(base)).alias("base_sha256"), joined_spans("spans").alias("spans"))


@query
def op11_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whitened(table(spark, sf_dir, "embeddings"))


@query
def op12_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scoring.scored(
        table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


@query
def op13_centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = centroids.clustered(table(spark, sf_dir, "embeddings"))
    parts = F.array_join(F.col("centroid").cast("array<string>"), ",")
    return found.select("vec_id", "cluster", "distance", "cluster_inertia", "inertia",
                        digest(parts).alias("centroid_sha256"))
