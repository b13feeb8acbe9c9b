"""The registered queries ``opN_<name>``: each applies one operator to its whole table, with its production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.tables import read_table, spread
from . import embedding_dedup, minhash_forest, mixing, quality_rules, sentencepiece, substring_dedup, url_filter, warc
from .labelled import held_out
from .quality_classifier import fit_quality, quality_score
from .toxicity import fit_toxicity, toxicity_score


def _table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    """All rows of a table, with these columns only."""
    return spread(read_table(spark, sf_dir, name).select(*columns))


def op1_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.filter_urls(_table(spark, sf_dir, "pages", "page_id", "url")).select("page_id", "host", "path", "rule", "verdict")


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality_rules.quality_rules(_table(spark, sf_dir, "documents", "doc_id", "text", "lang", "source"))
    return judged.withColumn("failed", F.array_join("failed", ","))


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents", "doc_id", "text", "source")
    return mixing.mix_sources(docs).select("doc_id", "size", "source_size", "target", "taken")


def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents", "doc_id", "text")
    return substring_dedup.substring_dedup(docs, window=13, with_text=False).select("row.doc_id", "n_words", "n_removed", "kept_sha256")


def op5_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.embedding_dedup(_table(spark, sf_dir, "embeddings", "vec_id", "embedding", "label"), threshold=0.98)


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents", "doc_id", "text", "lang")
    model = fit_toxicity(docs, read_table(spark, sf_dir, "labels"))
    scored = docs.select("doc_id", held_out("doc_id").alias("held_out"), toxicity_score(model, docs["text"]).alias("score"), model.threshold(docs["lang"]).alias("threshold"))
    return scored.withColumn("predicted", (F.col("score") >= 0.7).cast("int")).withColumn("rejected", F.col("score") >= F.col("threshold"))


def op7_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents", "doc_id", "text")
    digest = sentencepiece.tokens_digest(sentencepiece.load_model(), docs["text"])
    return docs.select("doc_id", digest.alias("d")).select("doc_id", "d.*")


def op8_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents", "doc_id", "text")
    return minhash_forest.minhash_dedup(docs, size=4, percent=80).select("doc_id", "n_shingles", "component_id", "kept")


def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive_round_trip(_table(spark, sf_dir, "pages", "page_id", "url", "html"))


def op10_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents", "doc_id", "text")
    model = fit_quality(docs, read_table(spark, sf_dir, "labels"))
    scored = docs.select("doc_id", held_out("doc_id").alias("held_out"), quality_score(model, docs["text"]).alias("score"))
    return scored.withColumn("predicted", (scored["score"] >= 0.5).cast("int"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_url_filters, op2_quality_rules, op3_mixing, op4_substring_dedup, op5_embedding_dedup, op6_toxicity, op7_sentencepiece, op8_minhash_dedup, op9_warc, op10_quality_classifier,
    )
}

#: Where SQL can express the query; the others are tested against brute force, the library or held-out rows.
ORACLES: dict[str, str] = {
    "op1_url_filters": url_filter.ORACLE,
    "op2_quality_rules": quality_rules.ORACLE,
    "op3_mixing": mixing.ORACLE,
    "op4_substring_dedup": substring_dedup.ORACLE,
    "op5_embedding_dedup": embedding_dedup.ORACLE,
    "op8_minhash_dedup": minhash_forest.ORACLE,
    "op9_warc": warc.ORACLE,
}
