"""A corpus pipeline over ``documents``: five stages, each written as a table and read by the next.

Each stage works on every row that its predecessor kept. All but the last return the columns of
documents; extra columns, whatever their names, pass through untouched.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from voxloom.llm import sentencepiece
from voxloom.llm.ids import text_key
from voxloom.llm.minhash_forest import minhash_dedup
from voxloom.llm.mixing import mix_texts
from voxloom.llm.shared import stage
from voxloom.llm.substring_dedup import substring_dedup
from voxloom.llm.toxicity import score_toxicity
from voxloom.operators import partitioning
from voxloom.sources.tables import read_table, spread


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity classifier rejects go (at the threshold of their language)."""
    scored = score_toxicity(docs, read_table(spark, sf_dir, "labels"))
    return scored.where(~F.col("rejected")).select("row.*")


def _keyed(docs: DataFrame) -> DataFrame:
    return docs.select(docs["doc_id"].alias("id"), text_key(docs["text"]).alias("key"), F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("row"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays, the one with the smallest id: five-word shingles, similarity 0.8.

    Of rows that repeat both id (or its absence) and text one stays, the same one in every run. Texts
    that share an id are documents of their own: each links by its own words only.
    """
    keyed = _keyed(docs)
    texts = stage(keyed.select("id", "key").where("id is not null").distinct(), "texts")
    if texts.groupBy("id").count().where("count > 1").isEmpty():
        kept = minhash_dedup(docs).where("kept").select(F.col("doc_id").alias("k_id"), F.col("text_key").alias("k_key"))
    else:  # numbers in the order of the ids stand for the texts
        nodes = stage(partitioning.with_row_index(texts, "id", ties=("key",)).select(F.col("id").alias("n_id"), F.col("key").alias("n_key"), F.col("row_idx").cast("long").alias("node")), "nodes")
        own = keyed.join(nodes, (F.col("id") == F.col("n_id")) & (F.col("key") == F.col("n_key")), "left").select(F.col("node").alias("doc_id"), F.col("row.text").alias("text"))
        kept = minhash_dedup(own).where("kept").join(nodes, F.col("doc_id") == F.col("node"), "left").select(F.col("n_id").alias("k_id"), F.col("text_key").alias("k_key"))
    kept = stage(kept.distinct(), "kept")
    rows = keyed.join(kept, F.col("id").eqNullSafe(F.col("k_id")) & (F.col("key") == F.col("k_key")), "left_semi")
    if not rows.groupBy("id", "key").count().where("count > 1").isEmpty():
        rows = rows.groupBy("id", "key").agg(F.min_by("row", F.xxhash64("row")).alias("row"))
    return rows.select("row.*")


def cut_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages that an earlier document has go from the text; ``n_chars`` counts what is left."""
    cut = substring_dedup(docs)
    new = {"text": F.col("clean_text"), "n_chars": F.length("clean_text").cast(docs.schema["n_chars"].dataType)}
    changed = F.col("n_removed") > 0
    return cut.select(*[(F.when(changed, new[c]).otherwise(F.col(f"row.`{c}`")) if c in new else F.col(f"row.`{c}`")).alias(c) for c in docs.columns])


_BLANKS = "[ \\t\\n\\x0B\\f\\r]"


def _first_words(text: Column, n: Column) -> Column:
    """The text up to the end of its n-th word, as it stands; it has more words than n, and n is not 0."""
    after = F.split(text, _BLANKS + "+", (n + 1 + F.rlike(text, F.lit("^" + _BLANKS)).cast("int")).cast("int"))
    return F.regexp_replace(F.substring(text, F.lit(1), F.length(text) - F.length(F.element_at(after, -1))), _BLANKS + "+$", "")


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them; the one at a source's budget is cut after its last word taken.

    Rows of which the mix takes no word are not in it. Of rows that repeat id, text and source each has
    its own share: where a budget ends among them, the first of them are taken whole and one is cut.
    """
    taken = mix_texts(docs).where("size > 0 and rounds + part > 0").select(F.col("id").alias("t_id"), F.col("text_key").alias("t_key"), F.col("source").alias("t_source"), "size", "copies", "rounds", "part")
    rows, taken = _keyed(docs), stage(taken, "taken")
    found = rows.join(taken, rows["id"].eqNullSafe(taken["t_id"]) & (rows["key"] == taken["t_key"]) & rows["row"]["source"].eqNullSafe(taken["t_source"]))
    uneven = (F.col("part") > 0) & (F.col("part") < F.col("size") * F.col("copies")) & (F.col("copies") > 1)
    out = found.where(~uneven).withColumn("extra", F.expr("part div copies")).select("row", "size", "rounds", "extra")
    if not taken.where(uneven).isEmpty():  # a group a source at most; equal rows are interchangeable, others stand in the order of their columns
        numbered = found.where(uneven).withColumn("nth", F.row_number().over(W.partitionBy("t_id", "t_key", "t_source").orderBy(F.to_json("row"))) - 1)
        extra = F.greatest(F.lit(0), F.least(F.col("size"), F.col("part") - F.col("nth") * F.col("size")))
        out = out.unionByName(numbered.select("row", "size", "rounds", extra.alias("extra")))
    rounds, rest = F.col("rounds") + F.expr("extra div size"), F.expr("extra % size")
    whole = out.where(rounds > 0).withColumn("copy", F.explode(F.sequence(F.lit(1), rounds.cast("int")))).select("row.*")
    part = out.where(rest > 0).withColumn("cut", _first_words(F.col("row.text"), rest))
    new = {"text": F.col("cut"), "n_chars": F.length("cut").cast(docs.schema["n_chars"].dataType)}
    part = part.select(*[(new[c] if c in new else F.col(f"row.`{c}`")).alias(c) for c in docs.columns])
    return whole.unionByName(part)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every row's whole text: doc_id, source, ids and n_tokens."""
    encoded = sentencepiece.encode_documents(docs)
    return encoded.select("row.doc_id", "row.source", "ids", "n_tokens")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", drop_toxic),
    ("minhash_near_dedup", drop_near_copies),
    ("substring_dedup", cut_repeated_passages),
    ("mixing", mix),
    ("sentencepiece", encode),
]

#: Classifier, signatures and tokenizer have no SQL form; the tests hold each stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply all stages to the table documents; each stage's result is a table in the shared folder."""
    docs = spread(read_table(spark, sf_dir, "documents"))
    for name, apply in STAGES[:-1]:
        docs = stage(apply(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
