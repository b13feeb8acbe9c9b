"""Mixing sources to target weights by hash-random order, distributed prefix sums and exact cuts.

Each source gets a budget of words. Its documents stand in the order of a hash of id and text, which is
cut into equal key ranges; sums per range give each range its offset, and a running sum within the
range each document its own. The mix takes as many whole rounds of a source as its budget holds, and
of one more round the documents up to the budget, the last of them cut, so a source's words equal its
budget exactly. A source with a third of all rows is spread over as many ranges as any.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..operators.partitioning import running_sums
from .ids import text_key
from .shared import stage

_SPACES = " \t\n\x0b\x0c\r"
#: Rows of a key range, about, were all rows of one source.
RANGE_ROWS = 250
_KEY_BITS = 20


def count_words(text: Column) -> Column:
    """Runs of characters other than the six ASCII white-space ones; 0 for null."""
    tokens = F.split(F.translate(F.coalesce(text, F.lit("")), _SPACES[1:], " " * 5), " ", -1)
    return F.size(F.filter(tokens, lambda w: w != "")).cast("long")


def targets(sizes: DataFrame, most: int = 3) -> DataFrame:
    """``(source, source_size, target)`` from ``(source, source_size)``, a row per source.

    Sources in the order of their code points, null last, weigh 1, 2, 3, repeating, and share all
    words by weight; none gets more than ``most`` times its size. The level at which the shares of
    the rest are even follows from running sums over the sources in the order of size per weight. Both
    orders are sorted in ranges, so there may be as many sources as there are hosts.
    """
    last = F.col("source").isNull()
    s = running_sums(sizes.withColumn("one", F.lit(1)), [last, F.col("source")], n="one")
    s = s.withColumn("weight", (F.col("n") % 3 + 1).cast("long")).withColumn("most", F.lit(most) * F.col("source_size"))
    s = running_sums(s, [F.expr("most * 6 div weight"), last, F.col("source")], k="one", most_before="most", weight_before="weight")
    s = stage(s, "ranked-sources")
    all_ = s.agg(F.sum("source_size").alias("words"), F.sum("weight").alias("weights")).first()  # two numbers
    s = s.withColumn("left_words", F.lit(all_["words"]) - F.col("most_before")).withColumn("left_weight", F.lit(all_["weights"]) - F.col("weight_before"))
    share = F.col("left_words").cast("double") * F.col("weight") / F.col("left_weight")
    even = s.where(share <= F.col("most")).agg(F.min(F.struct("k", "left_words", "left_weight")).alias("x")).first()["x"]  # the first with an even share
    level = F.lit(float(even["left_words"]) if even else None).cast("double") * F.col("weight") / F.lit(even["left_weight"] if even else None)
    return s.select("source", "source_size", F.when(F.col("k") < F.lit(even["k"] if even else None), F.col("most").cast("double")).otherwise(level).alias("target"))


def mix_texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", seed: int = 17, most: int = 3) -> DataFrame:
    """What the mix takes of each distinct id, text and source of ``docs``, with the number of rows that have them.

    ``(id, text_key, source, size, copies, source_size, target, rounds, part)``: each row is taken
    ``rounds`` times whole; ``part`` words more are taken of all the copies together, one after the other.
    """
    text = docs[f"`{text_col}`"]
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(docs[f"`{id_col}`"].cast("string"), F.lit("null")), F.lit(":"), F.coalesce(F.md5(text.cast("binary")), F.lit("null"))).cast("binary"))
    sized = docs.select(docs[f"`{id_col}`"].alias("id"), text_key(text).alias("text_key"), docs[f"`{source_col}`"].alias("source"), count_words(text).alias("size"), digest.alias("key"))
    # rows that are equal in all of this are one entry, so that no key has more than one in a source
    sized = stage(sized.groupBy("id", "text_key", "source", "size", "key").agg(F.count("*").alias("copies")).withColumn("words", F.col("size") * F.col("copies")), "sizes")
    rows, per_source = sized.count(), sized.groupBy("source").agg(F.sum("words").alias("source_size"))
    bits = min(_KEY_BITS, max(4, (rows // RANGE_ROWS).bit_length()))
    plan = stage(targets(per_source, most), "targets")
    sized = sized.withColumn("part", F.shiftright(F.conv(F.substring("key", 1, 5), 16, 10).cast("int"), _KEY_BITS - bits))
    sums = sized.groupBy("source", "part").agg(F.sum("words").alias("words"))
    sums = sums.withColumn("offset", F.sum("words").over(W.partitionBy("source").orderBy("part").rowsBetween(W.unboundedPreceding, -1)))
    # a row per source and range: joined with the sources' plan before the documents see it
    same = lambda a, b: F.col(a).eqNullSafe(F.col(b))
    plan = plan.withColumnRenamed("source", "p_source")
    ranges = sums.join(plan, same("source", "p_source")).select(F.col("source").alias("r_source"), F.col("part").alias("r_part"), F.coalesce("offset", F.lit(0)).alias("offset"), "source_size", "target")
    within = W.partitionBy("source", "part").orderBy("key").rowsBetween(W.unboundedPreceding, -1)
    placed = sized.withColumn("before", F.coalesce(F.sum("words").over(within), F.lit(0)))
    out = placed.join(ranges, same("source", "r_source") & (F.col("part") == F.col("r_part")))
    rounds = F.when(F.col("source_size") > 0, F.expr("cast(floor(target) as bigint) div source_size")).otherwise(F.lit(0))
    rest = F.floor("target").cast("long") - rounds * F.col("source_size")
    part = F.greatest(F.lit(0), F.least(F.col("words"), rest - (F.col("offset") + F.col("before"))))
    return out.select("id", "text_key", "source", "size", "copies", "source_size", "target", rounds.cast("long").alias("rounds"), part.cast("long").alias("part"))


def mix_sources(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", seed: int = 17, most: int = 3) -> DataFrame:
    """Per row of ``docs``: id, ``text_key`` (a hash of the text), size, source, source_size, target and taken.

    ``taken`` is the words that the mix takes of the row, repeats counted: whole rounds times its size,
    and for at most one row of a source a part of one. Ids may be of any type. Null texts have size 0
    and are never taken. Null sources are one source; null ids are told apart by their texts. Rows that
    are equal in id, text and source stand one after the other, and are interchangeable. An empty table
    gives an empty result.
    """
    texts = mix_texts(docs, id_col, text_col, source_col, seed, most)
    # copies by thousands first, so that a very frequent row's copies are made by many tasks
    thousands = texts.withColumn("a", F.explode(F.sequence(F.lit(0), F.expr("(copies - 1) div 1000"))))
    thousands = thousands.repartition("text_key", "a") if (texts.agg(F.max("copies")).first()[0] or 0) > 1000 else thousands
    rows = thousands.withColumn("nth", F.explode(F.sequence(F.col("a") * 1000, F.least(F.col("a") * 1000 + 999, F.col("copies") - 1))))
    own = F.greatest(F.lit(0), F.least(F.col("size"), F.col("part") - F.col("nth") * F.col("size")))
    return rows.select(F.col("id").alias(id_col), "text_key", "size", F.col("source").alias(source_col), "source_size", "target", (F.col("rounds") * F.col("size") + own).cast("long").alias("taken"))


#: The same rows in DuckDB, for the defaults above and the columns of the query.
ORACLE = r"""
WITH sized AS (
  SELECT doc_id, source, text,
    CAST(len(list_filter(string_split(translate(coalesce(text, ''), chr(9) || chr(10) || chr(11) || chr(12) || chr(13), '     '), ' '), lambda w: w <> '')) AS BIGINT) AS size,
    md5('17:' || coalesce(CAST(doc_id AS VARCHAR), 'null') || ':' || coalesce(md5(text), 'null')) AS key
  FROM documents),
sources AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM sized GROUP BY source),
weighed AS (
  SELECT *, (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS weight, 3 * source_size AS most FROM sources),
ranked AS (
  SELECT *, row_number() OVER (ORDER BY most * 6 // weight, source NULLS LAST) AS k,
    sum(source_size) OVER () - coalesce(sum(most) OVER (ORDER BY most * 6 // weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS left_words,
    sum(weight) OVER () - coalesce(sum(weight) OVER (ORDER BY most * 6 // weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS left_weight
  FROM weighed),
even AS (
  SELECT k AS even_from, left_words AS w, left_weight AS g FROM ranked
  WHERE CAST(left_words AS DOUBLE) * weight / left_weight <= most ORDER BY k LIMIT 1),
plan AS (
  SELECT source, source_size, CASE WHEN k < even_from THEN CAST(most AS DOUBLE) ELSE CAST(w AS DOUBLE) * weight / g END AS target
  FROM ranked CROSS JOIN even),
placed AS (
  SELECT s.doc_id, s.size, p.source_size, p.target, CAST(floor(p.target) AS BIGINT) AS budget,
    coalesce(sum(s.size) OVER (PARTITION BY s.source ORDER BY s.key ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM sized s JOIN plan p ON s.source IS NOT DISTINCT FROM p.source),
cut AS (
  SELECT *, CASE WHEN source_size > 0 THEN budget // source_size ELSE 0 END AS rounds FROM placed)
SELECT doc_id, size, source_size, target,
  CAST(rounds * size + greatest(0, least(size, budget - rounds * source_size - before)) AS BIGINT) AS taken
FROM cut
"""
