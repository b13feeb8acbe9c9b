"""Operators along an ordered sequence: merging across small gaps, linking to the predecessor."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

MERGE_GAP = 0.3


def merge_gaps(df: DataFrame, keys: list[str], start: str, end: str, text: str, gap: float = MERGE_GAP, order: list[str] | None = None) -> DataFrame:
    """One row per run of neighbours less than ``gap`` apart: keys, run, start, end, text and n.

    A run has its first start, its last end (not the greatest), the texts in order without a separator,
    and the number of its rows. Rows stand in the order of ``order``, the start if not given.
    """
    by = W.partitionBy(*keys).orderBy(*(order or [start]))
    apart = (F.col(start) - F.lag(end).over(by)) >= gap
    runs = df.withColumn("_apart", F.coalesce(apart, F.lit(True)).cast("int")).withColumn("_place", F.row_number().over(by))
    runs = runs.withColumn("run", F.sum("_apart").over(by.rowsBetween(W.unboundedPreceding, 0)))
    parts = F.array_sort(F.collect_list(F.struct("_place", F.coalesce(F.col(text), F.lit("")).alias("t"))))
    return runs.groupBy(*keys, "run").agg(F.min_by(start, "_place").alias("start"), F.max_by(end, "_place").alias("end"), F.array_join(F.transform(parts, lambda p: p["t"]), "").alias("text"), F.count("*").alias("n"))


def merge_segments(segments: Column | str, gap: float = MERGE_GAP) -> Column:
    """The same on an ``array<struct<start, end, text, word_scores>>``; a run keeps its first row's scores.

    First the places where runs begin, then each run from its slice of the array, so that an entry takes
    time in proportion to its segments.
    """
    segments = F.col(segments) if isinstance(segments, str) else segments
    n = F.size(segments)

    def begins(i: Column) -> Column:
        near = (segments[i]["start"] - segments[i - 1]["end"]) < gap
        return F.when(i == 0, True).otherwise(~F.coalesce(near, F.lit(False)))

    def runs(starts: Column) -> Column:
        def run(first: Column, k: Column) -> Column:
            after = F.coalesce(F.get(starts, k + 1), n)
            texts = F.transform(F.slice(segments, first + 1, after - first), lambda s: F.coalesce(s["text"], F.lit("")))
            return F.struct(segments[first]["start"].alias("start"), segments[after - 1]["end"].alias("end"), F.array_join(texts, "").alias("text"), segments[first]["word_scores"].alias("word_scores"))

        return F.transform(starts, run)

    places = F.filter(F.sequence(F.lit(0), n - 1), begins)
    found = F.flatten(F.transform(F.array(places), runs))  # the places are worked out once
    return F.when(n > 0, found).otherwise(F.slice(segments, 1, 0))


def link_previous(df: DataFrame, keys: list[str], order: str, text: str, empty: Column | str, keep: Column | str) -> DataFrame:
    """Rows that are kept, with ``has_prev`` and ``prev_text`` of the row kept before.

    An ``empty`` row breaks the chain; a row that is not kept neither breaks it nor becomes a
    predecessor. Rows with an empty text are predecessors and go afterwards.
    """
    empty, keep = (F.col(c) if isinstance(c, str) else c for c in (empty, keep))
    along = W.partitionBy(*keys).orderBy(order)
    chains = df.withColumn("_chain", F.sum(empty.cast("int")).over(along.rowsBetween(W.unboundedPreceding, 0)))
    kept = chains.where(~empty & keep)
    chain = W.partitionBy(*keys, "_chain").orderBy(order)
    linked = kept.withColumn("has_prev", F.lag(F.lit(True)).over(chain).isNotNull()).withColumn("prev_text", F.coalesce(F.lag(text).over(chain), F.lit("")))
    return linked.where(F.length(text) > 0).drop("_chain")
