"""Order, limits, shards, splits and unions of entries."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..sources.shared import stage


def duration_of(metadata: Column | str) -> Column:
    """Seconds from JSON metadata: ``duration``, or ``session_duration`` if that key is absent; 0 if unreadable."""
    metadata = F.col(metadata) if isinstance(metadata, str) else metadata
    has = F.array_contains(F.json_object_keys(metadata), "duration")
    raw = F.when(has, F.get_json_object(metadata, "$['duration']")).otherwise(F.get_json_object(metadata, "$['session_duration']"))
    return F.coalesce(F.trim(raw).try_cast("double"), F.lit(0.0))


def shortest(df: DataFrame, duration: str, path: str, k: int | None) -> DataFrame:
    """The k shortest entries, ties by path; all of them for None or 0."""
    ordered = df.orderBy(F.coalesce(F.col(duration), F.lit(0.0)), path)
    return ordered.limit(k) if k else ordered


def _dealt(df: DataFrame, order: list[Column]) -> DataFrame:
    """``df`` as a table in the shared folder, with ``_part``, the row's range of the whole sort key, and ``_place``, which sorts it.

    There are as many ranges as shuffle partitions. They come from a sample, but the order does not.
    """
    keys = [f"_k{i}" for i in range(len(order))]
    dealt = df.select("*", *[o.alias(k) for o, k in zip(order, keys, strict=True)]).repartitionByRange(*keys).sortWithinPartitions(*keys).drop(*keys)
    dealt = stage(dealt.withColumn("_place", F.monotonically_increasing_id()), "dealt")  # the range's number and 33 bits of the row's
    return dealt.withColumn("_part", F.shiftright("_place", 33))


def _ranks(df: DataFrame, order: list[Column]) -> DataFrame:
    """``_rank`` from 1 over the whole table without one task that sees all rows: each range gets the number of rows before it."""
    dealt = _dealt(df, order)
    sizes = dealt.groupBy("_part").agg(F.count("*").alias("n"), F.min("_place").alias("_first"))
    before = sizes.select("_part", "_first", F.coalesce(F.sum("n").over(W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("_before"))
    placed = dealt.join(F.broadcast(before), "_part")  # a row a range
    return placed.withColumn("_rank", F.col("_place") - F.col("_first") + F.col("_before") + 1).drop("_part", "_place", "_first", "_before")


def running_sums(df: DataFrame, order: list[Column], **sums: str) -> DataFrame:
    """For each ``name=column`` the sum of the column over all rows before this one, 0 for the first, as ``name``.

    The order is ascending, nulls first.
    """
    dealt = _dealt(df, order)
    parts = dealt.groupBy("_part").agg(*[F.sum(c).alias(n) for n, c in sums.items()])
    parts = parts.select("_part", *[F.coalesce(F.sum(n).over(W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias(f"_before_{n}") for n in sums])
    own = W.partitionBy("_part").orderBy("_place").rowsBetween(W.unboundedPreceding, -1)
    within = dealt.select("*", *[F.coalesce(F.sum(c).over(own), F.lit(0)).alias(n) for n, c in sums.items()])
    out = within.join(F.broadcast(parts), "_part")  # a row a range
    return out.select(*df.columns, *[(F.col(n) + F.col(f"_before_{n}")).alias(n) for n in sums])


def assign_shards(df: DataFrame, duration: str, path: str, size: int) -> DataFrame:
    """``rank`` by duration and path, and ``shard_id`` of ``size`` consecutive entries each."""
    ranked = _ranks(df, [F.coalesce(F.col(duration), F.lit(0.0)), F.col(path)])
    return ranked.withColumn("rank", F.col("_rank")).withColumn("shard_id", F.floor((F.col("_rank") - 1) / size)).drop("_rank")


def exact_split(df: DataFrame, key: str, size: float, seed: int = 0) -> DataFrame:
    """``split``: ``eval`` for ceil(size * n) rows in the order of a seeded hash of the key, else ``train``.

    All of ``df`` is sorted: give wide rows' keys alone, and join. The split is exact with repeated keys too.
    """
    if not 0 < size < 1:
        raise ValueError("the size of the validation split lies between 0 and 1")
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string")).cast("binary"))
    ranked = _ranks(df, [digest, F.col(key)])
    wanted = -int(-(size * ranked.count()) // 1)
    return ranked.withColumn("split", F.when(F.col("_rank") <= wanted, "eval").otherwise("train")).drop("_rank")


def concat_chunks(parts: list[DataFrame]) -> DataFrame:
    """All rows of all parts, columns by name."""
    return reduce(lambda a, b: a.unionByName(b), parts)


def split_counts(df: DataFrame, split: str = "split") -> DataFrame:
    return df.groupBy(split).agg(F.count("*").alias("n"))


def with_row_index(df: DataFrame, order: str, ties: tuple[str, ...] = ()) -> DataFrame:
    """``row_idx`` from 0 in the order of a column, equal values in that of ``ties``."""
    return _ranks(df, [F.col(c) for c in (order, *ties)]).withColumn("row_idx", F.col("_rank") - 1).drop("_rank")
