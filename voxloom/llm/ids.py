"""Ids of any orderable type as 64-bit numbers in the same order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators import partitioning
from .shared import stage

_WHOLE = ("tinyint", "smallint", "int", "bigint")


class Ids:
    """The ids of one table: whole numbers stand for themselves, others for their rank among the distinct ids.

    With ``ranked`` whole numbers have ranks too. Ranks come from ranges of a distributed sort and are a table; ids are then looked up by joins.
    """

    def __init__(self, df: DataFrame, id_col: str, ranked: bool = False):
        self.type = df.schema[id_col].dataType.simpleString()
        self.ranks: DataFrame | None = None
        if ranked or self.type not in _WHOLE:
            own = df.select(df[f"`{id_col}`"].alias("own_id")).where("own_id is not null").distinct()
            self.ranks = stage(partitioning.with_row_index(stage(own, "ids"), "own_id").select("own_id", F.col("row_idx").cast("long").alias("number")), "ranks")

    def number(self, df: DataFrame, id_: str, out: str) -> DataFrame:
        """``df`` with the numbers of its column ``id_`` as ``out``; null for null."""
        if self.ranks is None:
            return df.withColumn(out, F.col(id_).cast("long"))
        ranks = self.ranks.select(F.col("own_id").alias(f"_{out}_id"), F.col("number").alias(out))
        return df.join(ranks, F.col(id_) == F.col(f"_{out}_id"), "left").drop(f"_{out}_id")

    def restore(self, df: DataFrame, *columns: str) -> DataFrame:
        """``df`` with the ids in place of the numbers in these columns."""
        for c in columns:
            if self.ranks is None:
                df = df.withColumn(c, F.col(c).cast(self.type))
            else:
                ranks = self.ranks.select(F.col("own_id").alias(f"_{c}_id"), F.col("number").alias(f"_{c}_number"))
                df = df.join(ranks, F.col(c) == F.col(f"_{c}_number"), "left").withColumn(c, F.col(f"_{c}_id")).drop(f"_{c}_id", f"_{c}_number")
        return df


def text_key(text: Column) -> Column:
    """A 64-bit hash of a text; 0 for null."""
    return F.coalesce(F.xxhash64(text), F.lit(0))
