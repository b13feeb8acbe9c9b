"""Views for looking at a prepared dataset: rows by number, pages, random rows, before and after."""

from __future__ import annotations

import random

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import columns
from .filters import changed_flag, first_text

PAGE = 20


def row_at(df: DataFrame, index: int, row_idx: str = "row_idx") -> DataFrame:
    return df.where(F.col(row_idx) == index)


def page(df: DataFrame, start: int, count: int = PAGE, row_idx: str = "row_idx") -> DataFrame:
    return df.where(F.col(row_idx).between(start, start + count - 1)).orderBy(row_idx)


def neighbour(index: int, step: int, total: int) -> int:
    """The number of the row before or after, within the table."""
    return max(0, min(total - 1, index + step))


def random_row(df: DataFrame, total: int, seed: int, row_idx: str = "row_idx") -> DataFrame:
    return row_at(df, random.Random(seed).randrange(total) if total else -1, row_idx)


def pick_split(df: DataFrame, split: str | None = None) -> DataFrame:
    """Rows of the named split, else of the first by name; a table without splits as it is."""
    if "split" not in df.columns:
        return df
    if split is None:
        first = df.agg(F.min("split").alias("s")).first()["s"]
        return df.where(F.col("split") == first)
    return df.where(F.col("split") == split)


def before_after(df: DataFrame, replacements: dict[str, str] | None = None) -> DataFrame:
    """``raw``, the cautious and the expanded form, and whether each changed anything."""
    texts = [c for c in ("raw_text", "text") if c in df.columns]
    raw = F.coalesce(first_text(*texts), F.lit("")).alias("raw")
    out = df.select("*", raw).select("*", columns.compare_speech("raw", replacements).alias("_both")).select("*", "_both.*").drop("_both")
    return out.withColumn("cautious_changed", changed_flag("raw", "cautious")).withColumn("expanded_changed", changed_flag("raw", "expanded"))


def audio_path(df: DataFrame) -> DataFrame:
    """``audio_path`` from a column of that name, or ``audio`` as a path or a struct with one."""
    kinds = dict(df.dtypes)
    if "audio_path" in kinds:
        return df
    if "audio" not in kinds:
        return df.withColumn("audio_path", F.lit(None).cast("string"))
    return df.withColumn("audio_path", F.col("audio.path") if kinds["audio"].startswith("struct") else F.col("audio").cast("string"))


def resolve_path(path: str, candidates: list[str]) -> str | None:
    """The first of the path itself and the path under each folder that is a file on this machine."""
    import os

    return next((p for p in [path, *(os.path.join(c, path) for c in candidates), *(os.path.join(c, os.path.basename(path)) for c in candidates)] if os.path.isfile(p)), None)


def pretty_metadata(column: str = "metadata"):
    """A struct as indented JSON."""
    return F.to_json(column, {"pretty": "true"})
