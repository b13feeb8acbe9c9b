"""Bounded samples of labelled documents, on which the classifiers are fitted."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def held_out(id_col: Column | str) -> Column:
    """Whether crc32 of the id as text leaves 1 modulo 3; a null id is never held out."""
    id_ = F.col(id_col) if isinstance(id_col, str) else id_col
    return F.coalesce(F.crc32(id_.cast("string").cast("binary")) % 3 == 1, F.lit(False))


class Sample:
    """Texts, labels and languages of labelled rows, and the weight of each row's class.

    Up to ``per_class`` ids of each class are taken in the order of a hash, from labels that are not
    null and not held out. ``weights`` undo the different sampling rates, so that a model sees the
    classes in their true proportion. A repeated label counts once, as 1 if any is 1; of a repeated
    document one text is taken, the one with the least hash. Texts of more than ``text_bytes`` bytes
    are left out, so at most twice ``per_class`` times that many bytes come to the driver.
    """

    def __init__(self, docs: DataFrame, labels: DataFrame, label: str, per_class: int, id_col: str = "doc_id", text_col: str = "text", lang_col: str | None = None, text_bytes: int = 1 << 16):
        known = labels.select(labels[f"`{id_col}`"].alias("id"), labels[f"`{label}`"].cast("int").alias("y")).where("id is not null and y is not null")
        known = known.where(~held_out("id")).groupBy("id").agg(F.max("y").alias("y"))
        totals = {r["y"]: r["n"] for r in known.groupBy("y").agg(F.count("*").alias("n")).collect()}  # one row a class
        taken = [known.where(F.col("y") == y).orderBy(F.xxhash64("id"), "id").limit(per_class) for y in (0, 1)]
        lang = docs[f"`{lang_col}`"] if lang_col else F.lit(None)
        rows = docs.select(docs[f"`{id_col}`"].alias("id"), docs[f"`{text_col}`"].alias("text"), lang.cast("string").alias("lang"))
        rows = rows.where(F.coalesce(F.octet_length("text"), F.lit(0)) <= text_bytes).join(F.broadcast(taken[0].unionByName(taken[1])), "id")
        rows = rows.groupBy("id", "y").agg(F.min(F.struct(F.xxhash64("text").alias("h"), "text", "lang")).alias("row")).select("id", "y", "row.text", "row.lang").toArrow().sort_by([("id", "ascending")])
        self.texts = rows.column("text").combine_chunks().cast(pa.large_string())
        self.langs = rows.column("lang").to_pylist()
        self.y = rows.column("y").to_numpy().astype(np.float64)
        rate = {y: min(1.0, per_class / max(1, totals.get(y, 0))) for y in (0, 1)}
        self.weights = np.array([1 / rate[int(y)] for y in self.y])
        self.weights *= len(self.y) / max(1e-9, self.weights.sum())
