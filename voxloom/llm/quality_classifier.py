"""Quality scores of whole texts by attention over their passages."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import textblocks as tb
from .labelled import Sample
from .mil import Mil

#: Bytes of text scored at once.
SCORE_BYTES = 1 << 18


def fit_quality(docs: DataFrame, labels: DataFrame, per_class: int = 1500, **names: str) -> Mil:
    """Fit on at most ``per_class`` labelled rows of each class (documented bound; held-out ids excluded).

    Without rows of both classes every score is that class's label, or 0.5 without any row.
    """
    sample, model = Sample(docs, labels, "quality", per_class, **names), Mil()
    if len(set(sample.y.tolist())) < 2:
        model.p["out"][:] = 0
        model.p["level"][:] = 0 if not len(sample.y) else 30 * (2 * sample.y[0] - 1)
        return model
    return model.fit(sample.texts, sample.y, sample.weights)


def quality_score(model: Mil, text: Column) -> Column:
    """Score of each whole text, 0 to 1, higher for better; null and empty texts have one too."""

    @F.arrow_udf("double")  # the model travels with the function: its size is fixed by its parameters
    def score(texts: pa.Array) -> pa.Array:
        batch = pa.RecordBatch.from_arrays([texts], names=["t"])
        parts = [model.score(b.column("t")) for b in tb.blocks(batch, "t", SCORE_BYTES)]
        return pa.array(np.concatenate(parts) if parts else np.zeros(0), pa.float64())

    return score(text)


def score_quality(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", **fit: int) -> DataFrame:
    """All rows and columns of ``docs`` in a struct ``row``, with ``score``.

    Null, empty and blank texts are a bag of one passage without words. A null id is never held out and
    has no label; repeated rows are scored one by one. Extra columns, whatever their names, stay in
    ``row``. An empty table gives an empty result.
    """
    model = fit_quality(docs, labels, id_col=id_col, text_col=text_col, **fit)
    out = docs.select(F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("row"))
    return out.withColumn("score", quality_score(model, F.col("row").getField(text_col)))
