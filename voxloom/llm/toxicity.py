"""Toxicity scores of whole texts, with thresholds calibrated by language."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import textblocks as tb
from .conv_text import ConvTexts
from .labelled import Sample

#: Bytes of text scored at once: small, so that a block's filter values stay in the processor's cache.
SCORE_BYTES = 1 << 18


@dataclass
class ToxicityModel:
    """A fitted classifier, and from which score a text of a language is toxic.

    ``thresholds`` has the languages of the calibration rows; any other, and a null language, takes
    ``default``, the threshold of all of them. The language never changes a score.
    """

    net: ConvTexts
    thresholds: dict[str, float]
    default: float

    def threshold(self, lang: Column) -> Column:
        pairs = [x for k, v in sorted(self.thresholds.items()) for x in (F.lit(k), F.lit(v))]
        return F.coalesce(F.create_map(*pairs)[lang], F.lit(self.default)) if pairs else F.lit(self.default)


def best_cut(logits: np.ndarray, y: np.ndarray, alarms: float) -> float:
    """Where the share of toxic rows below plus ``alarms`` times the share of clean rows above is least.

    It lies in the middle between two neighbouring rows, of several such places the widest.
    """
    order = np.argsort(logits, kind="stable")
    x, toxic = logits[order], y[order] == 1
    below = np.concatenate([[0], np.cumsum(toxic)]) / max(1, toxic.sum())
    above = np.concatenate([np.cumsum(~toxic[::-1])[::-1], [0]]) / max(1, (~toxic).sum())
    cost = (below + alarms * above)[1:-1]
    gap = np.diff(x)
    at = np.lexsort((-gap, np.round(cost, 12)))[0]
    return float((x[at] + x[at + 1]) / 2)


def calibrate(logits: np.ndarray, y: np.ndarray, langs: list[str | None], alarms: float, prior: float, verdict: float) -> tuple[float, dict[str, float]]:
    """What to add to all logits so that the best cut of all rows scores ``verdict``, and each language's threshold then.

    A language's own best cut is drawn towards that of all rows as if the latter had ``prior`` rows of
    its rarer class; a language without rows of both classes takes it as it is.
    """
    every = best_cut(logits, y, alarms)
    shift = float(np.log(verdict / (1 - verdict))) - every
    found, langs = {}, np.array([x or "" for x in langs])
    for lang in sorted(set(langs.tolist()) - {""}):
        own = langs == lang
        rows = min(int((y[own] == 0).sum()), int((y[own] == 1).sum()))
        cut = (rows * best_cut(logits[own], y[own], alarms) + prior * every) / (rows + prior) if rows else every
        found[lang] = float(1 / (1 + np.exp(-cut - shift)))
    return shift, found


def fit_toxicity(docs: DataFrame, labels: DataFrame, per_class: int = 2000, alarms: float = 3.0, prior: float = 20.0, verdict: float = 0.7, **names: str) -> ToxicityModel:
    """Fit on at most ``per_class`` labelled rows of each class (documented bound; held-out ids excluded).

    Every fourth of them is kept from the fit and calibrates the very model that scores: the best cut
    of all these rows scores ``verdict``, and each language has a threshold near it. Without rows of
    both classes every score is 0 and no text is toxic.
    """
    sample = Sample(docs, labels, "toxic", per_class, lang_col=names.pop("lang_col", "lang"), **names)
    y, net = sample.y, ConvTexts()
    part = np.zeros(len(y), bool)
    for c in (0, 1):
        part[np.flatnonzero(y == c)[3::4]] = True
    if min((y[~part] == 0).sum(), (y[~part] == 1).sum()) == 0:
        for one in net.nets:
            one.level, one.out = -30.0, one.out * 0
            one.freeze()
        return ToxicityModel(net, {}, verdict)
    net.fit(sample.texts.filter(pa.array(~part)), y[~part], sample.weights[~part])
    if min((y[part] == 0).sum(), (y[part] == 1).sum()) == 0:  # fewer than four rows of a class
        return ToxicityModel(net, {}, verdict)
    langs = [x for x, p in zip(sample.langs, part, strict=True) if p]
    shift, found = calibrate(net.logits(sample.texts.filter(pa.array(part))), y[part], langs, alarms, prior, verdict)
    for one in net.nets:
        one.level += shift
    return ToxicityModel(net, found, verdict)


def toxicity_score(model: ToxicityModel, text: Column) -> Column:
    """Score of each whole text, 0 to 1; null and empty texts have one too."""

    @F.arrow_udf("double")  # the model travels with the function: its size is fixed by its parameters
    def score(texts: pa.Array) -> pa.Array:
        batch = pa.RecordBatch.from_arrays([texts], names=["t"])
        parts = [model.net.score(b.column("t")) for b in tb.blocks(batch, "t", SCORE_BYTES)]
        return pa.array(np.concatenate(parts) if parts else np.zeros(0), pa.float64())

    return score(text)


def score_toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", **fit: int) -> DataFrame:
    """All rows and columns of ``docs`` in a struct ``row``, with ``score`` and ``rejected`` (score at
    or above the threshold of the row's language).

    Null, empty and blank texts have the score of a text without words. A null id is never held out and
    has no label; repeated rows are scored one by one. Extra columns, whatever their names, stay in
    ``row``. An empty table gives an empty result, whatever the labels.
    """
    model = fit_toxicity(docs, labels, id_col=id_col, text_col=text_col, lang_col=lang_col, **fit)
    out = docs.select(F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("row"))
    out = out.withColumn("score", toxicity_score(model, F.col("row").getField(text_col)))
    return out.withColumn("rejected", F.col("score") >= model.threshold(F.col("row").getField(lang_col)))
