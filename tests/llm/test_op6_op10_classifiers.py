import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from voxloom.llm import conv_text, labelled, mil, quality_classifier, toxicity

SF = "/root/testdata/sf0.01"
CASES = {
    "toxic": (lambda d, y: toxicity.fit_toxicity(d, y), toxicity.toxicity_score, 0.7, 0.55, 0.97),
    "quality": (lambda d, y: quality_classifier.fit_quality(d, y), quality_classifier.quality_score, 0.5, 0.95, 0.95),
}


@pytest.fixture(scope="module")
def tables(spark):
    return [spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels")]


@pytest.mark.parametrize("label", CASES)
def test_held_out(spark, tables, label):
    fit, score, cut, least_recall, least_clean = CASES[label]
    docs, labels = tables
    held = labelled.held_out("doc_id")
    # labels of held-out rows say the opposite here: they must not matter
    wrong = labels.withColumn(label, F.when(held, 1 - F.col(label)).otherwise(F.col(label)))
    a, b = (docs.select("doc_id", score(fit(docs, y), docs["text"]).alias("s")) for y in (labels, wrong))
    scores = {r["doc_id"]: r["s"] for r in a.collect()}
    assert scores == {r["doc_id"]: r["s"] for r in b.collect()} and all(0 <= s <= 1 for s in scores.values())
    tested = [(scores[r["doc_id"]] >= cut, r[label] == 1) for r in labels.where(held).collect()]
    hits = [p for p, y in tested if y]
    assert sum(hits) / len(hits) >= least_recall
    assert sum(p == y for p, y in tested) / len(tested) >= 0.9
    if label == "toxic":
        assert sum(not p for p, y in tested if not y) / sum(not y for _, y in tested) >= least_clean


@pytest.mark.parametrize("label", CASES)
def test_edges(spark, docs, empty, tables, label):
    fit, score, *_ = CASES[label]
    real, labels = tables
    model = fit(real, labels)
    got = docs.select(score(model, docs["text"]).alias("s")).collect()
    assert len(got) == docs.count() and all(0 <= r["s"] <= 1 for r in got)
    assert empty.select(score(model, empty["text"]).alias("s")).count() == 0
    odd = spark.createDataFrame([(None, 1, 1), (1, None, None), (105, 1, 1), (105, 0, 0)], "doc_id long, quality int, toxic int")
    for some in (labels.where("false"), odd):
        model = fit(docs, some)
        assert {r["s"] for r in docs.select(score(model, docs["text"]).alias("s")).collect()} <= {0.5, *[x for x in [model.score(pa.array(["a"]))[0] if label == "quality" else model.net.score(pa.array(["a"]))[0]]]}


def test_held_out_rule(spark):
    ids = [0, 1, 17, -5, 10**15]
    got = spark.createDataFrame([(i,) for i in ids], "doc_id long").select(labelled.held_out("doc_id")).collect()
    assert [r[0] for r in got] == [zlib.crc32(str(i).encode()) % 3 == 1 for i in ids]
    assert spark.range(1).select(labelled.held_out(F.lit(None).cast("long"))).first()[0] is False


def test_language_sets_thresholds_only(spark, tables):
    docs, labels = tables
    a = toxicity.score_toxicity(docs, labels).select("row.doc_id", "score", "rejected")
    b = toxicity.score_toxicity(docs.withColumn("lang", F.lit(None).cast("string")), labels).select("row.doc_id", "score")
    assert {r["doc_id"]: r["score"] for r in a.collect()} == {r["doc_id"]: r["score"] for r in b.collect()}


def test_best_cut():
    rng = np.random.default_rng(4)
    assert toxicity.best_cut(np.array([-2.0, -1.0, 1.0, 2.0]), np.array([0, 0, 1, 1]), 3.0) == 0.0
    for _ in range(30):
        x, y = rng.normal(size=40), rng.integers(0, 2, 40)
        y[:2] = 0, 1
        cost = lambda t: ((x < t) & (y == 1)).sum() / (y == 1).sum() + 3 * ((x >= t) & (y == 0)).sum() / (y == 0).sum()  # noqa: B023, E731
        s = np.sort(x)
        assert cost(toxicity.best_cut(x, y, 3.0)) == pytest.approx(min(cost(t) for t in (s[1:] + s[:-1]) / 2))


def test_calibration():
    """The cut of all rows scores the verdict; a language with many rows has its own, one with few is drawn to all."""
    rng = np.random.default_rng(2)
    y = np.tile([0, 1], 400)
    langs = ["a"] * 500 + ["b"] * 296 + ["c"] * 4
    logits = rng.normal(size=800) * 0.3 + 4 * y + np.array([0.0] * 500 + [3.0] * 300)
    shift, found = toxicity.calibrate(logits, y, langs, 3.0, 20.0, 0.7)
    logit = {k: np.log(v / (1 - v)) - shift for k, v in found.items()}
    every = np.log(0.7 / 0.3) - shift
    assert every == pytest.approx(toxicity.best_cut(logits, y, 3.0))
    assert logit["a"] < every < logit["b"] and abs(logit["a"] - 2) < 0.8 and abs(logit["b"] - 5) < 0.8 and abs(logit["c"] - every) < 0.5


def test_recall_by_language(spark):
    """On rows that were held out: at the thresholds of their languages, and at the contract's score."""
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    scored = toxicity.score_toxicity(docs, labels).select("row.doc_id", "row.lang", "score", "rejected").join(labels, "doc_id").where(labelled.held_out("doc_id"))
    by = {}
    for r in scored.collect():
        if r["toxic"] is not None:
            by.setdefault((r["lang"], r["toxic"]), []).append((r["rejected"], r["score"] >= 0.7))
    langs = {k[0] for k in by}
    assert len(langs) == 4
    for lang in langs:
        for which in (0, 1):
            hits, alarms = ([x[which] for x in by[lang, t]] for t in (1, 0))
            assert sum(hits) / len(hits) >= 0.75 and sum(alarms) / len(alarms) <= 0.04, (lang, which)


def test_sample_is_bounded(spark, tables):
    """A repeated id gives one text, and texts beyond the bound none, whatever the names of the columns."""
    rows = [(i, f"text {i}", "en", i % 2) for i in range(40)] + [(3, f"other {i}", "en", 1) for i in range(500)] + [(5, "x" * 5000, "en", 1)]
    df = spark.createDataFrame(rows, "`doc.id` long, `te.xt` string, `la.ng` string, `la.bel` int")
    s = labelled.Sample(df, df.select("`doc.id`", "`la.bel`"), "la.bel", 8, id_col="doc.id", text_col="te.xt", lang_col="la.ng", text_bytes=1000)
    assert len(s.y) == len(s.langs) == len(s.texts) <= 16 and (s.y == 0).sum() == (s.y == 1).sum() == 8 and max(map(len, s.texts.to_pylist())) < 1000
    again = labelled.Sample(df.repartition(9), df.select("`doc.id`", "`la.bel`"), "la.bel", 8, id_col="doc.id", text_col="te.xt", lang_col="la.ng", text_bytes=1000)
    assert again.texts.equals(s.texts)


def test_conv_scores_by_hand():
    """A text's score from plain loops over words, taps and filters."""
    net = conv_text.ConvText(buckets=64, dim=3, filters=2, seed=4)
    rng = np.random.default_rng(1)
    net.bias, net.level = rng.normal(size=net.bias.shape).astype(np.float32), 0.3
    net.freeze()
    texts = ["one two three four two", "", None, "single", "a b"]
    for text, got in zip(texts, net.logits(pa.array(texts, pa.string())), strict=True):
        ids, _ = net.features(pa.array([text], pa.string()))
        x = net.embed[ids[:, 0]] + net.embed[ids[:, 1]]
        logit = net.level
        for k, bias, out in zip(net.kernels, net.bias, net.out):
            for f in range(net.filters):
                tops = [sum(float(x[i + j] @ k[j][:, f]) for j in range(len(k))) for i in range(len(x) - len(k) + 1)]
                logit += out[f] * max(0.0, max(tops, default=0.0) + bias[f])
        assert got == pytest.approx(logit, abs=1e-4)


def test_attention_by_hand():
    """Passages, gated attention weights and score from plain loops; gradients against differences."""
    model = mil.Mil(words=64, shapes=16, dim=3, hidden=4, gate=2, seed=6)
    texts = pa.array([" ".join(f"w{i}" for i in range(150)), "", None, "Few words, 3 lines\nhere here", " ".join(["again and"] * 40)], pa.string())
    bag = model.bags(texts)
    ids, begin, count, extra, first = bag
    assert np.diff(first).tolist() == [3, 1, 1, 1, 2] and count.tolist() == [64, 64, 22, 0, 0, 6, 64, 16]
    p = model.p
    for t in range(5):
        hidden, energy = [], []
        for q in range(first[t], first[t + 1]):
            words = [p["embed"][a] + p["embed"][b] for a, b in ids[begin[q] : begin[q] + count[q]]]
            x = np.concatenate([np.mean(words, 0) if words else np.zeros(3), extra[q]])
            hidden.append(np.tanh(x @ p["enc"] + p["enc_b"]))
            energy.append(float((np.tanh(hidden[-1] @ p["v"]) / (1 + np.exp(-(hidden[-1] @ p["u"])))) @ p["att"]))
        weight = np.exp(energy) / np.exp(energy).sum()
        logit = sum(w * h for w, h in zip(weight, hidden)) @ p["out"] + p["level"][0]
        assert model.score(texts)[t] == pytest.approx(1 / (1 + np.exp(-logit)))
    y = np.array([1, 0, 1, 0, 1.0])
    loss = lambda: float(sum(np.log1p(np.exp(-z)) if t else np.log1p(np.exp(z)) for z, t in zip(model._forward(bag)["logit"], y)))
    f = model._forward(bag)
    grads = model._backward(bag, f, 1 / (1 + np.exp(-f["logit"])) - y)
    rng = np.random.default_rng(0)
    for name, g in grads.items():
        for _ in range(5):
            at = tuple(rng.integers(0, s) for s in g.shape)
            if name == "embed":
                at = (int(rng.choice(ids[:, 0])), at[1])
            old, step = p[name][at], 1e-5
            p[name][at] = old + step
            high = loss()
            p[name][at] = old - step
            assert g[at] == pytest.approx((high - loss()) / (2 * step), rel=1e-3, abs=1e-6), name
            p[name][at] = old
