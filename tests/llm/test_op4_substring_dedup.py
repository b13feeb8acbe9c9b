import hashlib
import random
from collections import Counter

import pytest

from tests.llm.conftest import SF, WORDS
from tests.llm.test_textblocks import thue_morse
from voxloom.llm import substring_dedup as own
from voxloom.llm.substring_dedup import substring_dedup


def brute(rows, window):
    last = 2**63 - 1
    first = {}
    split = [(last if i is None else i, (t or "").encode().split()) for i, t in rows]
    for i, w in split:
        for p in range(len(w) - window + 1):
            k = tuple(w[p : p + window])
            first[k] = min(first.get(k, i), i)
    out = []
    for (i, w), (real, _) in zip(split, rows):
        gone = set()
        for p in range(len(w) - window + 1):
            if first[tuple(w[p : p + window])] < i:
                gone.update(range(p, p + window))
        kept = [x for j, x in enumerate(w) if j not in gone]
        out.append((real, len(w), len(gone), hashlib.sha256(b" ".join(kept)).hexdigest(), kept))
    return out


def check(df, rows, window):
    got = substring_dedup(df, window=window).select("row.doc_id", "row.text", "n_words", "n_removed", "kept_sha256", "clean_text").collect()
    expected = brute(rows, window)
    assert Counter((r[0], *r[2:5]) for r in got) == Counter(e[:4] for e in expected)
    texts = Counter((r[0], tuple((r[5] or "").encode().split())) for r in got)
    assert texts == Counter((e[0], tuple(e[4])) for e in expected)
    for r in got:
        assert r[5] == r[1] if not r[3] else len(r[5]) < len(r[1])


def test_edge_rows(docs, rows):
    check(docs, [(r[0], r[1]) for r in rows], 13)
    check(docs, [(r[0], r[1]) for r in rows], 5)


def test_single_shared_window(spark):
    shared = [f"s{i}" for i in range(13)]
    rows = [(i, " ".join([f"a{i}_{j}" for j in range(i * 3)] + shared + [f"b{i}_{j}" for j in range(9)])) for i in range(8)]
    rows += [(20, " ".join(shared)), (21, " ".join(shared[:12])), (22, " ".join(shared + shared))]
    check(spark.createDataFrame(rows, "doc_id long, text string"), rows, 13)


def test_table(spark):
    df = spark.read.parquet(f"{SF}/documents.parquet")
    check(df, [(r["doc_id"], r["text"]) for r in df.collect()], 13)


def test_words_that_regular_hashes_confuse(spark):
    """Documents that repeat nothing lose nothing."""
    one, two = thue_morse("a", "b")
    rows = [(1, " ".join([one] * 13)), (2, " ".join([two] * 13)), (3, " ".join([one] * 6 + [two] * 7))]
    check(spark.createDataFrame(rows, "doc_id long, text string"), rows, 13)


@pytest.mark.parametrize("bucket, block", [(50, 400), (10**6, 2000)])
def test_many_buckets_and_blocks(spark, monkeypatch, bucket, block):
    """Small bounds: windows of one document meet over many buckets, copies over many blocks."""
    monkeypatch.setattr(own, "BUCKET", bucket)
    monkeypatch.setattr(own, "BLOCK_BYTES", block)
    rng = random.Random(4)
    base = [rng.choices(WORDS, k=60) for _ in range(6)]
    rows = []
    for i in range(150):
        b = rng.choice(base)
        a, z = sorted(rng.choices(range(60), k=2))
        rows.append((i, " ".join(rng.choices(WORDS, k=rng.randrange(5)) + b[a:z] + rng.choices(WORDS, k=rng.randrange(20)))))
    check(spark.createDataFrame(rows, "doc_id long, text string").repartition(4), rows, 13)
    rows += rows[:40] + [(None, rows[3][1])] * 5
    check(spark.createDataFrame(rows, "doc_id long, text string").repartition(4), rows, 13)


def test_ids_of_other_types(spark):
    text = " ".join(WORDS[:20])
    for kind, ids in (("long", [2**63 - 1, None, 2**63 - 2]), ("long", [-(2**63), 2**63 - 1, None]), ("string", ["b", "a", None]), ("double", [0.5, -1.0, None])):
        df = spark.createDataFrame([(i, text) for i in ids], f"doc_id {kind}, text string")
        got = {r["doc_id"]: r["n_removed"] for r in substring_dedup(df).select("row.doc_id", "n_removed").collect()}
        least = min(i for i in ids if i is not None)
        assert got == {i: 0 if i == least else 20 for i in ids}


def test_columns_and_empty(docs, empty):
    assert substring_dedup(docs).select("row.*").columns == docs.columns
    assert substring_dedup(empty).count() == 0
