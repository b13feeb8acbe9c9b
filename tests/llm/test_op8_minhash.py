import random
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tests.llm.conftest import SF, WORDS, components, near
from tests.llm.test_textblocks import thue_morse
from voxloom.llm import minhash_forest as m


def shingle_set(text, size):
    w = bytes(text or "", "utf8").lower().split()
    return frozenset(tuple(w[i : i + size]) for i in range(len(w) - size + 1)) if len(w) >= size else frozenset([tuple(w)] if w else [])


def brute(rows, size, percent=80):
    sets = [shingle_set(t, size) for _, t in rows]
    pairs = []
    for a in range(len(rows)):
        for b in range(a):
            if sets[a] and sets[b] and None not in (rows[a][0], rows[b][0]):
                common = len(sets[a] & sets[b])
                if 100 * common >= percent * (len(sets[a]) + len(sets[b]) - common):
                    pairs.append((rows[a][0], rows[b][0]))
    comp = components({r[0] for r in rows if r[0] is not None}, pairs)
    return Counter((i, len(s), comp.get(i), i is None or comp[i] == i) for (i, _), s in zip(rows, sets))


def got(df, size):
    return Counter(tuple(r) for r in m.minhash_dedup(df, size=size).select("doc_id", "n_shingles", "component_id", "kept").collect())


@pytest.mark.parametrize("size", [4, 5])
def test_edge_rows(docs, rows, size):
    """Repeated rows, an id with two texts, null ids, blank and very long texts."""
    assert got(docs, size) == brute([(r[0], r[1]) for r in rows], size)


def test_ids_with_several_texts(spark):
    rng = random.Random(3)
    x, y, z = (rng.choices(WORDS, k=60) for _ in range(3))
    rows = [(5, x), (5, z), (9, z), (3, near(rng, x, 1)), (7, y), (9, near(rng, y, 1)), (11, x), (12, y[:30])]
    rows = [(i, " ".join(w)) for i, w in rows]
    assert got(spark.createDataFrame(rows, "doc_id long, text string"), 4) == brute(rows, 4)


def test_ids_of_other_types(spark):
    rng = random.Random(8)
    x = rng.choices(WORDS, k=60)
    rows = [("b", " ".join(x)), ("a", " ".join(near(rng, x, 1))), ("c", "alone here"), (None, " ".join(x))]
    assert got(spark.createDataFrame(rows, "doc_id string, text string"), 4) == brute(rows, 4)


def test_words_that_regular_hashes_confuse(spark):
    one, two = thue_morse("a", "b")
    rows = [(1, " ".join([one, "x"] * 20)), (2, " ".join([two, "x"] * 20))]
    assert got(spark.createDataFrame(rows, "doc_id long, text string"), 4) == brute(rows, 4)


@settings(max_examples=60, deadline=None)
@given(st.integers(0, 10**6), st.integers(1, 2500), st.integers(0, 400), st.integers(0, 400))
def test_sketches_never_deny_a_link(seed, common, a, b):
    rng = np.random.default_rng(seed)
    flat = rng.integers(0, 2**63, common + a + b, dtype=np.uint64)
    sets = [flat[: common + a], np.concatenate([flat[:common], flat[common + a :]])]
    first = np.cumsum([0, common + a, common + b])
    odd = m.odd_sketches(np.concatenate(sets), first)
    assert all(len(o) * 8 > n and len(o) * 8 >= m.LEAST_BITS for o, n in zip(odd, np.diff(first)))
    may = m.may_link(odd, np.diff(first), np.array([0]), np.array([1]), 80)[0]
    assert may or 100 * common < 80 * (common + a + b)
    if common < a + b and min(a, b) > 50:
        assert not may


def test_orders():
    for depth in range(m.START, m.DEEPEST + 1):
        forest = m.orders(depth, 80)
        assert (1 - 0.8**depth) ** len(forest) <= m.MISSED and forest.shape[1] == depth + 2
        assert all(len(set(o)) == depth + 2 for o in forest.tolist())


def test_table(spark):
    df = spark.read.parquet(f"{SF}/documents.parquet")
    assert got(df, 4) == brute([(r["doc_id"], r["text"]) for r in df.collect()], 4)


@pytest.mark.parametrize("window, crowd, deepest", [(2, 8, 3), (2, 8, 2), (31, 4096, 6)])
def test_crowded_regions(spark, monkeypatch, window, crowd, deepest):
    """A large group whose members link with some and not with others; small bounds force every path."""
    monkeypatch.setattr(m, "WINDOW", window)
    monkeypatch.setattr(m, "CROWD", crowd)
    monkeypatch.setattr(m, "BLOCK", 16)
    monkeypatch.setattr(m, "DEEPEST", deepest)
    rng = random.Random(5)
    base = rng.choices(WORDS, k=80)
    rows = [(i, " ".join(near(rng, base, rng.randrange(0, 9)))) for i in range(150)]
    rows += [(500 + i, " ".join(rng.choices(WORDS, k=40) + base[:9])) for i in range(60)]
    rng.shuffle(rows)
    assert got(spark.createDataFrame(rows, "doc_id long, text string").repartition(5), 4) == brute(rows, 4)


@pytest.mark.parametrize("others, deepest", [(1024, 6), (40, 6), (0, 6), (0, 2), (3, 3)])
def test_large_group_of_near_copies(spark, monkeypatch, others, deepest):
    """All but a few classes of a crowded region are linked: those few meet all at once, and no deeper order has to part them."""
    depths, place = [], m._place
    for name, value in (("WINDOW", 2), ("BLOCK", 16), ("CROWD", 8), ("OTHERS", others), ("DEEPEST", deepest)):
        monkeypatch.setattr(m, name, value, raising=False)
    monkeypatch.setattr(m, "_place", lambda classes, depth, percent: depths.append(depth) or place(classes, depth, percent))
    rng = random.Random(6)
    base = rng.choices(WORDS, k=80)
    rows = [(i, " ".join(near(rng, base, rng.randrange(0, 3)))) for i in range(120)] + [(300 + i, " ".join(near(rng, base, rng.randrange(3, 9)))) for i in range(50)]
    rng.shuffle(rows)
    assert got(spark.createDataFrame(rows, "doc_id long, text string").repartition(5), 4) == brute(rows, 4)
    assert others < 1024 or depths == [m.START]


def test_chain(spark):
    words = [f"c{i}" for i in range(60)]
    rows = []
    for i in range(25):
        rows.append((1000 - i, " ".join(words)))
        words = [*words[1:], f"n{i}"]
    assert got(spark.createDataFrame(rows, "doc_id long, text string"), 4) == brute(rows, 4)


def test_empty(empty):
    assert m.minhash_dedup(empty).count() == 0
