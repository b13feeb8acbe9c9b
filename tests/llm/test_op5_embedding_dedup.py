import tracemalloc

import numpy as np
import pyarrow as pa
import pytest

from tests.llm.conftest import components
from voxloom.llm import embedding_dedup as e


def brute(rows, threshold=0.98):
    def fine(i, v, label):
        return i is not None and label is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)

    def cosine(u, v):
        u, v = np.array(u, np.float32).astype(float), np.array(v, np.float32).astype(float)
        return u @ v / (np.sqrt(u @ u) * np.sqrt(v @ v))

    links, count = [], [0] * len(rows)
    for a in range(len(rows)):
        for b in range(a):
            (i, u, p), (j, v, q) = rows[a], rows[b]
            if fine(*rows[a]) and fine(*rows[b]) and p == q and len(u) == len(v) and cosine(u, v) >= threshold:
                count[a] += 1
                count[b] += 1
                links.append((i, j))
    comp = components({r[0] for r in rows if r[0] is not None}, links)
    return sorted(((r[0], n, comp.get(r[0]), r[0] is None or comp[r[0]] == r[0]) for r, n in zip(rows, count)), key=repr)


def check(spark, rows):
    df = spark.createDataFrame([(*r, "extra", 1) for r in rows], "vec_id long, embedding array<float>, label int, id string, node int").repartition(3)
    assert sorted((tuple(r) for r in e.embedding_dedup(df).collect()), key=repr) == brute(rows)


def test_edge_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (1, [1.0, 0.0], 1), (2, [1.0, 0.0], 1), (3, [1.0, 0.1], 1), (4, [1.0, 0.0], 2), (5, [1.0, 0.0], None), (6, None, 1), (7, [0.0, 0.0], 1), (8, [], 1), (9, [None, 1.0], 1), (10, [nan, 1.0], 1),
        (11, [inf, 1.0], 1), (12, [-0.0, 1.0], 1), (13, [0.0, 1.0], 1), (14, [1.0, 0.0, 0.0], 1), (None, [1.0, 0.0], 1), (15, [1e30, 0.0], 1), (16, [1e-30, 0.0], 1), (17, [-1.0, 0.0], 1),
    ]
    check(spark, rows)


@pytest.mark.parametrize("block", [16, 1024])
def test_crowded_cells(spark, monkeypatch, block):
    monkeypatch.setattr(e, "BLOCK", block)
    rng = np.random.default_rng(1)
    centre, chain = rng.normal(size=16), rng.normal(size=16)
    rows = [(i, (centre + rng.normal(size=16) * 0.08).tolist(), 1) for i in range(80)]
    rows += [(100 + i, rng.normal(size=16).tolist(), int(i % 3)) for i in range(60)]
    rows += [(200 + i, (chain + i * 0.15 * np.roll(chain, 1)).tolist(), 2) for i in range(12)] + [(300 + i, centre.tolist(), 1) for i in range(20)]
    check(spark, [(i, np.array(v, np.float32).tolist(), p) for i, v, p in rows])


def test_no_link_is_lost_between_cells():
    rng = np.random.default_rng(2)
    x = e._unit(rng.normal(size=(1500, 8)))
    y = e._unit(x + rng.normal(size=x.shape) * 0.05)
    for k in (4, 16, 64):
        cells = e.Cells(e._spherical_kmeans(x, k), float(np.sqrt(2 - 2 * 0.98)))
        home, _, _ = cells.assign(x)
        _, row, cell = cells.assign(y)
        member = np.zeros((len(y), len(cells.centres)), bool)
        member[row, cell] = True
        linked = (x * y).sum(1) >= 0.98
        assert linked.sum() > 100 and member[np.arange(len(x))[linked], home[linked]].all()


def test_many_lengths(spark, monkeypatch):
    """Lengths beyond the most frequent ones are compared too, each among themselves."""
    monkeypatch.setattr(e, "LENGTHS", 2)
    rng = np.random.default_rng(6)
    rows = []
    for dim in range(2, 9):
        base = rng.normal(size=dim)
        rows += [(100 * dim + i, np.array(base + rng.normal(size=dim) * 0.05, np.float32).tolist(), int(i % 2)) for i in range(12 - dim)]
    check(spark, rows)


def test_spanning():
    rng = np.random.default_rng(3)
    for _ in range(40):
        left, right = rng.choice(60, 12, replace=False), rng.choice(60, 15, replace=False)
        linked = rng.random((12, 15)) < 0.12
        edges = list(zip(*(x.tolist() for x in e._spanning(linked, left, right))))
        nodes = {*left.tolist(), *right.tolist()}
        assert components(nodes, edges) == components(nodes, [(int(left[i]), int(right[j])) for i, j in zip(*np.nonzero(linked))]) and len(edges) < len(nodes)


def test_ids_of_other_types(spark):
    df = spark.createDataFrame([("b", [1.0, 0.0], 1), ("a", [1.0, 0.01], 1), ("c", [0.0, 1.0], 1), (None, [1.0, 0.0], 1)], "vec_id string, embedding array<float>, label int")
    assert {tuple(r) for r in e.embedding_dedup(df).collect()} == {("b", 1, "a", False), ("a", 1, "a", True), ("c", 0, "c", True), (None, 0, None, True)}


def test_empty(spark):
    assert e.embedding_dedup(spark.createDataFrame([], "vec_id long, embedding array<float>, label int")).count() == 0


@pytest.mark.parametrize("rows", [20_000, 15_000_000])
def test_cells_of_vectors_without_structure(rows):
    """However many rows, a vector has few cells, as each is a copy of it."""
    x = e._unit(np.random.default_rng(8).normal(size=(6000, 64)))
    cells = e.fit_cells(x, np.arange(6000) % 10, rows, 0.98)
    assert len(cells.assign(x)[1]) <= 4 * len(x)


def test_memory_of_a_task():
    """Many cells that a batch is all a member of, and blocks that link as a whole."""
    rng = np.random.default_rng(9)
    x = rng.normal(size=(4000, 16)).astype(np.float32)
    cells = e.Cells(e._unit(rng.normal(size=(4000, 16))), 2.0)
    flat = pa.array((np.ones((2048, 16)) + rng.normal(size=(2048, 16)) * 1e-3).astype(np.float32).tolist(), pa.list_(pa.float32()))
    ids = pa.array(np.arange(2048))
    left = pa.table({"node": ids, "key": ids, "copies": ids, "x": flat})
    batch = pa.RecordBatch.from_arrays([pa.array(["a"] * 4000), *[pa.array(np.arange(4000))] * 3, pa.array(x.tolist(), pa.list_(pa.float32()))], names=["label", "node", "key", "copies", "x"])
    tracemalloc.start()
    try:
        parts = e._placing(cells, 16)(iter([batch]))
        assert sum(next(parts).num_rows for _ in range(20)) <= 20 * 8192 and tracemalloc.get_traced_memory()[1] < 200e6
        tracemalloc.reset_peak()
        found = e._multiplied(0.98)(left, left.rename_columns(["m_node", "m_key", "m_copies", "m_x"]))
        assert found.num_rows == 2 * 2048 - 1 and tracemalloc.get_traced_memory()[1] < 150e6
    finally:
        tracemalloc.stop()


def test_rounds(spark, monkeypatch):
    """What meets in blocks is moved in several rounds; together they have every link."""
    for name, value in (("BLOCK", 8), ("LEAST_COPIES", 40), ("COPIES", 1)):
        monkeypatch.setattr(e, name, value)
    rng = np.random.default_rng(10)
    centre = rng.normal(size=16)
    rows = [(i, (centre + rng.normal(size=16) * 0.08).tolist(), 1) for i in range(60)] + [(100 + i, rng.normal(size=16).tolist(), int(i % 2)) for i in range(30)]
    check(spark, [(i, np.array(v, np.float32).tolist(), p) for i, v, p in rows])
