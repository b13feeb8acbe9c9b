import hashlib
import math
from collections import defaultdict

from tests.llm.conftest import SF
from voxloom.llm import mixing


def brute(rows):
    sizes = [len((t or "").encode().split()) for _, t, _ in rows]
    per = defaultdict(int)
    for (_, _, s), n in zip(rows, sizes):
        per[s] += n
    order = sorted(per, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: i % 3 + 1 for i, s in enumerate(order)}
    target, capped, total = {}, set(), sum(per.values())
    while True:  # share what is left by weight until none is above three times its size
        left, weights = total - sum(3 * per[s] for s in capped), sum(weight[s] for s in order if s not in capped)
        target = {s: 3 * per[s] if s in capped else left * weight[s] / weights for s in order}
        over = {s for s in order if s not in capped and target[s] > 3 * per[s]}
        if not over:
            break
        capped |= over
    out = []
    for s in order:
        md5 = lambda t: "null" if t is None else hashlib.md5(str(t).encode()).hexdigest()
        own = sorted((md5(f"17:{'null' if i is None else i}:{md5(t)}"), i is None, i or 0, n) for (i, t, x), n in zip(rows, sizes) if x == s)
        rounds, rest = divmod(math.floor(target[s]), per[s]) if per[s] else (0, 0)
        for _, none, i, n in own:
            part = min(n, rest)
            rest -= part
            out.append((None if none else i, n, s, per[s], target[s], rounds * n + part))
    return out


def check(df, rows):
    got = sorted((tuple(r) for r in mixing.mix_sources(df).select("doc_id", "size", "source", "source_size", "target", "taken").collect()), key=repr)
    expected = sorted(brute(rows), key=repr)
    assert [g[:4] + g[5:] for g in got] == [e[:4] + e[5:] for e in expected]
    assert all(math.isclose(g[4], e[4], rel_tol=1e-12) for g, e in zip(got, expected))
    for source in {g[2] for g in got}:
        own = [g for g in got if g[2] == source]
        assert sum(g[5] for g in own) == math.floor(own[0][4]) and all(g[5] <= 3 * g[1] for g in own)
    return got


def test_edge_rows(docs, rows):
    plain = [(r[0], r[1], r[3]) for r in rows]
    assert check(docs, plain) == check(docs.repartition(7), plain)


def test_repeated_rows(spark):
    """Many equal rows, null ids and one id for many texts: each has a share, and budgets are met to the word."""
    rows = [(None, "a b c", "s")] * 2500 + [(None, f"n{i} x", "s") for i in range(50)] + [(7, f"t{i} y z", "t") for i in range(300)] + [(8, "one two", "t")] * 30
    got = check(spark.createDataFrame(rows, "doc_id long, text string, source string"), rows)
    assert len({g[5] for g in got if g[0] is None and g[1] == 3}) <= 3


def test_many_sources(spark):
    rows = [(i, "w " * (i % 17), f"host{i % 211}") for i in range(900)]
    check(spark.createDataFrame(rows, "doc_id long, text string, source string"), rows)


def test_table(spark):
    df = spark.read.parquet(f"{SF}/documents.parquet")
    check(df, [(r["doc_id"], r["text"], r["source"]) for r in df.collect()])


def test_cap_and_hot_source(spark):
    rows = [(i, "w " * 40, "hot") for i in range(300)] + [(1000 + i, "x y", s) for i, s in enumerate("abcde")] + [(2000, "", "none"), (2001, None, "none")]
    check(spark.createDataFrame(rows, "doc_id long, text string, source string"), rows)


def test_without_words_and_rows(spark, empty):
    rows = [(1, "", "a"), (2, None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    assert sorted(tuple(r)[-2:] for r in mixing.mix_sources(df).collect()) == [(0.0, 0), (0.0, 0)]
    assert mixing.mix_sources(empty).count() == 0
