"""Every query on the library's own operators against its SQL."""

import duckdb
import pytest

from voxloom.functions import lexicon as lx
from voxloom.plans import registry

SF = "/root/testdata/sf0.001"
TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


@pytest.fixture(scope="module")
def sql():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


def rows(columns, data):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    show = lambda v: f"{v:.9g}" if isinstance(v, float) else str(v)
    return sorted([tuple(show(r[i]) for i in order) for r in data])


@pytest.mark.parametrize("name", sorted(registry.queries()))
def test_query(spark, sql, name):
    df = registry.queries()[name](spark, SF)
    got = rows(df.columns, [tuple(r) for r in df.collect()])
    if name not in registry.oracles():
        assert got
        return
    result = sql.execute(registry.oracles()[name])
    names = [d[0] for d in result.description]
    assert sorted(names) == sorted(df.columns) and got == rows(names, result.fetchall())


def test_entry(spark):
    df = registry.entry(spark, SF)
    assert df.columns == ["doc_id", "clean", "changed"] and df.count() > 0


def test_whole_keys(spark, sql):
    """Every key is spelled, none as another one, and millions and billions occur."""
    keys = sql.execute("SELECT count(DISTINCT l_orderkey) FROM lineitem").fetchone()[0]
    for name, words in (("spoken_whole", "f"), ("normalize_counted_whole", "stt")):
        out = registry.queries()[name](spark, SF).collect()
        assert len({r["n"] for r in out}) == len(out) == keys
        assert any(lx.BILLION in r[words] for r in out) and any(lx.MILLION in r[words] for r in out)
