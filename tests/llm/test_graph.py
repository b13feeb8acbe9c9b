import random

import pytest

from tests.llm.conftest import components as brute
from voxloom.llm.graph import components


@pytest.mark.parametrize("kind", ["random", "chain", "star", "empty", "odd"])
def test_components(spark, kind):
    rng = random.Random(3)
    edges = {
        "random": [(rng.randrange(200), rng.randrange(200)) for _ in range(150)],
        "chain": [(i, i + 1) for i in range(60)],
        "star": [(500, i) for i in range(200)] + [(500, 0)],
        "empty": [],
        "odd": [(1, 1), (2, 1), (1, 2), (2, 1), (-5, 2), (None, 3), (3, None)],
    }[kind]
    got = {r["id"]: r["component"] for r in components(spark.createDataFrame(edges, "a long, b long"), "a", "b").collect()}
    real = [(a, b) for a, b in edges if a is not None and b is not None and a != b]
    assert got == brute({x for e in real for x in e}, real)
