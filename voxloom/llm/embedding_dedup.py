"""Embedding near-dedup: spherical k-means cells, blocked cosine products within cells.

Equal vectors of a label are one node, so copies meet once. Centres are fitted on a bounded sample and
only divide the work: every vector has the cell of its nearest centre as home and is a guest in every
other cell whose vectors it could reach. If u and v have unit length and cosine at least t, then
|u - v| <= r = sqrt(2 - 2t); u lies on its own side of the plane half-way between the centres c and c',
so v lies at most r beyond it: a guest of c is every v with v.(c' - c) / |c' - c| <= r, where c' is its
home. Hence each home vector meets all its links in its home cell, and no link is lost.

A cell is cut into blocks of bounded size by a hash; a task multiplies a block of home vectors with a
block of members, some rows at a time, sums the links of each row and keeps for the components one
edge per row and component of those, never all pairs.

Only cells with a bounded number of guests are chosen: memory and disk follow the rows, also where
nothing can be pruned and the products are those of all pairs. The vectors that meet in blocks are
moved in rounds, so that the copies on disk at once are a bounded multiple of the rows as well.
"""

from __future__ import annotations

import functools
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .graph import components
from .ids import Ids
from .shared import discard, stage

#: Vectors of a block at most, about, and numbers in them.
BLOCK, BLOCK_NUMBERS = 2048, 1 << 21
#: Distinct vectors on which centres are fitted, at most, and numbers in them.
SAMPLE, SAMPLE_NUMBERS = 20_000, 1 << 23
#: Products that cost about as much as moving a vector to one more cell.
MOVE = 500
#: Numbers of cells to choose from; the sample supports no more.
CELLS = (1, 4, 16, 64, 256, 1024, 4096)
#: Cells of a vector at most, on the average of the sample: each is a copy on disk.
MEMBER = 4
#: Copies of vectors that meet in blocks in one round, for each row of the table of cells, and at least.
COPIES, LEAST_COPIES = 4, 500_000
#: Lengths of vectors that have cells of their own, the most frequent ones; the rest is compared by label and length alone.
LENGTHS = 8
_ROWS = 1024
#: Numbers of a matrix that a task works out at once, and vectors of a batch that it sends on.
_NUMBERS, _SENT = 1 << 19, 8192
#: Slack of the products in float64, within which the cosine is recomputed as defined.
_NEAR = 1e-9


@dataclass
class Cells:
    """Unit centres, and what decides home and guest cells."""

    centres: np.ndarray
    radius: float

    def assign(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Home cell of each unit vector, and rows and cells of all memberships."""
        step = max(1, _NUMBERS // len(self.centres))
        homes, rows, cells = [], [], []
        for at in range(0, len(x), step):
            s = x[at : at + step] @ self.centres.T
            home = s.argmax(1)
            own = np.arange(len(home))
            gaps = np.sqrt(np.maximum(0, 2 - 2 * self.centres[home] @ self.centres.T))
            member = s[own, home][:, None] - s <= self.radius * gaps + _NEAR
            member[own, home] = True
            row, cell = np.nonzero(member)
            homes.append(home)
            rows.append(row + at)
            cells.append(cell)
        none = np.zeros(0, np.int64)
        return tuple(np.concatenate([none, *parts]) for parts in (homes, rows, cells))


def _spherical_kmeans(x: np.ndarray, k: int, rounds: int = 8, seed: int = 23) -> np.ndarray:
    rng = np.random.default_rng(seed)
    centres = x[rng.choice(len(x), min(k, len(x)), replace=False)].copy()
    step = max(1, _NUMBERS // len(centres))
    for _ in range(rounds):
        home = np.concatenate([(x[at : at + step] @ centres.T).argmax(1) for at in range(0, len(x), step)])
        sums = np.zeros_like(centres)
        np.add.at(sums, home, x)
        size = np.linalg.norm(sums, axis=1)
        centres[size > 0] = sums[size > 0] / size[size > 0][:, None]
    return np.unique(centres, axis=0)


def fit_cells(x: np.ndarray, labels: np.ndarray, rows: int, threshold: float) -> Cells:
    """The number of cells with the least work expected for ``rows`` vectors, judged by a sample of them.

    Work is the products of home vectors with members of their cell and label, which grow with the
    square of the rows, and moving each vector to every cell where it is a member. Numbers of cells that
    would make a vector a member of more than ``MEMBER`` on average are not chosen.
    """
    radius = float(np.sqrt(max(0.0, 2 - 2 * threshold)))
    scale, codes = rows / max(1, len(x)), np.unique(labels, return_inverse=True)[1]
    best = None
    for k in CELLS:
        if best is not None and k * 4 > len(x):
            break
        cells = Cells(_spherical_kmeans(x, k), radius)
        home, row, cell = cells.assign(x)
        if best is not None and len(row) > MEMBER * len(x):
            break
        homes, members = (np.zeros((codes.max(initial=0) + 1, len(cells.centres))) for _ in range(2))
        np.add.at(homes, (codes, home), 1)
        np.add.at(members, (codes[row], cell), 1)
        work = scale**2 * float((homes * members).sum()) + scale * MOVE * len(row)
        if best is not None and work > 2 * best[0]:
            break  # finer cells have only more guests
        if best is None or work < best[0]:
            best = (work, cells)
    return best[1]


def _matrix(values: pa.Array, dim: int) -> np.ndarray:
    return values.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)


def _unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(1)[:, None]  # huge and tiny components neither overflow nor vanish when squared
    return x / np.linalg.norm(x, axis=1)[:, None]


def _links(a: np.ndarray, b: np.ndarray, raw_a: np.ndarray, raw_b: np.ndarray, threshold: float) -> np.ndarray:
    dots = a @ b.T
    linked = dots >= threshold
    for i, j in zip(*np.nonzero(np.abs(dots - threshold) <= _NEAR), strict=True):
        u, v = raw_a[i], raw_b[j]
        linked[i, j] = u @ v / (np.sqrt(u @ u) * np.sqrt(v @ v)) >= threshold
    return linked


def _spanning(linked: np.ndarray, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges from each id to the least that the linked pairs connect it with, at most one an id."""
    i, j = np.nonzero(linked)
    ids, place = np.unique(np.concatenate([left, right]), return_inverse=True)
    return _least(ids, place[i], place[len(left) + j])


def _contracted(left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges from each id to the least that the pairs of ids connect it with, at most one an id."""
    ids, place = np.unique(np.concatenate([left, right]), return_inverse=True)
    return _least(ids, place[: len(left)], place[len(left) :])


def _least(ids: np.ndarray, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges by pairs of places in ascending ids: the least place is the least id."""
    least, old = np.arange(len(ids)), None
    while old is None or (least != old).any():
        old = least.copy()
        np.minimum.at(least, a, least[b])
        np.minimum.at(least, b, least[a])
        least = least[least]
    some = np.flatnonzero(least != np.arange(len(ids)))
    return ids[some], ids[least[some]]


def _valid(vector: Column) -> Column:
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce((F.size(vector) > 0) & finite & F.exists(vector, lambda x: x != 0), F.lit(False))


_FOUND = "node long, key long, links long, other long"


def _found(*columns) -> pa.Table:
    return pa.table([pa.array(c, pa.int64()) for c in columns], names=["node", "key", "links", "other"])


def _placing(cells: Cells, dim: int):
    """Batches of vectors with their cells, of a bounded number of memberships each."""

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, _ROWS):
                part = batch.slice(at, _ROWS).select(["label", "node", "key", "copies", "x"])
                home, row, cell = cells.assign(_unit(_matrix(part.column("x"), dim)))
                for i in range(0, len(row), _SENT):
                    r, c = row[i : i + _SENT], cell[i : i + _SENT]
                    out = part.take(pa.array(r))
                    yield pa.RecordBatch.from_arrays([*out.columns, pa.array(c.astype(np.int32)), pa.array(home[r] == c)], names=[*out.schema.names, "cell", "home"])

    return place


def _cells(nodes: DataFrame, dim: int, threshold: float) -> DataFrame:
    """The nodes of one length in each cell where they are members."""
    n, most, order = nodes.count(), max(1, min(SAMPLE, SAMPLE_NUMBERS // dim)), F.xxhash64("key", "node")
    # few more than the sample are sorted, whatever the rows
    least = nodes.where(F.pmod(F.xxhash64(F.lit("sample"), "key", "node"), F.lit(1 << 30)) < int(min(1.0, 1.5 * most / max(1, n)) * (1 << 30)))
    sample = least.orderBy(order, "node").limit(most).select("x", "label").toArrow()
    if not sample.num_rows:
        sample = nodes.limit(most).select("x", "label").toArrow()
    cells = fit_cells(_unit(_matrix(sample.column("x").combine_chunks(), dim)), np.array(sample.column("label").to_pylist()), n, threshold)
    kind = nodes.schema["x"].dataType.simpleString()
    return nodes.select("label", "node", "key", "copies", "x").mapInArrow(_placing(cells, dim), f"label string, node long, key long, copies long, x {kind}, cell int, home boolean")


def _multiplied(threshold: float):
    def multiply(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            return _found([], [], [], [])
        dim = len(left.column("x")[0])
        raw_a, raw_b = _matrix(left.column("x").combine_chunks(), dim), _matrix(right.column("m_x").combine_chunks(), dim)
        unit_a, unit_b = _unit(raw_a), _unit(raw_b)
        a, b, copies = left.column("node").to_numpy(), right.column("m_node").to_numpy(), right.column("m_copies").to_numpy().astype(np.float64)
        step, sums = max(1, _NUMBERS // len(b)), np.zeros(len(a))
        one, other = np.zeros(0, np.int64), np.zeros(0, np.int64)
        for at in range(0, len(a), step):
            own = slice(at, at + step)
            linked = _links(unit_a[own], unit_b, raw_a[own], raw_b, threshold)
            sums[own] = linked @ copies
            more = _spanning(linked, a[own], b)
            one, other = _contracted(np.concatenate([one, more[0]]), np.concatenate([other, more[1]]))
        some, n = np.flatnonzero(sums > 0), len(one)
        keys = left.column("key").to_numpy()[some]
        return _found(np.concatenate([a[some], one]), np.concatenate([keys, np.zeros(n, np.int64)]), np.concatenate([sums[some].astype(np.int64), np.zeros(n, np.int64)]), [*[None] * len(some), *other.tolist()])

    return multiply


def _compare(placed: DataFrame, threshold: float) -> list[DataFrame]:
    """Tables of rows ``(node, key, links, null)``, summands of a node's links, and ``(node, key, 0, other)``, edges.

    ``placed`` has vectors of one length in each label and cell. A round has some of the blocks of home
    vectors of each cell, with all members.
    """
    placed = stage(placed, "cells")
    blocks = lambda rows, numbers: F.greatest(F.ceil(rows / BLOCK), F.ceil(numbers / BLOCK_NUMBERS)).cast("int")
    home, n = F.col("home").cast("int"), F.size("x").cast("long")
    sizes = placed.groupBy("label", "cell").agg(F.count("*").alias("members"), F.sum(n).alias("numbers"), F.sum(home).alias("homes"), F.sum(home * n).alias("h_numbers"))
    sizes = sizes.select("*", blocks(F.col("members"), F.col("numbers")).alias("m_blocks"), blocks(F.col("homes"), F.col("h_numbers")).alias("h_blocks")).where("h_blocks > 0")
    sizes = stage(sizes.select("label", "cell", "members", "homes", "m_blocks", "h_blocks", F.xxhash64("label", "cell").alias("off")), "cell-sizes")
    rows, moved = sizes.agg(F.sum("members"), F.sum(F.col("homes") * F.col("m_blocks") + F.col("members") * F.col("h_blocks"))).first()
    rounds = math.ceil((moved or 0) / max(LEAST_COPIES, COPIES * (rows or 0)))
    placed = placed.join(sizes.select("label", "cell", "m_blocks", "h_blocks", "off"), ["label", "cell"])
    slot = F.xxhash64(F.lit("block"), "key", "node")
    own, group, out = ["label", "cell", "h", "m", "node", "key", "copies", "x"], ["label", "cell", "h", "m"], []
    for k in range(rounds):
        first = F.pmod(F.lit(k) - F.pmod("off", F.lit(rounds)), F.lit(rounds)).cast("int")  # block of the round, and each ``rounds``-th after it
        homes = placed.where("home").withColumn("h", F.pmod(slot, "h_blocks").cast("int")).where(F.pmod("h", F.lit(rounds)) == first)
        homes = homes.withColumn("m", F.explode(F.sequence(F.lit(0), F.col("m_blocks") - 1))).select(*own)
        members = placed.withColumn("first", first).where("first < h_blocks").withColumn("h", F.explode(F.sequence("first", F.col("h_blocks") - 1, F.lit(rounds))))
        members = members.withColumn("m", F.pmod(slot, "m_blocks").cast("int")).select(*[F.col(c).alias(f"m_{c}") for c in own])
        found = homes.groupBy(*group).cogroup(members.groupBy(*[f"m_{c}" for c in group])).applyInArrow(_multiplied(threshold), _FOUND)
        if rounds > 1:  # a node's links and edges of a round as one row each
            found = found.groupBy("node", "key", "other").agg(F.sum("links").alias("links")).select("node", "key", "links", "other")
        out.append(stage(found, "links"))
    discard(placed)
    return out


def embedding_dedup(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", threshold: float = 0.98) -> DataFrame:
    """Per row: id, n_links (other rows linked directly), component_id and kept.

    Rows link if their labels are equal and not null, their vectors have the same length and a cosine
    of at least ``threshold`` in double precision. Ids may be of any type that has an order. Null, empty and zero vectors and those with null or
    non-finite components link with nothing, and neither do rows with a null id or label: they are
    their own component (null for a null id) and kept. Rows that share an id are one node of the
    components, but each has its own vector's links. Other columns are not read. An empty table gives
    an empty result.
    """
    vector = F.transform(vectors[f"`{vector_col}`"], lambda v: v + F.lit(0).cast("float"))  # -0.0 becomes 0.0
    ids = Ids(vectors, id_col)
    rows = vectors.select(vectors[f"`{id_col}`"].alias("own"), vector.alias("x"), vectors[f"`{label_col}`"].cast("string").alias("label"))
    rows = ids.number(rows, "own", "id").select("id", "x", "label")
    rows = rows.withColumn("fine", F.col("id").isNotNull() & F.col("label").isNotNull() & _valid(F.col("x")))
    keys = [F.xxhash64("label", "x").alias("key"), F.xxhash64("x", F.lit("b"), "label").alias("key2")]
    nodes = rows.where("fine").groupBy("label", "x").agg(F.min("id").alias("node"), F.count("*").alias("copies"))
    nodes = stage(nodes.select("label", "x", "node", "copies", *keys, F.size("x").alias("dim")), "vectors")
    dims = [r["dim"] for r in nodes.groupBy("dim").count().orderBy(F.desc("count"), "dim").limit(LENGTHS).collect()]
    found = []
    if len(dims) == LENGTHS:  # there may be others
        rest = nodes.where(~F.col("dim").isin(dims))
        found += _compare(rest.select(F.concat_ws(":", "dim", "label").alias("label"), "node", "key", "copies", "x", F.lit(-1).alias("cell"), F.lit(True).alias("home")), threshold)
    for d in dims:
        found += _compare(_cells(nodes.where(F.col("dim") == d), d, threshold), threshold)
    found = functools.reduce(DataFrame.unionByName, found) if found else vectors.sparkSession.createDataFrame([], _FOUND)
    comps = components(found.where("other is not null"), "node", "other")
    links = found.where("other is null").groupBy("node", "key").agg((F.sum("links") - 1).alias("n_links"))
    own = nodes.select("key", "key2", "node").join(links, ["node", "key"]).join(comps.withColumnRenamed("id", "node"), "node", "left")
    own = stage(own.select("key", "key2", "n_links", F.coalesce("component", "node").alias("component")), "classes")
    keyed = rows.select("id", *[F.when(F.col("fine"), k).alias(n) for k, n in zip(keys, ("key", "key2"), strict=True)])
    out = keyed.join(own, ["key", "key2"], "left")
    component = F.coalesce("component", "id")
    out = out.select("id", F.coalesce("n_links", F.lit(0)).alias("n_links"), component.alias("component_id"), F.col("id").eqNullSafe(component).alias("kept"))
    return ids.restore(out, "id", "component_id").select(F.col("id").alias(id_col), "n_links", "component_id", "kept")


#: The same rows in DuckDB: all pairs of a label, then everything that links reach.
ORACLE = r"""
WITH RECURSIVE fine AS (
  SELECT vec_id, label, embedding::DOUBLE[] AS x FROM embeddings
  WHERE label IS NOT NULL AND vec_id IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda v: v IS NULL OR NOT isfinite(v))) = 0 AND len(list_filter(embedding, lambda v: v <> 0)) > 0),
links AS (SELECT a.vec_id AS a, b.vec_id AS b FROM fine a JOIN fine b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.x) = len(b.x) WHERE list_cosine_similarity(a.x, b.x) >= 0.98),
reach AS (SELECT vec_id AS id, vec_id AS r FROM embeddings UNION SELECT reach.id, links.b FROM reach JOIN links ON reach.r = links.a),
least AS (SELECT id, min(r) AS component_id FROM reach GROUP BY id),
degree AS (SELECT a, count(*) AS n FROM links GROUP BY a)
SELECT vec_id, coalesce(n, 0) AS n_links, component_id, component_id = vec_id AS kept FROM embeddings JOIN least ON id = vec_id LEFT JOIN degree ON a = vec_id
"""
