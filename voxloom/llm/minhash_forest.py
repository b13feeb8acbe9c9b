"""MinHash near-dedup with an LSH forest.

A document's set is that of its distinct word shingles. Documents with equal sets (128-bit digests of
them) are one class, whose least id stands for it. Each class has a signature of ``MINIMA`` minima. An
order of the forest sorts the classes by some of these minima; classes that share the first ``depth``
of them are a region of it.

1. In every order of depth ``START`` the neighbours within a region, which share the longest prefixes,
   are candidates. Their links' components are contracted.
2. In a region that still has several components, each class is compared with the ``WINDOW`` ones
   after it that are of another component: in a region of up to ``WINDOW + 1`` classes these are all.
   In a larger region of which all but ``OTHERS`` classes at most are of one component, as in a large
   group of near copies, these others are compared with all of its classes, which is in proportion to
   its size.
3. A region that is larger, has more others and still has several components is too shallow: its
   classes go on to orders that are one minimum deeper, of which there are more, so that a pair at the threshold shares
   a region of one of them as surely as before. Step 2 is done there, and so on to depth ``DEEPEST``.
4. What is crowded even there and has several components is compared whole, in blocks.

Candidates are dropped before the full sets are compared only where that is certain to be right: by
their sizes, and by odd sketches. Bit i of a class's odd sketch is the parity of the number of its
shingles that hash to i; two sketches differ in at most as many bits as the sets differ in shingles.
All others are confirmed on their full sets.

Two classes at the threshold ``t`` share no region of ``count`` orders of depth ``d`` with a
probability of ``(1 - t ** d) ** count``; :func:`orders` has as many as keep it below ``MISSED``.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import partitioning
from . import textblocks as tb
from .graph import components
from .ids import Ids, text_key
from .shared import discard, stage

#: Minima of a signature; minima that fix a region, at first and at last.
MINIMA, START, DEEPEST = 96, 2, 6
#: Probability that a pair at the threshold meets in no order of a depth.
MISSED = 1e-6
#: Classes after each one in its region that it is compared with.
WINDOW = 31
#: Classes outside the largest component of a region, at most, that are compared with all of the region.
OTHERS = 1024
#: Classes of a region, about, that one task sorts: larger ones are dealt by a hash that differs from order to order.
CROWD = 4096
#: Classes of a block of a region that is compared whole.
BLOCK = 2048
#: Bits of the smallest odd sketch; others have more bits than shingles.
LEAST_BITS = 512
_PAIRS = 1 << 15
_MULTIPLIERS = np.random.default_rng(977).integers(1, 2**63, MINIMA, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def orders(depth: int, percent: int) -> np.ndarray:
    """Minima of each order: ``depth`` that fix the region, and two more that sort it.

    Orders take their first minima from one permutation after another, without one twice.
    """
    count = math.ceil(math.log(MISSED) / math.log(1 - (percent / 100) ** depth)) if percent < 100 else 1
    rng, out, each = np.random.default_rng([41, depth]), [], MINIMA // depth
    while len(out) < count:
        turn = rng.permutation(MINIMA)
        for i in range(min(each, count - len(out))):
            own = turn[i * depth : (i + 1) * depth]
            out.append(np.concatenate([own, rng.choice(np.setdiff1d(turn, own), 2, replace=False)]))
    return np.array(out)


def shingles(texts: pa.Array, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of each text's distinct shingles, sorted, a second hash of each, and where each text's begin.

    A-Z are lower-cased. A text with fewer words than ``size`` has its whole sequence as one shingle,
    one without words has none.
    """
    w = tb.words(texts)
    kinds = []
    for kind in (1, 2):
        h = tb.word_hashes(w, lower=True, kind=kind)
        kinds.append([tb.window_hashes(h, n, kind) for n in range(1, size + 1)])
    out, again, first = [], [], [0]
    for a, b in zip(w.first[:-1].tolist(), w.first[1:].tolist(), strict=True):
        n = b - a
        if n:
            which, own = min(n, size) - 1, slice(a, max(a, b - size) + 1)
            hashes, at = np.unique(kinds[0][which][own], return_index=True)
            out.append(hashes)
            again.append(kinds[1][which][own][at])
        first.append(first[-1] + (len(out[-1]) if n else 0))
    none = np.zeros(0, np.uint64)
    return np.concatenate([none, *out]), np.concatenate([none, *again]), np.array(first)


def signatures(sets: np.ndarray, first: np.ndarray) -> np.ndarray:
    """32-bit minima, a row per text; all ones for empty sets."""
    out = np.full((len(first) - 1, MINIMA), 0xFFFFFFFF, np.uint32)
    some = np.flatnonzero(np.diff(first) > 0)
    if len(some):
        for k, m in enumerate(_MULTIPLIERS):
            mixed = sets * m
            mixed ^= mixed >> np.uint64(29)
            out[some, k] = (np.minimum.reduceat(mixed * m, first[some]) >> np.uint64(32)).astype(np.uint32)
    return out


def odd_sketches(sets: np.ndarray, first: np.ndarray) -> list[bytes]:
    """Parities of the numbers of shingles at each bit, of a power of two of bits that is larger than the set."""
    n = np.diff(first)
    bits = np.maximum(LEAST_BITS, 1 << np.ceil(np.log2(np.maximum(n, 1) + 1)).astype(np.int64))
    base = np.concatenate([[0], np.cumsum(bits)])
    at = np.repeat(base[:-1], n) + (sets & np.repeat(bits - 1, n).astype(np.uint64)).astype(np.int64)
    packed = np.packbits((np.bincount(at, minlength=base[-1]) & 1).astype(np.uint8)).tobytes()
    return [packed[a // 8 : b // 8] for a, b in zip(base[:-1].tolist(), base[1:].tolist(), strict=True)]


def may_link(sketches: list, n: np.ndarray, i: np.ndarray, j: np.ndarray, percent: int) -> np.ndarray:
    """Whether classes i and j can be as alike as ``percent``, by sizes and odd sketches; never false for a link."""
    fine = 100 * np.minimum(n[i], n[j]) >= percent * np.maximum(n[i], n[j])
    size = np.array([len(x) for x in sketches], np.int64)
    for at in range(0, len(i), _PAIRS):
        rows = at + np.flatnonzero(fine[at : at + _PAIRS])
        width = np.minimum(size[i[rows]], size[j[rows]])
        for w in np.unique(width).tolist():
            own = rows[width == w]
            x = _folded(sketches, size, i[own], w) ^ _folded(sketches, size, j[own], w)
            differ = np.bitwise_count(x).sum(1, dtype=np.int64)
            total = n[i[own]] + n[j[own]]
            fine[own] = 100 * (total - differ) >= percent * (total + differ)
    return fine


def _folded(sketches: list, size: np.ndarray, rows: np.ndarray, width: int) -> np.ndarray:
    """The rows' sketches as those of ``width`` bytes: a bit's parity is that of the bits that fall together."""
    out = np.empty((len(rows), width // 8), np.uint64)
    for w in np.unique(size[rows]).tolist():
        own = np.flatnonzero(size[rows] == w)
        flat = np.frombuffer(b"".join([sketches[r] for r in rows[own].tolist()]), np.uint64)
        out[own] = np.bitwise_xor.reduce(flat.reshape(len(own), w // width, width // 8), axis=1)
    return out


def _describe(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in tb.blocks(batch, "text"):
                sets, again, first = shingles(block.column("text"), size)
                both = np.stack([sets, again], 1)
                digests = [hashlib.blake2b(both[a:b].tobytes(), digest_size=16).digest() for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True)]
                sig = signatures(sets, first)
                columns = [block.column("id"), block.column("h"), pa.array(np.diff(first)), pa.array(digests, pa.binary()), pa.array([x.tobytes() for x in sig], pa.binary()), pa.array(odd_sketches(sets, first), pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, names=["id", "h", "n", "digest", "sig", "odd"])

    return run


def _sets(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in tb.blocks(batch, "text"):
                sets, _, first = shingles(block.column("text"), size)
                yield pa.RecordBatch.from_arrays([block.column("id"), block.column("h"), pa.ListArray.from_arrays(pa.array(first.astype(np.int32)), pa.array(tb.signed(sets)))], names=["id", "h", "set"])

    return run


def _place(classes: DataFrame, depth: int, percent: int) -> DataFrame:
    """``(region, place, id)`` of each class in each order of a depth."""
    forest = orders(depth, percent)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sig = np.frombuffer(b"".join(batch.column("sig").to_pylist()), np.uint32).reshape(-1, MINIMA).astype(np.uint64)
            for t, own in enumerate(forest):
                key = np.full(len(sig), depth * 1000 + t, np.uint64)
                for k in own[:depth]:
                    key = tb.mix(key * np.uint64(0x9E3779B97F4A7C15) + sig[:, k])
                place = (sig[:, own[depth]] << np.uint64(32)) | sig[:, own[depth + 1]]
                yield pa.RecordBatch.from_arrays([pa.array(tb.signed(key)), pa.array(tb.signed(place)), batch.column("id")], names=["region", "place", "id"])

    return stage(classes.select("id", "sig").mapInArrow(run, "region long, place long, id long"), "places")


def _nearby(window: int, percent: int):
    """Pairs of the classes of a region that are at most ``window`` places apart, of two components, and may link.

    The rows of a partition come sorted by region, slot and place; the last ones of a batch are kept for the next.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept = None
        for batch in batches:
            old = 0 if kept is None else kept.num_rows
            rows = pa.Table.from_batches([batch] if kept is None else [kept, batch]).combine_chunks()
            region, slot, id_, n, comp = (rows.column(c).to_numpy() for c in ("region", "slot", "id", "n", "comp"))
            odd, found = rows.column("odd").to_pylist(), []
            for k in range(1, min(window, len(id_) - 1) + 1):
                same = (region[k:] == region[:-k]) & (slot[k:] == slot[:-k])
                if not same.any():
                    break
                i = np.flatnonzero(same & (comp[k:] != comp[:-k]))
                found.append(np.stack([i, i + k])[:, i + k >= old])
            i, j = np.concatenate([np.zeros((2, 0), np.int64), *found], 1)
            fine = may_link(odd, n, i, j, percent)
            a, b = id_[i[fine]], id_[j[fine]]
            yield pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], names=["a", "b"])
            kept = rows.slice(max(0, rows.num_rows - window)).to_batches()[0]

    return run


def _candidates(members: DataFrame, classes: DataFrame, window: int, percent: int) -> DataFrame:
    """Pairs ``(a, b)`` to confirm, from ``(region, cnt, place, id, comp)``."""
    slots = F.ceil(F.col("cnt") / CROWD)
    rows = members.withColumn("slot", F.when(slots > 1, F.pmod(F.xxhash64("region", "id"), slots)).otherwise(F.lit(0)).cast("long")).join(classes.select("id", "n", "odd"), "id")
    rows = rows.repartition("region", "slot").sortWithinPartitions("region", "slot", "place", "id").select("region", "slot", "id", "n", "comp", "odd")
    return rows.mapInArrow(_nearby(window, percent), "a long, b long").distinct()


def _known(places: DataFrame, comps: DataFrame) -> DataFrame:
    """The places, with the class's component."""
    return places.join(comps, "id", "left").withColumn("comp", F.coalesce("component", "id")).drop("component")


def _mixed(places: DataFrame, comps: DataFrame) -> DataFrame:
    """The places in regions with several components, with the region's size and the class's component."""
    known = _known(places, comps)
    regions = known.groupBy("region").agg(F.count("*").alias("cnt"), F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo < hi").select("region", "cnt")
    # as a table, so that a crowded region's join can be split
    return stage(known.join(stage(regions, "mixed-regions"), "region"), "mixed")


def _led(mixed: DataFrame) -> DataFrame:
    """Crowded regions of which all but a few classes are of one component, ``main``."""
    sizes = mixed.where(F.col("cnt") > WINDOW + 1).groupBy("region", "comp").agg(F.count("*").alias("own")).groupBy("region")
    sizes = sizes.agg(F.sum("own").alias("all"), F.max(F.struct("own", "comp")).alias("most"))
    return stage(sizes.where(F.col("all") - F.col("most.own") <= OTHERS).select("region", F.col("most.comp").alias("main")), "led-regions")


def _still_mixed(mixed: DataFrame, comps: DataFrame) -> DataFrame:
    """Those of the rows whose regions have several components by now."""
    known = _known(mixed.drop("comp"), comps)
    regions = known.groupBy("region").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo < hi").select("region")
    return known.join(stage(regions, "mixed-regions"), "region", "left_semi")


def _whole(members: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """Pairs to confirm of all classes of a region that are of two components, by pairs of blocks."""
    rows = members.join(classes.select("id", "n", "odd"), "id").withColumn("blocks", F.ceil(F.col("cnt") / BLOCK).cast("int"))
    rows = stage(rows.withColumn("block", F.pmod(F.xxhash64(F.lit("block"), "id"), "blocks").cast("int")), "crowded")
    key, own = ["region", "i", "j"], ["id", "comp", "n", "odd"]
    left = rows.withColumn("i", F.col("block")).withColumn("j", F.explode(F.sequence("block", F.col("blocks") - 1))).select(*key, *own)
    right = rows.withColumn("j", F.col("block")).withColumn("i", F.explode(F.sequence(F.lit(0), "block"))).select(*[F.col(c).alias(f"r_{c}") for c in (*key, *own)])
    return _compared(left, right, key, percent)


def _others(members: DataFrame, classes: DataFrame, percent: int, one: bool = False) -> DataFrame:
    """Pairs to confirm of each class outside its region's component ``main`` and all of the region's classes, by blocks of these.

    With ``one`` a class has one pair at most with each component of a block.
    """
    rows = members.join(classes.select("id", "n", "odd"), "id").withColumn("blocks", F.ceil(F.col("cnt") / BLOCK).cast("int"))
    key, own = ["region", "block"], ["id", "comp", "n", "odd"]
    left = rows.where("comp <> main").withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(*key, *own)
    right = rows.withColumn("block", F.pmod(F.xxhash64(F.lit("block"), "id"), "blocks").cast("int")).select(*[F.col(c).alias(f"r_{c}") for c in (*key, *own)])
    return _compared(left, right, key, percent, one)


def _compared(left: DataFrame, right: DataFrame, key: list[str], percent: int, one: bool = False) -> DataFrame:
    """Pairs of two components that may link, of the rows ``left`` and ``right`` with the same key."""

    def compare(a: pa.Table, b: pa.Table) -> pa.Table:
        out = []
        if a.num_rows and b.num_rows:
            id_, comp, n = (np.concatenate([a.column(c).to_numpy(), b.column(f"r_{c}").to_numpy()]) for c in ("id", "comp", "n"))
            odd = a.column("odd").to_pylist() + b.column("r_odd").to_pylist()
            for i in range(a.num_rows):
                j = a.num_rows + np.flatnonzero(comp[a.num_rows :] != comp[i])
                j = j[may_link(odd, n, np.full(len(j), i), j, percent)]
                j = j[np.unique(comp[j], return_index=True)[1]] if one else j
                out.append(np.stack([np.full(len(j), id_[i]), id_[j]]))
        x, y = np.concatenate([np.zeros((2, 0), np.int64), *out], 1)
        return pa.table([pa.array(np.minimum(x, y)), pa.array(np.maximum(x, y))], names=["a", "b"])

    return left.groupBy(*key).cogroup(right.groupBy(*[f"r_{c}" for c in key])).applyInArrow(compare, "a long, b long").distinct()


def minhash_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 5, percent: int = 80) -> DataFrame:
    """Per row: id, ``text_key`` (a hash of the text), n_shingles, component_id and kept.

    Two documents link if ``100 * |intersection| >= percent * |union|`` of their sets. Ids may be of any
    type that has an order. Null, empty and blank texts have an empty set and link with nothing. A row
    without an id links with nothing either: its component is null and it is kept. Rows that share an
    id are one node, whose links are those of all its texts. Other columns are not read. An empty table
    gives an empty result.
    """
    ids, text = Ids(docs, id_col), docs[f"`{text_col}`"]
    source = ids.number(docs.select(docs[f"`{id_col}`"].alias("own"), text_key(text).alias("h"), text.alias("text")), "own", "id").select("id", "h", "text")
    rows = stage(source.mapInArrow(_describe(size), "id long, h long, n long, digest binary, sig binary, odd binary"), "signatures")
    linkable = rows.where("n > 0 and id is not null")
    shared = linkable.groupBy("id").agg(F.min("digest").alias("one"), F.max("digest").alias("other")).where("one <> other").select("id")
    # a class is named by its least id, or, if some id has several texts, by a number of its own
    classes = stage(linkable.groupBy("digest", "n", "sig", "odd").agg(F.min(F.struct("id", "h")).alias("first")).select("digest", "n", "sig", "odd", "first.*"), "classes")
    several = not shared.isEmpty()
    if several:
        classes = partitioning.with_row_index(classes.withColumnRenamed("id", "least"), "digest").withColumn("id", F.col("row_idx").cast("long"))

    def confirmed(pairs: DataFrame, many: bool = False) -> DataFrame:
        """The pairs whose full sets are alike enough; with ``many`` they concern a share of all texts, whatever the table's size."""
        pairs = stage(pairs, "candidates")
        wanted = stage(pairs.select(F.col("a").alias("id")).unionByName(pairs.select(F.col("b").alias("id"))).distinct(), "wanted")
        named = classes.join(wanted, "id").select(F.col("id").alias("class"), F.col("least" if several else "id").alias("id"), "h")
        named = stage(named, "wanted")
        texts = source.join(named.hint("merge") if many else named, ["id", "h"]).select("class", "h", "text").withColumnRenamed("class", "id")
        sets = stage(texts.mapInArrow(_sets(size), "id long, h long, set array<long>").drop("h").dropDuplicates(["id"]), "sets")
        left, right = (sets.select(F.col("id").alias(c), F.col("set").alias(f"{c}_set")) for c in ("a", "b"))
        both, common = pairs.join(left, "a").join(right, "b"), F.size(F.array_intersect("a_set", "b_set"))
        found = stage(both.where(100 * common >= percent * (F.size("a_set") + F.size("b_set") - common)).select("a", "b"), "links")
        for t in (pairs, wanted, sets):
            discard(t)
        return found

    def joined(comps: DataFrame, links: DataFrame) -> DataFrame:
        """The components of the old ones, each as one node, with new links."""
        edges = comps.select(F.col("id").alias("a"), F.col("component").alias("b")).unionByName(links)
        out = stage(components(edges, "a", "b"), "components")
        discard(links)
        return out

    places = _place(classes, START, percent)
    crowds = stage(places.groupBy("region").agg(F.count("*").alias("cnt")).where("cnt > 1"), "regions")
    near = places.join(crowds, "region").withColumn("comp", F.col("id"))
    comps = stage(components(confirmed(_candidates(near, classes, 1, percent), many=True), "a", "b"), "components")
    for depth in range(START, DEEPEST + 1):
        mixed = _mixed(places, comps)
        discard(places)
        led = _led(mixed)
        rest, near_main = mixed.join(led, "region", "left_anti"), not led.isEmpty()
        pairs = _candidates(rest, classes, WINDOW, percent)
        if near_main:  # one pair with each component first, which links most; then all that are still apart
            parts = mixed.join(led, "region", "left_semi")
            pairs = pairs.unionByName(_others(parts.join(led, "region"), classes, percent, one=True)).distinct()
        links, crowded = confirmed(pairs), rest.where(F.col("cnt") > WINDOW + 1)
        if not links.isEmpty():
            comps = joined(comps, links)
            crowded = _still_mixed(crowded, comps)
            parts = stage(_still_mixed(parts, comps), "led") if near_main else None
        if near_main:
            links = confirmed(_others(parts.join(_led(parts), "region"), classes, percent))
            comps = joined(comps, links) if not links.isEmpty() else comps
        crowded = stage(crowded, "crowded")
        discard(mixed)
        if crowded.isEmpty():
            break
        if depth < DEEPEST:
            places = _place(classes.join(crowded.select("id").distinct(), "id", "left_semi"), depth + 1, percent)
        else:
            comps = joined(comps, confirmed(_whole(crowded, classes, percent)))

    found = classes.join(comps, "id", "left").withColumn("component", F.coalesce("component", "id"))
    if several:  # nodes are ids from here on: those of a class's rows, and of all classes of its component
        of_class = linkable.select("id", "digest").distinct().join(found.select("digest", F.col("component").alias("group")), "digest")
        least = of_class.groupBy("group").agg(F.min("id").alias("first"))
        by_id = stage(components(of_class.join(least, "group").select(F.col("id").alias("a"), F.col("first").alias("b")), "a", "b"), "components")
        out = rows.select("id", "h", "n").join(by_id, "id", "left")
    else:
        found = stage(found.select(F.col("digest").alias("d"), "component"), "class-components")
        out = rows.select("id", "h", "n", "digest").join(found, F.col("id").isNotNull() & (F.col("n") > 0) & (F.col("digest") == F.col("d")), "left")
    component = F.coalesce("component", "id")
    out = out.select("id", F.col("h").alias("text_key"), F.col("n").alias("n_shingles"), component.alias("component_id"), F.col("id").eqNullSafe(component).alias("kept"))
    return ids.restore(out, "id", "component_id").select(F.col("id").alias(id_col), "text_key", "n_shingles", "component_id", "kept")


#: The same rows in DuckDB for shingles of four words: all pairs with a common shingle, then everything that links reach.
ORACLE = r"""
WITH RECURSIVE docs AS (
  SELECT doc_id, list_filter(string_split(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13), 'abcdefghijklmnopqrstuvwxyz     '), ' '), lambda x: x <> '') AS words FROM documents),
sets AS (
  SELECT DISTINCT doc_id, array_to_string(words[p : p + 3], ' ') AS k FROM (SELECT doc_id, words, unnest(range(1, greatest(2, len(words) - 2))) AS p FROM docs WHERE len(words) > 0)),
sizes AS (SELECT doc_id, count(*) AS n FROM sets GROUP BY doc_id),
common AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n FROM sets a JOIN sets b ON a.k = b.k AND a.doc_id <> b.doc_id GROUP BY ALL),
links AS (SELECT a, b FROM common c JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b WHERE 100 * c.n >= 80 * (x.n + y.n - c.n)),
reach AS (SELECT doc_id AS id, doc_id AS r FROM docs UNION SELECT reach.id, links.b FROM reach JOIN links ON reach.r = links.a),
least AS (SELECT id, min(r) AS component_id FROM reach GROUP BY id)
SELECT docs.doc_id, coalesce(n, 0) AS n_shingles, component_id, component_id = docs.doc_id AS kept FROM docs JOIN least ON id = docs.doc_id LEFT JOIN sizes ON sizes.doc_id = docs.doc_id
"""
