"""Substring dedup: Rabin-Karp hashes of every fixed-length word window, counted in Spark.

A window of ``window`` consecutive words of a document goes when the same word sequence also starts
in a document with a smaller id. Repeated windows of a document merge into maximal intervals, and
every word of an interval is removed. All windows are judged on the input.

1. Every window of every text is hashed (96 bits of two independent Rabin-Karp hashes over two
   independent hashes of each word). A block of texts is combined before the shuffle: of a window that
   several of its documents have, only the one with the smallest id is sent on; the others' windows
   are known to go. So a window that a third of all documents have makes one entry a block.
2. The entries travel as sorted arrays, one row per block and bucket of hashes. A bucket holds about
   ``BUCKET`` windows, whatever the table's size. Each bucket sorts its entries by hash, finds the
   smallest id of each and returns the others.
3. The hashes that go are gathered by document, as a table in the shared folder, and joined with the
   documents; adaptive execution may split either side. A document's text is then hashed once more,
   and the windows with these hashes are cut from it.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textblocks as tb
from .ids import Ids, text_key
from .shared import discard, stage

#: Windows of a bucket, about, and bytes of whole texts that are combined before the shuffle.
BUCKET, BLOCK_BYTES = 500_000, 2 << 20
#: Partitions of the buckets, at most; each bucket is worked on by itself.
MOST_PARTITIONS = 100_000
#: A word of running text has at least this many bytes, with its blank, on average: for the number of buckets only.
_BYTES_A_WORD = 5
#: In place of a null id: larger than any other.
_LAST = 2**63 - 1
_PACKED = "bucket long, w binary, v binary, ord binary, who binary"


def _pack(values: np.ndarray) -> bytes:
    """The values' lowest bytes first, then their second bytes and so on: high bytes are alike and compress well."""
    return np.ascontiguousarray(values).view(np.uint8).reshape(len(values), -1).T.tobytes()


def _pack_sorted(values: np.ndarray) -> bytes:
    """The same of each value's distance from the one before."""
    return _pack(np.diff(values, prepend=values.dtype.type(0)))


def _parts(column: pa.ChunkedArray, kind: type) -> list[np.ndarray]:
    size = np.dtype(kind).itemsize
    return [np.ascontiguousarray(np.frombuffer(x.as_buffer(), np.uint8).reshape(size, -1).T).view(kind).reshape(-1) for x in column]


def _unpack(column: pa.ChunkedArray, kind: type) -> np.ndarray:
    return np.concatenate([np.zeros(0, kind), *_parts(column, kind)])


def _unpack_sorted(column: pa.ChunkedArray, kind: type) -> np.ndarray:
    return np.concatenate([np.zeros(0, kind), *(np.cumsum(x, dtype=kind) for x in _parts(column, kind))])


def _bucket(h: np.ndarray, buckets: int) -> np.ndarray:
    """Buckets in the order of the hashes, equally wide."""
    return ((h >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)


def _slices(bucket: np.ndarray) -> Iterator[tuple[int, slice]]:
    """The buckets of sorted entries, and where each one's entries are."""
    ends = [*_runs(bucket).tolist(), len(bucket)]
    for a, b in zip(ends[:-1], ends[1:], strict=True):
        yield int(bucket[a]), slice(a, b)


def _runs(*columns: np.ndarray) -> np.ndarray:
    """Where each run of equal rows of the sorted columns begins."""
    new = np.zeros(len(columns[0]), bool)
    new[:1] = True
    for c in columns:
        new[1:] |= c[1:] != c[:-1]
    return np.flatnonzero(new)


def _least(runs: np.ndarray, ord_: np.ndarray) -> np.ndarray:
    """For each entry the smallest id of its run."""
    return np.repeat(np.minimum.reduceat(ord_, runs), np.diff(np.append(runs, len(ord_)))) if len(ord_) else ord_


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.int64(), *[pa.binary()] * 4)
    return pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=["bucket", "w", "v", "ord", "who"])


def _hash_windows(window: int, buckets: int, unique: bool):
    """Entries of all windows by bucket; those known to go under -1 minus their document's bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in tb.blocks(batch, "text", BLOCK_BYTES):
                words = tb.words(block.column("text"))
                at = np.flatnonzero(tb.inside_text(words, window))
                if not len(at):
                    continue
                w = tb.window_hashes(tb.word_hashes(words), window)[at]
                v = tb.window_hashes(tb.word_hashes(words, kind=2), window, kind=2)[at].astype(np.uint32)
                text = words.text_of_word()[at]
                order = np.argsort(w, kind="stable")  # texts stay in order within a hash
                w, v, text = w[order], v[order], text[order]
                ord_, who = (block.column(c).to_numpy()[text] for c in ("ord", "who"))
                first = ord_ == _least(_runs(w, v), ord_)
                again = np.zeros(len(w), bool)
                again[1:] = (text[1:] == text[:-1]) & (w[1:] == w[:-1])
                send = first & ~again
                gone = ~first & ~again
                rows = [(-1 - b, x, None, None, y) for b, x, y in _by_document(w[gone], who[gone], buckets)]
                w, v, ord_, who = w[send], v[send], ord_[send], who[send]
                rows += [(b, _pack_sorted(w[s]), _pack(v[s]), _pack(ord_[s]), None if unique else _pack(who[s])) for b, s in _slices(_bucket(w, buckets))]
                yield _batch(rows)

    return run


def _by_document(w: np.ndarray, who: np.ndarray, buckets: int) -> Iterator[tuple[int, bytes, bytes]]:
    """The sorted hashes that go, by bucket of their documents."""
    bucket = _bucket(tb.mix(who.view(np.uint64)), buckets)
    order = np.argsort(bucket, kind="stable")
    for b, s in _slices(bucket[order]):
        yield b, _pack_sorted(w[order[s]]), _pack(who[order[s]])


def _repeated(buckets: int, unique: bool):
    """Of a bucket's entries those of documents with a larger id than the window's smallest, by bucket of their documents."""

    def run(entries: pa.Table) -> pa.Table:
        bucket = entries.column("bucket")[0].as_py()
        if bucket < 0:
            rows = [(-1 - bucket, w.as_py(), who.as_py()) for w, who in zip(entries.column("w"), entries.column("who"), strict=True)]
        else:
            w, v, ord_ = _unpack_sorted(entries.column("w"), np.uint64), _unpack(entries.column("v"), np.uint32), _unpack(entries.column("ord"), np.int64)
            who = ord_ if unique else _unpack(entries.column("who"), np.int64)
            order = np.argsort(w, kind="stable")
            w, v = w[order], v[order]
            if ((w[1:] == w[:-1]) & (v[1:] != v[:-1])).any():
                again = np.lexsort((v, w))
                w, v, order = w[again], v[again], order[again]
            ord_ = ord_[order]
            gone = ord_ > _least(_runs(w, v), ord_)
            rows = list(_by_document(w[gone], who[order[gone]], buckets))
            del w, v, ord_, who, order, gone
            tb.release()
        return pa.table([pa.array([r[i] for r in rows], k) for i, k in enumerate((pa.int64(), pa.binary(), pa.binary()))], names=["bucket", "w", "who"])

    return run


def _gather(entries: pa.Table) -> pa.Table:
    """One row per document, with the distinct hashes of its windows that go."""
    w, who = _unpack_sorted(entries.column("w"), np.uint64), _unpack(entries.column("who"), np.int64)
    order = np.lexsort((w, who))
    w, who = w[order], who[order]
    keep = _runs(who, w)
    w, who = w[keep], who[keep]
    first = _runs(who)
    lists = pa.ListArray.from_arrays(pa.array(np.append(first, len(w)).astype(np.int32)), pa.array(tb.signed(w)))
    return pa.table([pa.array(who[first]), lists], names=["who", "gone"])


def repeated_windows(texts: DataFrame, window: int, n_bytes: int, unique: bool) -> DataFrame:
    """``(who, gone)``: hashes of the windows that each document loses, from ``(ord, who, text)``.

    ``who`` names a document; with ``unique`` it is the id itself, which no two rows share.
    """
    buckets = max(1, -(-n_bytes // (_BYTES_A_WORD * BUCKET)))
    found = texts.select("ord", "who", "text").mapInArrow(_hash_windows(window, buckets, unique), _PACKED)
    found = found.repartition(min(MOST_PARTITIONS, -(-buckets // 4)), "bucket")  # as the table grows, not as the session is set
    found = found.groupBy("bucket").applyInArrow(_repeated(buckets, unique), "bucket long, w binary, who binary")
    return found.groupBy("bucket").applyInArrow(_gather, "who long, gone array<long>")


def _cover(n: int, starts: np.ndarray, window: int) -> np.ndarray:
    """Which of n words lie in a window that starts at one of ``starts``."""
    change = np.zeros(n + 1, np.int64)
    np.add.at(change, starts, 1)
    np.add.at(change, np.minimum(starts + window, n), -1)
    return np.cumsum(change[:n]) > 0


def cut(text: str | None, gone: np.ndarray | None, window: int) -> tuple[int, int, str, str | None]:
    """Words, removed words, SHA-256 of the kept words joined by blanks, and the text without them.

    ``gone`` has the hashes of the windows to remove. The text loses the bytes from each removed
    interval's first word up to the next kept word; all other characters stay. A null text stays null
    and has no words.
    """
    if text is None:
        return 0, 0, hashlib.sha256(b"").hexdigest(), None
    raw = text.encode()
    tokens = raw.split()
    n = len(tokens)
    if gone is None or not len(gone):
        return n, 0, hashlib.sha256(b" ".join(tokens)).hexdigest(), text
    w = tb.words(pa.array([text], pa.large_string()))
    out = _cover(n, np.flatnonzero(np.isin(tb.window_hashes(tb.word_hashes(w), window), gone)), window)
    edge = np.diff(np.concatenate([[0], out.view(np.int8), [0]]))
    begins, ends = np.flatnonzero(edge == 1).tolist(), np.flatnonzero(edge == -1).tolist()
    kept, parts, at, word = [], [], 0, 0
    for a, b in zip(begins, ends, strict=True):
        kept += tokens[word:a]
        parts.append(raw[at : w.starts[a]])
        at, word = (int(w.starts[b]) if b < n else len(raw)), b
    kept += tokens[word:]
    return n, int(out.sum()), hashlib.sha256(b" ".join(kept)).hexdigest(), b"".join([*parts, raw[at:]]).decode()


_CUT = ["n_words", "n_removed", "kept_sha256", "clean_text"]
#: Rows whose texts are Python objects at a time.
_ROWS = 500


def _cut_udf(window: int, with_text: bool):
    @F.arrow_udf("struct<n_words:bigint,n_removed:bigint,kept_sha256:string,clean_text:string>")
    def run(text: pa.Array, gone: pa.Array) -> pa.Array:
        kinds = (pa.int64(), pa.int64(), pa.string(), pa.string())
        parts = [pa.StructArray.from_arrays([pa.array([], k) for k in kinds], _CUT)]
        for at in range(0, len(text), _ROWS):
            out = []
            for t, g in zip(text.slice(at, _ROWS), gone.slice(at, _ROWS), strict=True):
                hashes = None if g.values is None else g.values.to_numpy().view(np.uint64)
                *found, clean = cut(t.as_py(), hashes, window)
                out.append((*found, clean if with_text else None))
            parts.append(pa.StructArray.from_arrays([pa.array(list(c), k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], _CUT))
        tb.release()
        return pa.concat_arrays(parts)

    return run


def substring_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = 13, with_text: bool = True) -> DataFrame:
    """One row per row of ``docs``: ``row`` (a struct of all its columns), n_words, n_removed,
    kept_sha256 and clean_text (null unless ``with_text``).

    Ids may be of any type that has an order. A null id counts as larger than any other, and rows
    without one never lose words to each other. Rows that share an id are one document as far as "a
    smaller id" goes: they never lose words to each other, whether their texts are equal or not. Null,
    empty and short texts have no window and stay as they are. Other columns, whatever their names, are
    carried in ``row`` untouched. An empty table gives an empty result.
    """
    rows = docs.select(F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("row"), docs[f"`{id_col}`"].alias("own"), docs[f"`{text_col}`"].alias("text"))
    for ranked in (False, True):
        numbered = Ids(docs, id_col, ranked).number(rows, "own", "number")
        by_id = numbered.groupBy("number").agg(F.count("*").alias("n"), F.sum(F.octet_length("text")).alias("size"))
        about = by_id.agg(F.max("n").alias("most"), F.sum("size").alias("size"), F.max("number").alias("last"), F.count_if(F.col("number").isNull()).alias("none")).first()
        if about["last"] != _LAST:
            break  # otherwise ranks leave room above the ids
    rows = numbered
    rows = rows.withColumn("ord", F.coalesce("number", F.lit(_LAST)))
    unique = about["most"] == 1 and not about["none"]
    if unique:
        rows = rows.withColumn("who", F.col("ord"))
        texts = rows
    else:  # rows that repeat both id and text are one document; combined before the shuffle
        rows = rows.withColumn("who", F.xxhash64("ord", text_key(F.col("text"))))
        texts = rows.where("text is not null").groupBy("ord", "who").agg(F.min("text").alias("text"))
    gone = stage(repeated_windows(texts.where("text is not null"), window, about["size"] or 0, unique), "repeated-windows")
    out = rows.select("row", "who").join(gone, "who", "left")
    return out.select("row", _cut_udf(window, with_text)(F.col("row").getField(text_col), F.col("gone")).alias("r")).select("row", "r.*")


#: The same rows in DuckDB for the query's columns, with the 13 words of each window as its key.
ORACLE = r"""
WITH docs AS (SELECT doc_id, list_filter(string_split(translate(coalesce(text, ''), chr(9) || chr(10) || chr(11) || chr(12) || chr(13), '     '), ' '), lambda x: x <> '') AS words FROM documents),
windows AS (SELECT doc_id, p, array_to_string(words[p : p + 12], ' ') AS k FROM (SELECT doc_id, words, unnest(range(1, len(words) - 11)) AS p FROM docs)),
firsts AS (SELECT k, min(doc_id) AS first FROM windows GROUP BY k),
gone AS (SELECT DISTINCT doc_id, p + o AS i FROM windows JOIN firsts USING (k) CROSS JOIN range(13) t(o) WHERE doc_id > first),
kept AS (
  SELECT doc_id, count(*) AS n_kept, string_agg(word, ' ' ORDER BY i) AS text
  FROM (SELECT doc_id, unnest(words) AS word, unnest(range(1, len(words) + 1)) AS i FROM docs) ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id)
SELECT docs.doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(len(words) - coalesce(n_kept, 0) AS BIGINT) AS n_removed, sha256(coalesce(text, '')) AS kept_sha256
FROM docs LEFT JOIN kept USING (doc_id)
"""
