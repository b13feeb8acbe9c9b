"""Greedy packing of time-stamped segments into slices of bounded length.

The rules are sequential with look-back, so an entry is packed in one piece of plain Python. Arrow
batches are taken apart so that the Python objects there are at a time are those of ``PART`` segments,
or of one entry with more. If a controller adapts targets across entries, their shard is a group.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from itertools import count
from statistics import median

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SEGMENTS = "array<struct<start:double,end:double,text:string,word_scores:array<double>>>"
PART = 4096


@dataclass(frozen=True, slots=True)
class Segment:
    start: float
    end: float
    text: str = ""
    word_scores: tuple[float, ...] = ()


@dataclass(slots=True)
class Slice:
    """``seek`` in seconds; segments as (start, end, text, word_scores) relative to it."""

    seek: float
    duration: float = 0.0
    segments: list[tuple[float, float, str, tuple[float, ...]]] = field(default_factory=list)


class DurationController:
    """Random targets whose mean is steered to ``target``; the n-th is drawn by a digest of seed and n."""

    BOOTSTRAP, SPREAD, PULL = 5, 0.35, 0.5

    def __init__(self, least: float, most: float, target: float, seed: int | str = 0):
        self.least, self.most, self.target = least, most, target
        self.seed, self.draws = seed, 0
        self.done: list[float] = []

    def _uniform(self, low: float, high: float) -> float:
        share = int(hashlib.md5(f"{self.seed}:{self.draws}".encode(), usedforsecurity=False).hexdigest()[:8], 16) / 2**32
        self.draws += 1
        return low + (high - low) * share

    def next_target(self) -> float:
        if len(self.done) < self.BOOTSTRAP:
            return self._uniform(max(self.least, 0.7 * self.target), min(self.most, 1.3 * self.target))
        centre = self.target + self.PULL * (self.target - sum(self.done) / len(self.done))
        reach = self.SPREAD * self.target
        return min(self.most, max(self.least, self._uniform(centre - reach, centre + reach)))

    def record(self, duration: float) -> None:
        self.done.append(duration)

    def reject(self) -> None:
        self.done.pop()


def quality(segments: Iterable[Segment]) -> float:
    """Median of all word scores together; 0 without any. Null ones are none."""
    scores = [s for x in segments for s in x.word_scores if s is not None]
    return median(scores) if scores else 0.0


class _Packer:
    def __init__(self, segments: list[Segment], audio: float, most: float, threshold: float, controller: DurationController | None):
        self.all, self.audio, self.most, self.threshold, self.controller = segments, audio, most, threshold, controller

    def _start(self, i: int) -> float:
        """Where slicing goes on at segment i; the end of the audio if there is none."""
        return self.all[i].start if i < len(self.all) else self.audio

    def _fit(self, i: int, at: float, end: float) -> int:
        """The first segment from i on that does not belong to the slice from ``at`` to ``end``."""
        while i < len(self.all) and self.all[i].start < end and min(self.all[i].end, self.audio) <= end:
            i += 1
        return i

    def _target(self, i: int, at: float) -> float:
        if self.controller is None:
            return self.most
        target = self.controller.next_target()
        # a first segment that no target can hold would be tried forever: the target gives way to it
        if i < len(self.all) and self.all[i].start <= at:
            target = max(target, min(self.all[i].end, self.audio) - at)
        return target

    def _rewind(self, first: int, stop: int) -> int:
        """After a poor slice: its first good segment but the first, else what follows it."""
        return next((k for k in range(first + 1, stop) if quality([self.all[k]]) >= self.threshold), stop)

    def run(self) -> list[Slice]:
        out: list[Slice] = []
        i, at = 0, 0.0
        while at < self.audio:
            if i < len(self.all):
                length = self.all[i].end - self.all[i].start
                if length > self.most or length == 0:
                    i, at = i + 1, self._start(i + 1)
                    continue
            hop = at + self._target(i, at)
            end = min(hop, self.audio)
            stop = self._fit(i, at, end)
            own = self.all[i:stop]
            piece = Slice(at, min(own[-1].end, self.audio) - at if own else 0.0)
            piece.segments = [(max(0.0, s.start - at), min(self.most, min(s.end, self.audio) - at), s.text, s.word_scores) for s in own]
            out.append(piece)
            if self.controller and piece.duration > 0:
                self.controller.record(piece.duration)
            if stop < len(self.all) and self.all[stop].start < end:  # it did not fit: the next slice begins there
                hop = self.all[stop].start
            if own and quality(own) < self.threshold:
                i = self._rewind(i, stop)
                at = self._start(i)
                piece.segments = []
                if self.controller and piece.duration > 0:
                    self.controller.reject()
            else:
                i, at = stop, hop
        return out


def greedy_slices(segments: list[Segment], audio_duration: float, max_duration: float, threshold: float = 0.0, controller: DurationController | None = None) -> list[Slice]:
    """Slices of an entry in order, empty and abandoned ones (without segments) included."""
    return _Packer(segments, audio_duration, max_duration, threshold, controller).run()


SLICES = f"array<struct<slice_idx:int,seek:double,duration:double,segments:{SEGMENTS}>>"
_SEGMENT = pa.struct([("start", pa.float64()), ("end", pa.float64()), ("text", pa.string()), ("word_scores", pa.list_(pa.float64()))])
_SLICES = pa.list_(pa.struct([("slice_idx", pa.int32()), ("seek", pa.float64()), ("duration", pa.float64()), ("segments", pa.list_(_SEGMENT))]))


def _parts(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """The rows of a batch in order, in parts of at most ``PART`` rows and segments, or of a row with more."""
    start = held = 0
    for i, n in enumerate(pc.fill_null(pc.list_value_length(batch["s"]), 0).to_pylist()):
        if i > start and (held + n > PART or i - start == PART):
            yield batch.slice(start, i - start)
            start, held = i, 0
        held += n
    yield batch.slice(start)


def _sliced(rows: pa.RecordBatch, entry: str, most: float, threshold: float, controller: DurationController | None) -> pa.RecordBatch:
    out = []
    for found, audio in zip(rows["s"].to_pylist(), rows["d"].to_pylist(), strict=True):
        own = [Segment(x["start"], x["end"], x["text"] or "", tuple(x["word_scores"] or ())) for x in found or ()]
        pieces = [] if audio is None or audio != audio else greedy_slices(own, audio, most, threshold, controller)
        out.append([(n, p.seek, p.duration, p.segments) for n, p in zip(count(), pieces)])
    return pa.RecordBatch.from_arrays([rows["e"], pa.array(out, _SLICES)], [entry, "slices"])


def slice_entries(
    df: DataFrame,
    entry: str,
    segments: str,
    audio_duration: str,
    max_duration: float,
    threshold: float = 0.0,
    shard: str | None = None,
    rank: str | None = None,
    target: float | None = None,
    least: float = 0.0,
    seed: int = 0,
) -> DataFrame:
    """``(entry, slices)`` of a table with a row per entry.

    With ``target``, each ``shard`` has a controller of its own, seeded by (seed, shard), that sees its
    entries in the order of ``rank``; a shard is bounded by how shards are dealt. Without, every entry
    stands alone and nothing is shuffled. Null segments are none; a null duration has no slices.
    """
    kind = df.schema[entry].dataType.simpleString()

    def pack(batch: pa.RecordBatch, controller: DurationController | None) -> Iterator[pa.RecordBatch]:
        return (_sliced(rows, entry, max_duration, threshold, controller) for rows in _parts(batch))

    columns = [F.col(entry).alias("e"), F.col(segments).cast(SEGMENTS).alias("s"), F.col(audio_duration).cast("double").alias("d")]
    schema = f"{entry} {kind}, slices {SLICES}"
    if target is None:
        return df.select(*columns).mapInArrow(lambda batches: (rows for batch in batches for rows in pack(batch, None)), schema)

    def shard_of(key: tuple, rows: pa.Table) -> pa.Table:
        controller = DurationController(least, max_duration, target, f"{seed}:{key[0].as_py()}")
        return pa.Table.from_batches(part for batch in rows.sort_by("r").to_batches() for part in pack(batch, controller))

    return df.select(*columns, F.col(shard).alias("k"), F.col(rank).alias("r")).groupBy("k").applyInArrow(shard_of, schema)


def explode_slices(df: DataFrame, entry: str) -> DataFrame:
    """``(entry, slice_idx, seek, duration, segments)``, a row per slice."""
    return df.select(entry, F.explode("slices").alias("s")).select(entry, "s.*")


def pooled_median(scores: Column | str) -> Column:
    """Median of an array of scores: the mean of the two middle ones, 0 for an empty or null one."""
    scores = F.col(scores) if isinstance(scores, str) else scores
    s = F.array_sort(F.filter(scores, lambda x: x.isNotNull()))
    n = F.size(s)
    middle = (F.try_element_at(s, F.floor((n + 1) / 2).cast("int")) + F.try_element_at(s, (F.floor(n / 2) + 1).cast("int"))) / 2
    return F.when(n > 0, middle).otherwise(F.lit(0.0))


def segment_scores(segments: Column | str) -> Column:
    """All word scores of an array of segments, in order."""
    segments = F.col(segments) if isinstance(segments, str) else segments
    return F.flatten(F.transform(segments, lambda s: F.coalesce(s["word_scores"], F.array().cast("array<double>"))))


def segment_text(segments: Column | str) -> Column:
    """The texts of an array of segments, without a separator."""
    segments = F.col(segments) if isinstance(segments, str) else segments
    return F.array_join(F.transform(segments, lambda s: s["text"]), "", "")
