import math
import random
import statistics
import tracemalloc

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from voxloom.operators import audio, audit, filters, partitioning, sequences, slicing, stats
from voxloom.operators.slicing import DurationController, Segment, greedy_slices


def shape(slices):
    return [(round(s.seek, 6), round(s.duration, 6), [(round(a, 6), round(b, 6), t) for a, b, t, _ in s.segments]) for s in slices]


def test_packing():
    """Ten-second slices of 25 s; an eleven-second segment is skipped."""
    segments = [Segment(a, b, t) for a, b, t in ((0, 4, "A"), (4.1, 8, "B"), (8.5, 12, "C"), (12, 12, "D"), (13, 24, "E"), (24, 25, "F"))]
    assert shape(greedy_slices(segments, 25.0, 10.0)) == [(0, 8, [(0, 4, "A"), (4.1, 8, "B")]), (8.5, 3.5, [(0, 3.5, "C"), (3.5, 3.5, "D")]), (24, 1, [(0, 1, "F")])]


def test_poor_slice_is_abandoned():
    segments = [Segment(0, 3, "A", (0.2,)), Segment(3, 6, "B", (0.9,)), Segment(6, 9, "C", (0.4,))]
    assert shape(greedy_slices(segments, 9.0, 10.0, 0.6)) == [(0, 9, []), (3, 6, [(0, 3, "B"), (3, 6, "C")])]


def test_empty_slices_to_the_end():
    assert shape(greedy_slices([], 25.0, 10.0)) == [(0, 0, []), (10, 0, []), (20, 0, [])]
    assert greedy_slices([Segment(0, 1)], 0.0, 10.0) == []


def test_target_gives_way_to_a_long_first_segment():
    found = greedy_slices([Segment(0, 29, "long"), Segment(29, 30, "x")], 30.0, 30.0, controller=DurationController(5, 30, 20, seed=3))
    assert found[0].segments and len(found) < 10


@pytest.mark.parametrize("seed", range(15))
def test_slices_keep_their_promises(seed):
    rng = random.Random(seed)
    at, segments = 0.0, []
    for i in range(rng.randrange(1, 60)):
        at += rng.random() * 2
        end = at + rng.choice([0, 1, 2, 5, 12, 31]) * rng.random()
        segments.append(Segment(at, end, str(i), (rng.random(),)))
        at = end
    controller = DurationController(5, 30, 20, seed) if seed % 2 else None
    found = greedy_slices(segments, at + 3, 30.0, 0.5 if seed % 3 == 0 else 0.0, controller)
    texts = {s.text: s for s in segments}
    for piece in found:
        assert 0 <= piece.duration <= 30 + 1e-9 or not piece.segments
        for a, b, t, _ in piece.segments:
            assert math.isclose(piece.seek + a, texts[t].start, abs_tol=1e-6) and b <= 30 and b - a <= texts[t].end - texts[t].start + 1e-6
    if seed % 3:
        assert [p.seek for p in found] == sorted(p.seek for p in found)


def test_controller_is_seeded_and_bounded():
    a, b = (DurationController(5, 30, 20, 9) for _ in range(2))
    for _ in range(40):
        x, y = a.next_target(), b.next_target()
        assert x == y and 5 <= x <= 30
        a.record(x)
        b.record(x)


def test_slicing_tables(spark):
    rows = [(i, [{"start": 0.0, "end": 4.0, "text": "a", "word_scores": [0.5]}, {"start": 4.1, "end": 8.0 + i % 3, "text": None, "word_scores": None}], 20.0, i % 2) for i in range(6)]
    rows += [(10, None, 20.0, 0), (11, [], None, 1)]
    df = spark.createDataFrame(rows, f"e long, segments {slicing.SEGMENTS}, d double, shard long")
    plain = {r["e"]: r["slices"] for r in slicing.slice_entries(df, "e", "segments", "d", 10.0).collect()}
    assert len(plain) == 8 and plain[11] == [] and len(plain[10]) == 2 and plain[0][0]["segments"][1]["text"] == ""
    steered = slicing.slice_entries(df, "e", "segments", "d", 10.0, shard="shard", rank="e", target=7.0, least=2.0)
    assert sorted(map(str, steered.collect())) == sorted(map(str, steered.repartition(5).collect())) and steered.count() == 8
    assert slicing.explode_slices(steered, "e").where("e = 10").count() >= 1
    assert slicing.slice_entries(df.where("false"), "e", "segments", "d", 10.0).count() == 0


def test_slicing_holds_few_segments_at_a_time(spark, monkeypatch):
    text = [{"start": i * 3.0, "end": i * 3.0 + 2, "text": f"w{i}", "word_scores": [i % 10 / 10]} for i in range(20)]
    df = spark.createDataFrame([(0, text, 60.0)], f"e long, segments {slicing.SEGMENTS}, d double")
    monkeypatch.setattr(type(df), "mapInArrow", lambda self, f, schema: f)
    run = slicing.slice_entries(df, "e", "segments", "d", 10.0, 0.45)
    kind = pa.list_(pa.struct([("start", pa.float64()), ("end", pa.float64()), ("text", pa.string()), ("word_scores", pa.list_(pa.float64()))]))
    few, many = (pa.RecordBatch.from_pydict({"e": range(n), "s": pa.array([text] * n, kind), "d": [60.0] * n}) for n in (1, 8000))
    wanted = next(run([few]))["slices"][0].as_py()
    tracemalloc.start()
    found = sum(b["slices"].to_pylist() == [wanted] * len(b) and len(b) for b in run([many, few]))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert found == 8001 and len(wanted) > 5 and peak < 20e6, peak


def test_slicing_of_one_entry_with_more_segments_than_a_part(spark):
    text = [(float(i), i + 0.5, "x", [0.5, None]) for i in range(slicing.PART + 7)]
    rows = [(0, text[:3], 3.0, 0), (1, text, len(text) + 0.0, 0), (2, None, 5.0, 0), (3, text[:2], 2.0, 0)]
    df = spark.createDataFrame(rows, f"e long, segments {slicing.SEGMENTS}, d double, shard long").coalesce(1)
    for more in ({}, {"shard": "shard", "rank": "e", "target": 7.0, "least": 2.0}):
        got = {r["e"]: r["slices"] for r in slicing.slice_entries(df, "e", "segments", "d", 10.0, 0.4, **more).collect()}
        assert {e: sum(len(p["segments"]) for p in pieces) for e, pieces in got.items()} == {0: 3, 1: len(text), 2: 0, 3: 2}


def test_medians(spark):
    rows = [([3.0, 1.0, 2.0],), ([4.0, 1.0],), ([],), (None,), ([None, 5.0],)]
    got = [r[0] for r in spark.createDataFrame(rows, "s array<double>").select(slicing.pooled_median("s")).collect()]
    assert got == [2.0, 2.5, 0.0, 0.0, 5.0]


def test_merge_segments_and_rows(spark):
    parts = [(0.0, 4.0, "A", [0.2]), (4.1, 8.0, "B", [0.9]), (8.5, 9.0, "C", [0.1]), (9.3, 9.5, "D", []), (9.0, 9.2, "E", [])]
    df = spark.createDataFrame([(1, [dict(zip(("start", "end", "text", "word_scores"), p)) for p in parts]), (2, []), (3, None)], f"k int, s {slicing.SEGMENTS}")
    got = {r["k"]: r["m"] for r in df.select("k", sequences.merge_segments("s").alias("m")).collect()}
    assert [(x["start"], x["end"], x["text"], x["word_scores"]) for x in got[1]] == [(0.0, 8.0, "AB", [0.2]), (8.5, 9.0, "C", [0.1]), (9.3, 9.2, "DE", [])]
    assert got[2] == [] and got[3] is None
    flat = spark.createDataFrame([(1, i, *p[:3]) for i, p in enumerate(parts)] + [(2, 0, 1.0, 2.0, None)], "k int, i int, s double, e double, t string")
    runs = sequences.merge_gaps(flat, ["k"], "s", "e", "t", order=["i"]).orderBy("k", "run").collect()
    assert [(r["k"], r["start"], r["end"], r["text"], r["n"]) for r in runs] == [(1, 0.0, 8.0, "AB", 2), (1, 8.5, 9.0, "C", 1), (1, 9.3, 9.2, "DE", 2), (2, 1.0, 2.0, "", 1)]


def test_chain(spark):
    rows = [("e", 0, "ok0", False, True), ("e", 1, "short", False, False), ("e", 2, "ok2", False, True), ("e", 3, "", True, True), ("e", 4, "ok4", False, True), ("e", 5, "", False, True), ("e", 6, "ok6", False, True)]
    df = spark.createDataFrame(rows, "entry string, n int, text string, empty boolean, keep boolean")
    got = [(r["n"], r["has_prev"], r["prev_text"]) for r in sequences.link_previous(df, ["entry"], "n", "text", "empty", "keep").orderBy("n").collect()]
    assert got == [(0, False, ""), (2, True, "ok0"), (4, False, ""), (6, True, "")]


def test_filters(spark):
    assert filters.parse_exclusion("a.b:eq:x:y") == filters.Exclusion("a.b", "x:y")
    for bad in ("a", "a:eq", "a:ne:b", ""):
        with pytest.raises(ValueError):
            filters.parse_exclusion(bad)
    docs = ['{"a":{"b":true}}', '{"a":{"b":"true"}}', '{"a":{"b":null}}', '{"a":1}', '{"a.b":"true"}', "not json", None, '{"a":{"b":1.0}}']
    df = spark.createDataFrame(list(enumerate(docs)), "i int, md string")
    left = lambda *f: [r["i"] for r in filters.exclude_by_metadata(df, "md", [filters.parse_exclusion(x) for x in f]).orderBy("i").collect()]
    assert left("a.b:eq:True") == [1, 2, 3, 4, 5, 6, 7] and left("a.b:eq:true") == [0, 2, 3, 4, 5, 6, 7]
    assert left("a.b:eq:1.0", "a:eq:1") == [0, 1, 2, 4, 5, 6] and left() == list(range(8))
    scores = spark.createDataFrame([(0.5,), (0.6,), (None,)], "s double")
    assert filters.quality_gate(scores, "s", 0.6).count() == 2 and filters.quality_gate(scores, "s", 0).count() == 3
    row = df.where("i = 0").select(filters.copy_fields(F.struct(F.lit("x").alias("a"), F.lit(1).alias("k")), "md", ["a", "zz"]).alias("m")).first()["m"]
    assert row.asDict() == {"a": '{"b":true}', "k": 1, "zz": None}
    texts = spark.createDataFrame([("", "b"), (None, "c"), ("a", None), ("", "")], "x string, y string")
    assert [r[0] for r in texts.select(filters.first_text("x", "y")).collect()] == ["b", "c", "a", None]


def test_order_limits_shards_splits(spark):
    rows = [(i, float((i * 7919) % 50) if i % 9 else None, f"p{i:04d}") for i in range(300)]
    df = spark.createDataFrame(rows, "i long, d double, path string").repartition(5)
    order = sorted(rows, key=lambda r: (r[1] or 0.0, r[2]))
    got = partitioning.assign_shards(df, "d", "path", 30).orderBy("rank").collect()
    assert [r["i"] for r in got] == [r[0] for r in order] and [r["shard_id"] for r in got] == [i // 30 for i in range(300)]
    assert [r["i"] for r in partitioning.shortest(df, "d", "path", 5).collect()] == [r[0] for r in order[:5]] and partitioning.shortest(df, "d", "path", 0).count() == 300
    split = partitioning.exact_split(df, "i", 0.101, seed=3)
    assert {r["split"]: r["n"] for r in partitioning.split_counts(split).collect()} == {"eval": 31, "train": 269}
    assert sorted(map(str, split.collect())) == sorted(map(str, partitioning.exact_split(df.repartition(2), "i", 0.101, seed=3).collect()))
    for bad in (0, 1, 1.5):
        with pytest.raises(ValueError):
            partitioning.exact_split(df, "i", bad)
    assert partitioning.concat_chunks([df, df.select("path", "d", "i")]).count() == 600
    indexed = partitioning.with_row_index(df, "i")
    assert [r["i"] for r in audit.page(indexed, 40).collect()] == list(range(40, 60)) and audit.row_at(indexed, 7).first()["i"] == 7
    assert audit.neighbour(0, -1, 300) == 0 and audit.neighbour(299, 1, 300) == 299 and audit.random_row(indexed, 300, 5).count() == 1
    sums = {r["i"]: (r["a"], r["b"]) for r in partitioning.running_sums(df.withColumn("one", F.lit(1)), [-F.col("d"), F.col("i")], a="i", b="one").collect()}
    before = [0, 0]
    for i, _, _ in sorted(rows, key=lambda r: (r[1] is not None, -(r[1] or 0), r[0])):
        assert sums[i] == tuple(before)
        before = [before[0] + i, before[1] + 1]
    none = df.where("false")
    assert partitioning.running_sums(none, [F.col("i")], a="i").count() == 0
    assert partitioning.assign_shards(none, "d", "path", 30).count() == 0 and partitioning.exact_split(none, "i", 0.5).count() == 0


def test_duration(spark):
    docs = ['{"duration": 5}', '{"duration": "6.5"}', '{"session_duration": 7}', '{"duration": null, "session_duration": 7}', "{}", "broken", '{"duration": "x"}']
    got = spark.createDataFrame([(d,) for d in docs], "md string").select(partitioning.duration_of("md")).collect()
    assert [r[0] for r in got] == [5.0, 6.5, 7.0, 0.0, 0.0, 0.0, 0.0]


def test_statistics(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(stats, "_SORTED", 50)
    df = spark.createDataFrame([(float(x),) for x in (0, 1, 2, 3, 4, 10, 20)], "v double")
    row = stats.duration_stats(df, "v").first()
    assert (row["n"], row["max"], row["min"], row["median"]) == (7, 20.0, 0.0, 3.0) and math.isclose(row["stdev"], 7.0879, abs_tol=1e-3)
    assert stats.duration_stats(df.limit(1), "v").first()["stdev"] == 0.0
    rng = random.Random(3)
    for values in ([rng.random() ** 9 * 1e9 for _ in range(3001)], [7.0] * 500 + [1e-300, 1e300], [float(rng.randrange(3)) for _ in range(400)], [-1.5, 2.5]):
        many = spark.createDataFrame([(x,) for x in values] + [(None,)], "v double")
        assert stats.duration_stats(many, "v").first()["median"] == statistics.median(values)
    assert stats.duration_stats(df.where("false"), "v").first()["median"] is None
    bins = stats.histogram(df, "v").orderBy("bin").collect()
    assert len(bins) == 20 and [r["n"] for r in bins][:5] == [1, 1, 1, 1, 1] and bins[10]["n"] == 1 and bins[19]["n"] == 1 and sum(r["n"] for r in bins) == 7
    same = stats.histogram(spark.createDataFrame([(3.0,), (3.0,), (None,)], "v double"), "v").collect()
    assert [(r["bin"], r["low"], r["high"], r["n"]) for r in same] == [(0, 3.0, 3.0, 2)]
    assert stats.histogram(df.where("false"), "v").count() == 0
    assert len(stats.render_histogram(bins).splitlines()) == 20 and stats.save_histogram_png(bins, {"mean": 1.0}, str(tmp_path / "h.png")) in (True, False)


def test_audio(spark):
    pcm = b"".join(int(i).to_bytes(2, "little", signed=True) for i in range(-50, 50))
    wav = audio.encode_wav(pcm)
    assert audio.encode_wav(b"") == b"" and audio.decode_audio(wav) == pcm
    with pytest.raises(RuntimeError):
        audio.decode_audio(b"no audio")
    df = spark.createDataFrame([(wav, pcm), (b"bad", None), (None, None)], "w binary, pcm binary")
    rows = df.select(audio.decode_column("w").alias("a"), audio.wav_samples(F.when(F.col("pcm").isNotNull(), F.col("w"))).alias("s"), audio.wav_bytes("pcm").alias("back")).collect()
    assert bytes(rows[0]["a"]["pcm"]) == pcm and bytes(rows[0]["back"]) == wav and rows[0]["s"][0] == pytest.approx(-50 / 32768)
    assert rows[1]["a"]["pcm"] is None and rows[1]["a"]["error"] and rows[2]["a"]["error"] == "no audio"
    first, stop = audio.sample_range(F.lit(0.5 / 24000), F.lit(1.0 / 24000))
    assert tuple(spark.range(1).select(first, stop).first()) == (0, 2)
    cut = df.limit(1).select(audio.cut_pcm("pcm", F.lit(10 / 24000), F.lit(5 / 24000))).first()[0]
    assert bytes(cut) == pcm[20:30]
    got = spark.createDataFrame([(1.5,), (-2.0,), (0.5,), (0.0,)], "x double").select(audio.pcm16("x"), audio.from_pcm16(F.lit(-32768))).collect()
    assert [r[0] for r in got] == [32767, -32768, 16384, 0] and got[0][1] == -1.0


def test_audit_views(spark, tmp_path):
    df = spark.createDataFrame([("10km", None, "train"), (None, "plain", "eval")], "raw_text string, text string, split string")
    rows = {r["raw"]: r for r in audit.before_after(df).collect()}
    assert rows["10km"]["cautious"] == "עשרה קילומטר" and rows["10km"]["cautious_changed"] == "YES" and rows["plain"]["expanded_changed"] == "no"
    assert audit.pick_split(df).first()["split"] == "eval" and audit.pick_split(df, "train").count() == 1 and audit.pick_split(df.drop("split")).count() == 2
    for kind, value in (("struct<bytes:binary,path:string>", (None, "p")), ("string", "p")):
        assert audit.audio_path(spark.createDataFrame([(value,)], f"audio {kind}")).first()["audio_path"] == "p"
    (tmp_path / "x.wav").write_bytes(b"")
    assert audit.resolve_path("/no/x.wav", [str(tmp_path)]) == str(tmp_path / "x.wav") and audit.resolve_path("/no/y.wav", []) is None
    assert "\n" in spark.range(1).select(F.struct(F.lit("א").alias("a")).alias("metadata")).select(audit.pretty_metadata()).first()[0]


def test_merged_segments_of_any_array(spark):
    """Null and empty arrays stay; gaps of the threshold part, null times too; a null text is empty; long arrays keep every text."""
    kind = "id int, segments array<struct<start:double,end:double,text:string,word_scores:array<double>>>"
    long = [(float(i), i + (0.9 if i % 100 else 0.5), str(i % 10), [float(i)]) for i in range(5000)]
    rows = [(1, None), (2, []), (3, [(0.0, 1.0, "a", [0.5]), (1.25, 2.0, None, None), (2.5, 3.0, "b", []), (3.5, 4.0, "c", None)]), (4, [(0.0, None, "a", None), (1.0, 2.0, "b", None)]), (5, long)]
    found = {r["id"]: r["m"] for r in spark.createDataFrame(rows, kind).select("id", sequences.merge_segments("segments").alias("m")).collect()}
    assert found[1] is None and found[2] == []
    assert [tuple(x) for x in found[3]] == [(0.0, 2.0, "a", [0.5]), (2.5, 3.0, "b", []), (3.5, 4.0, "c", None)]
    assert [x["text"] for x in found[4]] == ["a", "b"]
    # after every 100th segment the gap is 0.5
    assert len(found[5]) == 51 and "".join(x["text"] for x in found[5]) == "".join(x[2] for x in long)
    assert all(x["word_scores"] == [x["start"]] for x in found[5])
