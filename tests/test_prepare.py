import json
import logging

import pytest
from pyspark.sql import functions as F

from voxloom.operators import audio, filters
from voxloom.plans import cli, config
from voxloom.plans.prepare import PrepareConfig, manifest, prepare
from voxloom.sources import datasets, entries, replacements
from voxloom.streaming import rewrite_stream


def segment(start, end, text, p=0.9):
    return {"start": start, "end": end, "text": text, "words": [{"start": start, "end": end, "word": text, "probability": p, "tokens": [1]}], "seek": 0.0}


def wav(seconds):
    return audio.encode_wav(bytes(2 * int(seconds * audio.RATE)))


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    root = tmp_path_factory.mktemp("entries")
    three = {"segments": [segment(0, 4, " 3 ילדות"), segment(4.1, 8, " ועוד."), segment(8.5, 12, "סוף"), segment(12.5, 17, "עוד")]}
    good = [
        {"name": "a/one", "audio": wav(20), "transcript": three, "metadata": {"duration": 20, "quality_score": 0.9, "source_id": "s", "source_entry_id": "one", "lang": "he", "nested": {"ok": True}}},
        {"name": "a/two", "audio": wav(9), "transcript": {"segments": [segment(0, 6, "טקסט")]}, "metadata": {"session_duration": 9}},
        {"name": "b/poor", "audio": wav(9), "transcript": three, "metadata": {"duration": "9", "quality_score": 0.1}},
        {"name": "b/left", "audio": wav(9), "transcript": three, "metadata": {"duration": 9, "drop": "yes"}},
        {"name": "c/strange", "audio": wav(9), "transcript": {"segments": [segment(0, 1, "x") | {"unknown": 1}]}, "metadata": {"duration": 9}},
        {"name": "c/missing", "audio": wav(9), "transcript": {"segments": [{"start": 0, "end": 1, "text": "x"}]}, "metadata": {"duration": 9}},
        {"name": "c/noise", "audio": b"not audio", "transcript": three, "metadata": {"duration": 9}},
    ]
    entries.write_entries(good, str(root))
    return str(root)


def settings(folder, **more):
    return PrepareConfig(folder, **{"max_duration": 10.0, "min_duration": 3.0, "per_sample_quality_threshold": 0.5, "exclude_filters": (filters.parse_exclusion("drop:eq:yes"),), "copy_metadata_fields": ("lang",), **more})


def test_examples(spark, folder):
    out = prepare(spark, settings(folder))
    rows = out.examples.select("text", "raw_text", "has_prev", "prev_text", "metadata.*", F.col("audio.path").alias("path"), F.octet_length("audio.bytes").alias("n")).orderBy("entry_id", "seek").collect()
    one = [r for r in rows if r["entry_id"] == "one"]
    assert [r["text"] for r in one] == ["שלוש ילדות ועוד.", "סוףעוד"] and one[0]["raw_text"] == " 3 ילדות ועוד."
    assert [(r["has_prev"], r["prev_text"]) for r in one] == [(False, ""), (True, "שלוש ילדות ועוד.")]
    assert [(r["seek"], r["duration"], r["source"], r["lang"], r["path"]) for r in one] == [(0.0, 8.0, "s", "he", "one.wav"), (8.5, 8.5, "s", "he", "one.wav")]
    assert [r["n"] for r in one] == [44 + 2 * int(s * audio.RATE) for s in (8, 8.5)] and one[0]["quality_score"] == pytest.approx(0.9)
    other = [r for r in rows if r["entry_id"] != "one"]
    assert len(other) == 1 and other[0]["source"] == "unknown" and len(other[0]["entry_id"]) == 64 and other[0]["lang"] is None
    assert out.examples.schema["metadata"].dataType.simpleString() == "struct<seek:float,duration:float,source:string,entry_id:string,quality_score:float,lang:string>"
    bad = {r["entry"].split("/")[-2]: r["error"] for r in out.quarantine.collect()}
    assert set(bad) == {"strange", "missing", "noise"}


def test_steered_and_limited(spark, folder):
    a, b = (prepare(spark, settings(folder, target_duration=6.0, max_source_entries=3, seed=2)).examples.drop("audio").orderBy("metadata.entry_id", "metadata.seek").collect() for _ in range(2))
    assert a == b
    found = manifest(spark, settings(folder, per_proc_per_chunk_size=2))[0].orderBy("rank").collect()
    assert [r["shard_id"] for r in found] == [i // 2 for i in range(7)] and [r["md_duration"] for r in found] == [9.0] * 6 + [20.0]


def test_folders_and_files_left_out(spark, folder, tmp_path):
    """Without strict folders a broken one is reported; files of entries that are left out are not opened."""
    import shutil

    copy = str(tmp_path / "in")
    shutil.copytree(folder, copy)
    some = next(p.parent for p in sorted((tmp_path / "in").rglob("audio.*")) if p.parent.name not in ("noise", "strange", "missing"))
    shutil.copy(next(some.glob("audio.*")), some / "audio.again.wav")
    with pytest.raises(Exception, match="audio files: 2"):
        prepare(spark, settings(copy))
    out = prepare(spark, settings(copy, strict_folders=False))
    assert {r["entry"].split("/")[-2]: r["error"] for r in out.quarantine.collect()}[some.name] == "audio files: 2"
    whole = prepare(spark, settings(folder))
    assert 0 < out.examples.count() <= whole.examples.count() and whole.keys.distinct().count() == whole.keyed.count() == whole.keyed.join(whole.keys, "_key").count()


def test_co_location(spark, tmp_path):
    files = lambda rows: spark.createDataFrame(rows, "dir string, path string")
    transcripts = files([("a", "a/t1"), ("a", "a/t2"), ("b", "b/t"), ("c", "c/t")])
    sounds, about = files([("a", "a/s"), ("b", "b/s1"), ("b", "b/s2")]), files([("a", "a/m"), ("b", "b/m"), ("c", "c/m")])
    marked = {r["path"]: r["problem"] for r in entries.co_locate(transcripts, sounds, about, strict=False).collect()}
    assert marked == {"a/t1": None, "a/t2": None, "b/t": "audio files: 2", "c/t": "audio files: 0"}
    with pytest.raises(Exception, match="audio files"):
        entries.co_locate(transcripts, sounds, about).collect()


def test_scans_read_paths_only(spark, folder, capsys):
    entries.list_files(spark, folder, "audio.*").explain("formatted")
    assert "ReadSchema: struct<path:string>" in capsys.readouterr().out


def test_replacements(spark, tmp_path):
    text = "﻿SOURCE\tTARGET\n a \t b \nx\t\n\ty\na\tc\n"
    (tmp_path / "r.tsv").write_text(text, encoding="utf8")
    assert replacements.load_replacements(spark, str(tmp_path / "r.tsv")) == {"a": "c"}
    assert replacements.parse_replacements(text, strict=False) == {" a ": " b ", "x": "", "": "y", "a": "c"}
    assert replacements.load_replacements(spark, None) == {}


def test_datasets(spark, tmp_path, monkeypatch):
    df = spark.createDataFrame([("a", "train"), ("b", "eval"), ("c", "train")], "text string, split string")
    path = str(tmp_path / "out")
    (tmp_path / "LICENSE").write_text("free")
    counts = datasets.write_dataset(df, path, "name", "1.0", str(tmp_path / "LICENSE"), language="he", task_categories=["asr"])
    assert counts == {"train": 2, "eval": 1} and datasets.open_dataset(spark, path).count() == 3
    assert json.loads((tmp_path / "out/_dataset_info.json").read_text())["splits"] == counts and (tmp_path / "out/_LICENSE").read_text() == "free"
    assert "language: he" in (tmp_path / "out/_README.md").read_text() and datasets.card() is None
    assert datasets.write_dataset(df.where("false"), str(tmp_path / "none")) is None and not (tmp_path / "none").exists()
    assert datasets.write_dataset(df.drop("split"), None) == {"all": 3}
    assert datasets.Hub(str(tmp_path / "hub")).push(path, "n").endswith("private/n") and (tmp_path / "hub/private/n/_LICENSE").exists()
    import pyarrow as pa

    table = pa.table({"text": ["x", "y"]})
    (tmp_path / "d").mkdir()
    with pa.OSFile(str(tmp_path / "d/raw.arrow"), "wb") as f, pa.ipc.new_stream(f, table.schema) as w:
        w.write_table(table)
    assert datasets.open_dataset(spark, str(tmp_path / "d")).count() == 2 and datasets.open_dataset(spark, str(tmp_path / "d/raw.arrow")).count() == 2
    (tmp_path / "e").mkdir()
    (tmp_path / "d").rename(tmp_path / "e/raw")
    assert datasets.open_dataset(spark, str(tmp_path / "e")).count() == 2
    with pytest.raises(FileNotFoundError):
        datasets.open_dataset(spark, str(tmp_path / "no"))
    monkeypatch.setenv("DATA_PATH", str(tmp_path / "no"))
    assert datasets.open_from_environment(spark).count() == 0


def test_config(tmp_path, caplog):
    (tmp_path / "c.json").write_text(json.dumps({"prepare": {"input_folder": "/in", "max_duration": 12, "nonsense": 1, "exclude_by_md": ["a:eq:b"]}}))
    with caplog.at_level(logging.WARNING):
        args = cli.parse(["--config", str(tmp_path / "c.json"), "--min_duration", "2"])
    assert (args.input_folder, args.max_duration, args.min_duration) == ("/in", 12, 2.0) and "nonsense" in caplog.text
    assert args.exclude_filters == (filters.Exclusion("a", "b"),)
    (tmp_path / "c.yaml").write_text("# run\nprepare:\n  input_folder: /in\n  max_duration: 30.0\n  exclude_by_md:\n  - 'x:eq:y'\n  push_to_hub: false\n  log_level: INFO # quiet\n")
    found = config.load_config(str(tmp_path / "c.yaml"))
    assert found == config._flat_yaml((tmp_path / "c.yaml").read_text())["prepare"] == {"input_folder": "/in", "max_duration": 30.0, "exclude_by_md": ["x:eq:y"], "push_to_hub": False, "log_level": "INFO"}
    assert cli.parse(["/in", "--slice_length", "8"]).max_duration == 8 and cli.parse(["/in", "--slice_length", "8", "--max_duration", "9"]).max_duration == 9
    for argv, error in ((["/in", "--log_level", "LOUD"], ValueError), (["/in", "--exclude_by_md", "a"], ValueError), ([], SystemExit), (["--config", "none.json"], FileNotFoundError)):
        with pytest.raises(error):
            cli.parse(argv)
    (tmp_path / "c.txt").write_text("")
    (tmp_path / "l.json").write_text("[]")
    for name in ("c.txt", "l.json"):
        with pytest.raises(ValueError):
            config.load_config(str(tmp_path / name))


def test_command_line(spark, folder, tmp_path):
    args = cli.parse([folder, "--max_duration", "10", "--min_duration", "3", "--validation_split_size", "0.3", "--output_dataset_name", str(tmp_path / "ds"), "--dataset_card_language", "he", "--exclude_by_md", "drop:eq:yes"])
    counts = cli.run(spark, args)
    assert sum(counts.values()) == datasets.open_dataset(spark, str(tmp_path / "ds")).count() and set(counts) == {"train", "eval"}


def test_command_line_quarantine(spark, folder, tmp_path, caplog):
    args = cli.parse([folder, "--max_duration", "10", "--min_duration", "3", "--output_dataset_name", str(tmp_path / "ds")])
    cli.run(spark, args)
    left_out = {r["entry"].split("/")[-2]: r["error"] for r in spark.read.parquet(str(tmp_path / "ds_quarantine")).collect()}
    assert set(left_out) == {"strange", "missing", "noise"} and all(left_out.values())
    assert "3 entries left out because of an error" in caplog.text


def test_streams(spark, tmp_path):
    rows = [("u", "2024-01-01 00:00:00.0", "10km "), ("u", "2024-01-01 00:00:00.2", "b"), ("u", "2024-01-01 00:00:05", "c")]
    df = spark.createDataFrame(rows, "k string, ts string, t string").withColumn("ts", F.col("ts").cast("timestamp"))
    df.write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(df.schema).parquet(str(tmp_path / "in"))
    for name, out in (("plain", rewrite_stream.normalize_stream(stream, "t")), ("merged", rewrite_stream.merge_sessions(stream, "k", "ts", "t"))):
        query = out.writeStream.format("memory").queryName(name).outputMode("append" if name == "plain" else "complete").start()
        query.processAllAvailable()
        query.stop()
    assert {r["normalized"] for r in spark.table("plain").collect()} == {"עשרה קילומטר", "b", "c"}
    assert {(r["text"], r["n"]) for r in spark.table("merged").collect()} == {("10km b", 2), ("c", 1)}
