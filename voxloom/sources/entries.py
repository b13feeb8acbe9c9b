"""Folders of audio, transcript and metadata files as tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

AUDIO_GLOB, TRANSCRIPT_GLOB, METADATA_GLOB = "audio.*", "transcript.*.json", "metadata.json"

WORD = "struct<start:double,end:double,word:string,probability:double,tokens:array<bigint>>"
SEGMENT = f"struct<start:double,end:double,text:string,words:array<{WORD}>,seek:double,tokens:array<bigint>,temperature:double,avg_logprob:double,compression_ratio:double,no_speech_prob:double>"
TRANSCRIPT = f"struct<segments:array<{SEGMENT}>>"
_WORD_KEYS = ("start", "end", "word", "probability", "tokens")
_SEGMENT_KEYS = ("start", "end", "text", "words", "seek", "tokens", "temperature", "avg_logprob", "compression_ratio", "no_speech_prob")
_SEGMENT_NEEDS = ("start", "end", "text", "words")


def list_files(spark: SparkSession, folder: str, glob: str) -> DataFrame:
    """``(path, dir)`` of all files under the folder whose name fits; contents are not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", glob).load(folder)
    return files.select("path").withColumn("dir", F.regexp_extract("path", r"^(.*)/[^/]*$", 1))


def read_texts(spark: SparkSession, folder: str, glob: str) -> DataFrame:
    """``(path, dir, value)``: whole files as text."""
    files = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", glob).text(folder, wholetext=True)
    return files.select(F.col("_metadata.file_path").alias("path"), "value").withColumn("dir", F.regexp_extract("path", r"^(.*)/[^/]*$", 1))


def read_audio(spark: SparkSession, folder: str, glob: str = AUDIO_GLOB) -> DataFrame:
    """``(path, content)``; join it with the entries that are left before anything reads ``content``."""
    return spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", glob).load(folder).select("path", "content")


def co_locate(transcripts: DataFrame, audio: DataFrame, metadata: DataFrame, key: str = "dir", strict: bool = True) -> DataFrame:
    """A row per transcript with the one audio file and the one metadata file of its folder.

    ``audio`` and ``metadata`` have ``key`` and ``path``; the result has ``audio_path``,
    ``metadata_path`` and ``problem``, null for sound entries. With ``strict`` a folder with none or
    several of either is an error when the result is read; otherwise it is marked for quarantine.
    """

    def one(files: DataFrame, name: str) -> DataFrame:
        return files.groupBy(key).agg(F.count("*").alias(f"{name}_n"), F.min("path").alias(f"{name}_path"))

    out = transcripts.join(one(audio, "audio"), key, "left").join(one(metadata, "metadata"), key, "left")
    counts = [F.coalesce(f"{n}_n", F.lit(0)) for n in ("audio", "metadata")]
    bad = [F.when(c != 1, F.concat(F.lit(f"{name} files: "), c.cast("string"))) for c, name in zip(counts, ("audio", "metadata"), strict=True)]
    problem = F.nullif(F.concat_ws("; ", *bad), F.lit(""))
    if strict:
        problem = F.when(problem.isNotNull(), F.raise_error(F.concat(F.col(key).cast("string"), F.lit(": "), problem)).cast("string"))
    return out.withColumn("problem", problem).drop("audio_n", "metadata_n")


def _known_keys(text: Column) -> Column:
    """Whether every segment and word of the transcript has the required keys and no unknown ones."""
    raw = F.from_json(text, "struct<segments:array<map<string,string>>>")["segments"]

    def segment(s: Column) -> Column:
        keys = F.map_keys(s)
        words = F.from_json(F.try_element_at(s, F.lit("words")), "array<map<string,string>>")
        fine = lambda w: (F.size(F.array_except(F.map_keys(w), F.array(*map(F.lit, _WORD_KEYS)))) == 0) & (F.size(F.map_keys(w)) == len(_WORD_KEYS))
        return (F.size(F.array_except(keys, F.array(*map(F.lit, _SEGMENT_KEYS)))) == 0) & (F.size(F.array_except(F.array(*map(F.lit, _SEGMENT_NEEDS)), keys)) == 0) & words.isNotNull() & F.coalesce(F.forall(words, fine), F.lit(False))

    return raw.isNotNull() & F.coalesce(F.forall(raw, segment), F.lit(False))


def parse_transcripts(df: DataFrame, value: str = "value") -> DataFrame:
    """``segments`` from JSON text, and ``parse_error``, null where the transcript follows the schema.

    A segment or word with an unknown key or without a required one rejects the whole transcript.
    """
    parsed = F.from_json(F.col(value), TRANSCRIPT)["segments"]
    slim = F.transform(parsed, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), F.coalesce(s["text"], F.lit("")).alias("text"), F.transform(s["words"], lambda w: w["probability"]).alias("word_scores")))
    ok = _known_keys(F.col(value)) & F.forall(parsed, lambda s: s["start"].isNotNull() & s["end"].isNotNull())
    return df.withColumn("parse_error", F.when(F.coalesce(ok, F.lit(False)), F.lit(None).cast("string")).otherwise("the transcript does not follow the schema")).withColumn("segments", F.when(F.col("parse_error").isNull(), slim))


def write_entries(entries: list[dict], folder: str) -> None:
    """Write entry folders on this machine, for examples and tests: name, audio (bytes), transcript and metadata (JSON values)."""
    import json
    import os

    for e in entries:
        os.makedirs(path := os.path.join(folder, e["name"]), exist_ok=True)
        with open(os.path.join(path, "audio.wav"), "wb") as f:
            f.write(e["audio"])
        for name in ("transcript", "metadata"):
            with open(os.path.join(path, f"{name}.full.json" if name == "transcript" else "metadata.json"), "w", encoding="utf8") as f:
                json.dump(e[name], f, ensure_ascii=False, indent=1)
