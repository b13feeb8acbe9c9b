"""Preparing a speech dataset: entry folders in, examples out, as one lazy plan."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import columns, rewrite
from ..operators import audio, filters, partitioning, sequences, slicing
from ..sources import entries
from ..sources.shared import stage


@dataclass(frozen=True)
class PrepareConfig:
    input_folder: str
    max_duration: float = 30.0
    min_duration: float = 5.0
    target_duration: float | None = None
    max_source_entries: int | None = None
    audio_filename_glob: str = entries.AUDIO_GLOB
    segments_filename_glob: str = entries.TRANSCRIPT_GLOB
    metadata_glob: str = entries.METADATA_GLOB
    num_proc: int = 1
    per_proc_per_chunk_size: int = 10
    per_sample_quality_threshold: float = 0.0
    per_segment_quality_threshold: float = 0.0
    copy_metadata_fields: tuple[str, ...] = ()
    exclude_filters: tuple[filters.Exclusion, ...] = ()
    seed: int = 0
    strict_folders: bool = True
    replacements: dict[str, str] = field(default_factory=dict)


@dataclass(frozen=True)
class Prepared:
    """Examples, and entries left out because of an error, with the reason.

    ``keyed`` has the examples with a column ``_key`` that no two share, and ``keys`` that column alone,
    from a table without audio: what is to be ranked or split is ranked or split there.
    """

    examples: DataFrame
    quarantine: DataFrame
    keyed: DataFrame
    keys: DataFrame


def manifest(spark: SparkSession, c: PrepareConfig) -> tuple[DataFrame, DataFrame]:
    """A row per transcript: entry (its path), audio_path, md (JSON), duration, rank and shard_id; and entry and error of the others.

    A folder without exactly one audio and one metadata file is an error, or, without
    ``strict_folders``, its transcripts are among the others.
    """
    transcripts = entries.list_files(spark, c.input_folder, c.segments_filename_glob).withColumnRenamed("path", "entry")
    metadata = entries.read_texts(spark, c.input_folder, c.metadata_glob)
    found = entries.co_locate(transcripts, entries.list_files(spark, c.input_folder, c.audio_filename_glob), metadata.select("dir", "path"), strict=c.strict_folders)
    found = stage(found, "folders")
    sound = found.where("problem is null").join(metadata.select("dir", F.col("value").alias("md")), "dir")
    sound = sound.withColumn("md_duration", partitioning.duration_of("md"))
    chosen = partitioning.shortest(sound, "md_duration", "entry", c.max_source_entries)
    ranked = partitioning.assign_shards(chosen, "md_duration", "entry", c.num_proc * c.per_proc_per_chunk_size)
    return stage(ranked, "manifest"), found.where("problem is not null").select("entry", F.col("problem").alias("error"))


def prepare(spark: SparkSession, c: PrepareConfig) -> Prepared:
    """Filters come before transcripts are parsed, and audio is opened by path, only for what they leave.

    The manifest and the texts, slices and links are tables, each worked out once. Before slicing only
    the length of an entry's audio is taken, from a WAV file's header; it is decoded when it is cut where
    the slices are, and the pieces are exploded in place, so audio is never moved between tasks.
    """
    listed, misplaced = manifest(spark, c)
    wanted = filters.exclude_by_metadata(listed, "md", list(c.exclude_filters))
    wanted = wanted.withColumn("sample_score", F.get_json_object("md", "$['quality_score']").try_cast("double"))
    wanted = filters.quality_gate(wanted, "sample_score", c.per_sample_quality_threshold)
    transcripts = entries.read_texts(spark, c.input_folder, c.segments_filename_glob).select(F.col("path").alias("entry"), "value")
    parsed = entries.parse_transcripts(wanted.join(transcripts, "entry")).drop("value")
    measured = F.when(F.col("parse_error").isNull(), audio.file_seconds("audio_path"))
    parsed = stage(parsed.withColumn("a", measured).withColumn("audio_duration", F.col("a.seconds")).withColumn("error", F.coalesce("parse_error", "a.error")).drop("a"), "transcripts")
    ready = parsed.where("error is null")
    sliced = slicing.slice_entries(
        ready, "entry", "segments", "audio_duration", c.max_duration, c.per_segment_quality_threshold, "shard_id", "rank", c.target_duration, c.min_duration, c.seed
    )
    pieces = slicing.explode_slices(sliced, "entry").withColumn("segments", sequences.merge_segments("segments"))
    pieces = pieces.withColumn("raw_text", slicing.segment_text("segments")).withColumn("quality_score", slicing.pooled_median(slicing.segment_scores("segments")))
    pieces = pieces.withColumn("empty", F.size("segments") == 0).drop("segments").withColumn("text", columns.normalize_speech("raw_text", rewrite.PREPARATION, c.replacements))
    linked = sequences.link_previous(pieces, ["entry"], "slice_idx", "text", "empty", F.col("duration") >= c.min_duration)
    linked = stage(linked.select("entry", "slice_idx", "seek", "duration", "quality_score", "text", "raw_text", "has_prev", "prev_text"), "pieces")

    source, own_id = F.get_json_object("md", "$['source_id']"), F.get_json_object("md", "$['source_entry_id']")
    about = wanted.select("entry", "audio_path", "md", F.coalesce(source, F.lit("unknown")).alias("source"), F.coalesce(own_id, F.sha2("entry", 256)).alias("entry_id"))
    texts = linked.groupBy("entry").agg(F.collect_list(F.struct("slice_idx", "seek", "duration", "quality_score", "text", "raw_text", "has_prev", "prev_text")).alias("pieces"))  # of one entry
    whole = about.join(texts, "entry").withColumn("pcm", audio.decode_files("audio_path")["pcm"])
    rows = whole.withColumn("p", F.explode("pieces")).withColumn("part", audio.cut_pcm("pcm", F.col("p.seek"), F.col("p.duration"))).drop("pcm", "pieces")
    metadata = F.struct(
        F.col("p.seek").cast("float").alias("seek"), F.col("p.duration").cast("float").alias("duration"), F.col("source"), F.col("entry_id"), F.col("p.quality_score").cast("float").alias("quality_score")
    )
    metadata = filters.copy_fields(metadata, "md", list(c.copy_metadata_fields))
    path = F.concat(F.col("entry_id"), F.lit(".wav"))
    key = lambda i: F.sha2(F.concat_ws(":", "entry", i), 256).alias("_key")
    keyed = rows.select(F.struct(audio.wav_bytes("part").alias("bytes"), path.alias("path")).alias("audio"), "p.text", "p.raw_text", metadata.alias("metadata"), "p.has_prev", "p.prev_text", key("p.slice_idx"))
    bad = parsed.where("error is not null").select("entry", "error").unionByName(misplaced)
    return Prepared(keyed.drop("_key"), bad, keyed, linked.select(key("slice_idx")))
