"""Streams: text rewriting, which has no state, and merging across gaps in event time."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import columns, rewrite


def normalize_stream(stream: DataFrame, text: str, options: rewrite.SpeechOptions = rewrite.CAUTIOUS, replacements: dict[str, str] | None = None) -> DataFrame:
    """The stream with ``normalized`` beside the text."""
    return stream.withColumn("normalized", columns.normalize_speech(text, options, replacements))


def merge_sessions(stream: DataFrame, key: str, time: str, text: str, gap: str = "300 milliseconds", late: str = "10 minutes") -> DataFrame:
    """Runs of a key's events less than ``gap`` apart, as sessions: key, start, end, text and n.

    Rows later than ``late`` behind the newest are left out of their session, as watermarks do.
    """
    parts = F.array_sort(F.collect_list(F.struct(time, F.coalesce(F.col(text), F.lit("")).alias("t"))))
    sessions = stream.withWatermark(time, late).groupBy(F.session_window(time, gap), key)
    out = sessions.agg(F.min(time).alias("start"), F.max(time).alias("end"), F.array_join(F.transform(parts, lambda p: p["t"]), "").alias("text"), F.count("*").alias("n"))
    return out.drop("session_window")
