"""Waveforms: decoding, cutting by samples, encoding as WAV."""

from __future__ import annotations

import io
import re
import shutil
import subprocess
import wave

import numpy as np
import pyarrow as pa
from pyarrow import fs as arrow_fs
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

RATE = 24_000


def sample_range(start: Column | str, length: Column | str, rate: int = RATE) -> tuple[Column, Column]:
    """First sample, and the one after the last; halves are rounded to even."""
    start, length = (F.col(c) if isinstance(c, str) else c for c in (start, length))
    first = F.greatest(F.lit(0), F.rint(start * rate).cast("long"))
    return first, F.greatest(first, F.rint((start + length) * rate).cast("long"))


def cut_samples(samples: Column | str, start: Column | str, length: Column | str, rate: int = RATE) -> Column:
    """That part of an array of samples; what lies beyond its end is missing."""
    first, stop = sample_range(start, length, rate)
    return F.slice(samples, first.cast("int") + 1, (stop - first).cast("int"))


def cut_pcm(pcm: Column | str, start: Column | str, length: Column | str, rate: int = RATE) -> Column:
    """The same of 16-bit PCM bytes, which is how long audio travels."""
    first, stop = sample_range(start, length, rate)
    return F.substring(pcm, (first * 2 + 1).cast("int"), ((stop - first) * 2).cast("int"))


def pcm16(sample: Column | str) -> Column:
    """A sample in [-1, 1] as a 16-bit integer: scaled by 32767, halves to even, clipped."""
    sample = F.col(sample) if isinstance(sample, str) else sample
    return F.greatest(F.lit(-32768), F.least(F.lit(32767), F.rint(sample.cast("double") * 32767))).cast("int")


def from_pcm16(sample: Column | str) -> Column:
    sample = F.col(sample) if isinstance(sample, str) else sample
    return (sample / 32768.0).cast("float")


def decode_audio(data: bytes, rate: int = RATE) -> bytes:
    """Mono 16-bit PCM at ``rate`` of an audio file's bytes.

    PCM WAV that already has that form is read directly; anything else goes through ffmpeg, whose
    failure or absence is an error with what it said.
    """
    try:
        with wave.open(io.BytesIO(data)) as w:
            if (w.getnchannels(), w.getsampwidth(), w.getframerate()) == (1, 2, rate):
                return w.readframes(w.getnframes())
    except (wave.Error, EOFError):
        pass
    tool = shutil.which("ffmpeg")
    if tool is None:
        raise RuntimeError("the audio is not 16-bit mono WAV at the wanted rate, and ffmpeg is not installed")
    done = subprocess.run([tool, "-loglevel", "error", "-i", "pipe:0", "-ac", "1", "-ar", str(rate), "-f", "s16le", "pipe:1"], input=data, capture_output=True)
    if done.returncode:
        raise RuntimeError(f"ffmpeg failed: {done.stderr.decode(errors='replace')}")
    return done.stdout


def encode_wav(pcm: bytes, rate: int = RATE) -> bytes:
    """A WAV file of mono 16-bit PCM; no bytes for no samples."""
    if not pcm:
        return b""
    out = io.BytesIO()
    with wave.open(out, "wb") as w:
        w.setnchannels(1)
        w.setsampwidth(2)
        w.setframerate(rate)
        w.writeframes(pcm)
    return out.getvalue()


@F.arrow_udf(T.BinaryType())
def wav_bytes(pcm: pa.Array) -> pa.Array:
    """WAV files of 16-bit PCM columns."""
    return pa.array([None if p is None else encode_wav(p) for p in pcm.to_pylist()], pa.binary())


@F.arrow_udf(T.StructType([T.StructField("pcm", T.BinaryType()), T.StructField("error", T.StringType())]))
def decode_column(data: pa.Array) -> pa.Array:
    """PCM of audio files, or why there is none: a bad file spoils its own row only."""
    pcm, errors = [], []
    for d in data.to_pylist():
        try:
            pcm.append(None if d is None else decode_audio(d))
            errors.append("no audio" if d is None else None)
        except Exception as e:
            pcm.append(None)
            errors.append(str(e))
    return pa.StructArray.from_arrays([pa.array(pcm, pa.binary()), pa.array(errors, pa.string())], ["pcm", "error"])


def read_file(path: str) -> bytes:
    """A whole file of any store that Arrow knows, read in the task that needs it."""
    fs, own = arrow_fs.FileSystem.from_uri(re.sub("^file:/+", "/", path))
    with fs.open_input_stream(own, compression=None) as f:
        return f.read()


def seconds(data: bytes, rate: int = RATE) -> float:
    """How long the audio is: from a WAV file's header if that has the wanted form, else by decoding it."""
    try:
        with wave.open(io.BytesIO(data)) as w:
            if (w.getnchannels(), w.getsampwidth(), w.getframerate()) == (1, 2, rate):
                return len(w.readframes(w.getnframes())) / 2 / rate
    except (wave.Error, EOFError):
        pass
    return len(decode_audio(data, rate)) / 2 / rate


def _each(paths: pa.Array, f, kind: pa.DataType, name: str) -> pa.Array:
    out, errors = [], []
    for path in paths.to_pylist():
        try:
            out.append(None if path is None else f(read_file(path)))
            errors.append("no audio" if path is None else None)
        except Exception as e:
            out.append(None)
            errors.append(str(e) or type(e).__name__)
    return pa.StructArray.from_arrays([pa.array(out, kind), pa.array(errors, pa.string())], [name, "error"])


@F.arrow_udf(T.StructType([T.StructField("pcm", T.BinaryType()), T.StructField("error", T.StringType())]))
def decode_files(paths: pa.Array) -> pa.Array:
    """PCM of audio files by their paths, or why there is none; no other file is opened."""
    return _each(paths, decode_audio, pa.binary(), "pcm")


@F.arrow_udf(T.StructType([T.StructField("seconds", T.DoubleType()), T.StructField("error", T.StringType())]))
def file_seconds(paths: pa.Array) -> pa.Array:
    """Length of audio files by their paths, or why there is none."""
    return _each(paths, seconds, pa.float64(), "seconds")


@F.arrow_udf(T.ArrayType(T.FloatType()))
def wav_samples(data: pa.Array) -> pa.Array:
    """Samples in [-1, 1) of WAV files, for playback."""
    return pa.array([None if not d else (np.frombuffer(decode_audio(d), "<i2") / np.float32(32768)).astype(np.float32) for d in data.to_pylist()], pa.list_(pa.float32()))
