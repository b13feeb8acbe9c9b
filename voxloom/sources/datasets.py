"""Prepared datasets: opening them in any of their forms, and writing them."""

from __future__ import annotations

import json
import os
import re
import shutil

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_CARD_FIELDS = ("language", "license", "language_creators", "task_categories", "pretty_name")


def _children(spark: SparkSession, path: str) -> tuple[bool, list[str]]:
    """Whether the path is a file, and the names in it if it is a folder; an error if it is neither."""
    jvm = spark.sparkContext._jvm
    hadoop = jvm.org.apache.hadoop.fs.Path(path)
    fs = hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(hadoop):
        raise FileNotFoundError(path)
    if fs.getFileStatus(hadoop).isFile():
        return True, []
    return False, [s.getPath().getName() for s in fs.listStatus(hadoop)]


def _arrow_reader(f):
    """Batches and schema of an Arrow file or stream."""
    import pyarrow as pa

    try:
        found = pa.ipc.open_file(f)
        return (found.get_batch(i) for i in range(found.num_record_batches)), found.schema
    except pa.ArrowInvalid:
        f.seek(0)
        found = pa.ipc.open_stream(f)
        return found, found.schema


def _read_arrow(spark: SparkSession, path: str) -> DataFrame:
    """An Arrow stream or file on any store that Arrow knows: its schema on the driver, its batches one by one in a task."""
    from pyarrow import fs as arrow_fs
    from pyspark.sql.pandas.types import from_arrow_schema, to_arrow_schema

    def source():
        fs, own = arrow_fs.FileSystem.from_uri(re.sub("^file:/+", "/", path))
        return fs.open_input_file(own)

    with source() as f:
        kinds = from_arrow_schema(_arrow_reader(f)[1])
    wanted = to_arrow_schema(kinds)

    def run(batches):
        for _ in batches:
            with source() as f:
                for batch in _arrow_reader(f)[0]:
                    yield batch.cast(wanted)

    return spark.range(0, 1, 1, 1).mapInArrow(run, kinds)


def open_dataset(spark: SparkSession, path: str) -> DataFrame:
    """An Arrow or Parquet file; a folder of Parquet files; ``raw.arrow`` in it; or its folder ``raw``."""
    is_file, names = _children(spark, path)
    if is_file:
        return _read_arrow(spark, path) if path.endswith(".arrow") else spark.read.parquet(path)
    if any(n.endswith(".parquet") or n.startswith("split=") for n in names):
        return spark.read.parquet(path)
    if "raw.arrow" in names:
        return _read_arrow(spark, os.path.join(path, "raw.arrow"))
    if "raw" in names:
        return open_dataset(spark, os.path.join(path, "raw"))
    raise ValueError(f"no dataset in {path}")


def open_from_environment(spark: SparkSession, schema: str = "raw_text string, text string", variable: str = "DATA_PATH") -> DataFrame:
    """The dataset that the environment names; an empty one if it can't be opened."""
    try:
        return open_dataset(spark, os.environ[variable])
    except (KeyError, OSError, ValueError):
        return spark.createDataFrame([], schema)


def card(name: str | None = None, version: str | None = None, **fields) -> str | None:
    """A dataset card in Markdown with a header of the fields that are set; None without any."""
    given = {k: fields[k] for k in _CARD_FIELDS if fields.get(k)}
    if not given:
        return None
    lines = ["---"]
    for k, v in given.items():
        lines += [f"{k}:"] + [f"- {x}" for x in v] if isinstance(v, (list, tuple)) else [f"{k}: {v}"]
    title = given.get("pretty_name") or name or "Dataset"
    return "\n".join([*lines, "---", "", f"# {title}", "", f"Version: {version}" if version else "", "", "Speech examples with text, audio and the text before each.", ""])


def _put(spark: SparkSession, path: str, text: str) -> None:
    jvm = spark.sparkContext._jvm
    hadoop = jvm.org.apache.hadoop.fs.Path(path)
    out = hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(hadoop, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()


def write_dataset(df: DataFrame, path: str | None, name: str | None = None, version: str | None = None, license_file: str | None = None, **card_fields) -> dict[str, int] | None:
    """Write Parquet, by split if there is one, with its card, licence and ``dataset_info.json``.

    Returns rows per split as written (``all`` without splits). Without a path nothing is written and
    the rows are only counted. An empty dataset is not written; the result is None.
    """
    splits = "split" in df.columns
    if path is None:
        source = df
    else:
        if df.isEmpty():
            return None
        writer = df.write.mode("overwrite")
        (writer.partitionBy("split") if splits else writer).parquet(path)
        source = df.sparkSession.read.parquet(path)
    counts = {r[0]: r[1] for r in source.groupBy("split" if splits else F.lit("all")).count().collect()}  # a row a split
    if not counts:
        return None
    if path is not None:
        spark = df.sparkSession
        # names with an underscore in front are no data to Spark's readers
        _put(spark, f"{path}/_dataset_info.json", json.dumps({"name": name, "version": version, "splits": counts}, ensure_ascii=False, indent=1))
        if text := card(name, version, **card_fields):
            _put(spark, f"{path}/_README.md", text)
        if license_file:
            with open(license_file, encoding="utf8") as f:
                _put(spark, f"{path}/_LICENSE", f.read())
    return counts


def write_quarantine(df: DataFrame, path: str | None) -> int:
    """Write the entries left out, with the reason, as the table ``<path>_quarantine`` beside the dataset; their number.

    The table is written even if no entry was left out, so that one of an earlier run does not stay.
    Without a path they are only counted.
    """
    if path is None:
        return df.count()
    beside = path.rstrip("/") + "_quarantine"
    df.write.mode("overwrite").parquet(beside)
    return df.sparkSession.read.parquet(beside).count()


class Hub:
    """Where a dataset could be pushed. This one only copies folders; a remote one would override ``push``."""

    def __init__(self, root: str):
        self.root = root

    def push(self, path: str, name: str, public: bool = False) -> str:
        """Copy a written dataset and say whether it is public."""
        target = os.path.join(self.root, "public" if public else "private", name)
        shutil.copytree(path, target, dirs_exist_ok=True)
        return target
