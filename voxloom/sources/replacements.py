"""Word replacement tables."""

from __future__ import annotations

import csv
import io

from pyspark.sql import SparkSession


def parse_replacements(text: str, strict: bool = True) -> dict[str, str]:
    """``SOURCE`` to ``TARGET`` of tab-separated text with a header, perhaps after a byte-order mark.

    The last of equal sources wins. With ``strict`` both sides are stripped and rows with a blank side
    are skipped; without, they stand as they are.
    """
    out = {}
    for row in csv.DictReader(io.StringIO(text.removeprefix("﻿"), newline=""), delimiter="\t"):
        source, target = row.get("SOURCE") or "", row.get("TARGET") or ""
        if strict:
            source, target = source.strip(), target.strip()
            if not source or not target:
                continue
        out[source] = target
    return out


def load_replacements(spark: SparkSession, path: str | None, strict: bool = True) -> dict[str, str]:
    """The table in a file that Spark can read; no path, no replacements. The file's order counts, so it is read whole."""
    if path is None:
        return {}
    row = spark.read.text(path, wholetext=True).first()
    return parse_replacements(row[0], strict) if row else {}
