"""Filters on open-schema JSON metadata, quality gates and copied fields."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Exclusion:
    """Rows whose field at ``path`` (keys joined by dots) reads ``value`` go."""

    path: str
    value: str


def parse_exclusion(text: str) -> Exclusion:
    """``path:eq:value``; the value may hold colons. Any other operator or form is an error."""
    path, operator, value = (text.split(":", 2) + ["", ""])[:3]
    if text.count(":") < 2 or operator != "eq":
        raise ValueError(f"a filter reads path:eq:value, not {text!r}")
    return Exclusion(path.strip(), value)


def _json_path(path: str) -> str:
    return "$" + "".join(f"['{step}']" for step in path.split("."))


def json_field(document: Column | str, path: str) -> Column:
    """The field's raw text; null if it or anything before it is missing, null or no object."""
    return F.get_json_object(document, _json_path(path))


def json_field_text(document: Column | str, path: str) -> Column:
    """The field's text, with JSON booleans as ``True`` and ``False``."""
    document = F.col(document) if isinstance(document, str) else document
    raw = json_field(document, path)
    kind = F.schema_of_variant(F.try_variant_get(F.try_parse_json(document), _json_path(path), "variant"))
    # only a value that reads true or false can be a boolean: the parse is spared elsewhere
    return F.when(raw.isin("true", "false"), F.when(kind == "BOOLEAN", F.initcap(raw)).otherwise(raw)).otherwise(raw)


def excluded(document: Column | str, filters: list[Exclusion]) -> Column:
    """Whether any filter matches. A missing field never does."""
    hits = [F.coalesce(json_field_text(document, f.path) == f.value, F.lit(False)) for f in filters]
    return reduce(lambda a, b: a | b, hits, F.lit(False))


def exclude_by_metadata(df: DataFrame, document: str, filters: list[Exclusion]) -> DataFrame:
    return df.where(~excluded(document, filters)) if filters else df


def quality_gate(df: DataFrame, score: str, threshold: float) -> DataFrame:
    """Rows without a score stay; with a threshold of 0 or less all do."""
    return df.where(F.col(score).isNull() | (F.col(score) >= threshold)) if threshold > 0 else df


def copy_fields(metadata: Column | str, document: Column | str, fields: list[str]) -> Column:
    """The struct with the document's top-level fields as strings; one of the same name is overridden."""
    out = F.col(metadata) if isinstance(metadata, str) else metadata
    for name in fields:
        out = out.withField(f"`{name}`", F.get_json_object(document, f"$['{name}']"))
    return out


def changed_flag(raw: Column | str, new: Column | str) -> Column:
    """``YES`` where the two texts differ, else ``no``; a null on one side is a difference."""
    raw, new = (F.col(c) if isinstance(c, str) else c for c in (raw, new))
    return F.when(raw.eqNullSafe(new), "no").otherwise("YES")


def first_text(*columns: Column | str) -> Column:
    """The first column that is neither null nor empty."""
    return F.coalesce(*[F.nullif(F.col(c) if isinstance(c, str) else c, F.lit("")) for c in columns])
