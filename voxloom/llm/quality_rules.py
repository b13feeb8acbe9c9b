"""Quality rules with adaptive thresholds, in DataFrame functions only.

Each text is measured; for each measure a mergeable quantile sketch per language and source gives a
median and quartiles. The sketch counts values in buckets whose bounds grow by a constant factor, so a
quantile is right to within 1 %, sketches merge by adding counts, and reruns agree. A source's
quantiles are drawn towards its language's, and these towards those of all rows, by as much as
``prior`` rows weigh, so small groups need no rule of their own.

A fence lies ``reach`` quartile distances from the median. Where the quartiles fall together the
distance counts as one occurrence in a text of median size, the least that such a text can show. Rows
and fences are joined, and a row fails if it lies beyond a fence by more than ``errors`` standard
errors of its own count: a short text may be further off than a long one.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .shared import stage

_SPACES = " \t\n\x0b\x0c\r"
_SYMBOLS = "#*$%&|<>"
_UPPER = "".join(map(chr, range(65, 91)))
#: Words of the windows whose repetition within a text counts.
WINDOW = 5
#: Measures: what is counted, the size that it is divided by, how many counts come at once, and whether a low value fails as well.
MEASURES = {
    "symbol_rate": ("n_symbols", "n_words", 1, False), "word_length": ("word_chars", "n_words", 1, True), "dup_line_rate": ("n_dup_lines", "n_lines", 1, False),
    "repeat_rate": ("n_repeat_words", "n_words", WINDOW, False), "upper_rate": ("n_upper", "word_chars", 1, False),
}
_SIZES = ("n_words", "n_lines", "word_chars")
#: Factor between the bounds of two buckets, and the bucket of zero.
_GROWTH, _ZERO = 1.02, -100_000


@dataclass(frozen=True)
class Fences:
    """Quartile distances from the median, standard errors beyond the fence, and rows that a parent group weighs."""

    reach: float = 6.0
    errors: float = 3.0
    prior: float = 100.0


def _without(text: Column, characters: str) -> Column:
    return F.translate(text, characters, "")


def measure(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", groups: tuple[str, str] = ("lang", "source")) -> DataFrame:
    """Per row: id, the groups, and the counts of its whole text (null counts as empty)."""
    text = F.coalesce(docs[f"`{text_col}`"], F.lit(""))
    tokens = F.filter(F.split(F.translate(text, _SPACES[1:], " " * 5), " ", -1), lambda w: w != "")
    lines = F.filter(F.split(text, "\n", -1), lambda x: _without(x, _SPACES) != "")
    df = docs.select(
        docs[f"`{id_col}`"].alias("id"), *[docs[f"`{g}`"].cast("string").alias(f"group{i}") for i, g in enumerate(groups)], F.length(_without(text, _SPACES)).cast("long").alias("word_chars"),
        (F.length(text) - F.length(_without(text, _SYMBOLS))).cast("long").alias("n_symbols"), (F.length(text) - F.length(_without(text, _UPPER))).cast("long").alias("n_upper"),
        lines.alias("lines"), F.transform(tokens, lambda w: F.xxhash64(w)).alias("h"),
    )
    # every array is used at least twice below, so that Spark keeps it as a column and computes it once
    df = df.select("id", "group0", "group1", "word_chars", "n_symbols", "n_upper", F.size("lines").cast("long").alias("n_lines"), (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"), "h", F.size("h").cast("long").alias("n_words"))
    h = F.col("h")
    runs = F.when(F.size("h") >= WINDOW, F.transform(F.slice("h", 1, F.greatest(F.size("h") - (WINDOW - 1), F.lit(0))), lambda x, i: F.xxhash64(x, *[F.get(h, i + k) for k in range(1, WINDOW)]))).otherwise(F.array().cast("array<bigint>"))
    df = df.withColumn("runs", runs)
    repeats = F.size(F.array_distinct("runs")) < F.size("runs")
    at = F.transform(F.col("runs"), lambda x, i: F.struct(x.alias("h"), i.alias("i")))
    df = df.withColumn("s", F.when(repeats, F.array_sort(at)).otherwise(F.expr("cast(array() as array<struct<h:bigint,i:int>>)"))).drop("runs", "h")
    s = F.col("s")
    twice = F.filter(s, lambda x, j: F.get(s, j - 1)["h"].eqNullSafe(x["h"]) | F.get(s, j + 1)["h"].eqNullSafe(x["h"]))
    starts = F.array_sort(F.transform(twice, lambda x: x["i"]))
    # each start adds the words of its window that no earlier one has covered
    covered = F.aggregate(
        starts, F.struct(F.lit(0).alias("n"), F.lit(0).alias("end")), lambda a, p: F.struct((a["n"] + (p + WINDOW) - F.greatest(a["end"], p)).alias("n"), (p + WINDOW).alias("end")), lambda a: a["n"].cast("long")
    )
    return df.withColumn("n_repeat_words", covered).drop("s")


def sketches(m: DataFrame) -> DataFrame:
    """``(group0, group1, measure, bucket, n)``: how many rows of a group have a value in a bucket."""

    def rate(count: str, size: str) -> Column:
        return F.when(F.col(size) > 0, F.col(count) / F.col(size))

    values = [(name, rate(count, size)) for name, (count, size, _, _) in MEASURES.items()]
    values += [(name, F.when(F.col(name) > 0, F.col(name).cast("double"))) for name in _SIZES]
    rows = m.select("group0", "group1", F.explode(F.array(*[F.struct(F.lit(name).alias("measure"), v.alias("v")) for name, v in values])).alias("x")).where("x.v is not null")
    bucket = F.when(F.col("x.v") > 0, F.ceil(F.ln("x.v") / F.lit(math.log(_GROWTH)))).otherwise(F.lit(_ZERO)).cast("int")
    return rows.groupBy("group0", "group1", F.col("x.measure").alias("measure"), bucket.alias("bucket")).agg(F.count("*").alias("n"))


def quantiles(sketch: DataFrame, *groups: str) -> DataFrame:
    """Rows and quartiles ``q1``, ``q2``, ``q3`` of each measure of each group, from its merged sketch."""
    key = [*groups, "measure"]
    merged = sketch.groupBy(*key, "bucket").agg(F.sum("n").alias("n"))
    own = W.partitionBy(*key)
    placed = merged.withColumn("upto", F.sum("n").over(own.orderBy("bucket"))).withColumn("rows", F.sum("n").over(own))
    found = placed.groupBy(*key).agg(F.max("rows").alias("rows"), *[F.min(F.when(4 * F.col("upto") >= i * F.col("rows"), F.col("bucket"))).alias(f"b{i}") for i in (1, 2, 3)])
    value = lambda b: F.when(F.col(b) == _ZERO, F.lit(0.0)).otherwise(F.pow(F.lit(_GROWTH), F.col(b)) * F.lit(2 / (1 + _GROWTH)))
    return found.select(*key, "rows", *[value(f"b{i}").alias(f"q{i}") for i in (1, 2, 3)])


def thresholds(m: DataFrame, fences: Fences = Fences()) -> DataFrame:
    """``(group0, group1)`` and for each measure its ``_high`` and, where low values fail, ``_low`` fence."""
    sketch = stage(sketches(m), "quality-sketches")
    drawn = lambda a, b: [((F.col(f"{a}.rows") * F.col(f"{a}.q{i}") + F.lit(fences.prior) * F.col(f"{b}.q{i}")) / (F.col(f"{a}.rows") + F.lit(fences.prior))).alias(f"q{i}") for i in (1, 2, 3)]
    every, langs, own = quantiles(sketch).alias("e"), quantiles(sketch, "group0").alias("l"), quantiles(sketch, "group0", "group1").alias("o")
    langs = langs.join(every, "measure").select("l.group0", "measure", *drawn("l", "e")).alias("p")
    drawn_own = own.join(langs, F.col("o.group0").eqNullSafe(F.col("p.group0")) & (F.col("o.measure") == F.col("p.measure"))).select("o.group0", "o.group1", "o.measure", *drawn("o", "p"))
    of = lambda name, q: F.max(F.when(F.col("measure") == name, F.col(q)))
    names = [*MEASURES, *_SIZES]
    wide = drawn_own.groupBy("group0", "group1").agg(*[of(name, f"q{i}").alias(f"{name}{i}") for name in names for i in (1, 2, 3)])
    out = []
    for name, (_, size, unit, both) in MEASURES.items():
        low, mid, high = (F.col(f"{name}{i}") for i in (1, 2, 3))
        least = F.lit(float(unit)) / F.col(f"{size}2")
        out.append((mid + F.lit(fences.reach) * F.greatest(high - mid, least)).alias(f"{name}_high"))
        if both:
            out.append((mid - F.lit(fences.reach) * F.greatest(mid - low, least)).alias(f"{name}_low"))
    return wide.select("group0", "group1", *out)


def _outside(fences: Fences) -> Column:
    """The measures of a row that lie beyond their fences."""
    out = []
    for name, (count, size, unit, both) in MEASURES.items():
        error = F.lit(fences.errors) * F.sqrt(F.lit(float(unit)) * (F.col(count) + F.lit(unit)))
        beyond = (F.col(count) - error) / F.col(size) > F.col(f"{name}_high")
        if both:
            beyond = beyond | ((F.col(count) + error) / F.col(size) < F.col(f"{name}_low"))
        out.append(F.when((F.col(size) > 0) & beyond, F.lit(name)))
    return F.array_compact(F.array(*out))


def quality_rules(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", groups: tuple[str, str] = ("lang", "source"), fences: Fences = Fences()) -> DataFrame:
    """One row per row of ``docs``: id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    base_failed, kept, and ``failed`` (the measures outside their fences).

    Words are runs of characters other than the six ASCII white-space ones. Null and empty texts have
    no words and fail the base rules. Null languages and sources are groups of their own. Repeated
    rows are judged one by one. Columns other than the four named are not read. An empty table gives an
    empty result.
    """
    m = stage(measure(docs, id_col, text_col, groups), "quality-measures")
    t = stage(thresholds(m, fences).withColumnRenamed("group0", "t0").withColumnRenamed("group1", "t1"), "quality-fences")
    # a null-safe equi-join; Spark broadcasts the fences only if they are small
    out = m.join(t, F.col("group0").eqNullSafe(F.col("t0")) & F.col("group1").eqNullSafe(F.col("t1")), "left")
    base_failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    out = out.withColumn("base_failed", base_failed).withColumn("failed", _outside(fences))
    out = out.withColumn("kept", ~F.col("base_failed") & (F.size("failed") == 0))
    return out.select(F.col("id").alias(id_col), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "failed")


def _oracle(fences: Fences = Fences()) -> str:
    spaces = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
    values = [f"('{name}', CASE WHEN {size} > 0 THEN {count} / {size} END)" for name, (count, size, _, _) in MEASURES.items()] + [f"('{x}', CASE WHEN {x} > 0 THEN {x}::DOUBLE END)" for x in _SIZES]
    found = ", ".join(f"CASE WHEN b{i} = {_ZERO} THEN 0.0::DOUBLE ELSE pow({_GROWTH}::DOUBLE, b{i}) * {2 / (1 + _GROWTH)!r}::DOUBLE END AS q{i}" for i in (1, 2, 3))
    drawn = lambda a, b: ", ".join(f"({a}.n * {a}.q{i} + {fences.prior}::DOUBLE * {b}.q{i}) / ({a}.n + {fences.prior}::DOUBLE) AS q{i}" for i in (1, 2, 3))

    def level(keys: str) -> str:
        key = f"{keys}measure"
        return f"""SELECT *, {found} FROM (
    SELECT {key}, max(total) AS n, {", ".join(f"min(CASE WHEN 4 * upto >= {i} * total THEN bucket END) AS b{i}" for i in (1, 2, 3))} FROM (
      SELECT *, sum(n) OVER (PARTITION BY {key} ORDER BY bucket) AS upto, sum(n) OVER (PARTITION BY {key}) AS total FROM (SELECT {key}, bucket, sum(n) AS n FROM sketch GROUP BY ALL)) GROUP BY ALL)"""

    failed = []
    for name, (count, size, unit, both) in MEASURES.items():
        error = f"{fences.errors}::DOUBLE * sqrt({float(unit)}::DOUBLE * ({count} + {unit}))"
        least = f"{float(unit)}::DOUBLE / {size}_q2"
        test = f"({count} - {error}) / {size} > {name}_q2 + {fences.reach}::DOUBLE * greatest({name}_q3 - {name}_q2, {least})"
        if both:
            test += f" OR ({count} + {error}) / {size} < {name}_q2 - {fences.reach}::DOUBLE * greatest({name}_q2 - {name}_q1, {least})"
        failed.append(f"CASE WHEN {size} > 0 AND ({test}) THEN '{name}' END")
    wide = ", ".join(f"max(CASE WHEN measure = '{name}' THEN q{i} END) AS {name}_q{i}" for name in (*MEASURES, *_SIZES) for i in (1, 2, 3))
    return f"""
WITH split AS (
  SELECT doc_id, lang, source, coalesce(text, '') AS text, list_filter(string_split(translate(coalesce(text, ''), chr(9) || chr(10) || chr(11) || chr(12) || chr(13), '     '), ' '), lambda x: x <> '') AS words,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: translate(x, {spaces}, '') <> '') AS lines FROM documents),
windows AS (SELECT doc_id, p, array_to_string(words[p : p + 4], ' ') AS k FROM (SELECT doc_id, words, unnest(range(1, len(words) - 3)) AS p FROM split)),
twice AS (SELECT doc_id, p FROM windows JOIN (SELECT doc_id, k FROM windows GROUP BY ALL HAVING count(*) > 1) USING (doc_id, k)),
repeats AS (SELECT doc_id, count(DISTINCT p + o) AS n FROM twice CROSS JOIN range(5) t(o) GROUP BY 1),
m AS (
  SELECT doc_id, lang, source, len(words) AS n_words, length(array_to_string(words, '')) AS word_chars, length(text) - length(translate(text, '{_SYMBOLS}', '')) AS n_symbols,
    length(text) - length(translate(text, '{_UPPER}', '')) AS n_upper, len(lines) AS n_lines, len(lines) - len(list_distinct(lines)) AS n_dup_lines, coalesce(n, 0) AS n_repeat_words FROM split LEFT JOIN repeats USING (doc_id)),
sketch AS (
  SELECT lang, source, measure, CASE WHEN v > 0 THEN ceil(ln(v) / {math.log(_GROWTH)!r}::DOUBLE)::BIGINT ELSE {_ZERO} END AS bucket, count(*) AS n
  FROM m, LATERAL (VALUES {", ".join(values)}) x(measure, v) WHERE v IS NOT NULL GROUP BY ALL),
every AS ({level("")}),
langs AS (SELECT l.lang, l.measure, {drawn("l", "e")} FROM ({level("lang, ")}) l JOIN every e USING (measure)),
own AS (SELECT o.lang, o.source, o.measure, {drawn("o", "p")} FROM ({level("lang, source, ")}) o JOIN langs p ON o.lang IS NOT DISTINCT FROM p.lang AND o.measure = p.measure),
fences AS (SELECT lang, source, {wide} FROM own GROUP BY lang, source),
judged AS (
  SELECT m.*, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed, concat_ws(',', {", ".join(failed)}) AS failed
  FROM m LEFT JOIN fences f ON m.lang IS NOT DISTINCT FROM f.lang AND m.source IS NOT DISTINCT FROM f.source)
SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars, n_symbols::BIGINT AS n_symbols, n_dup_lines::BIGINT AS n_dup_lines, n_repeat_words::BIGINT AS n_repeat_words, base_failed, NOT base_failed AND failed = '' AS kept, failed FROM judged
"""


#: The same rows in DuckDB, with ``failed`` as one string.
ORACLE = _oracle()
