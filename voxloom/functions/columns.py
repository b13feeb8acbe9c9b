"""Column forms of the text functions: native expressions where they exist, Arrow functions for the rest."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping
from itertools import chain

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from . import lexicon as lx
from . import rewrite, spoken

_SPACE = "[" + "".join(f"\\x{{{ord(c):x}}}" for c in lx.WHITE_SPACE) + "]"
_SOLID = "[^" + _SPACE[1:]
_HELD = ""  # a private character that stands for a dash between two passes


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def char_cleanup(text: Column | str, backslash: bool = True) -> Column:
    """Control and direction characters go, hyphens, quotes and apostrophes become ASCII; ``backslash`` goes too."""
    to = " " * len(lx.BLANKS) + "-" * len(lx.HYPHENS) + '"' * len(lx.QUOTES) + "'" * len(lx.APOSTROPHES)
    return F.translate(_col(text), lx.BLANKS + lx.HYPHENS + lx.QUOTES + lx.APOSTROPHES + lx.DELETED + ("\\" if backslash else ""), to)


def strip_emoji(text: Column | str) -> Column:
    return F.regexp_replace(_col(text), "[" + "".join(f"\\x{{{a:X}}}-\\x{{{b:X}}}" for a, b in lx.EMOJI) + "]+", "")


def strip_parentheses(text: Column | str) -> Column:
    """Without ``(...)``, from the first to the next closing one on the same line."""
    return F.regexp_replace(_col(text), r"(?d)\(.*?\)", "")


def strip_brackets(text: Column | str) -> Column:
    return F.regexp_replace(_col(text), r"(?d)\[.*?\]", "")


def split_dashes(text: Column | str) -> Column:
    """Dashes between two characters become blanks, except between digits; a match uses up both neighbours."""
    held = F.regexp_replace(_col(text), f"({_SOLID})-({_SOLID})", f"$1{_HELD}$2")
    return F.replace(F.regexp_replace(held, rf"(?U)(?<=\d){_HELD}(?=\d)", "-"), F.lit(_HELD), F.lit(" "))


def collapse_blanks(text: Column | str) -> Column:
    return F.trim(F.regexp_replace(_col(text), f"{_SPACE}+", " "))


def speech_cleanup(text: Column | str) -> Column:
    """All of the clean-up that comes before words are looked at, in one native expression."""
    return collapse_blanks(split_dashes(strip_brackets(strip_parentheses(strip_emoji(char_cleanup(text))))))


def unwrap(word: Column | str) -> Column:
    """A word without quotes and brackets around it."""
    return F.regexp_replace(_col(word), r'^["(\[{]+|[")\]}]+$', "")


def closing_mark(word: Column | str) -> Column:
    """``struct<core, mark>``: a word without its closing mark, and what that becomes."""
    word = F.regexp_replace(_col(word), f"^{_SPACE}+|{_SPACE}+$", "")
    out = F.struct(word.alias("core"), F.lit("").alias("mark"))
    for mark in sorted(lx.CLOSING_MARKS, key=len):  # later, longer marks win
        hit = F.struct(F.substring(word, F.lit(1), F.length(word) - len(mark)).alias("core"), F.lit(lx.CLOSING_MARKS[mark]).alias("mark"))
        out = F.when((F.length(word) > len(mark)) & F.endswith(word, F.lit(mark)), hit).otherwise(out)
    return out


def _pick(words: tuple[str, ...], index: Column) -> Column:
    return F.element_at(F.array(*map(F.lit, words)), index.cast("int") + 1)


def _small(n: Column, gender: str) -> Column:
    """0 to 99."""
    unit = _pick(lx.UNITS_M if gender in ("m", "mn") else lx.UNITS_F, F.least(n, F.lit(19)))
    if gender in ("m0", "f0"):
        unit = F.when(n.between(1, 10), _pick(lx.ORDINALS_M if gender == "m0" else lx.ORDINALS_F, F.least(n, F.lit(10)))).otherwise(unit)
    last = _pick(lx.UNITS_M if gender in ("m", "m0", "mn") else lx.UNITS_F, n % 10)
    two = {"mn": lx.TWO_OF_M, "fn": lx.TWO_OF_F}.get(gender)
    if two:
        unit, last = F.when(n == 2, F.lit(two)).otherwise(unit), F.when(n % 10 == 2, F.lit(two)).otherwise(last)
    tens = _pick(lx.TENS, F.floor(n / 10))
    return F.when(n < 20, unit).when(n % 10 == 0, tens).otherwise(F.concat(tens, F.lit(" " + lx.AND), last))


def _below_thousand(n: Column, gender: str, lead: Column) -> Column:
    """Parts of 0 to 999 after ``lead``, an array that may be empty; ``compat`` spelling."""
    hundreds, rest = F.floor(n / 100), n % 100
    head = F.when(hundreds > 0, F.concat(lead, F.array(_pick(lx.HUNDREDS, hundreds)))).otherwise(lead)
    joined = (F.size(head) > 0) & ((hundreds == 1) | (rest < 20) | (rest % 10 == 0))
    last = F.concat(F.when(joined, F.lit(lx.AND)).otherwise(F.lit("")), _small(rest, gender))
    out = F.when((rest > 0) | (F.size(head) == 0), F.concat(head, F.array(last))).otherwise(head)
    two = {"mn": lx.TWO_OF_M, "fn": lx.TWO_OF_F}.get(gender)
    return F.when(rest == 2, F.array(F.lit(two))).otherwise(out) if two else out


def spoken_integer(value: Column | str, gender: str = "f") -> Column:
    """A whole number from 0 to 999,999 in words, in native expressions; null outside."""
    n = _col(value).cast("long")
    thousands = F.floor(n / 1000)
    none = F.array().cast("array<string>")
    count = F.array_join(_below_thousand(thousands, "m", none), " ")
    lead = F.when(thousands > 10, F.array(F.concat(count, F.lit(" " + lx.THOUSANDS[1])))).when(thousands > 0, F.array(_pick(lx.THOUSANDS, F.least(thousands, F.lit(10))))).otherwise(none)
    return F.when(n.between(0, 999_999), F.array_join(_below_thousand(n % 1000, gender, lead), " "))


def _div(n: Column, by: int) -> Column:
    return F.call_function("div", n, F.lit(by).cast("long"))


def _three(n: Column, gender: str, after: Column) -> Column:
    """0 to 999, ``after`` other parts or not."""
    hundreds, rest = _div(n, 100), n % 100
    joined = (after | (hundreds > 0)) & ((hundreds == 1) | (rest < 20) | (rest % 10 == 0))
    last = F.concat(F.when(joined, F.lit(lx.AND)).otherwise(F.lit("")), _small(rest, gender))
    return F.concat_ws(" ", F.when(hundreds > 0, _pick(lx.HUNDREDS, hundreds)), F.when((rest > 0) | (~after & (hundreds == 0)), last))


def _count(group: Column) -> Column:
    """Words of a group of three digits with its unit, if any; null for 0."""
    x, unit = group["x"], group["unit"]
    words = F.concat_ws(" ", _three(x, "m", group["after"]), F.when(unit != "", unit))
    few = F.when(x <= 10, _pick(lx.THOUSANDS, F.least(x, F.lit(10)))).otherwise(words)
    return F.when(x == 0, F.lit(None)).when(unit == lx.THOUSANDS[1], few).when((x == 1) & (unit != ""), unit).otherwise(words)


def spoken_whole(value: Column | str, gender: str = "f") -> Column:
    """Any whole number from 0 to the largest long in words, in native expressions; null for negative ones and null.

    The number of billions is itself spelled with billions, millions and thousands. The groups before
    the last share one lambda, as code for each of them outgrows what Spark compiles.
    """
    n = _col(value).cast("long")
    b = _div(n, 10**9)
    groups = [
        (_div(b, 10**9), lx.BILLION), (_div(b, 10**6) % 1000, lx.MILLION), (_div(b, 1000) % 1000, lx.THOUSANDS[1]), (F.when(b == 1, 0).otherwise(b % 1000), ""), ((b > 0).cast("long"), lx.BILLION),
        (_div(n, 10**6) % 1000, lx.MILLION), (_div(n, 1000) % 1000, lx.THOUSANDS[1]),
    ]
    groups = F.array(*[F.struct(x.cast("long").alias("x"), F.lit(unit).alias("unit"), ((b >= 1000) if unit == "" else F.lit(False)).alias("after")) for x, unit in groups])
    last = F.when((n % 1000 > 0) | (n == 0), _three(n % 1000, gender, n >= 1000))
    out = F.concat_ws(" ", F.transform(groups, _count), last)
    two = {"mn": lx.TWO_OF_M, "fn": lx.TWO_OF_F}.get(gender)
    return F.when(n >= 0, F.when(n % 100 == 2, F.lit(two)).otherwise(out) if two else out)


def spoken_clock(hour: Column | str, minute: Column | str) -> Column:
    """A time of day in words; null outside 00:00 to 23:59."""
    h, m = _col(hour).cast("int"), _col(minute).cast("int")
    words = _pick(lx.UNITS_F, F.when(h % 12 == 0, 12).otherwise(h % 12))
    half = F.when(h > 12, F.lit(" " + lx.AFTERNOON)).otherwise(F.lit(" " + lx.MORNING))
    out = (
        F.when(m == 0, F.concat(words, half)).when(m == 15, F.concat(words, F.lit(" " + lx.AND_QUARTER), half)).when(m == 30, F.concat(words, F.lit(" " + lx.AND_HALF), half))
        .when(m % 10 == 0, F.concat(words, F.lit(" " + lx.AND), _small(m, "m"))).otherwise(F.concat(words, F.lit(" "), _small(m, "f")))
    )
    return F.when(h.between(0, 23) & m.between(0, 59), out)


def spoken_date(day: Column | str, month: Column | str, year: Column | str | None = None) -> Column:
    """Day and month, perhaps a year, in words; null out of range."""
    d, m = _col(day).cast("int"), _col(month).cast("int")
    words = F.concat(F.when(d == 1, F.lit(lx.FIRST_OF_MONTH)).otherwise(_small(d, "f")), F.lit(" "), _pick(lx.MONTHS, F.least(F.greatest(m, F.lit(1)), F.lit(12)) - 1))
    if year is not None:
        words = F.concat(words, F.lit(" "), spoken_integer(year, "f"))
    return F.when(d.between(1, 31) & m.between(1, 12), words)


def spoken_phone(token: Column | str) -> Column:
    """A phone number digit by digit; null for anything else."""
    t = _col(token)
    digits = F.filter(F.split(t, ""), lambda c: c.between("0", "9"))
    return F.when(F.regexp_like(t, F.lit(r"^0[0-9]{1,2}-?[0-9]{7}$")), F.array_join(F.transform(digits, lambda c: _pick(lx.UNITS_F, c.cast("int"))), " "))


PART = 1 << 20


def _parts(text: pa.Array) -> Iterator[pa.Array]:
    """The texts of a batch in order, in parts of at most ``PART`` bytes (64 more for each text), or of a longer text."""
    start = held = 0
    for i, n in enumerate(pc.fill_null(pc.binary_length(text), 0).to_pylist()):
        if i > start and held + n + 64 > PART:
            yield text.slice(start, i - start)
            start, held = i, 0
        held += n + 64
    yield text.slice(start)


_PAIR = pa.struct([("cautious", pa.string()), ("expanded", pa.string())])


def _each(text: pa.Array, f: Callable, kind: pa.DataType) -> pa.Array:
    return pa.array([None if t is None else f(t) for t in text.to_pylist()], kind)


def _on_texts(f: Callable, name: str = "string", kind: pa.DataType | None = None):
    """``f`` as a column function, null for null; a part of an Arrow batch is at a time in Python, and sent on by itself."""
    kind = kind or pa.string()

    @F.arrow_udf(name)
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        return map(lambda part: _each(part, f, kind), chain.from_iterable(map(_parts, batches)))

    return run


def normalize_speech(text: Column | str, options: rewrite.SpeechOptions = rewrite.CAUTIOUS, replacements: Mapping[str, str] | None = None) -> Column:
    """Text for speech synthesis; null for null. The replacement table is a caller's map and travels along."""
    return _on_texts(rewrite.Speaker(options, replacements))(_col(text))


def compare_speech(text: Column | str, replacements: Mapping[str, str] | None = None) -> Column:
    """``struct<cautious, expanded>``: both forms of a text in one pass; null for null."""
    return _on_texts(rewrite.Comparison(replacements), "struct<cautious:string,expanded:string>", _PAIR)(_col(text))


def normalize_transcript(text: Column | str, replacements: Mapping[str, str] | None = None, **options) -> Column:
    """Text as the older rewriter writes it; null for null."""
    table = dict(replacements or {})
    return _on_texts(lambda x: rewrite.for_transcript(x, replacements=table, **options))(_col(text))


def spoken_form(token: Column | str, gender: Column | str = "f") -> Column:
    """A number, time or amount of any size in words; null if the token is none. ``gender``: a column or a literal."""

    @F.arrow_udf("string")
    def run(t: pa.Array, g: pa.Array) -> pa.Array:
        return pa.array([None if x is None or y is None else spoken.spoken(x, y) for x, y in zip(t.to_pylist(), g.to_pylist(), strict=True)], pa.string())

    return run(_col(token), F.lit(gender) if isinstance(gender, str) else gender)


def spoken_quantity(token: Column | str) -> Column:
    """A number with a unit in words; null for anything else."""
    return _on_texts(spoken.quantity)(_col(token))


def replace_word(word: Column | str, replacements: Column) -> Column:
    """The word's entry in a map column, else the word itself."""
    return F.coalesce(F.try_element_at(replacements, _col(word)), _col(word))


def register(spark: SparkSession, replacements: Mapping[str, str] | None = None) -> None:
    """SQL functions ``normalize_tts``, ``normalize_tts_expanded``, ``normalize_stt`` and ``spoken_form``."""
    table = dict(replacements or {})

    spark.udf.register("normalize_tts", _on_texts(rewrite.Speaker(rewrite.CAUTIOUS, table)))
    spark.udf.register("normalize_tts_expanded", _on_texts(rewrite.Speaker(rewrite.EXPANDED, table)))
    spark.udf.register("normalize_stt", _on_texts(lambda x: rewrite.for_transcript(x, replacements=table)))

    @F.arrow_udf("string")
    def form(t: pa.Array, g: pa.Array) -> pa.Array:
        return pa.array([None if x is None or y is None else spoken.spoken(x, y) for x, y in zip(t.to_pylist(), g.to_pylist(), strict=True)], pa.string())

    spark.udf.register("spoken_form", form)
