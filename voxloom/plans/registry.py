"""Named queries over the driver's tables, each with the SQL that gives the same rows where there is one.

The tables hold no Hebrew, brackets or typographic marks, so queries on text first add a tail that
has them, chosen by the row's id; the SQL adds the same.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import columns, rewrite
from ..functions import lexicon as lx
from ..operators import audio, audit, filters, partitioning, sequences, slicing, stats
from ..sources import datasets, entries
from ..sources.shared import new_path
from ..sources.tables import read_table as _t
from ..sources.tables import spread
from ..streaming import rewrite_stream

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}
_ORACLES: dict[str, str] = {}

_TAILS = (
    " a\u2014b \u201cq\u201d\u200f \u05d1\u05be\u05d2 \u2019s \u00ab5\u00bb",
    " \U0001F642x\u2764\ufe0f [x] (y (z)) [\u05d0]",
    "\t\u00a0 [a] \u2003z (q) \u3000\u2028 end",
    " 10-20 a-b-c 1-2-a \\ 050-1234567",
    " \"(word)\" ... !? [deep [er]] {x}",
)


def _query(name: str, oracle: str | None = None) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        _QUERIES[name] = f
        if oracle is not None:
            _ORACLES[name] = oracle
        return f

    return add


def _q(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _tailed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _with_tail(spread(_t(spark, sf_dir, "documents").select("doc_id", "text")))


def _with_tail(docs: DataFrame) -> DataFrame:
    tail = reduce(lambda acc, i: F.when(F.col("doc_id") % len(_TAILS) == i, F.lit(_TAILS[i])).otherwise(acc), range(len(_TAILS)), F.lit(""))
    return docs.select("doc_id", F.concat("text", tail).alias("t"))


_TAILED = f"(SELECT doc_id, text || CASE doc_id % {len(_TAILS)} " + " ".join(f"WHEN {i} THEN {_q(t)}" for i, t in enumerate(_TAILS)) + " ELSE '' END AS t FROM documents)"

# the clean-up steps in SQL
_FROM = lx.BLANKS + lx.HYPHENS + lx.QUOTES + lx.APOSTROPHES + lx.DELETED + "\\"
_TO = " " * len(lx.BLANKS) + "-" * len(lx.HYPHENS) + '"' * len(lx.QUOTES) + "'" * len(lx.APOSTROPHES)
_RE_SPACE = "[" + "".join(f"\\x{{{ord(c):X}}}" for c in lx.WHITE_SPACE) + "]"
_RE_SOLID = "[^" + _RE_SPACE[1:]
_RE_EMOJI = "[" + "".join(f"\\x{{{a:X}}}-\\x{{{b:X}}}" for a, b in lx.EMOJI) + "]+"


def _sql_translate(x: str) -> str:
    return f"translate({x}, {_q(_FROM)}, {_q(_TO)})"


def _sql_sub(x: str, pattern: str, to: str = "") -> str:
    return f"regexp_replace({x}, {_q(pattern)}, {_q(to)}, 'g')"


def _sql_dashes(x: str) -> str:
    held = _sql_sub(x, f"({_RE_SOLID})-({_RE_SOLID})", "\\1\ue000\\2")
    return f"replace({_sql_sub(held, '([0-9])' + chr(0xE000) + '([0-9])', chr(92) + '1-' + chr(92) + '2')}, {_q(chr(0xE000))}, ' ')"


def _sql_blanks(x: str) -> str:
    return f"trim({_sql_sub(x, _RE_SPACE + '+', ' ')})"


def _text_query(name: str, f: Callable[[Column], Column], sql: str) -> None:
    _query(name, f"SELECT doc_id, {sql} AS out FROM {_TAILED}")(lambda spark, sf_dir: _tailed(spark, sf_dir).select("doc_id", f(F.col("t")).alias("out")))


_text_query("char_cleanup", columns.char_cleanup, _sql_translate("t"))
_text_query("emoji_strip", columns.strip_emoji, _sql_sub("t", _RE_EMOJI))
_text_query("bracket_strip", columns.strip_brackets, _sql_sub("t", r"\[.*?\]"))
_text_query("dash_split_text", columns.split_dashes, _sql_dashes("t"))
_text_query("collapse_ws", columns.collapse_blanks, _sql_blanks("t"))
_PREPARED_SQL = _sql_blanks(_sql_dashes(_sql_sub(_sql_sub(_sql_translate("t"), _RE_EMOJI), r"\[.*?\]")))  # parentheses stay
_SPEECH_SQL = _sql_blanks(_sql_dashes(_sql_sub(_sql_sub(_sql_sub(_sql_translate("t"), _RE_EMOJI), r"\(.*?\)"), r"\[.*?\]")))
_text_query("speech_cleanup", columns.speech_cleanup, _SPEECH_SQL)


def entry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The flagship query: texts before and after the clean-up, and whether it changed them."""
    return changed_flag(spark, sf_dir)


@_query("paren_strip", f"SELECT page_id, {_sql_sub('html', chr(92) + '(.*?' + chr(92) + ')')} AS out FROM pages")
def paren_strip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spread(_t(spark, sf_dir, "pages").select("page_id", "html")).select("page_id", columns.strip_parentheses("html").alias("out"))


@_query("changed_flag", f"SELECT doc_id, {_SPEECH_SQL} AS clean, CASE WHEN {_SPEECH_SQL} = t THEN 'no' ELSE 'YES' END AS changed FROM {_TAILED}")
def changed_flag(spark: SparkSession, sf_dir: str) -> DataFrame:
    clean = _tailed(spark, sf_dir).withColumn("clean", columns.speech_cleanup("t"))
    return clean.select("doc_id", "clean", filters.changed_flag("t", "clean").alias("changed"))


_WORDS = f"(SELECT unnest(string_split(t, ' ')) AS word FROM {_TAILED})"


def _words(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _tailed(spark, sf_dir).select(F.explode(F.split("t", " ", -1)).alias("word"))


@_query("token_wrap_strip", f"""SELECT out, count(*) AS n FROM (SELECT {_sql_sub('word', '^["(' + chr(92) + '[{]+|[")' + chr(92) + ']}]+$')} AS out FROM {_WORDS}) GROUP BY out""")
def token_wrap_strip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _words(spark, sf_dir).groupBy(columns.unwrap("word").alias("out")).agg(F.count("*").alias("n"))


def _mark_sql(core: bool) -> str:
    cases = [f"WHEN length(w) > {len(m)} AND ends_with(w, {_q(m)}) THEN " + (f"substr(w, 1, length(w) - {len(m)})" if core else _q(lx.CLOSING_MARKS[m])) for m in sorted(lx.CLOSING_MARKS, key=len, reverse=True)]
    return f"CASE {' '.join(cases)} ELSE {'w' if core else _q('')} END"


@_query("suffix_punct", f"SELECT {_mark_sql(True)} AS core, {_mark_sql(False)} AS mark, count(*) AS n FROM (SELECT {_sql_sub('word', f'^{_RE_SPACE}+|{_RE_SPACE}+$')} AS w FROM {_WORDS}) GROUP BY ALL")
def suffix_punct(spark: SparkSession, sf_dir: str) -> DataFrame:
    split = _words(spark, sf_dir).select(columns.closing_mark("word").alias("m"))
    return split.groupBy(F.col("m.core").alias("core"), F.col("m.mark").alias("mark")).agg(F.count("*").alias("n"))


# numbers in SQL: the same spelling rules on lists


def _sql_list(words: tuple[str, ...]) -> str:
    return "[" + ", ".join(map(_q, words)) + "]"


def _sql_small(n: str, gender: str) -> str:
    unit = f"{_sql_list(lx.UNITS_M if gender in ('m', 'mn') else lx.UNITS_F)}[least({n}, 19) + 1]"
    if gender in ("m0", "f0"):
        unit = f"CASE WHEN {n} BETWEEN 1 AND 10 THEN {_sql_list(lx.ORDINALS_M if gender == 'm0' else lx.ORDINALS_F)}[least({n}, 10) + 1] ELSE {unit} END"
    last = f"{_sql_list(lx.UNITS_M if gender in ('m', 'm0', 'mn') else lx.UNITS_F)}[{n} % 10 + 1]"
    two = {"mn": lx.TWO_OF_M, "fn": lx.TWO_OF_F}.get(gender)
    if two:
        unit = f"CASE WHEN {n} = 2 THEN {_q(two)} ELSE {unit} END"
        last = f"CASE WHEN {n} % 10 = 2 THEN {_q(two)} ELSE {last} END"
    tens = f"{_sql_list(lx.TENS)}[{n} // 10 + 1]"
    return f"CASE WHEN {n} < 20 THEN {unit} WHEN {n} % 10 = 0 THEN {tens} ELSE {tens} || ' {lx.AND}' || {last} END"


def _sql_integer(source: str, gender: str, out: str = "spoken") -> str:
    """SELECT n and its words FROM ``source``, which has a BIGINT n from 0 to 999,999."""
    thousands = (
        f"CASE WHEN th = 0 THEN '' WHEN th <= 10 THEN {_sql_list(lx.THOUSANDS)}[least(th, 10) + 1] ELSE "
        f"(CASE WHEN th // 100 > 0 THEN {_sql_list(lx.HUNDREDS)}[th // 100 + 1] || CASE WHEN th % 100 > 0 THEN ' ' ELSE '' END ELSE '' END) || "
        f"(CASE WHEN th % 100 = 0 THEN '' ELSE (CASE WHEN th >= 100 AND (th // 100 = 1 OR th % 100 < 20 OR th % 10 = 0) THEN '{lx.AND}' ELSE '' END) || ({_sql_small('(th % 100)', 'm')}) END) || ' {lx.THOUSANDS[1]}' END"
    )
    hundreds = f"CASE WHEN h > 0 THEN {_sql_list(lx.HUNDREDS)}[h + 1] ELSE '' END"
    joined = "(th > 0 OR h > 0) AND (h = 1 OR r < 20 OR r % 10 = 0)"
    last = f"CASE WHEN r = 0 AND n > 0 THEN '' ELSE (CASE WHEN {joined} THEN '{lx.AND}' ELSE '' END) || ({_sql_small('r', gender)}) END"
    two = {"mn": lx.TWO_OF_M, "fn": lx.TWO_OF_F}.get(gender)
    whole = f"array_to_string(list_filter([{thousands}, {hundreds}, {last}], lambda x: x <> ''), ' ')"
    if two:
        whole = f"CASE WHEN r = 2 THEN {_q(two)} ELSE {whole} END"
    return f"SELECT n, {whole} AS {out} FROM (SELECT n, n // 1000 AS th, n % 1000 // 100 AS h, n % 100 AS r FROM ({source}))"


def _sql_whole(source: str, gender: str, levels: int = 1) -> str:
    """SELECT n and its words FROM ``source``, which has a BIGINT n from 0 up: millions, billions and the rest by the SQL above."""
    low, millions = _sql_integer(f"SELECT DISTINCT n % 1000000 AS n FROM ({source})", gender), _sql_integer(f"SELECT DISTINCT n // 1000000 % 1000 AS n FROM ({source})", "m")
    count = f"SELECT DISTINCT n // 1000000000 AS n FROM ({source})"
    billions = _sql_whole(count, "m", levels - 1) if levels else _sql_integer(count, "m")
    part = lambda t, unit: f"CASE {t}.n WHEN 0 THEN '' WHEN 1 THEN {_q(unit)} ELSE {t}.spoken || {_q(' ' + unit)} END"
    joined = "k.n >= 1000000 AND l.n < 100 AND (l.n < 20 OR l.n % 10 = 0)"
    last = f"CASE WHEN l.n = 0 AND k.n > 0 THEN '' WHEN {joined} THEN {_q(lx.AND)} || l.spoken ELSE l.spoken END"
    whole = f"array_to_string(list_filter([{part('b', lx.BILLION)}, {part('m', lx.MILLION)}, {last}], lambda x: x <> ''), ' ')"
    two = {"mn": lx.TWO_OF_M, "fn": lx.TWO_OF_F}.get(gender)
    if two:
        whole = f"CASE WHEN k.n % 100 = 2 THEN {_q(two)} ELSE {whole} END"
    return f"SELECT k.n, {whole} AS spoken FROM ({source}) k JOIN ({billions}) b ON b.n = k.n // 1000000000 JOIN ({millions}) m ON m.n = k.n // 1000000 % 1000 JOIN ({low}) l ON l.n = k.n % 1000000"


_KEYS = "SELECT DISTINCT l_orderkey * 7 AS n FROM lineitem"


def _keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _t(spark, sf_dir, "lineitem").select((F.col("l_orderkey").cast("long") * 7).alias("n")).distinct()


def _spoken_query(gender: str) -> None:
    _query(f"spoken_int_{gender}", _sql_whole(_KEYS, gender))(lambda spark, sf_dir: _keys(spark, sf_dir).select("n", columns.spoken_whole("n", gender).alias("spoken")))


for _gender in ("f", "m", "mn", "fn", "f0", "m0"):
    _spoken_query(_gender)


@_query("spoken_form_token", _sql_whole(_KEYS, "f"))
def spoken_form_token(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _keys(spark, sf_dir).select("n", columns.spoken_form(F.col("n").cast("string"), "f").alias("spoken"))


# decimals with a sign, halves after prepositions, and numbers with a symbol
_CENTS = "SELECT DISTINCT CAST(round(l_extendedprice * 100) AS BIGINT) AS cents, l_linenumber % 2 = 1 AS minus FROM lineitem"
_HALVES = "SELECT DISTINCT CAST(l_quantity AS BIGINT) - 1 AS n, CAST(l_orderkey % {} AS INT) AS i FROM lineitem".format(len(lx.PREPOSITIONS))
_AMOUNTS = "SELECT DISTINCT CAST(floor(l_extendedprice) AS BIGINT) AS n, CAST(l_linenumber % {} AS INT) AS i FROM lineitem".format(len(lx.SYMBOL_UNITS))
_FRACTION = f"CASE WHEN cents % 100 < 10 THEN {_q(lx.UNITS_F[0] + ' ')} || {_sql_list(lx.UNITS_F)}[cents % 10 + 1] ELSE {_sql_small('(cents % 100)', 'f')} END"
_SYMBOLS_SQL = " UNION ALL ".join(
    f"SELECT n || {_q(symbol)} AS token, spoken || {_q(' ' + word)} AS spoken FROM (SELECT DISTINCT n FROM ({_AMOUNTS}) WHERE i = {i}) JOIN ({_sql_whole(f'SELECT DISTINCT n FROM ({_AMOUNTS})', gender)}) USING (n)"
    for i, (symbol, (word, gender)) in enumerate(lx.SYMBOL_UNITS.items())
)


@_query(
    "spoken_numerals",
    f"""SELECT CASE WHEN minus THEN '-' ELSE '' END || n || '.' || lpad(CAST(cents % 100 AS VARCHAR), 2, '0') AS token, CASE WHEN minus AND n > 0 THEN {_q(lx.MINUS + ' ')} ELSE '' END || spoken || {_q(f' {lx.POINT} ')} || ({_FRACTION}) AS spoken
  FROM (SELECT *, cents // 100 AS n FROM ({_CENTS})) JOIN ({_sql_whole(f'SELECT DISTINCT cents // 100 AS n FROM ({_CENTS})', 'f')}) USING (n)
  UNION ALL SELECT p || n || '.5', substr(p, 1, length(p) - 1) || CASE WHEN n = 0 THEN {_q(lx.HALF)} ELSE spoken || {_q(' ' + lx.AND_HALF)} END
  FROM (SELECT n, {_sql_list(lx.PREPOSITIONS)}[i + 1] AS p FROM ({_HALVES}) GROUP BY ALL) JOIN ({_sql_whole(f'SELECT DISTINCT n FROM ({_HALVES})', 'f')}) USING (n)
  UNION ALL {_SYMBOLS_SQL}""",
)
def spoken_numerals(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines, whole = _t(spark, sf_dir, "lineitem"), lambda c: F.col(c).cast("long")
    cents = F.round(F.col("l_extendedprice") * 100).cast("long")
    sign = F.when(F.col("l_linenumber") % 2 == 1, "-").otherwise("")
    decimals = lines.select(F.concat(sign, F.expr("cast(round(l_extendedprice * 100) as bigint) div 100").cast("string"), F.lit("."), F.lpad((cents % 100).cast("string"), 2, "0")).alias("token"))
    pick = lambda words, i: F.element_at(F.array(*map(F.lit, words)), (F.col(i) % len(words) + 1).cast("int"))
    halves = lines.select(F.concat(pick(lx.PREPOSITIONS, "l_orderkey"), (whole("l_quantity") - 1).cast("string"), F.lit(".5")))
    amounts = lines.select(F.concat(F.floor("l_extendedprice").cast("string"), pick(tuple(lx.SYMBOL_UNITS), "l_linenumber")))
    tokens = decimals.union(halves).union(amounts).distinct()
    return spread(tokens).select("token", columns.spoken_form("token", "f").alias("spoken"))


#: Keys are spread so that millions and billions occur; no key is folded onto another one.
_FACTOR = 7_000_021
_WHOLE_KEYS = f"SELECT DISTINCT l_orderkey * {_FACTOR} AS n FROM lineitem"
_GENDERS = ("f", "m", "mn", "fn", "f0", "m0")


def _whole_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _t(spark, sf_dir, "lineitem").select((F.col("l_orderkey").cast("long") * _FACTOR).alias("n")).distinct()


@_query("spoken_whole", f"SELECT n, {', '.join(f'{g}.spoken AS {g}' for g in _GENDERS)}, f.spoken AS token FROM ({_WHOLE_KEYS}) " + " ".join(f"JOIN ({_sql_whole(_WHOLE_KEYS, g)}) {g} USING (n)" for g in _GENDERS))
def spoken_whole(spark: SparkSession, sf_dir: str) -> DataFrame:
    token = columns.spoken_form(F.col("n").cast("string"), "f")
    return spread(_whole_keys(spark, sf_dir)).select("n", *[columns.spoken_whole("n", g).alias(g) for g in _GENDERS], token.alias("token"))


_SQL_CLOCK = (
    f"SELECT h, m, CASE WHEN m = 0 THEN w || half WHEN m = 15 THEN w || ' {lx.AND_QUARTER}' || half WHEN m = 30 THEN w || ' {lx.AND_HALF}' || half "
    f"WHEN m % 10 = 0 THEN w || ' {lx.AND}' || ({_sql_small('m', 'm')}) ELSE w || ' ' || ({_sql_small('m', 'f')}) END AS spoken, n FROM "
    f"(SELECT h, m, n, {_sql_list(lx.UNITS_F)}[CASE WHEN h % 12 = 0 THEN 12 ELSE h % 12 END + 1] AS w, CASE WHEN h > 12 THEN ' {lx.AFTERNOON}' ELSE ' {lx.MORNING}' END AS half FROM "
    "(SELECT hour(ts)::INT AS h, minute(ts)::INT AS m, count(*) AS n FROM events GROUP BY ALL))"
)


@_query("spoken_time", _SQL_CLOCK)
def spoken_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    times = _t(spark, sf_dir, "events").groupBy(F.hour("ts").alias("h"), F.minute("ts").alias("m")).agg(F.count("*").alias("n"))
    return times.select("h", "m", columns.spoken_clock("h", "m").alias("spoken"), "n")


@_query("spoken_time_token", _SQL_CLOCK)
def spoken_time_token(spark: SparkSession, sf_dir: str) -> DataFrame:
    times = _t(spark, sf_dir, "events").groupBy(F.hour("ts").alias("h"), F.minute("ts").alias("m")).agg(F.count("*").alias("n"))
    return times.select("h", "m", columns.spoken_form(F.format_string("%02d:%02d", "h", "m"), "f").alias("spoken"), "n")


@_query("unit_suffix", f"SELECT n || 'kg' AS token, ({_sql_small('n', 'mn')}) || ' {lx.UNIT_WORDS['kg']}' AS spoken, c FROM (SELECT l_quantity::BIGINT AS n, count(*) AS c FROM lineitem GROUP BY 1)")
def unit_suffix(spark: SparkSession, sf_dir: str) -> DataFrame:
    tokens = _t(spark, sf_dir, "lineitem").groupBy(F.concat(F.col("l_quantity").cast("long").cast("string"), F.lit("kg")).alias("token")).agg(F.count("*").alias("c"))
    return tokens.select("token", columns.spoken_quantity("token").alias("spoken"), "c")


_DATE_SQL = (
    f"SELECT CAST(day AS VARCHAR) AS day, spoken_day || ' ' || {_sql_list(lx.MONTHS)}[month(day)] || ' ' || y.spoken AS spoken, c FROM "
    f"(SELECT day, CASE WHEN d = 1 THEN {_q(lx.FIRST_OF_MONTH)} ELSE {_sql_small('d', 'f')} END AS spoken_day, c FROM (SELECT o_orderdate::DATE AS day, day(o_orderdate)::BIGINT AS d, count(*) AS c FROM orders GROUP BY ALL)) "
    f"JOIN ({_sql_integer('SELECT DISTINCT year(o_orderdate)::BIGINT AS n FROM orders', 'f')}) y ON y.n = year(day)"
)


@_query("date_spoken", _DATE_SQL)
def date_spoken(spark: SparkSession, sf_dir: str) -> DataFrame:
    days = _t(spark, sf_dir, "orders").groupBy(F.to_date("o_orderdate").alias("day")).agg(F.count("*").alias("c"))
    return days.select(F.col("day").cast("string").alias("day"), columns.spoken_date(F.day("day"), F.month("day"), F.year("day")).alias("spoken"), "c")


_PHONE = "'05' || CAST(c_custkey % 10 AS VARCHAR) || '-' || lpad(CAST(c_custkey * 7919 % 10000000 AS VARCHAR), 7, '0')"


@_query("phone_spoken", f"SELECT c_custkey, array_to_string(list_transform(list_filter(string_split(token, ''), lambda x: x <> '-'), lambda x: {_sql_list(lx.UNITS_F)}[x::INT + 1]), ' ') AS spoken FROM (SELECT c_custkey, {_PHONE} AS token FROM customer)")
def phone_spoken(spark: SparkSession, sf_dir: str) -> DataFrame:
    token = F.concat(F.lit("05"), (F.col("c_custkey") % 10).cast("string"), F.lit("-"), F.lpad((F.col("c_custkey") * 7919 % 10_000_000).cast("string"), 7, "0"))
    return _t(spark, sf_dir, "customer").select("c_custkey", columns.spoken_phone(token).alias("spoken"))


# whole documents in SQL: words, what each becomes, and the words together again. The tables have plain
# numbers, phone numbers and numbers with a marker between, but no dates, times, units or plural nouns
# beside a number; those have queries of their own
_RE_NUMERAL = r"(-?)(?:([1-9][0-9]{0,2}(?:,[0-9]{3})*)|([0-9]+))(?:\.([0-9]+))?"
_RE_WRAP = r'^["(\[{]+|[")\]}]+$'
_WORDS_OF = "(SELECT doc_id, unnest(l) AS raw, unnest(range(1, len(l) + 1)) AS i FROM (SELECT doc_id, string_split(c, ' ') AS l FROM ({})))"


def _sql_digits(x: str) -> str:
    return f"array_to_string(list_transform(list_filter(string_split({x}, ''), lambda c: c BETWEEN '0' AND '9'), lambda c: {_sql_list(lx.UNITS_F)}[c::INT + 1]), ' ')"


def _sql_said(tokens: str) -> str:
    """CTEs up to ``said``: p, spoken, and the ordinal that follows a hundred, of the numerals among ``tokens`` (a relation with p)."""
    fraction = f"""CASE WHEN fraction = '' THEN '' WHEN fraction = '5' THEN {_q(' ' + lx.AND_HALF)} WHEN length(fraction) = 2 AND fraction[1] <> '0' THEN {_q(f' {lx.POINT} ')} || ({_sql_small('(fraction::BIGINT)', 'f')})
      ELSE {_q(f' {lx.POINT} ')} || {_sql_digits('fraction')} END"""
    whole = lambda g: f"CASE WHEN n = 0 AND fraction = '5' THEN {_q(lx.HALF)} WHEN sign = '-' AND n > 0 THEN {_q(lx.MINUS + ' ')} || f.spoken || ({fraction}) ELSE {g}.spoken || ({fraction}) END"
    return f"""numerals AS MATERIALIZED (SELECT p, m.sign AS sign, m.fraction AS fraction, (replace(m.grouped, ',', '') || m.plain)::BIGINT AS n
    FROM (SELECT p, regexp_extract(p, {_q('^' + _RE_NUMERAL + '$')}, ['sign', 'grouped', 'plain', 'fraction']) AS m FROM (SELECT DISTINCT p FROM {tokens}) WHERE regexp_full_match(p, {_q(_RE_NUMERAL)}))),
  wholes AS MATERIALIZED (SELECT DISTINCT n FROM numerals),
  said AS MATERIALIZED (SELECT p, {whole('f')} AS spoken, {whole('o')} AS ordinal FROM numerals JOIN ({_sql_whole('SELECT n FROM wholes', 'f')}) f USING (n) JOIN ({_sql_whole('SELECT n FROM wholes', 'f0')}) o USING (n))"""


def _abbreviations(own: dict[str, str]) -> str:
    found: dict[str, str] = {}
    for lead in ("", *lx.ABBREVIATION_PREFIXES):
        for table in (own, lx.ABBREVIATIONS):
            for short, full in table.items():
                found.setdefault(lead + short, lead + full)
    return ", ".join(f"({_q(a)}, {_q(b)})" for a, b in found.items())


def _speech_sql(own: dict[str, str], numbers: bool, cleaned: str = _SPEECH_SQL) -> str:
    """Words without wrappers and mark, abbreviations in full, numbers spoken, marks attached."""
    head = f"""
  WITH words AS MATERIALIZED (SELECT doc_id, i, coalesce(a.target, x.word) AS word, x.mark FROM (
    SELECT doc_id, i, {_sql_sub(_mark_sql(True), _RE_WRAP)} AS word, {_mark_sql(False)} AS mark FROM (SELECT doc_id, i, {_sql_sub('raw', _RE_WRAP)} AS w FROM {_WORDS_OF.format(f'SELECT doc_id, {cleaned} AS c FROM {_TAILED}')})) x
    LEFT JOIN (VALUES {_abbreviations(own)}) a(source, target) ON x.word = a.source WHERE x.word <> '')"""
    if numbers:
        head += f""",
  parts AS MATERIALIZED (SELECT word, unnest(l) AS p, unnest(range(len(l))) AS j FROM (SELECT word, string_split(word, CASE WHEN contains(word, '/') THEN '/' ELSE '-' END) AS l FROM (SELECT DISTINCT word FROM words WHERE regexp_matches(word, '[0-9]')))),
  tokens AS (SELECT p FROM parts UNION ALL SELECT word FROM parts),
  {_sql_said('tokens')},
  split AS (SELECT word, string_agg(spoken, ' ' ORDER BY j) AS spoken FROM parts LEFT JOIN said USING (p) GROUP BY word HAVING count(*) > 1 AND bool_and(spoken IS NOT NULL)),
  written AS (SELECT doc_id, i, mark, CASE WHEN regexp_full_match(word, '0[0-9]{{1,2}}-?[0-9]{{7}}') THEN {_sql_digits('word')} ELSE coalesce(a.spoken, s.spoken, word) END AS cardinal, a.ordinal
    FROM words LEFT JOIN said a ON a.p = word LEFT JOIN split s USING (word)),
  outs AS (SELECT doc_id, i, CASE WHEN ordinal IS NOT NULL AND ends_with(lag(cardinal || mark, 1, '') OVER (PARTITION BY doc_id ORDER BY i), {_q(lx.HUNDRED)}) THEN ordinal ELSE cardinal END || mark AS out FROM written)"""
    else:
        head += ", outs AS (SELECT doc_id, i, word || mark AS out FROM words)"
    glued = _sql_sub("string_agg(out, ' ' ORDER BY i)", _RE_SPACE + r"+([.,?!])", r"\1")
    return f"{head} SELECT doc_id, coalesce(out, '') AS out FROM documents LEFT JOIN (SELECT doc_id, trim({glued}) AS out FROM outs GROUP BY 1) USING (doc_id)"


@_query("normalize_tts_cautious", _speech_sql({}, False))
def normalize_tts_cautious(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _tailed(spark, sf_dir).select("doc_id", columns.normalize_speech("t", rewrite.CAUTIOUS).alias("out"))


_OWN = {"the": "THE"}


@_query("normalize_tts_expanded", _speech_sql(_OWN, True))
def normalize_tts_expanded(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _tailed(spark, sf_dir).select("doc_id", columns.normalize_speech("t", rewrite.EXPANDED, _OWN).alias("out"))


_BOTH = f"({_speech_sql({}, False)}) c JOIN ({_speech_sql({}, True, _PREPARED_SQL)}) e USING (doc_id) JOIN {_TAILED} USING (doc_id)"


@_query("before_after", f"SELECT doc_id, t AS raw, c.out AS cautious, e.out AS expanded, CASE WHEN c.out = t THEN 'no' ELSE 'YES' END AS cautious_changed, CASE WHEN e.out = t THEN 'no' ELSE 'YES' END AS expanded_changed FROM {_BOTH}")
def before_after(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.before_after(_tailed(spark, sf_dir).withColumnRenamed("t", "raw_text")).drop("raw_text")


def _sql_peeled(x: str) -> tuple[str, str]:
    """A word without marks around it, and the mark kept: the last one but dots in threes, quotes and brackets."""
    solid = _sql_sub(x, r"""^[."'(\[,:;?!\x{2026}]+""")
    led = f"(CASE WHEN {solid} = '' THEN right({x}, 1) ELSE {solid} END)"
    end = r'[.!?",:;)\]\x{2026}]+$'
    run = _sql_sub(f"regexp_extract({led}, {_q(end)})", r'(\.\.\.|[")\]])+$')
    kept = f"CASE WHEN {run} = '' THEN '' WHEN ends_with({run}, '?!') THEN '?' ELSE CASE right({run}, 1) WHEN '?' THEN '?' WHEN '!' THEN '!' WHEN '.' THEN '.' WHEN '\u2026' THEN '.' ELSE ',' END END"
    return _sql_sub(led, end), kept


def _transcript_sql() -> str:
    """Words peeled, numbers spoken, else words cut at a marker if no part is empty; a kept mark stands alone."""
    cleaned = _sql_sub(_sql_sub(f"translate(t, {_q(_FROM[:-1])}, {_q(_TO)})", r"\(.*?\)"), r"\[.*?\]")
    (word, mark), part = _sql_peeled("raw"), _sql_peeled("raw")[0]
    at, after_quote = "(strpos(p, '\"') - 1)", "substr(p, strpos(p, '\"') + 1)"
    acronym = f"length(p) - CASE WHEN ends_with(p, {_q(lx.PLURAL_M)}) OR ends_with(p, {_q(lx.PLURAL_F)}) THEN 4 ELSE 2 END"
    quoted = f"CASE WHEN {at} > 0 AND {at} <> {acronym} AND list_contains({_sql_list(lx.PREPOSITIONS)}, left(p, {at}) || '-') THEN left(p, {at}) || {after_quote} ELSE p END"
    return f"""
  WITH texts AS (SELECT doc_id, CASE WHEN starts_with(t, '  ') THEN t ELSE {_sql_sub('t', ' {2,}', ' ')} END AS c FROM (SELECT doc_id, {cleaned} AS t FROM {_TAILED})),
  words AS MATERIALIZED (SELECT doc_id, i, {word} AS p, {mark} AS mark FROM {_WORDS_OF.format('SELECT * FROM texts')} WHERE raw <> ''),
  cut AS (SELECT DISTINCT p, m FROM words, (VALUES ('/'), ('-')) v(m) WHERE contains(p, m)),
  parts AS MATERIALIZED (SELECT whole, m, j, CASE WHEN raw = '' THEN '' ELSE {part} END AS p FROM (SELECT p AS whole, m, unnest(l) AS raw, unnest(range(len(l))) AS j FROM (SELECT p, m, string_split(p, m) AS l FROM cut))),
  tokens AS (SELECT p FROM parts UNION ALL SELECT p FROM words WHERE regexp_matches(p, '[0-9]')),
  {_sql_said('tokens')},
  split AS (SELECT whole AS p, string_agg(coalesce(spoken, {quoted}), ' ' ORDER BY j) AS spoken FROM parts LEFT JOIN said USING (p) GROUP BY whole, m HAVING bool_and(p <> '') QUALIFY row_number() OVER (PARTITION BY whole ORDER BY m DESC) = 1),
  outs AS (SELECT doc_id, i, coalesce(a.spoken, s.spoken, {quoted}) || CASE WHEN mark = '' THEN '' ELSE ' ' || mark END AS out FROM words LEFT JOIN said a USING (p) LEFT JOIN split s USING (p))
  SELECT doc_id, coalesce(out, '') AS out FROM documents LEFT JOIN (SELECT doc_id, string_agg(out, ' ' ORDER BY i) AS out FROM outs WHERE out <> '' GROUP BY 1) USING (doc_id)"""


@_query("normalize_stt", _transcript_sql())
def normalize_stt(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _tailed(spark, sf_dir).select("doc_id", columns.normalize_transcript("t").alias("out"))


# numbers before nouns: what a noun makes of the number, in either rewriter
_NOUNS = {"\u05d9\u05dc\u05d3\u05d9\u05dd": ("mn", "m"), "\u05d9\u05dc\u05d3\u05d5\u05ea": ("fn", "f"), "\u05e9\u05e0\u05d9\u05dd": ("fn", "f"), "\u05e9\u05de\u05d5\u05ea": ("mn", "m"), "\u05e9\u05e7\u05dc": ("mn", "f"), "\u05db\u05e1\u05d0\u05d5\u05ea": ("mn", "f")}


def _counted_sql(which: int, keys: str = _KEYS) -> str:
    parts = [f"SELECT n, spoken || ' ' || {_q(noun)} AS out FROM ({_sql_whole(keys, genders[which])}) WHERE n % {len(_NOUNS)} = {i}" for i, (noun, genders) in enumerate(_NOUNS.items())]
    return " UNION ALL ".join(parts)


def _before_nouns(keys: DataFrame) -> DataFrame:
    noun = F.element_at(F.array(*map(F.lit, _NOUNS)), (F.col("n") % len(_NOUNS) + 1).cast("int"))
    return spread(keys).select("n", F.concat(F.col("n").cast("string"), F.lit(" "), noun).alias("t"))


def _counted(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _before_nouns(_keys(spark, sf_dir))


@_query("normalize_tts_counted", _counted_sql(0))
def normalize_tts_counted(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _counted(spark, sf_dir).select("n", columns.normalize_speech("t", rewrite.EXPANDED).alias("out"))


@_query("normalize_stt_counted", _counted_sql(1))
def normalize_stt_counted(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _counted(spark, sf_dir).select("n", columns.normalize_transcript("t").alias("out"))


@_query("normalize_counted_whole", f"SELECT n, a.out AS tts, b.out AS stt FROM ({_counted_sql(0, _WHOLE_KEYS)}) a JOIN ({_counted_sql(1, _WHOLE_KEYS)}) b USING (n)")
def normalize_counted_whole(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = _before_nouns(_whole_keys(spark, sf_dir))
    return counted.select("n", columns.normalize_speech("t", rewrite.EXPANDED).alias("tts"), columns.normalize_transcript("t").alias("stt"))


_COLOURS = {"red": "\u05d0\u05d3\u05d5\u05dd", "blue": "\u05db\u05d7\u05d5\u05dc", "green": "\u05d9\u05e8\u05d5\u05e7", "Brand#11": "\u05de\u05d5\u05ea\u05d2", "small": "\u05e7\u05d8\u05df"}
_COLOUR_ROWS = ", ".join(f"({_q(a)}, {_q(b)})" for a, b in _COLOURS.items())


@_query("replacement_lookup", f"SELECT word, coalesce(target, word) AS out, count(*) AS n FROM (SELECT unnest(string_split(p_name || ' ' || p_brand || ' ' || p_type, ' ')) AS word FROM part) LEFT JOIN (VALUES {_COLOUR_ROWS}) r(source, target) ON word = source GROUP BY ALL")
def replacement_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = _t(spark, sf_dir, "part").select(F.explode(F.split(F.concat_ws(" ", "p_name", "p_brand", "p_type"), " ")).alias("word"))
    table = F.create_map(*[F.lit(x) for pair in _COLOURS.items() for x in pair])
    return words.groupBy("word", columns.replace_word("word", table).alias("out")).agg(F.count("*").alias("n"))


_MANIFEST = """
  SELECT d.doc_id AS dir, d.path, a.p AS audio_path, m.p AS metadata_path,
    nullif(concat_ws('; ', CASE WHEN coalesce(a.n, 0) <> 1 THEN 'audio files: ' || coalesce(a.n, 0) END, CASE WHEN coalesce(m.n, 0) <> 1 THEN 'metadata files: ' || coalesce(m.n, 0) END), '') AS problem
  FROM (SELECT doc_id, source || '/' || doc_id AS path FROM documents) d
  LEFT JOIN (SELECT doc_id, count(*) AS n, min('a' || doc_id) AS p FROM labels GROUP BY 1) a ON a.doc_id = d.doc_id
  LEFT JOIN (SELECT conv_id, count(*) AS n, min(role || turn) AS p FROM conversations GROUP BY 1) m ON m.conv_id = d.doc_id"""


def _manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    transcripts = _t(spark, sf_dir, "documents").select(F.col("doc_id").alias("dir"), F.concat("source", F.lit("/"), F.col("doc_id").cast("string")).alias("path"))
    sounds = _t(spark, sf_dir, "labels").select(F.col("doc_id").alias("dir"), F.concat(F.lit("a"), F.col("doc_id").cast("string")).alias("path"))
    about = _t(spark, sf_dir, "conversations").select(F.col("conv_id").alias("dir"), F.concat("role", F.col("turn").cast("string")).alias("path"))
    return entries.co_locate(transcripts, sounds, about, strict=False)


@_query("manifest_join", _MANIFEST)
def manifest_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _manifest(spark, sf_dir).select("dir", "path", "audio_path", "metadata_path", "problem")


@_query("manifest_quarantine", f"SELECT problem, count(*) AS n FROM ({_MANIFEST}) WHERE problem IS NOT NULL GROUP BY 1")
def manifest_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _manifest(spark, sf_dir).where("problem is not null").groupBy("problem").agg(F.count("*").alias("n"))


_EXCLUDED = [filters.parse_exclusion(x) for x in ("k:eq:69", "k:eq:7", "no.such:eq:x")]


@_query("md_exclude", "SELECT event_id, props FROM events WHERE NOT coalesce(json_extract_string(props, '$.k') IN ('69', '7'), false)")
def md_exclude(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filters.exclude_by_metadata(_t(spark, sf_dir, "events").select("event_id", "props"), "props", _EXCLUDED)


@_query("sample_quality_gate", "SELECT d.doc_id, l.quality * 0.9::DOUBLE AS score FROM documents d LEFT JOIN (SELECT doc_id, max(quality) AS quality FROM labels GROUP BY 1) l USING (doc_id) WHERE l.quality IS NULL OR l.quality * 0.9::DOUBLE >= 0.6")
def sample_quality_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    scores = _t(spark, sf_dir, "labels").groupBy("doc_id").agg((F.max("quality") * F.lit(0.9)).alias("score"))
    return filters.quality_gate(_t(spark, sf_dir, "documents").select("doc_id").join(scores, "doc_id", "left"), "score", 0.6)


@_query("copy_md_fields", "SELECT event_id, event_type AS kept, json_extract_string(props, '$.k') AS k, json_extract_string(props, '$.none') AS \"none\" FROM events")
def copy_md_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    metadata = filters.copy_fields(F.struct(F.col("event_type").alias("kept"), F.lit("old").alias("k")), "props", ["k", "none"])
    return _t(spark, sf_dir, "events").select("event_id", metadata.alias("m")).select("event_id", "m.*")


@_query("pooled_median_score", "SELECT user_id, median(value) AS score, count(*) AS n FROM events GROUP BY 1")
def pooled_median_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _t(spark, sf_dir, "events").groupBy("user_id").agg(F.coalesce(F.median("value"), F.lit(0.0)).alias("score"), F.count("*").alias("n"))


@_query("array_median_score", "SELECT vec_id, coalesce(median(x::DOUBLE), 0.0) AS score FROM (SELECT vec_id, unnest(embedding) AS x FROM embeddings) GROUP BY 1")
def array_median_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _t(spark, sf_dir, "embeddings").select("vec_id", slicing.pooled_median(F.col("embedding").cast("array<double>")).alias("score"))


# events as segments: a second of an hour's time line is an hour, lengths come from the id
_SEGMENTS = "(SELECT user_id, event_id, epoch(ts) / 3600.0 AS s, epoch(ts) / 3600.0 + (event_id % 40) / 4.0 AS e, event_type AS t FROM events)"
_ISLANDS = f"""
  SELECT *, sum(CASE WHEN apart THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY s, event_id ROWS UNBOUNDED PRECEDING) AS run FROM (
    SELECT *, coalesce(s - lag(e) OVER (PARTITION BY user_id ORDER BY s, event_id) >= 2.0, true) AS apart FROM {_SEGMENTS})"""


def _segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    hours = F.expr("timestampdiff(MICROSECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', cast(ts as timestamp_ntz))") / 1e6 / F.lit(3600.0)
    return _t(spark, sf_dir, "events").select("user_id", "event_id", hours.alias("s"), (hours + (F.col("event_id") % 40) / F.lit(4.0)).alias("e"), F.col("event_type").alias("t"))


@_query("gap_merge", f"""SELECT user_id, run::BIGINT AS run, min_by(s, (s, event_id)) AS "start", max_by(e, (s, event_id)) AS "end", string_agg(t, '' ORDER BY s, event_id) AS text, count(*) AS n FROM ({_ISLANDS}) GROUP BY ALL""")
def gap_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sequences.merge_gaps(_segments(spark, sf_dir), ["user_id"], "s", "e", "t", 2.0, ["s", "event_id"])


@_query("gap_merge_array", f"""SELECT user_id, count(*) AS runs, string_agg(text, '|' ORDER BY run) AS text FROM (SELECT user_id, run, string_agg(t, '' ORDER BY s, event_id) AS text FROM ({_ISLANDS}) GROUP BY ALL) GROUP BY 1""")
def gap_merge_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = F.transform(F.array_sort(F.collect_list(F.struct("s", "event_id", "e", "t"))), lambda x: F.struct(x["s"].alias("start"), x["e"].alias("end"), x["t"].alias("text"), F.array().cast("array<double>").alias("word_scores")))
    merged = _segments(spark, sf_dir).groupBy("user_id").agg(parts.alias("segments")).select("user_id", sequences.merge_segments("segments", 2.0).alias("m"))
    return merged.select("user_id", F.size("m").cast("long").alias("runs"), F.array_join(F.transform("m", lambda x: x["text"]), "|").alias("text"))


@_query(
    "prev_text_chain",
    """
  SELECT conv_id, turn, text, lag(true) OVER w IS NOT NULL AS has_prev, coalesce(lag(text) OVER w, '') AS prev_text FROM (
    SELECT *, sum(CASE WHEN turn % 5 = 3 THEN 1 ELSE 0 END) OVER (PARTITION BY conv_id ORDER BY turn ROWS UNBOUNDED PRECEDING) AS chain FROM conversations)
  WHERE turn % 5 <> 3 AND length(text) >= 20 WINDOW w AS (PARTITION BY conv_id, chain ORDER BY turn)""",
)
def prev_text_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    linked = sequences.link_previous(_t(spark, sf_dir, "conversations"), ["conv_id"], "turn", "text", F.col("turn") % 5 == 3, F.length("text") >= 20)
    return linked.select("conv_id", "turn", "text", "has_prev", "prev_text")


_SHARD = 10  # entries that share a controller: no shard grows with the table


def _entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row per user: events as segments of a time line in hours from the user's first event."""
    parts = F.array_sort(F.collect_list(F.struct("s", "event_id", "e", "t")))
    users = _segments(spark, sf_dir).groupBy("user_id").agg(parts.alias("p"), F.min("s").alias("first"), F.max("e").alias("last"))
    word = lambda x: F.array((x["event_id"] % 10) / 10)
    segments = F.transform("p", lambda x: F.struct((x["s"] - F.col("first")).alias("start"), (x["e"] - F.col("first")).alias("end"), x["t"].alias("text"), word(x).alias("word_scores")))
    return users.select("user_id", segments.alias("segments"), (F.col("last") - F.col("first") + 1).alias("audio"), F.expr(f"user_id div {_SHARD}").alias("shard"))


def _slice_rows(sliced: DataFrame) -> DataFrame:
    rows = slicing.explode_slices(sliced, "user_id")
    return rows.select("user_id", "slice_idx", F.round("seek", 6).alias("seek"), F.round("duration", 6).alias("duration"), F.size("segments").alias("n"), slicing.segment_text("segments").alias("text"))


def _slices_sql(threshold: float) -> str:
    """The same packing as a recursion: a step skips a segment or makes a slice; places count from 1."""
    poor = f"(j > i AND list_aggregate(g[i : j - 1], 'median') < {threshold})"
    return f"""
  WITH RECURSIVE users AS (
    SELECT user_id, list(s - f ORDER BY s, event_id) AS a, list(e - f ORDER BY s, event_id) AS b, list(t ORDER BY s, event_id) AS t, list((event_id % 10) / 10.0::DOUBLE ORDER BY s, event_id) AS g, any_value(l - f + 1) AS audio, count(*)::INT AS n
    FROM (SELECT *, min(s) OVER (PARTITION BY user_id) AS f, max(e) OVER (PARTITION BY user_id) AS l FROM {_SEGMENTS}) GROUP BY user_id),
  steps AS (
    SELECT user_id, 1 AS i, 0.0::DOUBLE AS pos, 0 AS done, false AS made, 0.0::DOUBLE AS seek, 0.0::DOUBLE AS duration, 0 AS k, '' AS text FROM users
    UNION ALL
    SELECT user_id, CASE WHEN skip THEN i + 1 WHEN {poor} THEN r ELSE j END,
      CASE WHEN skip THEN coalesce(a[i + 1], audio) WHEN {poor} THEN coalesce(a[r], audio) WHEN j <= n AND a[j] < stop THEN a[j] ELSE pos + 30.0 END,
      done + CASE WHEN skip THEN 0 ELSE 1 END, NOT skip, pos, CASE WHEN j > i THEN least(b[j - 1], audio) - pos ELSE 0.0 END, CASE WHEN {poor} THEN 0 ELSE j - i END, CASE WHEN {poor} THEN '' ELSE array_to_string(t[i : j - 1], '') END
    FROM (
      SELECT *, coalesce(list_min(list_filter(range(i + 1, j), lambda x: g[x] >= {threshold})), j)::INT AS r FROM (
        SELECT *, coalesce(list_min(list_filter(range(i, n + 1), lambda x: NOT (a[x] < stop AND least(b[x], audio) <= stop))), n + 1)::INT AS j FROM (
          SELECT s.user_id, s.i, s.pos, s.done, u.a, u.b, u.t, u.g, u.audio, u.n, least(s.pos + 30.0, u.audio) AS stop, coalesce(u.b[s.i] - u.a[s.i] > 30.0 OR u.b[s.i] - u.a[s.i] = 0, false) AS skip
          FROM steps s JOIN users u USING (user_id) WHERE s.pos < u.audio))))
  SELECT user_id, done - 1 AS slice_idx, round(seek, 6) AS seek, round(duration, 6) AS duration, k AS n, text FROM steps WHERE made"""


@_query("greedy_slices", _slices_sql(0.0))
def greedy_slices(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _slice_rows(slicing.slice_entries(_entries(spark, sf_dir), "user_id", "segments", "audio", 30.0))


@_query("greedy_slices_quality", _slices_sql(0.45))
def greedy_slices_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _slice_rows(slicing.slice_entries(_entries(spark, sf_dir), "user_id", "segments", "audio", 30.0, threshold=0.45))


_ADAPTIVE_SQL = f"""
  WITH RECURSIVE users AS (
    SELECT *, row_number() OVER (PARTITION BY shard ORDER BY user_id) AS k FROM (
      SELECT user_id, user_id // {_SHARD} AS shard, list(s - f ORDER BY s, event_id) AS a, list(e - f ORDER BY s, event_id) AS b, list(t ORDER BY s, event_id) AS t, any_value(l - f + 1) AS audio, count(*)::INT AS n
      FROM (SELECT *, min(s) OVER (PARTITION BY user_id) AS f, max(e) OVER (PARTITION BY user_id) AS l FROM {_SEGMENTS}) GROUP BY user_id)),
  steps AS (
    SELECT DISTINCT shard, 1::BIGINT AS k, 1 AS i, 0.0::DOUBLE AS pos, 0 AS draws, 0 AS recorded, 0.0::DOUBLE AS total, 0 AS done, NULL::BIGINT AS user_id, false AS made, 0.0::DOUBLE AS seek, 0.0::DOUBLE AS duration, 0 AS size, '' AS text FROM users
    UNION ALL
    SELECT shard, CASE WHEN past THEN k + 1 ELSE k END, CASE WHEN past THEN 1 WHEN skip THEN i + 1 ELSE j END,
      CASE WHEN past THEN 0.0 WHEN skip THEN coalesce(a[i + 1], audio) WHEN j <= n AND a[j] < stop THEN a[j] ELSE pos + aim END,
      draws + made::INT, recorded + (made AND length > 0)::INT, total + CASE WHEN made THEN length ELSE 0.0 END, CASE WHEN past THEN 0 ELSE done + made::INT END,
      user_id, made, pos, length, j - i, array_to_string(t[i : j - 1], '')
    FROM (
      SELECT *, NOT past AND NOT skip AS made, CASE WHEN j > i THEN least(b[j - 1], audio) - pos ELSE 0.0 END AS length FROM (
        SELECT *, coalesce(list_min(list_filter(range(i, n + 1), lambda x: NOT (a[x] < stop AND least(b[x], audio) <= stop))), n + 1)::INT AS j FROM (
          SELECT *, least(pos + aim, audio) AS stop FROM (
            SELECT *, CASE WHEN i <= n AND a[i] <= pos THEN greatest(drawn, least(b[i], audio) - pos) ELSE drawn END AS aim FROM (
              SELECT *, CASE WHEN recorded < 5 THEN 14.0 + 12.0 * u ELSE least(30.0, greatest(5.0, centre - 7.0 + 14.0 * u)) END AS drawn FROM (
                SELECT s.shard, s.k, s.i, s.pos, s.draws, s.recorded, s.total, s.done, v.user_id, v.a, v.b, v.t, v.audio, v.n, s.pos >= v.audio AS past, coalesce(v.b[s.i] - v.a[s.i] > 30.0 OR v.b[s.i] - v.a[s.i] = 0, false) AS skip,
                  ('0x' || left(md5('1:' || s.shard || ':' || s.draws), 8))::BIGINT / 4294967296.0::DOUBLE AS u, 20.0 + 0.5 * (20.0 - s.total / greatest(s.recorded, 1)) AS centre
                FROM steps s JOIN users v ON v.shard = s.shard AND v.k = s.k)))))))
  SELECT user_id, done - 1 AS slice_idx, round(seek, 6) AS seek, round(duration, 6) AS duration, size AS n, text FROM steps WHERE made"""


@_query("adaptive_slices", _ADAPTIVE_SQL)
def adaptive_slices(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _slice_rows(slicing.slice_entries(_entries(spark, sf_dir), "user_id", "segments", "audio", 30.0, shard="shard", rank="user_id", target=20.0, least=5.0, seed=1))


@_query("shortest_k", "SELECT doc_id, n_chars FROM documents ORDER BY n_chars, lpad(CAST(doc_id AS VARCHAR), 12, '0') LIMIT 50")
def shortest_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _t(spark, sf_dir, "documents").select("doc_id", "n_chars", F.lpad(F.col("doc_id").cast("string"), 12, "0").alias("path"))
    return partitioning.shortest(docs, "n_chars", "path", 50).select("doc_id", "n_chars")


_RANKED = "SELECT doc_id, row_number() OVER (ORDER BY n_chars, lpad(CAST(doc_id AS VARCHAR), 12, '0')) AS rank FROM documents"


@_query("shard_assign", f"SELECT doc_id, rank, (rank - 1) // 30 AS shard_id FROM ({_RANKED})")
def shard_assign(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _t(spark, sf_dir, "documents").select("doc_id", "n_chars", F.lpad(F.col("doc_id").cast("string"), 12, "0").alias("path"))
    return partitioning.assign_shards(docs, "n_chars", "path", 30).select("doc_id", "rank", "shard_id")


_SPLIT = "SELECT doc_id, CASE WHEN row_number() OVER (ORDER BY md5('5:' || doc_id), doc_id) <= ceil(0.1 * count(*) OVER ()) THEN 'eval' ELSE 'train' END AS split FROM documents"


def _split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return partitioning.exact_split(_t(spark, sf_dir, "documents").select("doc_id"), "doc_id", 0.1, seed=5)


@_query("exact_split", _SPLIT)
def exact_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _split(spark, sf_dir).select("doc_id", "split")


@_query("split_counts", f"SELECT split, count(*) AS n FROM ({_SPLIT}) GROUP BY 1")
def split_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return partitioning.split_counts(_split(spark, sf_dir))


@_query("concat_chunks", "SELECT doc_id, lang FROM documents WHERE doc_id % 3 = 0 UNION ALL SELECT doc_id, lang FROM documents WHERE doc_id % 3 = 1 UNION ALL SELECT doc_id, lang FROM documents WHERE doc_id % 3 = 2")
def concat_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _t(spark, sf_dir, "documents").select("doc_id", "lang")
    return partitioning.concat_chunks([docs.where(F.col("doc_id") % 3 == i) for i in range(3)])


@_query("duration_stats", "SELECT count(n_chars) AS n, max(n_chars)::DOUBLE AS max, min(n_chars)::DOUBLE AS min, avg(n_chars) AS mean, median(n_chars) AS median, round(coalesce(stddev_samp(n_chars), 0.0), 6) AS stdev FROM documents")
def duration_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.duration_stats(_t(spark, sf_dir, "documents"), "n_chars").withColumn("stdev", F.round("stdev", 6))


@_query(
    "duration_hist20",
    """
  WITH ends AS (SELECT min(l_extendedprice) AS lo, max(l_extendedprice) AS hi, (max(l_extendedprice) - min(l_extendedprice)) / 20 AS w FROM lineitem),
  placed AS (SELECT least(floor((l_extendedprice - lo) / w), 19)::INT AS bin FROM lineitem, ends)
  SELECT b.bin::INT AS bin, round(lo + b.bin * w, 6) AS low, round(lo + (b.bin + 1) * w, 6) AS high, count(p.bin) AS n FROM range(20) b(bin) CROSS JOIN ends LEFT JOIN placed p ON p.bin = b.bin GROUP BY ALL""",
)
def duration_hist20(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.histogram(_t(spark, sf_dir, "lineitem"), "l_extendedprice").withColumn("low", F.round("low", 6)).withColumn("high", F.round("high", 6))


_INDEXED = "SELECT *, row_number() OVER (ORDER BY doc_id) - 1 AS row_idx FROM documents"


def _numbered(spark: SparkSession, sf_dir: str, pick: Callable[[DataFrame], DataFrame], *columns: str) -> DataFrame:
    """Rows picked by their number: only the ids are numbered, and the picked ones joined with the rest."""
    docs = _t(spark, sf_dir, "documents")
    picked = pick(partitioning.with_row_index(docs.select("doc_id"), "doc_id"))
    return docs.select("doc_id", *columns).join(F.broadcast(picked), "doc_id").select("row_idx", "doc_id", *columns)  # a page at most


@_query("batch_page", f"SELECT row_idx, doc_id, lang FROM ({_INDEXED}) WHERE row_idx BETWEEN 40 AND 59")
def batch_page(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _numbered(spark, sf_dir, lambda rows: audit.page(rows, 40), "lang")


@_query("row_at", f"SELECT row_idx, doc_id, text FROM ({_INDEXED}) WHERE row_idx = 123")
def row_at(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _numbered(spark, sf_dir, lambda rows: audit.row_at(rows, 123), "text")


@_query("text_fallback", "SELECT conv_id, turn, coalesce(nullif(CASE WHEN turn % 2 = 0 THEN '' ELSE role END, ''), text) AS raw FROM conversations")
def text_fallback(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _t(spark, sf_dir, "conversations").withColumn("raw_text", F.when(F.col("turn") % 2 == 0, F.lit("")).otherwise(F.col("role")))
    return rows.select("conv_id", "turn", filters.first_text("raw_text", "text").alias("raw"))


@_query("waveform_slice", "SELECT vec_id, unnest(range(b - a)) AS at, unnest(embedding[a + 1 : b])::DOUBLE AS sample FROM (SELECT vec_id, embedding, round_even((vec_id % 9) + 0.5, 0)::BIGINT AS a, round_even((vec_id % 9) + 0.5 + 20.0, 0)::BIGINT AS b FROM embeddings)")
def waveform_slice(spark: SparkSession, sf_dir: str) -> DataFrame:
    start = (F.col("vec_id") % 9 + 0.5) / 1000
    # a rate of 1000 samples a second, 20 ms
    return _t(spark, sf_dir, "embeddings").select("vec_id", F.posexplode(audio.cut_samples("embedding", start, F.lit(0.02), 1000)).alias("at", "sample")).select("vec_id", F.col("at").cast("long").alias("at"), F.col("sample").cast("double").alias("sample"))


@_query("pcm16_scale", "SELECT vec_id, unnest(range(len(embedding))) AS at, unnest(list_transform(embedding, lambda x: greatest(-32768, least(32767, round_even(x::DOUBLE * 32767, 0)))::INT)) AS pcm FROM embeddings")
def pcm16_scale(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _t(spark, sf_dir, "embeddings").select("vec_id", F.posexplode(F.transform("embedding", audio.pcm16)).alias("at", "pcm")).withColumn("at", F.col("at").cast("long"))


@_query("column_prune", "SELECT source, lang, count(*) AS n FROM documents GROUP BY ALL")
def column_prune(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _t(spark, sf_dir, "documents").groupBy("source", "lang").agg(F.count("*").alias("n"))


@_query("segment_text_concat", "SELECT conv_id, string_agg(text, '' ORDER BY turn) AS text FROM conversations GROUP BY 1")
def segment_text_concat(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = F.transform(F.array_sort(F.collect_list(F.struct("turn", "text"))), lambda x: F.struct(x["text"].alias("text")))
    return _t(spark, sf_dir, "conversations").groupBy("conv_id").agg(parts.alias("segments")).select("conv_id", slicing.segment_text("segments").alias("text"))


# transcripts as JSON text: of five conversations one has an unknown key, one lacks the words, one is cut off
_FORMS = 5


@_query(
    "strict_transcripts",
    f"""SELECT conv_id, CASE WHEN conv_id % {_FORMS} IN (1, 2, 3) THEN 'the transcript does not follow the schema' END AS parse_error, CASE WHEN conv_id % {_FORMS} NOT IN (1, 2, 3) THEN count(*) END AS n,
  CASE WHEN conv_id % {_FORMS} NOT IN (1, 2, 3) THEN string_agg(text, '' ORDER BY turn) END AS text, CASE WHEN conv_id % {_FORMS} IN (1, 2, 3) THEN 0.0 ELSE median(turn / 8.0::DOUBLE) END AS score FROM conversations GROUP BY 1""",
)
def strict_transcripts(spark: SparkSession, sf_dir: str) -> DataFrame:
    start, form = F.col("turn").cast("double"), F.col("conv_id") % _FORMS
    word = F.struct(start.alias("start"), (start + 1).alias("end"), F.col("text").alias("word"), (start / 8).alias("probability"), F.array(F.col("turn")).alias("tokens"))
    words = F.when(form != 2, F.array(word))  # a null field is not written
    segment = F.struct(start.alias("start"), (start + 1).alias("end"), F.col("text"), words.alias("words"), F.when(form == 1, F.lit(1)).alias("unknown"))
    whole = _t(spark, sf_dir, "conversations").select("conv_id", "turn", segment.alias("s")).groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", "s"))).alias("p"))
    text = F.to_json(F.struct(F.transform("p", lambda x: x["s"]).alias("segments")))
    parsed = entries.parse_transcripts(whole.select("conv_id", F.when(F.col("conv_id") % _FORMS == 3, F.left(text, F.length(text) - 2)).otherwise(text).alias("value")))
    score = slicing.pooled_median(slicing.segment_scores("segments"))
    return parsed.select("conv_id", "parse_error", F.when(F.col("segments").isNotNull(), F.size("segments").cast("long")).alias("n"), slicing.segment_text("segments").alias("text"), score.alias("score"))


_MD_FORMS = ('{"duration": %d}', '{"duration": "%d.5", "session_duration": 1}', '{"session_duration": %d}', '{"other": {"duration": %d}}')


@_query("metadata_duration", f"SELECT doc_id, CASE doc_id % {len(_MD_FORMS)} WHEN 1 THEN n_chars + 0.5::DOUBLE WHEN 3 THEN 0.0 ELSE n_chars END::DOUBLE AS duration FROM documents")
def metadata_duration(spark: SparkSession, sf_dir: str) -> DataFrame:
    forms = [F.format_string(form, F.col("n_chars").cast("long")) for form in _MD_FORMS]
    md = F.element_at(F.array(*forms), (F.col("doc_id") % len(_MD_FORMS) + 1).cast("int"))
    return _t(spark, sf_dir, "documents").select("doc_id", md.alias("md")).select("doc_id", partitioning.duration_of("md").alias("duration"))


@_query("dataset_round_trip", f"SELECT doc_id, split, lang, text FROM documents JOIN ({_SPLIT}) USING (doc_id)")
def dataset_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents written as a dataset with splits and opened again."""
    path = new_path(spark, "dataset")
    docs = _t(spark, sf_dir, "documents").select("doc_id", "lang", "text").join(_split(spark, sf_dir).select("doc_id", "split"), "doc_id")
    datasets.write_dataset(docs, path, name="documents", language="he")
    return datasets.open_dataset(spark, path).select("doc_id", "split", "lang", "text")


def _stream(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    # a stream takes a file only by a pattern; this one fits a folder of that name as well
    return spark.readStream.schema(_t(spark, sf_dir, table).schema).parquet(f"{sf_dir}/{table}[.]parquet")


@_query("stream_rewrite", _speech_sql({}, False))
def stream_rewrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents as a stream, rewritten into files; all there are, then it stops."""
    out, texts = new_path(spark, "stream"), _with_tail(_stream(spark, sf_dir, "documents").select("doc_id", "text"))
    rewritten = rewrite_stream.normalize_stream(texts, "t").select("doc_id", F.col("normalized").alias("out"))
    rewritten.writeStream.format("parquet").option("checkpointLocation", new_path(spark, "stream-state")).trigger(availableNow=True).start(out).awaitTermination()
    return spark.read.schema(rewritten.schema).parquet(out)


@_query(
    "stream_sessions",
    """SELECT user_id, strftime(min(ts), '%Y-%m-%d %H:%M:%S.%f') AS "start", strftime(max(ts), '%Y-%m-%d %H:%M:%S.%f') AS "end", string_agg(event_type, '' ORDER BY ts, event_type) AS text, count(*) AS n FROM (
  SELECT *, sum(apart) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS run FROM (
    SELECT *, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) <= INTERVAL 6 HOURS THEN 0 ELSE 1 END AS apart FROM events)) GROUP BY user_id, run""",
)
def stream_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events as a stream, merged into sessions across gaps of up to six hours; the last state of every session."""
    out = new_path(spark, "stream")
    events = _stream(spark, sf_dir, "events").select("user_id", F.col("ts").cast("timestamp").alias("ts"), "event_type")
    merged = rewrite_stream.merge_sessions(events, "user_id", "ts", "event_type", "6 hours", "1 hour")
    write = merged.writeStream.outputMode("complete").option("checkpointLocation", new_path(spark, "stream-state")).foreachBatch(lambda batch, _: batch.write.mode("overwrite").parquet(out))
    write.trigger(availableNow=True).start().awaitTermination()
    when = lambda c: F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS").alias(c)
    return spark.read.schema(merged.schema).parquet(out).select("user_id", when("start"), when("end"), "text", "n")


@_query("wav_round_trip", f"SELECT vec_id, 44 + 2 * len(embedding) AS n_bytes, unnest(range(len(embedding))) AS at, unnest(list_transform(embedding, lambda x: greatest(-32768, least(32767, round_even(x::DOUBLE * 32767, 0)))::INT / 32768.0::DOUBLE)) AS sample FROM embeddings")
def wav_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Samples written as WAV files, decoded, cut over their whole length, written and read for playback."""
    octet = lambda x: F.lpad(F.hex(x.bitwiseAND(255)), 2, "0")
    pcm = F.unhex(F.array_join(F.transform("embedding", lambda x: F.concat(octet(audio.pcm16(x)), octet(F.shiftright(audio.pcm16(x), 8)))), ""))
    sounds = spread(_t(spark, sf_dir, "embeddings").select("vec_id", F.size("embedding").alias("size"), pcm.alias("pcm"))).withColumn("wav", audio.wav_bytes("pcm"))
    cut = sounds.withColumn("back", audio.decode_column("wav")["pcm"]).withColumn("cut", audio.wav_bytes(audio.cut_pcm("back", F.lit(0.0), F.col("size") / audio.RATE)))
    rows = cut.select("vec_id", F.octet_length("cut").cast("long").alias("n_bytes"), F.posexplode(audio.wav_samples("cut")).alias("at", "sample"))
    return rows.withColumn("at", F.col("at").cast("long")).withColumn("sample", F.col("sample").cast("double"))


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


def oracles() -> dict[str, str]:
    return dict(_ORACLES)
