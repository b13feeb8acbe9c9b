"""Native columns against the plain functions, and the Arrow columns."""

import re
import tracemalloc

import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from voxloom.functions import columns, rewrite, spoken
from voxloom.operators import audit

TEXTS = [
    "", " ", "a—b “q”‏ ב־ג", "\U0001f642x❤️ [x] (y (z)) \\", "\t  [a]  z (q\nr) 　\x1c\x85", "10-20 a-b-c 1-2-a a-1-2 א-ב-ג ١-٢ --- a--b", '"(word)" ... !? [deep [er]] {x}', "(open [mixed) ]", "a\rb(c\rd)e", "plain",
]


@pytest.fixture(scope="module")
def texts(spark):
    return spark.createDataFrame([(i, t) for i, t in enumerate(TEXTS)] + [(99, None)], "i int, t string")


def pairs(df, column):
    return {r["i"]: r["out"] for r in df.select("i", column.alias("out")).collect()}


STEPS = {
    "chars": (columns.char_cleanup, lambda t: t.translate(rewrite._CLEAN)),
    "chars_older": (lambda c: columns.char_cleanup(c, backslash=False), lambda t: t.translate(rewrite._CLEAN_OLDER)),
    "emoji": (columns.strip_emoji, lambda t: rewrite._EMOJI.sub("", t)),
    "parentheses": (columns.strip_parentheses, lambda t: rewrite._PARENTHESES.sub("", t)),
    "brackets": (columns.strip_brackets, lambda t: rewrite._BRACKETS.sub("", t)),
    "dashes": (columns.split_dashes, rewrite.split_dashes),
    "blanks": (columns.collapse_blanks, lambda t: " ".join(t.split())),
    "all": (columns.speech_cleanup, lambda t: rewrite.clean(t, rewrite.CAUTIOUS)),
}


@pytest.mark.parametrize("step", STEPS)
def test_steps(texts, step):
    native, plain = STEPS[step]
    assert pairs(texts, native(F.col("t"))) == {**{i: plain(t) for i, t in enumerate(TEXTS)}, 99: None}


def test_words(spark):
    words = ["", "a", '"a"', "((a]}", "a...", "...", "a?!", "a!?", "a…", "a;", "a.)", "..", "x....", " a, "]
    df = spark.createDataFrame([(i, w) for i, w in enumerate(words)], "i int, t string")
    assert pairs(df, columns.unwrap("t")) == {i: rewrite.unwrap(w) for i, w in enumerate(words)}
    marks = {i: tuple(v) for i, v in pairs(df, columns.closing_mark("t")).items()}
    assert marks == {i: rewrite.closing_mark(w) for i, w in enumerate(words)}


@pytest.mark.parametrize("gender", ["f", "m", "f0", "m0", "fn", "mn"])
def test_spoken_integer(spark, gender):
    numbers = [*range(0, 2300), 9_999, 10_000, 10_001, 11_000, 12_102, 99_999, 100_000, 102_002, 111_111, 200_020, 345_678, 999_999]
    df = spark.createDataFrame([(n, n) for n in numbers] + [(-1, -1), (10**6, 10**6)], "i long, t long")
    got = pairs(df, columns.spoken_integer("t", gender))
    assert got.pop(-1) is None and got.pop(10**6) is None
    assert got == {n: spoken.integer(n, gender) for n in numbers}


@pytest.mark.parametrize("gender", ["f", "m", "f0", "m0", "fn", "mn"])
def test_spoken_whole(spark, gender):
    numbers = [*range(0, 1200), 999_999, 2**53 - 1, 2**53 + 1, 2**63 - 1, 999_999_999_999_999]
    numbers += [k * size + rest for size in (10**6, 10**9, 10**12, 10**15, 10**18) for k in (1, 2, 3, 9) for rest in (0, 1, 2, 5, 20, 21, 22, 100, 102, 199, 345, 1000, 1002, 11_000, 102_002, 999_999) if k * size + rest < 2**63]
    numbers += [1_001_000_000, 2_000_001_002, 21_345_678_901, 102_102_102_102, 1_000_000_002_000_000]
    df = spark.createDataFrame([(n, n) for n in sorted(set(numbers))] + [(-1, -1), (-2, None)], "i long, t long")
    got = pairs(df, columns.spoken_whole("t", gender))
    assert got.pop(-1) is None and got.pop(-2) is None
    assert got == {n: spoken.integer(n, gender) for n in numbers}


def test_clock_date_phone(spark):
    times = [(h * 100 + m, h, m) for h in range(-1, 26) for m in (0, 1, 5, 10, 12, 15, 20, 30, 45, 59, 60)]
    df = spark.createDataFrame(times, "i int, h int, m int")
    assert pairs(df, columns.spoken_clock("h", "m")) == {i: spoken.clock(h, m) if h >= 0 else None for i, h, m in times}
    days = [(d * 100 + m, d, m) for d in (0, 1, 2, 20, 27, 31, 32) for m in (0, 1, 11, 12, 13)]
    df = spark.createDataFrame(days, "i int, d int, m int")
    assert pairs(df, columns.spoken_date("d", "m", F.lit(2026))) == {i: spoken.date(f"{d}/{m}/2026") for i, d, m in days}
    phones = ["050-1234567", "031234567", "0501234567", "1234567", "050-123456", "05-0123456x"]
    df = spark.createDataFrame(list(enumerate(phones)), "i int, t string")
    assert pairs(df, columns.spoken_phone("t")) == {i: spoken.phone(p) for i, p in enumerate(phones)}


def test_arrow_columns_and_sql(spark, texts):
    table = {"plain": "simple"}
    assert pairs(texts, columns.normalize_speech("t", rewrite.EXPANDED, table))[9] == "simple"
    assert pairs(texts, columns.normalize_transcript("t"))[99] is None
    columns.register(spark, table)
    row = spark.sql("SELECT normalize_tts('3 ילדות') a, normalize_tts_expanded('3 ילדות') b, normalize_stt('plain.') c, spoken_form('ב-27', 'f') d, spoken_form(null, 'f') e").first()
    assert tuple(row) == ("3 ילדות", "שלוש ילדות", "simple .", "בעשרים ושבע", None)
    df = spark.createDataFrame([("2.5kg",), ("x",), (None,)], "t string")
    assert [r[0] for r in df.select(columns.spoken_quantity("t")).collect()] == ["שניים וחצי קילוגרם", None, None]
    words = df.select(columns.replace_word("t", F.create_map(F.lit("x"), F.lit("y")))).collect()
    assert [r[0] for r in words] == ["2.5kg", "y", None]


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet=st.sampled_from(list("אבםהו0123456789.,:;!?-/\"'()[]{} %₪km°C…")), max_size=30))
def test_rewriting_never_fails(text):
    for options in rewrite.PRESETS.values():
        out = rewrite.for_speech(text, options)
        assert out == out.strip()
    rewrite.for_transcript(text)
    rewrite.playground(text)


@settings(max_examples=200, deadline=None)
@given(st.integers(0, 10**15), st.sampled_from(["m", "f", "m0", "f0"]))
def test_any_integer(n, gender):
    words = spoken.integer(n, gender)
    assert words and words == words.strip() and "  " not in words and spoken.spoken(str(n), gender) == words


def test_rewriting_holds_few_texts_at_a_time(spark):
    text = "\u05d0 plain words, " * 400
    batches = [pa.array([text, None] * 3000), pa.array([], pa.string()), pa.array([text, None])]
    for f in (rewrite.for_speech, rewrite.for_transcript):
        wanted, found = [f(text), None], 0
        tracemalloc.start()
        for part in columns._on_texts(f).func(iter(batches)):
            assert part.to_pylist() == (wanted * len(part))[found % 2 :][: len(part)]
            found += len(part)
        peak = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        assert found == 6002 and peak < 20e6, peak


def test_rewriting_long_and_null_texts_keeps_rows(spark):
    rows = [(i, None if i % 7 == 0 else f"{i} (x) \u05d0-\u05d1 " * (60_000 if i == 10 else i)) for i in range(40)]
    df = spark.createDataFrame(rows, "i int, t string").coalesce(1)
    got = df.select("i", columns.normalize_speech("t", rewrite.EXPANDED).alias("a"), columns.normalize_transcript("t").alias("b"), columns.normalize_speech(columns.normalize_speech("t")).alias("c")).collect()
    for (_, t), r in zip(rows, sorted(got), strict=True):
        once = t and rewrite.for_speech(t)
        assert (r["a"], r["b"], r["c"]) == (None if t is None else rewrite.for_speech(t, rewrite.EXPANDED), None if t is None else rewrite.for_transcript(t), once and rewrite.for_speech(once))


SPOKEN = [*TEXTS, "the ד\"ר פרופ' a, ה5. 3 ילדות, מאה 5 5kg -5 3/4 1,000.5% x5- 12:30, 050-1234567 the.", "a-b-c--d -e f- 1-2-3 -", " ".join(f"w{i}" for i in range(300))]


@pytest.mark.parametrize("own", [{}, {"the": "THE", "a": "", "w7": "7", "ילדות": "x"}])
def test_kept_words_and_one_pass_give_the_same(own, monkeypatch):
    both, speakers = rewrite.Comparison(own), {n: rewrite.Speaker(o, own) for n, o in rewrite.PRESETS.items()}
    monkeypatch.setattr(rewrite._Words, "MOST", 100)
    for text in SPOKEN * 2:
        alone = {n: rewrite.for_speech(text, o, own) for n, o in rewrite.PRESETS.items()}
        assert {n: f(text) for n, f in speakers.items()} == alone and both(text) == (alone["cautious"], alone["preparation"])
    assert all(0 < len(f.words) <= 100 for f in speakers.values())


def test_texts_without_parentheses_are_cleaned_once_for_both_forms(monkeypatch):
    calls, once = [], rewrite.clean
    monkeypatch.setattr(rewrite, "clean", lambda text, o: calls.append(text) or once(text, o))
    assert rewrite.Comparison()("a-b 5 [x]") == ("a b 5", "a b חמש") and len(calls) == 1
    assert rewrite.Comparison()("a (b) 5") == ("a 5", "a b חמש") and len(calls) == 3


def test_before_and_after_come_from_one_function(spark, texts):
    plan = audit.before_after(texts.withColumnRenamed("t", "raw_text"))._jdf.queryExecution().executedPlan().toString()
    assert [x.count("run(") for x in re.findall(r"ArrowEvalPython \[(.*?)\]", plan)] == [1], plan


def test_words_kept_stay_few_however_many_there_are(spark):
    batches = (pa.array([" ".join(f"w{i},{j} {i}x{j} the" for j in range(500))]) for i in range(400))
    run = columns._on_texts(rewrite.Speaker(rewrite.EXPANDED, {"the": "THE"})).func
    tracemalloc.start()
    assert sum(part[0].as_py().count("THE") for part in run(batches)) == 200_000
    held = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert held < 40e6, held  # 32,768 words and the numbers spelled last
