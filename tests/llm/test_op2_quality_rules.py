import re
from collections import Counter

import numpy as np
import pytest

from tests.llm.conftest import SF
from voxloom.llm import quality_rules as q


def brute(text):
    text = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4))
    covered = {j for i in range(len(w) - 4) if windows[tuple(w[i : i + 5])] > 1 for j in range(i, i + 5)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered)


def test_counts(spark, docs, rows):
    more = [(1, "a b c d e a b c d e f", "en", "a", 1), (2, "x\n\nx\nx \n##|\n\n", "en", "a", 1), (3, "a a a a a a", "en", "a", 1), (4, "a b c d e x a b c d e", "en", "a", 1)]
    df = docs.select("doc_id", "text", "lang", "source", "id", "h", "n").unionByName(spark.createDataFrame(more, "doc_id long, text string, lang string, source string, n_chars long").drop("n_chars"), allowMissingColumns=True)
    got = Counter(tuple(r)[1:6] for r in q.quality_rules(df).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words").collect())
    assert got == Counter(brute(r[1]) for r in rows + more)
    for r in q.quality_rules(df).collect():
        assert r["base_failed"] == (r["n_words"] < 10 or 100 * r["n_repeat_words"] > 20 * r["n_words"])
        assert r["kept"] == (not r["base_failed"] and not r["failed"])


def test_empty(empty):
    assert q.quality_rules(empty).count() == 0


def test_native(spark, capsys):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for plan in (q.measure(docs), q.thresholds(q.measure(docs)), q.quality_rules(docs)):
        plan.explain("formatted")
    assert not re.search("Python|Arrow|Pandas", capsys.readouterr().out)


def brute_fences(m, fences):
    """Quantiles of sorted values instead of sketches, drawn towards those of the parent groups."""

    def quartiles(rows, count, size):
        v = np.sort([r[count] / r[size] if count else r[size] for r in rows if r[size] > 0])
        return len(v), np.array([v[-(-len(v) * i // 4) - 1] for i in (1, 2, 3)]) if len(v) else np.zeros(3)

    def drawn(levels, count, size):
        found = None
        for rows in levels:
            n, own = quartiles(rows, count, size)
            found = own if found is None else (n * own + fences.prior * found) / (n + fences.prior)
        return found

    out = {}
    for group in {(r["group0"], r["group1"]) for r in m}:
        levels = [m, [r for r in m if r["group0"] == group[0]], [r for r in m if (r["group0"], r["group1"]) == group]]
        for name, (count, size, unit, _) in q.MEASURES.items():
            low, mid, high = drawn(levels, count, size)
            least = unit / drawn(levels, None, size)[1]
            out[group, name] = (mid - fences.reach * max(mid - low, least), mid + fences.reach * max(high - mid, least))
    return out


@pytest.mark.parametrize("fences", [q.Fences(), q.Fences(reach=2.0, errors=0.5, prior=5.0)])
def test_kept_against_exact_quantiles(spark, docs, fences):
    """The sketches' fences lie within 3 % of those of the values themselves, and only rows between the two may differ."""
    for table in (docs, spark.read.parquet(f"{SF}/documents.parquet")):
        m = [r.asDict() for r in q.measure(table).collect()]
        exact = brute_fences(m, fences)
        judged = {}
        for r in q.quality_rules(table, fences=fences).collect():
            judged.setdefault(r["doc_id"], []).append((r["kept"], set(r["failed"]), r["base_failed"], r["n_words"], r["n_symbols"]))
        for r in m:
            same = [j for j in judged[r["id"]] if j[3:] == (r["n_words"], r["n_symbols"])]
            for name, (count, size, unit, both) in q.MEASURES.items():
                if not r[size]:
                    continue
                low, high = exact[(r["group0"], r["group1"]), name]
                error = fences.errors * (unit * (r[count] + unit)) ** 0.5
                over, under, slack = (r[count] - error) / r[size] - high, low - (r[count] + error) / r[size], 0.03 * max(abs(high), abs(low) if both else 0) * (1 + fences.reach / 3)
                beyond = max(over, under) if both else over
                if abs(beyond) > slack:
                    assert all((name in j[1]) == (beyond > 0) for j in same), (r, name, low, high)
            assert all(j[0] == (not j[1] and not j[2]) for j in same)


def test_fences_adapt(spark):
    """A source where symbols or long words are usual keeps its texts; the same text fails elsewhere; reruns agree."""
    rows = [(i, " ".join(["plain", "words", "only", "here", "always"][j % 5] + str(100_000 + 61 * i + j) for j in range(60)), "en", "prose") for i in range(900)]
    rows += [(3000 + i, " ".join(f"${100 + i}|{100 + j}|*" for j in range(60)), "en", "tables") for i in range(300)]
    rows += [(4000 + i, " ".join(f"long{100 + i}word{100 + j}everywhereinthislanguage" for j in range(60)), "xx", "prose") for i in range(300)]
    rows += [(5000, rows[900][1], "en", "prose"), (5001, rows[1200][1], "en", "prose"), (5002, rows[0][1], "xx", "prose"), (5003, rows[900][1], "new", None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    got = {r["doc_id"]: (r["kept"], r["failed"]) for r in q.quality_rules(df).collect()}
    assert [(r[0], got[r[0]]) for r in rows[:1500] if not got[r[0]][0]] == []
    assert "symbol_rate" in got[5000][1] and got[5001][1] == ["word_length"] and "word_length" in got[5002][1]
    assert got == {r["doc_id"]: (r["kept"], r["failed"]) for r in q.quality_rules(df.repartition(7)).collect()}


def test_sketch_quantiles(spark):
    m = q.measure(spark.read.parquet(f"{SF}/documents.parquet")).cache()
    found = q.quantiles(q.sketches(m)).where("measure = 'word_length'").first()
    exact = np.quantile([r["word_chars"] / r["n_words"] for r in m.where("n_words > 0").collect()], [0.25, 0.5, 0.75], method="inverted_cdf")
    assert np.allclose([found["q1"], found["q2"], found["q3"]], exact, rtol=0.011)


def test_labelled(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    judged = q.quality_rules(docs).join(labels, "doc_id").selectExpr("quality", "cast(kept as int) as k")
    rates = {r["quality"]: r["rate"] for r in judged.groupBy("quality").agg({"k": "avg"}).toDF("quality", "rate").collect()}
    assert rates[1] > 0.95 and rates[0] < 0.1
