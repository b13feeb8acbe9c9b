from collections import Counter

import pytest
from pyspark.sql import functions as F

import corpus_pipeline as cp
from tests.llm.conftest import SF
from tests.llm.test_op3_mixing import brute as brute_mix
from tests.llm.test_op4_substring_dedup import brute as brute_cut
from tests.llm.test_op7_sentencepiece import LIBRARY
from tests.llm.test_op8_minhash import brute as brute_near
from voxloom.llm import toxicity

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def table(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


def plain(df):
    return [tuple(r) for r in df.collect()]


def test_order():
    assert [n for n, _ in cp.STAGES] == ["toxicity", "minhash_near_dedup", "substring_dedup", "mixing", "sentencepiece"]


def test_toxicity(spark, table):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    rejected = {r["doc_id"] for r in toxicity.score_toxicity(table, labels).where("rejected").select("row.doc_id").collect()}
    out = cp.drop_toxic(spark, table, SF)
    assert out.columns == COLUMNS and Counter(plain(out)) == Counter(r for r in plain(table) if r[0] not in rejected)


def test_near_copies(spark, table):
    rows = plain(table)
    kept = {k[0] for k in brute_near([(r[0], r[1]) for r in rows], 5) if k[3]}
    out = cp.drop_near_copies(spark, table, SF)
    assert out.columns == COLUMNS and Counter(plain(out)) == Counter(r for r in rows if r[0] in kept)


def test_near_copies_of_reused_ids(spark):
    """Texts that share an id link each for itself; one document of every group of near copies stays."""
    x, z, q = ([f"{c}{i}" for i in range(60)] for c in "xzq")
    near = lambda words: " ".join([*words[:-1], "other"])
    rows = [(5, " ".join(x)), (5, " ".join(z)), (9, " ".join(z)), (3, near(x)), (7, near(z)), (5, " ".join(z)), (None, " ".join(q)), (None, " ".join(q)), (4, " ".join(q)), (11, None), (11, "")]
    df = spark.createDataFrame([(i, t, "en", "a", 1) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long").repartition(3)
    out = Counter((r["doc_id"], r["text"]) for r in cp.drop_near_copies(spark, df, SF).collect())
    assert out == Counter([(3, near(x)), (5, " ".join(z)), (None, " ".join(q)), (4, " ".join(q)), (11, None), (11, "")])


def test_passages(spark, table):
    out = cp.cut_repeated_passages(spark, table, SF)
    expected = {e[0]: e for e in brute_cut([(r[0], r[1]) for r in plain(table)], 13)}
    before = {r[0]: r for r in plain(table)}
    assert out.columns == COLUMNS and out.count() == len(before)
    for r in plain(out):
        assert r[1].encode().split() == expected[r[0]][4] and r[4] == len(r[1]) and r[2:4] == before[r[0]][2:4]
        if not expected[r[0]][2]:
            assert r == before[r[0]]


def test_mixing(spark, table):
    out = cp.mix(spark, table, SF)
    taken = {e[0]: e for e in brute_mix([(r[0], r[1], r[3]) for r in plain(table)])}
    words, texts = Counter(), {r[0]: r[1] for r in plain(table)}
    for r in plain(out):
        words[r[0]] += len(r[1].encode().split())
        assert r[1] == texts[r[0]] or texts[r[0]].encode().split()[: len(r[1].split())] == r[1].encode().split()
    assert out.columns == COLUMNS and words == Counter({i: e[5] for i, e in taken.items() if e[5]})


def test_mixing_repeated_rows(spark):
    """A budget that ends among equal rows: whole texts and one cut, and no word of the budget lost."""
    text = " ".join(f"w{i}" for i in range(300))
    rows = [(1, text, "en", "a", 1)] * 1000 + [(2, "x y z", "en", "b", 1)] * 7 + [(3, None, "en", "b", 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(5)
    expected = Counter()
    for e in brute_mix([(r[0], r[1], r[3]) for r in rows]):
        words = (text if e[0] == 1 else "x y z").split()
        if e[5]:
            expected += Counter({(e[0], len(words)): e[5] // len(words), (e[0], e[5] % len(words)): 1 if e[5] % len(words) else 0})
    assert Counter((r["doc_id"], len(r["text"].split())) for r in cp.mix(spark, df, SF).collect()) == expected


def test_first_words(spark):
    """The cut text keeps its blanks and line breaks."""
    texts = ["a b c", "  a\n\nb\t c d ", "\x0ba \x0c b\rc", "é  漢\n字 x\u00a0y z"]
    df = spark.createDataFrame([(t, n) for t in texts for n in (1, 2)], "t string, n int")
    for r in df.withColumn("cut", cp._first_words(F.col("t"), F.col("n"))).collect():
        assert r["t"].startswith(r["cut"]) and r["cut"].encode().split() == r["t"].encode().split()[: r["n"]] and r["cut"].encode()[-1:].strip()


def test_encoding(spark, table):
    texts = {r[0]: r[1] for r in plain(table)}
    for r in cp.encode(spark, table, SF).collect():
        assert r["ids"] == LIBRARY.encode(texts[r["doc_id"]]) and r["n_tokens"] == len(r["ids"])


def test_edge_rows(spark, docs, empty):
    for name, stage in cp.STAGES:
        out = stage(spark, docs, SF)
        if name != "sentencepiece":
            assert out.columns == docs.columns
        assert out.count() > 0
        assert stage(spark, empty, SF).count() == 0


def test_ids_of_other_types(spark, table):
    named = table.withColumn("doc_id", F.format_string("d%06d", "doc_id"))
    for name, stage in cp.STAGES[1:]:
        own, other = stage(spark, table, SF), stage(spark, named, SF)
        kinds = [c for c in own.columns if c != "doc_id"]
        if name != "mixing":  # whose order is that of a hash of the ids
            assert Counter((f"d{r['doc_id']:06d}", *(str(r[c]) for c in kinds)) for r in own.collect()) == Counter((r["doc_id"], *(str(r[c]) for c in kinds)) for r in other.collect())
        else:
            assert other.count() > 0


def test_run(spark, table):
    """All stages against brute force, each on what the ones before it have left, and the library's own ids at the end."""
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    rejected = {r["doc_id"] for r in toxicity.score_toxicity(table, labels).where("rejected").select("row.doc_id").collect()}
    rows = [r for r in plain(table) if r[0] not in rejected]
    kept = {k[0] for k in brute_near([(r[0], r[1]) for r in rows], 5) if k[3]}
    rows = [r for r in rows if r[0] in kept]
    docs = table.where(~F.col("doc_id").isin(list(rejected)) & F.col("doc_id").isin(list(kept)))
    cut = {r["doc_id"]: r["text"] for r in cp.cut_repeated_passages(spark, docs, SF).collect()}
    for e in brute_cut([(r[0], r[1]) for r in rows], 13):
        assert (cut[e[0]] or "").encode().split() == e[4]
    expected, pieces = Counter(), {r[0]: r for r in rows}
    for e in brute_mix([(r[0], cut[r[0]], r[3]) for r in rows]):
        text, words = cut[e[0]], (cut[e[0]] or "").encode().split()
        if e[5]:
            rounds, rest = divmod(e[5], len(words))
            expected[(e[0], pieces[e[0]][3], tuple(LIBRARY.encode(text)))] += rounds
            if rest:
                at = 0
                for w in words[:rest]:
                    at = text.encode().index(w, at) + len(w)
                expected[(e[0], pieces[e[0]][3], tuple(LIBRARY.encode(text.encode()[:at].decode())))] += 1
    assert Counter((r["doc_id"], r["source"], tuple(r["ids"])) for r in cp.run(spark, SF).collect()) == +expected
