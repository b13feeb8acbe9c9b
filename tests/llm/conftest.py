import random

import pytest

SF = "/root/testdata/sf0.001"
WORDS = [f"w{i}" for i in range(400)]


def near(rng, words, edits):
    out = list(words)
    for _ in range(edits):
        out[rng.randrange(len(out))] = f"x{rng.randrange(10**9)}"
    return out


@pytest.fixture(scope="session")
def rows():
    """Documents with nulls, blanks, short and very long texts, equal and near copies and repeated rows."""
    rng = random.Random(7)
    base = [rng.choices(WORDS, k=rng.randrange(30, 120)) for _ in range(25)]
    texts = [" ".join(b) for b in base] + [" ".join(near(rng, base[i % 5], rng.randrange(1, 6))) for i in range(60)]
    texts += [texts[0]] * 6 + [texts[3]] * 2
    texts += [" ".join(rng.choices(WORDS, k=20) + base[7][:25] + rng.choices(WORDS, k=20)) for _ in range(10)]  # a shared passage
    texts += [None, "", "   \n\t ", "one", "one", "One two", "a b c", "ONE", "é à b", "w1 w2 w3 w4", "W1 w2 w3 w4"]
    texts += [" ".join(rng.choices(WORDS, k=20_000)), "z" * 300_000]
    out = [(100 + i, t, ("en", "de", None)[i % 3], ("a", "b", None, "c")[i % 4], len(t or "")) for i, t in enumerate(texts)]
    rng.shuffle(out)
    out.append(out[5])  # a row twice
    out.append((out[9][0], "another text under an id that is there already " * 3, "en", "a", 10))
    out += [(None, texts[0], "en", "a", 1), (None, "no id here at all but words enough to count " * 2, None, None, 1)]
    return out


@pytest.fixture(scope="session")
def docs(spark, rows):
    """The rows, with extra columns whose names clash with what operators use inside."""
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(3)
    for name in ("id", "row", "h", "h1", "ord", "key", "n", "copy", "size", "taken", "score", "rest", "kept", "part"):
        from pyspark.sql import functions as F

        df = df.withColumn(name, F.lit("extra"))
    return df


@pytest.fixture(scope="session")
def empty(docs):
    return docs.where("false")


def components(nodes, pairs):
    parent = {n: n for n in nodes}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in pairs:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    return {n: root(n) for n in nodes}
