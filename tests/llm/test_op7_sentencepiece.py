import random

import numpy as np
import pyarrow as pa
import pytest
import sentencepiece as library
from hypothesis import given, settings
from hypothesis import strategies as st

from tests.llm.conftest import SF
from voxloom.llm import sentencepiece as own

MODEL = own.load_model()
LIBRARY = library.SentencePieceProcessor(model_file=own.MODEL_PATH)
ODD = ["", " ", "  ", "a  b", "   lead", "trail   ", "\n\n x", "a\tb\r\n  c", "ﬁne 漢字かな 🙂 עברית", "\0x", "    \n        y", "a" + " " * 40 + "b", "a" * 40, "!!!!????", "0000011111", "= == === ===="]


def encoded(e, texts):
    ids, first = e.encode(pa.array(texts, pa.string()))
    assert len(first) == len(texts) + 1
    return [ids[a:b].tolist() for a, b in zip(first, first[1:])]


def decoded(e, rows):
    return own._texts(*e.decode(np.concatenate([np.array(r, np.int32) for r in rows]), np.cumsum([0, *map(len, rows)])))


def test_as_the_library():
    e = own.Encoder(MODEL)
    assert encoded(e, ODD) == [LIBRARY.encode(t) for t in ODD]
    assert decoded(e, encoded(e, ODD)) == ODD
    assert encoded(e, ["▁x"]) == [LIBRARY.encode("▁x")]
    assert encoded(e, [None, "a", "", None]) == [[], LIBRARY.encode("a"), [], []]
    assert encoded(e, []) == [] and encoded(e, [None]) == [[]]
    assert decoded(e, [[e.v.byte_ids[0xC3]], [], [e.v.byte_ids[0xA9]]]) == ["\ufffd", "", "\ufffd"]


@pytest.mark.parametrize("long", [1, 4, 10**6])
def test_long_words_as_short_ones(monkeypatch, long):
    """Words beyond LONG are walked alone, with the same result."""
    monkeypatch.setattr(own, "LONG", long)
    rng = random.Random(5)
    texts = ODD + ["".join(rng.choices("abcdehilnorst é漢🙂\n", k=rng.randrange(300))) for _ in range(60)] + ["x" * 700 + "thing" * 90]
    assert encoded(own.encoder(MODEL), texts) == [LIBRARY.encode(t) for t in texts]


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet=st.sampled_from(list("ab thein\n.,é漢 ")), max_size=60))
def test_any_text(text):
    e = own.encoder(MODEL)
    assert encoded(e, [text]) == [LIBRARY.encode(text)] and decoded(e, encoded(e, [text])) == [text]


def test_memory_bounds_change_nothing(monkeypatch):
    rng = random.Random(1)
    texts = [" ".join("".join(rng.choices("abcdehilnorst", k=rng.randrange(1, 12))) for _ in range(50)) for _ in range(20)]
    monkeypatch.setattr(own, "PAIRS_KEPT", 50)
    e = own.Encoder(MODEL)
    assert [encoded(e, [t])[0] for t in texts] == [LIBRARY.encode(t) for t in texts]
    assert e.pairs.size <= 50


def test_shared_prefixes_are_worked_out_once(monkeypatch):
    e, nodes = own.Encoder(MODEL), []
    real = e._best
    monkeypatch.setattr(e, "_best", lambda letters, at, *rest: nodes.append(len(at)) or real(letters, at, *rest))
    encoded(e, ["thing things think thinking things"])
    assert sum(nodes) == 6 + 1 + 1 + 3


def test_table_of_numbers():
    rng, table, known = np.random.default_rng(3), own._Table(4), {}
    for _ in range(30):
        keys = np.setdiff1d(rng.integers(0, 2**40, 200), list(known))
        values = rng.integers(0, 1000, len(keys)).astype(np.int32)
        table.add(keys, values)
        known.update(zip(keys.tolist(), values.tolist()))
        asked = np.concatenate([list(known), rng.integers(2**41, 2**42, 50)]).astype(np.int64)
        assert table.get(asked).tolist() == [known.get(k, -1) for k in asked.tolist()]


def test_unigram_viterbi_is_the_best_segmentation(monkeypatch):
    from sentencepiece import sentencepiece_model_pb2 as pb

    proto = pb.ModelProto()
    rng = random.Random(2)
    proto.trainer_spec.model_type = pb.TrainerSpec.UNIGRAM
    proto.normalizer_spec.add_dummy_prefix, proto.normalizer_spec.remove_extra_whitespaces = True, False
    proto.pieces.add(piece="<unk>", score=0.0, type=pb.ModelProto.SentencePiece.UNKNOWN)
    for p in ["▁", "a", "b", "c", "ab", "bc", "abc", "▁a", "▁ab", "ca", "cab", "aa"]:
        proto.pieces.add(piece=p, score=-rng.random() * 5 - 1)
    e = own.Encoder(proto.SerializeToString())
    score = {p.piece.replace("▁", " "): p.score for p in proto.pieces[1:]}

    def best(t):
        return max((score[t[:k]] + best(t[k:]) for k in range(1, len(t) + 1) if t[:k] in score), default=-1e9) if t else 0.0

    for _ in range(40):
        word = "".join(rng.choices("abc", k=rng.randrange(1, 9)))
        monkeypatch.setattr(own, "LONG", rng.choice([2, 64]))
        ids = encoded(e, [word])[0]
        assert sum(e.v.scores[i] for i in ids) == pytest.approx(best(" " + word)) and decoded(e, [ids]) == [word]


def test_query(spark, docs, empty):
    df = docs.select("text", own.tokens_digest(MODEL, docs["text"]).alias("d"), own.encode(MODEL, docs["text"]).alias("ids"))
    for r in df.collect():
        assert (r["ids"] is None) == (r["text"] is None) and r["d"]["n_tokens"] == len(r["ids"] or []) and r["d"]["round_trip"]
    back = df.where("text is not null").select("text", own.decode(MODEL, df["ids"]).alias("back"))
    assert back.where("text <> back").count() == 0
    assert own.encode_documents(empty).count() == 0 and own.encode_documents(docs).select("row.*").columns == docs.columns


def test_table(spark):
    texts = [r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    assert encoded(own.Encoder(MODEL), texts) == [LIBRARY.encode(t or "") for t in texts]
