import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from voxloom.llm import textblocks as tb

TEXTS = st.lists(st.one_of(st.none(), st.text(alphabet="ab \n\té漢.A", max_size=40)), max_size=12)


@settings(max_examples=60, deadline=None)
@given(TEXTS)
def test_words_and_hashes(texts):
    w = tb.words(pa.array(texts, pa.string()))
    plain = [(t or "").encode().split() for t in texts]
    assert w.counts.tolist() == [len(p) for p in plain]
    flat = [x for p in plain for x in p]
    assert [bytes(w.raw[a:b]) for a, b in zip(w.starts, w.ends)] == flat
    h = tb.word_hashes(w).tolist()
    assert all((h[i] == h[j]) == (flat[i] == flat[j]) for i in range(len(h)) for j in range(i))
    low = tb.word_hashes(w, lower=True).tolist()
    assert all((low[i] == low[j]) == (flat[i].lower() == flat[j].lower()) for i in range(len(h)) for j in range(i))


def test_slices_of_batches_and_long_texts():
    texts = ["a b", None, "c" * 3_000_000 + " d", "", "e f g"]
    batch = pa.RecordBatch.from_arrays([pa.array(texts)], names=["t"]).slice(1)
    parts = [b.column("t").to_pylist() for b in tb.blocks(batch, "t", 10)]
    assert [t for p in parts for t in p] == texts[1:]
    w = tb.words(batch.column("t"))
    assert w.counts.tolist() == [0, 2, 0, 3]
    alone = tb.word_hashes(tb.words(pa.array(["c" * 3_000_000])))
    assert tb.word_hashes(w)[0] == alone[0]


def thue_morse(a, b, n=1024):
    """A word and its complement, which polynomial hashes modulo a power of two don't tell apart."""
    bits = [bin(i).count("1") % 2 for i in range(n)]
    return "".join((a, b)[x] for x in bits), "".join((b, a)[x] for x in bits)


def test_regular_words_differ():
    for a, b in (("a", "b"), ("ab", "ba"), ("abcdefgh", "ABCDEFGH")):
        for n in (8, 16, 64, 1024, 4096):
            w = tb.words(pa.array(thue_morse(a, b, n)))
            for kind in (1, 2):
                h = tb.word_hashes(w, kind=kind)
                assert h[0] != h[1]
    words = [x * n for x in ("a", "\x01", "z") for n in range(1, 400)]
    assert len(set(tb.word_hashes(tb.words(pa.array([" ".join(words)]))).tolist())) == len(words)
    one, two = (tb.word_hashes(tb.words(pa.array([" ".join(words)])), kind=k) for k in (1, 2))
    assert not set(one.tolist()) & set(two.tolist())


def test_windows():
    w = tb.words(pa.array(["a b c a b c d", "b c a"]))
    h = tb.window_hashes(tb.word_hashes(w), 3)
    assert h[0] == h[3] and h[1] == h[7] and len(set(h.tolist())) == 6
    assert tb.inside_text(w, 3).tolist() == [True] * 5 + [False, False, True]
    assert tb.sliding_min(np.array([5, 3, 8, 1, 9, 2], np.uint64), 3).tolist() == [3, 1, 1, 1]
    assert len(tb.window_hashes(tb.word_hashes(w)[:2], 3)) == 0
