"""SentencePiece encoding and decoding by shared-prefix Viterbi.

A text is cut into marked words (a run of blanks and what follows up to the next blank; line feeds
stand alone). The distinct words of a block are sorted, which numbers the nodes of their trie depth
first; a word's nodes up to the common prefix with the word before it are that word's. Each node has a
forward score, and the last piece and its length on the best way there. The nodes of one depth are
worked out together in numpy, each once, however many words share it.

For a unigram vocabulary a way's score is the sum of its pieces' scores. For a BPE vocabulary that sum
does not say what the merges give. There a step from one piece to the next scores 0 if merging the two
pieces' characters leaves just these two, and minus infinity otherwise. A sequence of pieces is what
merging makes of its characters if and only if every piece is what merging makes of its own and all
neighbours are left apart like that: no merge crosses a border between two pieces unless it would
cross it in the pair alone, since a merge is chosen by its own pair's rank. Merging gives one result,
so of all ways to a node exactly one scores 0, and every beginning of it is such a way itself: Viterbi
over these scores finds the merges' result. Both kinds give the ids that the vocabulary's own library
gives. Characters outside the vocabulary become their UTF-8 bytes' pieces.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import textblocks as tb

MODEL_PATH = "/opt/tokenizers/piece_bpe_32k.model"
#: Bytes of whole texts whose words share a trie, and characters beyond which a word is walked by itself.
BLOCK_BYTES, LONG = 1 << 22, 64
#: Pairs of pieces whose fate a Python worker remembers, at most.
PAIRS_KEPT = 1 << 20
_MARK = "▁"


class Vocabulary:
    """Pieces, ids and scores of a model file's bytes; blanks stand for the mark."""

    def __init__(self, model: bytes):
        from sentencepiece import sentencepiece_model_pb2 as pb

        proto = pb.ModelProto()
        proto.ParseFromString(model)
        kinds = pb.ModelProto.SentencePiece
        self.bpe = proto.trainer_spec.model_type == pb.TrainerSpec.BPE
        if not self.bpe and proto.trainer_spec.model_type != pb.TrainerSpec.UNIGRAM:
            raise ValueError("neither a unigram nor a BPE model")
        if proto.normalizer_spec.precompiled_charsmap or proto.normalizer_spec.remove_extra_whitespaces:
            raise ValueError("models that rewrite their input are not supported")
        self.dummy = proto.normalizer_spec.add_dummy_prefix
        self.ids: dict[str, int] = {}
        self.scores: list[float] = []
        self.byte_ids, self.unknown = [-1] * 256, 0
        self.out: list[bytes] = []
        for i, p in enumerate(proto.pieces):
            self.scores.append(p.score)
            surface = b""
            if p.type == kinds.BYTE:
                self.byte_ids[int(p.piece[3:5], 16)] = i
                surface = bytes([int(p.piece[3:5], 16)])
            elif p.type == kinds.UNKNOWN:
                self.unknown, surface = i, " ⁇ ".encode()
            elif p.type != kinds.CONTROL:
                self.ids[p.piece.replace(_MARK, " ")] = i
                surface = p.piece.replace(_MARK, " ").encode()
            self.out.append(surface)
        self.fallback = min(self.byte_ids) >= 0
        self.longest = max(map(len, self.ids), default=1)


class _Table:
    """Numbers from 0 up under non-negative keys, by open addressing; lookups are of whole arrays."""

    def __init__(self, bits: int = 12):
        self.bits, self.size = bits, 0
        self.keys, self.values = np.full(1 << bits, -1, np.int64), np.full(1 << bits, -1, np.int32)

    def _find(self, keys: np.ndarray) -> np.ndarray:
        """The slot that has each key, or the empty one where the search for it ends."""
        mask = (1 << self.bits) - 1
        at = ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)
        have = self.keys[at]
        far = np.flatnonzero((have != keys) & (have >= 0))
        while len(far):
            at[far] = (at[far] + 1) & mask
            have = self.keys[at[far]]
            far = far[(have != keys[far]) & (have >= 0)]
        return at

    def get(self, keys: np.ndarray) -> np.ndarray:
        """The values, -1 for keys that are not there."""
        return self.values[self._find(keys)]  # an empty slot's value is -1

    def add(self, keys: np.ndarray, values: np.ndarray) -> None:
        """Enter distinct keys that are not there yet."""
        self.size += len(keys)
        if 2 * self.size > 1 << self.bits:
            kept = self.keys >= 0
            keys, values = np.concatenate([self.keys[kept], keys]), np.concatenate([self.values[kept], values])
            self.__init__(max(12, int(4 * len(keys)).bit_length()))
            self.size = len(keys)
        left = np.arange(len(keys))
        while len(left):
            at = self._find(keys[left])
            self.keys[at] = keys[left]  # of several that meet in one slot the last stays, the others search on
            won = self.keys[at] == keys[left]
            self.values[at[won]] = values[left[won]]
            left = left[~won]


def _spread(first: np.ndarray, count: np.ndarray) -> np.ndarray:
    """All positions ``first[i]`` to ``first[i] + count[i] - 1``, one after the other."""
    ends = np.cumsum(count)
    return np.repeat(first - (ends - count), count) + np.arange(ends[-1] if len(ends) else 0)


def _ends(count: np.ndarray) -> np.ndarray:
    return np.concatenate([[0], np.cumsum(count)]).astype(np.int64)


class Encoder:
    """Encodes and decodes; remembers pairs of pieces within a fixed bound."""

    def __init__(self, model: bytes):
        self.v = v = Vocabulary(model)
        self.surface = [""] * len(v.scores)
        for piece, i in v.ids.items():
            self.surface[i] = piece
        self.scores = np.array(v.scores, np.float64)
        self.unknown_score = min((v.scores[i] for i in v.ids.values()), default=0.0) - 10.0
        self.byte_ids = np.array(v.byte_ids, np.int32)
        self.out, self.out_first = np.frombuffer(b"".join(v.out), np.uint8), _ends(np.array([len(x) for x in v.out]))
        # pieces that merging makes of their own characters: the others never end a BPE encoding
        whole = {p: i for p, i in v.ids.items() if not v.bpe or self.merged(p) == [p]}
        alphabet = sorted({c for p in whole for c in p})
        self.letter = np.full(0x110000, -1, np.int32)
        self.letter[[ord(c) for c in alphabet]] = np.arange(len(alphabet))
        self.letters = max(1, len(alphabet))
        # ends of pieces as a trie from the last character to the first; ``piece`` has a node's id if it is a piece
        nodes, piece, keys, values = {"": 0}, [-1], [], []
        for p, i in whole.items():
            for k in range(len(p) - 1, -1, -1):
                if p[k:] not in nodes:
                    keys.append(nodes[p[k + 1 :]] * self.letters + int(self.letter[ord(p[k])]))
                    values.append(len(piece))
                    nodes[p[k:]] = len(piece)
                    piece.append(-1)
            piece[nodes[p]] = i
        self.piece, self.steps, self.pairs = np.array(piece, np.int32), _Table(), _Table()
        self.steps.add(np.array(keys, np.int64), np.array(values, np.int32))

    def merged(self, text: str) -> list[str]:
        """What merging leaves: again and again the adjacent pair with the best score, the first of equals."""
        ids, scores = self.v.ids, self.v.scores
        parts = list(text)
        while len(parts) > 1:
            best, at = None, -1
            for i in range(len(parts) - 1):
                found = ids.get(parts[i] + parts[i + 1])
                if found is not None and (best is None or scores[found] > best):
                    best, at = scores[found], i
            if best is None:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def _apart(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Whether merging the characters of the two pieces leaves just these two."""
        keys = left.astype(np.int64) * len(self.surface) + right
        known = self.pairs.get(keys)
        new = np.unique(keys[known < 0])
        if len(new):
            fate = []
            for a, b in zip(*(x.tolist() for x in np.divmod(new, len(self.surface))), strict=True):
                parts = [self.surface[a], self.surface[b]]
                fate.append(self.merged("".join(parts)) == parts)
            fate = np.array(fate, np.int32)
            known[known < 0] = fate[np.searchsorted(new, keys[known < 0])]
            if self.pairs.size + len(new) > PAIRS_KEPT:
                self.pairs = _Table()
            if len(new) <= PAIRS_KEPT:
                self.pairs.add(new, fate)
        return known > 0

    def _best(self, letters: np.ndarray, at: np.ndarray, state: np.ndarray, depth: int, forward: tuple[np.ndarray, ...]) -> tuple[np.ndarray, ...]:
        """Last piece (-1 for an unknown character), its length and the score of nodes of one depth.

        ``at`` is where a node's word has its first letter, ``state`` where it has its first forward state.
        """
        last, _, score = forward
        node, alive, found = np.zeros(len(at), np.int64), np.arange(len(at)), []
        for k in range(1, min(depth, self.v.longest) + 1):
            letter = letters[at[alive] + (depth - k)]
            fine = letter >= 0
            if not fine.all():
                alive, node, letter = alive[fine], node[fine], letter[fine]
            node = self.steps.get(node * self.letters + letter).astype(np.int64)
            fine = node >= 0  # otherwise no piece ends like this, so none that begins further left does
            alive, node = alive[fine], node[fine]
            if not len(alive):
                break
            piece = self.piece[node]
            hit = piece >= 0
            found.append((k, alive[hit], piece[hit]))
        best, length = np.full(len(at), -1, np.int32), np.ones(len(at), np.int32)
        total = score[state + depth - 1] + (0.0 if self.v.bpe else self.unknown_score)
        for k, rows, piece in reversed(found):  # the longest first
            before = state[rows] + (depth - k)
            if self.v.bpe:
                open_ = best[rows] < 0
                rows, piece, left = rows[open_], piece[open_], last[before[open_]]
                good = left < 0
                good[~good] = self._apart(left[~good], piece[~good])
            else:
                ways = score[before] + self.scores[piece]
                good = ways > total[rows]
                total[rows[good]] = ways[good]
            best[rows[good]], length[rows[good]] = piece[good], k
        return best, length, total

    def _walk(self, codes: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Pieces of sorted distinct words (code points, and where each word's begin), and where each word's begin.

        An unknown character is the negative of one plus its place in ``codes``.
        """
        size = np.diff(first)
        n, deepest = len(size), int(size.max(initial=0))
        common, rows = np.zeros(n, np.int32), np.arange(1, n)
        for d in range(deepest):
            rows = rows[(size[rows] > d) & (size[rows - 1] > d)]
            rows = rows[codes[first[rows] + d] == codes[first[rows - 1] + d]]
            common[rows] += 1
        letters, state = self.letter[codes], first[:-1] + np.arange(n)
        forward = (np.full(len(codes) + n, -1, np.int32), np.ones(len(codes) + n, np.int32), np.zeros(len(codes) + n))
        rows = np.arange(n)
        for d in range(1, deepest + 1):
            rows = rows[size[rows] >= d]
            new = common[rows] < d
            own, node = rows[new], np.cumsum(new) - 1
            for to, value in zip(forward, self._best(letters, first[own], state[own], d, forward), strict=True):
                to[state[rows] + d] = value[node]
        rows, end, back = np.arange(n), size.copy(), []
        while len(rows := rows[end[rows] > 0]):
            at = state[rows] + end[rows]
            end[rows] -= forward[1][at]
            back.append((rows, np.where(forward[0][at] < 0, -1 - (first[rows] + end[rows]), forward[0][at])))
        count = np.zeros(n, np.int64)
        for rows, _ in back:
            count[rows] += 1
        begin = _ends(count)
        pieces, left = np.empty(begin[-1], np.int64), begin[1:].copy()
        for rows, piece in back:
            left[rows] -= 1
            pieces[left[rows]] = piece
        return pieces, begin

    def _long(self, codes: np.ndarray) -> np.ndarray:
        """Pieces of one long word, with a score for each of its characters; as :meth:`_walk` has them."""
        text = codes.astype("<u4").tobytes().decode("utf-32-le")
        ids, pairs, v = self.v.ids, {}, self.v
        states: list[tuple[int, int, float]] = [(0, -1, 0.0)]
        for end in range(1, len(text) + 1):
            best = (end - 1, -1, states[end - 1][2] + (0.0 if v.bpe else self.unknown_score))
            for start in range(max(0, end - v.longest), end):
                i = ids.get(text[start:end])
                if i is None:
                    continue
                if v.bpe:
                    left = states[start][1]
                    key = (left, i)
                    if key not in pairs:
                        pairs[key] = self.merged(self.surface[i]) == [self.surface[i]] and (left < 0 or self.merged(self.surface[left] + self.surface[i]) == [self.surface[left], self.surface[i]])
                    if pairs[key]:
                        best = (start, i, 0.0)
                        break
                elif (score := states[start][2] + v.scores[i]) > best[2]:
                    best = (start, i, score)
            states.append(best)
        out, end = [], len(text)
        while end:
            start, i, _ = states[end]
            out.append(i if i >= 0 else -1 - start)
            end = start
        return np.array(out[::-1], np.int64)

    def _word_ids(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of distinct words, and where each word's begin."""
        order = pc.array_sort_indices(words)
        ranked = words.take(order)
        raw, _ = tb.offsets(ranked)
        codes = np.frombuffer(raw.tobytes().decode().encode("utf-32-le"), "<u4").astype(np.int64)
        size = pc.utf8_length(ranked).to_numpy().astype(np.int64)
        first = _ends(size)
        short = size <= LONG
        at = _spread(first[:-1][short], size[short])
        pieces, begin = self._walk(codes[at], _ends(size[short]))
        strange = pieces < 0
        pieces[strange] = -1 - at[-1 - pieces[strange]]
        count = np.zeros(len(size), np.int64)
        count[short] = np.diff(begin)
        longer = {int(r): self._long(codes[first[r] : first[r + 1]]) for r in np.flatnonzero(~short)}
        for r, own in longer.items():
            count[r] = len(own)
            own[own < 0] -= first[r]
        begin, own_first = _ends(count), begin
        every = np.empty(begin[-1], np.int64)
        every[_spread(begin[:-1][short], count[short])] = pieces
        for r, own in longer.items():
            every[begin[r] : begin[r + 1]] = own
        # unknown characters as the pieces of their bytes
        strange = np.flatnonzero(every < 0)
        if len(strange):
            place = -1 - every[strange]
            if self.v.fallback:
                code_bytes = 1 + (codes >= 0x80).astype(np.int64) + (codes >= 0x800) + (codes >= 0x10000)
                byte_at = _ends(code_bytes)
                width = np.ones(len(every), np.int64)
                width[strange] = code_bytes[place]
                wide = _ends(width)
                out = np.empty(wide[-1], np.int64)
                plain = every >= 0
                out[wide[:-1][plain]] = every[plain]
                out[_spread(wide[:-1][strange], width[strange])] = self.byte_ids[raw[_spread(byte_at[place], width[strange])]]
                every, begin = out, wide[begin]
            else:
                every[strange] = self.v.unknown
        rank = np.empty(len(words), np.int64)
        rank[order.to_numpy()] = np.arange(len(words))
        count = np.diff(begin)[rank]
        return every[_spread(begin[:-1][rank], count)].astype(np.int32), _ends(count)

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all the texts, and where each text's begin; null and empty texts have none."""
        texts = pc.replace_substring(texts.cast(pa.large_string()), _MARK, " ")
        if self.v.dummy:
            blank, none = pa.scalar(" ", pa.large_string()), pa.scalar("", pa.large_string())
            texts = pc.if_else(pc.equal(texts, none), none, pc.binary_join_element_wise(blank, texts, none))
        raw, at = tb.offsets(texts)
        if not len(raw):
            return np.zeros(0, np.int32), np.zeros(len(texts) + 1, np.int64)
        begins, blank, line = np.zeros(len(raw), bool), raw == 0x20, raw == 0x0A
        begins[at[:-1][np.diff(at) > 0]] = True
        begins[1:] |= (blank[1:] & ~blank[:-1]) | (line[:-1] & ~blank[1:])
        begins |= line
        starts = np.flatnonzero(begins)
        units = pa.LargeStringArray.from_buffers(len(starts), pa.py_buffer(np.append(starts, len(raw)).astype(np.int64)), pa.py_buffer(raw.tobytes()))
        coded = units.dictionary_encode()
        ids, first = self._word_ids(coded.dictionary)
        which = coded.indices.to_numpy()
        count = np.diff(first)[which]
        total = _ends(count)
        return ids[_spread(first[:-1][which], count)], total[np.searchsorted(starts, at)]

    def decode(self, ids: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """UTF-8 bytes of the ids of several texts, and where each text's begin.

        A text's bytes are those of its pieces, byte pieces as they are, without the blank that encoding put in front.
        """
        size = np.diff(self.out_first)[ids]
        total = _ends(size)
        raw = self.out[_spread(self.out_first[ids], size)]
        first = total[first]
        if self.v.dummy and len(raw):
            some = first[:-1][np.diff(first) > 0]
            gone = some[raw[some] == 0x20]
            keep = np.ones(len(raw), bool)
            keep[gone] = False
            raw, first = raw[keep], first - np.searchsorted(gone, first)
        return raw, first


_ENCODERS: dict[bytes, Encoder] = {}


def encoder(model: bytes) -> Encoder:
    """One encoder for each model and Python process."""
    key = hashlib.sha256(model).digest()
    if key not in _ENCODERS:
        _ENCODERS[key] = Encoder(model)
    return _ENCODERS[key]


def load_model(path: str = MODEL_PATH) -> bytes:
    """The model file's bytes, read on the driver; they travel with the functions below."""
    with open(path, "rb") as f:
        return f.read()


def _encoded(e: Encoder, texts: pa.Array) -> pa.ListArray:
    ids, first = e.encode(texts)
    mask = pc.is_null(texts) if texts.null_count else None
    return pa.ListArray.from_arrays(pa.array(first.astype(np.int32)), pa.array(ids), mask=mask)


def encode(model: bytes, text: Column) -> Column:
    """``array<int>`` of each whole text's ids; null for null."""

    @F.arrow_udf("array<int>")
    def run(texts: pa.Array) -> pa.Array:
        batch, e = pa.RecordBatch.from_arrays([texts], names=["t"]), encoder(model)
        found = [_encoded(e, block.column("t")) for block in tb.blocks(batch, "t", BLOCK_BYTES)]
        return pa.concat_arrays(found) if found else pa.array([], pa.list_(pa.int32()))

    return run(text)


def _texts(raw: np.ndarray, first: np.ndarray) -> list[str]:
    data = raw.tobytes()
    return [data[a:b].decode("utf-8", "replace") for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True)]


def decode(model: bytes, ids: Column) -> Column:
    """The text of an ``array<int>`` of ids; null for null. Bytes that are no UTF-8 become U+FFFD."""

    @F.arrow_udf("string")
    def run(rows: pa.Array) -> pa.Array:
        found = _texts(*encoder(model).decode(rows.flatten().to_numpy(), _ends(pc.fill_null(pc.list_value_length(rows), 0).to_numpy())))
        return pa.array([t if valid else None for t, valid in zip(found, rows.is_valid().to_pylist(), strict=True)], pa.string())

    return run(ids)


def tokens_digest(model: bytes, text: Column) -> Column:
    """Number of ids, SHA-256 of their 32-bit little-endian forms, and whether they decode to the text.

    Null counts as the empty text here.
    """

    @F.arrow_udf("struct<n_tokens:bigint,ids_sha256:string,round_trip:boolean>")
    def run(texts: pa.Array) -> pa.Array:
        batch, e = pa.RecordBatch.from_arrays([texts], names=["t"]), encoder(model)
        counts, digests, exact = [], [], []
        for block in tb.blocks(batch, "t", BLOCK_BYTES):
            own = block.column("t")
            ids, first = e.encode(own)
            data, (back, ends), (plain, at) = ids.astype("<i4").tobytes(), e.decode(ids, first), tb.offsets(own)
            counts += np.diff(first).tolist()
            digests += [hashlib.sha256(data[4 * a : 4 * b]).hexdigest() for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True)]
            exact += [np.array_equal(back[a:b], plain[c:d]) for a, b, c, d in zip(*(x.tolist() for x in (ends[:-1], ends[1:], at[:-1], at[1:])), strict=True)]
        return pa.StructArray.from_arrays([pa.array(counts, pa.int64()), pa.array(digests, pa.string()), pa.array(exact, pa.bool_())], ["n_tokens", "ids_sha256", "round_trip"])

    return run(text)


def encode_documents(docs: DataFrame, text_col: str = "text", model_path: str = MODEL_PATH) -> DataFrame:
    """All rows and columns of ``docs`` in a struct ``row``, with ``ids`` and ``n_tokens`` (0 for null).

    A null text has null ids, an empty one none. Texts and words of any length are encoded whole.
    Repeated rows and null ids of documents are rows like any other; extra columns stay in ``row``. An
    empty table gives an empty result. ``model_path`` is read on the driver alone.
    """
    out = docs.select(F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("row"))
    out = out.withColumn("ids", encode(load_model(model_path), F.col("row").getField(text_col)))
    return out.withColumn("n_tokens", F.coalesce(F.size("ids"), F.lit(0)).cast("long"))
