"""Unigram encoding and decoding with a sentence-piece vocabulary.

The pieces and their log scores come from a model file (a parameter; nothing is trained).  They
are laid out in a double-array trie over UTF-8 bytes: the child of state s for byte b is
``base[s] + b + 1`` if ``check`` there is s.  A text is marked (a space becomes U+2581, one goes
before the text), and Viterbi finds the segmentation of the largest summed score; of equal
ones the longest last piece wins.  A character that no piece starts with alone may become its
bytes, at a score below every piece.  No piece has a marker after another character, so texts
are cut before markers without changing the best path, and words are looked up once.

Decoding joins pieces and bytes, turns markers into spaces and drops the first.  It gives the
text back exactly but for U+2581 itself, which reads as a space, and invalid byte runs, which
read as U+FFFD.  Null and empty texts: no ids; no ids: empty text.  Null ids: skipped.
"""

from __future__ import annotations

import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidings.llm.common import read

MODEL = "piece_bpe_32k.model"
MARK = "▁"
UNKNOWN_PENALTY = 10.0
_CACHE = 600_000
_CHUNK = re.compile(f"{MARK}+[^{MARK}]*|[^{MARK}]+")


class Pieces:
    """The pieces of a model file: texts, scores, byte pieces."""

    def __init__(self, path: str):
        import sentencepiece

        m = sentencepiece.SentencePieceProcessor(model_file=path)
        n = m.get_piece_size()
        self.text = [m.id_to_piece(i) for i in range(n)]
        self.score = [m.get_score(i) for i in range(n)]
        self.byte = {i: int(self.text[i][3:5], 16) for i in range(n) if m.is_byte(i)}
        self.silent = {i for i in range(n) if m.is_control(i) or m.is_unknown(i)}
        self.normal = [i for i in range(n) if i not in self.byte and i not in self.silent and not m.is_unused(i)]


class Trie:
    """Double-array trie: lists base, check and value (a piece's id, or -1)."""

    def __init__(self, keys: list[tuple[bytes, int]]):
        keys = sorted(keys)
        self.base, self.check, self.value = [0], [0], [-1]
        self.room(512)
        free, hint = 257, 0  # no slot below can be left of every code
        todo = [(0, 0, len(keys), 0)]  # state, keys from, to, depth
        while todo:
            state, s, e, depth = todo.pop()
            if s < e and len(keys[s][0]) == depth:
                self.value[state] = keys[s][1]
                s += 1
            if s == e:
                continue
            starts = [i for i in range(s, e) if i == s or keys[i][0][depth] != keys[i - 1][0][depth]]
            codes = [keys[i][0][depth] + 1 for i in starts]
            at = hint
            if len(codes) == 1:  # fills single gaps
                while self.check[free] >= 0:
                    free += 1
                    self.room(free)
                at = max(free - codes[0], 0)
            tries = 0
            while True:
                self.room(at + codes[-1])
                if all(self.check[at + c] < 0 for c in codes):
                    break
                at += 1
                tries += 1
            if len(codes) > 1 and tries > 32:  # crowded up to here
                hint = at
            self.base[state] = at
            for c in codes:
                self.check[at + c] = state
            for c, i, j in zip(codes, starts, starts[1:] + [e]):
                todo.append((at + c, i, j, depth + 1))

    def room(self, n: int) -> None:
        more = n + 258 - len(self.check)
        if more > 0:
            self.base += [0] * more
            self.check += [-1] * more
            self.value += [-1] * more


class Unigram:
    """Encoder and decoder of one vocabulary; small enough to be sent to every task."""

    def __init__(self, pieces: Pieces):
        self.trie = Trie([(pieces.text[i].encode(), i) for i in pieces.normal])
        self.score = pieces.score
        self.unknown = min(pieces.score[i] for i in pieces.normal) - UNKNOWN_PENALTY
        by_value = {b: i for i, b in pieces.byte.items()}
        self.bytes = [by_value[b] for b in range(256)]
        self.out = [bytes([pieces.byte[i]]) if i in pieces.byte else b"" if i in pieces.silent else t.encode()
                    for i, t in enumerate(pieces.text)]
        self.cuts = not any(MARK in pieces.text[i].lstrip(MARK) for i in pieces.normal)

    def viterbi(self, data: bytes) -> list[int]:
        base, check, value, score = self.trie.base, self.trie.check, self.trie.value, self.score
        n = len(data)
        best, back = [None] * (n + 1), [None] * (n + 1)
        best[0] = 0.0
        i = 0
        while i < n:
            b = data[i]
            width = 1 if b < 128 else 2 if b < 224 else 3 if b < 240 else 4
            here, state, j, single = best[i], 0, i, False
            if here is not None:
                while j < n:
                    t = base[state] + data[j] + 1
                    if check[t] != state:
                        break
                    state = t
                    j += 1
                    v = value[state]
                    if v >= 0:
                        s = here + score[v]
                        if best[j] is None or s > best[j]:
                            best[j], back[j] = s, (i, v)
                        single = single or j == i + width
                if not single:
                    j, s = i + width, here + self.unknown
                    if best[j] is None or s > best[j]:
                        best[j], back[j] = s, (i, -1)
            i += width
        ids, j = [], n
        while j > 0:
            i, v = back[j]
            if v >= 0:
                ids.append(v)
            else:
                ids.extend(self.bytes[b] for b in reversed(data[i:j]))
            j = i
        ids.reverse()
        return ids

    def encode(self, text: str, known: dict) -> np.ndarray:
        if not text:
            return np.empty(0, np.int32)
        marked = MARK + text.replace(" ", MARK)
        parts = _CHUNK.findall(marked) if self.cuts else [marked]
        return np.frombuffer(b"".join([known[p] for p in parts]), np.int32)

    def decode(self, ids) -> str:
        out = self.out
        text = b"".join([out[i] for i in ids if i is not None]).decode("utf-8", "replace").replace(MARK, " ")
        return text[1:] if text.startswith(" ") else text


class _Known(dict):
    """marked word -> its ids as bytes."""

    def __init__(self, model: Unigram):
        super().__init__()
        self.model = model

    def __missing__(self, part):
        if len(self) > _CACHE:
            self.clear()
        ids = self[part] = np.array(self.model.viterbi(part.encode("utf-8", "replace")), np.int32).tobytes()
        return ids


def load(path: str | None = None) -> Unigram:
    import public_tokenizers

    return Unigram(Pieces(path or public_tokenizers.path(MODEL)))


def _per_task(model: Unigram):
    """The words known so far; made anew in every task, shared by its batches."""
    held = {}

    def known() -> _Known:
        if "k" not in held:
            held["k"] = _Known(model)
        return held["k"]

    return known


def encode(text_col, model: Unigram):
    """Ids of a text column."""
    known = _per_task(model)

    def of(texts: pa.Array) -> pa.Array:
        k = known()
        ids = [model.encode(t.as_py() or "", k) for t in texts]
        offsets = np.concatenate([[0], np.cumsum([len(x) for x in ids])]).astype(np.int32)
        values = np.concatenate(ids) if ids else np.empty(0, np.int32)
        return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values))

    return F.arrow_udf(of, "array<int>")(text_col)


def decode(ids_col, model: Unigram):
    """Text of an ids column."""
    return F.arrow_udf(lambda ids: pa.array([model.decode(x.values.to_pylist() if x.is_valid else []) for x in ids], pa.string()),
                       "string")(ids_col)


def round_trip(text_col, model: Unigram):
    """``n_ids, ids_crc32, decoded`` of a text column: encoded and decoded in one pass, row by row."""
    known = _per_task(model)

    def of(texts: pa.Array) -> pa.Array:
        k, n, crc, back = known(), [], [], []
        for t in texts:
            ids = model.encode(t.as_py() or "", k)
            n.append(len(ids))
            crc.append(zlib.crc32(ids.astype("<u4").tobytes()))
            back.append(model.decode(ids.tolist()))
        return pa.StructArray.from_arrays([pa.array(n, pa.int64()), pa.array(crc, pa.int64()), pa.array(back, pa.string())],
                                          names=["n_ids", "ids_crc32", "decoded"])

    return F.arrow_udf(of, "n_ids long, ids_crc32 long, decoded string")(text_col)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every document and what they decode to."""
    docs = read(spark, sf_dir, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    whole = docs.withColumn("r", round_trip(F.col("text"), load()))
    return whole.select("doc_id", "r.n_ids", "r.ids_crc32", F.sha2(F.encode("r.decoded", "UTF-8"), 256).alias("decoded_sha256"),
                        (F.col("r.decoded") == F.replace(F.col("text"), F.lit(MARK), F.lit(" "))).alias("exact"))
