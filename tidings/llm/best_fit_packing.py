"""Best-fit packing by exact-complement hashing.

Every document becomes token ids and a closing id 0; pieces of at most ``capacity`` ids are
packed into sequences of ``capacity`` ids.  What matters for packing is only how many pieces
there are of each length, so Spark counts lengths (at most ``capacity`` rows, whatever the
input) and the plan is made on that histogram:

* the longest length left opens a sequence; its gap is looked up among the lengths that are
  left as a single length, as the sum of a pair and as the sum of a triple (an index of pair
  sums is kept up to date while lengths run out);
* a combination that fills the gap exactly is consumed as often as the counts allow at once;
* where none does, the best-fitting (longest) length that still fits goes in and the remaining
  gap is looked up again.

The plan is a list of patterns with a number of uses each.  Pieces get their rank within their
length (counted per bucket, so a hot length is split) and a rank decides pattern, sequence and
place.  Repeated rows, ties: equal lengths are interchangeable, each row is packed once.  Null
text: packed as an empty one (the closing id alone).  A long text is cut into pieces of the capacity, the last may be
shorter.  Empty table: no rows.
"""

from __future__ import annotations

import json
import re
import struct
import unicodedata
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidings.llm.common import Table, batches, id_type, keyed, read

CAPACITY = 2048
TOKENIZER = "word_bpe_49k.json"
_CACHE = 500_000
ROWS_PER_BUCKET = 500_000

# How a vocabulary must cut texts for words to be looked up one by one.
_NORMALIZER = {"type": "Sequence", "normalizers": [
    {"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]}
_PRE_TOKENIZER = {"type": "Sequence", "pretokenizers": [
    {"type": "Split", "pattern": {"Regex": "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"}, "behavior": "Removed", "invert": True},
    {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}]}

# Characters below U+0250 that normal forms leave alone and that change case one by one.  Texts
# of these are cut into the tokenizer's words here, so that each word is looked up once; other
# texts, those that hold the start of a special token, and all texts where the vocabulary has other
# rules than those above, go through the tokenizer whole.
_EDGE = 0x250
_OTHER = re.compile(f"[^\\t\\n\\r -~\u00a1-{chr(_EDGE - 1)}]|\u0130|<\\|")
_CLASS = {k: "".join(re.escape(chr(c)) for c in range(_EDGE) if unicodedata.category(chr(c))[0] == k) for k in "LN"}
# the tokenizer's own pattern of words
_WORDS = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{_CLASS['L']}]+|[{_CLASS['N']}]|[^\\s{_CLASS['L']}{_CLASS['N']}]+")


def byte_alphabet() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies: itself, or the next one from U+0100."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    out, extra = [], 256
    for b in range(256):
        out.append(chr(b if b in plain else extra))
        extra += b not in plain
    return out


class _Ids(dict):
    """Ids of the tokenizer's words as little-endian uint32 bytes."""

    def __init__(self, tokenizer):
        super().__init__()
        self.tokenizer, self.model, self.bytes = tokenizer, tokenizer.model, byte_alphabet()
        rules = json.loads(tokenizer.to_str())
        self.by_words = rules["normalizer"] == _NORMALIZER and rules["pre_tokenizer"] == _PRE_TOKENIZER

    def __missing__(self, word):
        if len(self) > _CACHE:
            self.clear()
        spelled = word if word.isascii() else "".join([self.bytes[b] for b in word.encode()])
        ids = [t.id for t in self.model.tokenize(spelled)]
        b = self[word] = struct.pack(f"<{len(ids)}I", *ids)
        return b

    def of(self, text: str) -> bytes:
        if not self.by_words or _OTHER.search(text):
            return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        return b"".join(map(self.__getitem__, _WORDS.findall(text.lower())))


def token_pieces(docs: DataFrame, capacity: int = CAPACITY, tokenizer: str = TOKENIZER, path: str | None = None) -> DataFrame:
    """``doc_id, _h, piece, start, length, ids_crc32`` of every document; ``path`` names the vocabulary file itself."""

    def run(it):
        import public_tokenizers
        from tokenizers import Tokenizer

        t = Tokenizer.from_file(path or public_tokenizers.path(tokenizer))
        t.no_truncation()
        ids = _Ids(t)
        for b in it:
            schema = pa.schema([b.schema.field("doc_id"), pa.field("_h", pa.binary()), pa.field("piece", pa.int32()),
                                pa.field("start", pa.int64()), pa.field("length", pa.int64()), pa.field("ids_crc32", pa.int64())])
            row, piece, start, length, crc = [], [], [], [], []
            for i, text in enumerate(b.column("text")):
                data = ids.of(text.as_py()) + b"\0\0\0\0"
                for n, at in enumerate(range(0, len(data), 4 * capacity)):
                    part = data[at:at + 4 * capacity]
                    row.append(i)
                    piece.append(n)
                    start.append(at // 4)
                    length.append(len(part) // 4)
                    crc.append(zlib.crc32(part))
            take = pa.array(row, pa.int64())
            yield from batches(schema, {"doc_id": b.column("doc_id").take(take), "_h": b.column("_h").take(take),
                                        "piece": piece, "start": start, "length": length, "ids_crc32": crc})

    return docs.mapInArrow(run, f"doc_id {id_type(docs)}, _h binary, piece int, start long, length long, ids_crc32 long")


class _Left:
    """Counts of the lengths that are left, with an index of the pair sums they can form."""

    def __init__(self, counts: np.ndarray):
        self.n = counts.astype(np.int64)
        self.cap = len(counts) - 1
        self.there = (self.n > 0).astype(np.int64)
        # number of ordered pairs of lengths for each sum
        self.pairs = np.convolve(self.there, self.there)[:self.cap + 1]

    def use(self, lengths: list[int], times: int) -> None:
        for x in lengths:
            self.n[x] -= times
            if self.n[x] == 0:
                self.pairs[x:] -= 2 * self.there[:self.cap + 1 - x]
                if 2 * x <= self.cap:
                    self.pairs[2 * x] += 1
                self.there[x] = 0

    def free(self, taken: list[int]) -> np.ndarray:
        left = self.n.copy()
        for x in taken:
            left[x] -= 1
        return left

    def exact(self, gap: int, taken: list[int]) -> list[int] | None:
        """One, two or three lengths that fill the gap, longest first."""
        left = self.free(taken)
        if left[gap] > 0:
            return [gap]
        if self.pairs[gap] > 0 and (p := self._pair(left, gap)):
            return p
        firsts = np.flatnonzero((left[:gap + 1] > 0) & (self.pairs[gap::-1] > 0))
        for a in firsts[::-1].tolist():
            if 3 * a < gap:
                break
            left[a] -= 1
            p = self._pair(left, gap - a)
            left[a] += 1
            if p:
                return [a, *p]
        return None

    @staticmethod
    def _pair(left: np.ndarray, total: int) -> list[int] | None:
        half = total // 2
        low = left[:half + 1]
        high = left[total - half:total + 1][::-1]
        ok = (low > 0) & (high > 0)
        if total == 2 * half and left[half] < 2:
            ok[half] = False
        at = int(ok.argmax())
        return [total - at, at] if ok[at] else None

    def best(self, gap: int, taken: list[int]) -> int:
        fits = np.flatnonzero(self.free(taken)[:gap + 1] > 0)
        return int(fits[-1]) if len(fits) else 0


def pack_counts(counts: np.ndarray) -> list[tuple[int, list[int]]]:
    """``(uses, lengths)`` patterns for ``counts[length]`` pieces, lengths 1 to the capacity; index 0 is unused."""
    counts = counts.copy()
    counts[0] = 0
    left, out = _Left(counts), []
    for longest in range(left.cap, 0, -1):
        while left.n[longest] > 0:
            pattern = [longest]
            gap = left.cap - longest
            while gap > 0:
                more = left.exact(gap, pattern)
                if more is None:
                    best = left.best(gap, pattern)
                    if not best:
                        break
                    more = [best]
                pattern += more
                gap -= sum(more)
            size, times = np.unique(pattern, return_counts=True)
            uses = int((left.n[size] // times).min())
            for s, t in zip(size.tolist(), times.tolist()):
                left.use([s], t * uses)
            out.append((uses, pattern))
    return out


def slots(patterns: list[tuple[int, list[int]]]):
    """Arrays (length, first rank, first sequence, offset) sorted by length and rank: where the ranks of a length go."""
    rank: dict[int, int] = {}
    rows, base = [], 0
    for uses, pattern in patterns:
        offset = 0
        for x in pattern:
            rows.append((x, rank.get(x, 0), base, offset))
            rank[x] = rank.get(x, 0) + uses
            offset += x
        base += uses
    rows.sort()
    return [np.array(c, np.int64) for c in zip(*rows)] if rows else [np.empty(0, np.int64)] * 4


def pack_pieces(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """The pieces with ``sequence_id`` and ``offset``; ``length`` from 1 to ``capacity``, any other columns."""
    taken = Table(pieces, "pieces")
    pieces = taken.df()
    # at most `capacity` rows come to the driver
    hist = pieces.groupBy("length").count().collect()
    counts = np.zeros(capacity + 1, np.int64)
    for r in hist:
        if r["length"] is not None:
            counts[r["length"]] = r["count"]
    length, rank, sequence, offset = slots(pack_counts(counts))
    key = length * (1 << 44) + rank
    buckets = int(max(1, counts.sum() // ROWS_PER_BUCKET, 4 * pieces.sparkSession.sparkContext.defaultParallelism))
    b = F.pmod(F.xxhash64("doc_id", "piece", "_h"), F.lit(buckets))
    pieces = pieces.withColumn("_b", b)
    below = Window.partitionBy("length").orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    starts = (pieces.groupBy("length", "_b").count()
              .withColumn("_base", F.coalesce(F.sum("count").over(below), F.lit(0))).drop("count"))
    within = Window.partitionBy("length", "_b").orderBy("doc_id", "_h", "piece")
    ranked = (pieces.withColumn("_r", F.row_number().over(within) - 1).join(starts, ["length", "_b"])
              .withColumn("_r", F.col("_r") + F.col("_base")))

    def place(n: pa.Array, r: pa.Array) -> pa.Array:
        n, r = n.to_numpy(zero_copy_only=False), r.to_numpy(zero_copy_only=False)
        at = np.searchsorted(key, n * (1 << 44) + r, side="right") - 1
        return pa.StructArray.from_arrays([pa.array(sequence[at] + r - rank[at]), pa.array(offset[at])],
                                          names=["sequence_id", "offset"])

    placed = F.arrow_udf(place, "sequence_id long, offset long")
    return ranked.withColumn("_p", placed("length", "_r")).select(
        *[c for c in taken.schema.names], "_p.sequence_id", "_p.offset")


def pack_documents(docs: DataFrame, capacity: int = CAPACITY, tokenizer: str = TOKENIZER) -> DataFrame:
    return pack_pieces(token_pieces(keyed(docs), capacity, tokenizer), capacity).drop("_h")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    return pack_documents(docs).select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")
