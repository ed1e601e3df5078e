"""Repeated windows: every window of ``T`` units (words or bytes) that starts at two places or more.

Seeds.  A window's anchor is the smallest hash among its k-grams, the rightmost among equals.
It depends on the window's units alone, so equal windows have equal anchors at equal offsets
and only occurrences of one anchor need comparing.  Neighbouring windows share their anchor;
such a run of windows is one row here: ``ah`` (anchor hash), ``ch`` (hash of the run's units
and of the anchor's place in it) and ``pos`` (first window, number of windows, anchor offset).
That is about ``2 / (T - k)`` rows per unit.

Decisions.  An anchor seen once settles its windows: they are unique.  An anchor whose
occurrences all have the same ``ch``: all its windows repeat.  The rest, mostly the edges of
shared passages, is extended both ways per distinct run (``ch``), however many copies each has;
the extension gives, per run, how far matches of at least ``T`` units that hold the anchor
reach to the left and right.  All of such matches overlap in the anchor, so the covered units
are one interval.

Rows that repeat (same id, same text) take part once: all their windows repeat, so a document with
such a row goes whole if it has ``T`` units, and what others share with it they share with the one that takes part.

No group is ever gathered whole and no pairs within a group are made: groups are counted by
partial aggregation, and hot keys occur only in plain equi-joins, which Spark can split.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidings.llm.common import Scope, Table, batches, id_type, same_doc

BASE = 0x9E3779B97F4A7C15
SEGMENT = 1 << 20  # windows worked on at a time
_LOW = np.uint64(SEGMENT * 2 - 1)
MASK64 = (1 << 64) - 1
# keys of repeated rows are sent along up to this many, some 5 MB; beyond it they are joined
MOST_SENT = 100_000


def mix(h: np.ndarray) -> np.ndarray:
    """Finalizer of 64-bit hashes, in place on a fresh array."""
    h = h ^ (h >> np.uint64(33))
    h *= np.uint64(0xFF51AFD7ED558CCD)
    h ^= h >> np.uint64(33)
    h *= np.uint64(0xC4CEB9FE1A85EC53)
    h ^= h >> np.uint64(33)
    return h


class Powers:
    """Powers of the base and of its inverse modulo 2**64, grown on demand."""

    def __init__(self, base: int = BASE):
        self.base, self.inverse = base, pow(base, -1, 1 << 64)
        self.up = self.down = np.ones(1, np.uint64)

    def upto(self, n: int):
        if len(self.up) < n:
            size = max(n, 2 * len(self.up))
            for name, b in (("up", self.base), ("down", self.inverse)):
                p = np.full(size, b, np.uint64)
                p[0] = 1
                setattr(self, name, np.multiply.accumulate(p))
        return self.up[:n], self.down[:n]


class Prefix:
    """Polynomial prefix hashes of a unit array: the hash of any slice in three operations."""

    def __init__(self, units: np.ndarray, powers: Powers):
        up, self.down = powers.upto(len(units) + 1)
        self.sums = np.zeros(len(units) + 1, np.uint64)
        np.cumsum(units * up[:-1], out=self.sums[1:])

    def of(self, start, end) -> np.ndarray:
        return (self.sums[end] - self.sums[start]) * self.down[start]


def anchor_runs(units: np.ndarray, T: int, k: int, powers: Powers):
    """Runs of windows with one anchor: arrays (ah, ch, first window, windows, anchor offset)."""
    out = [[] for _ in range(5)]
    w = T - k + 1
    for base in range(0, len(units) - T + 1, SEGMENT):
        u = units[base:base + SEGMENT + T - 1]
        pre = Prefix(u, powers)
        n_g = len(u) - k + 1
        grams = mix((pre.sums[k:] - pre.sums[:n_g]) * pre.down[:n_g])
        v = (grams & ~_LOW) | (_LOW - np.arange(n_g, dtype=np.uint64))  # ties: the rightmost is least
        span = 1
        while span * 2 <= w:
            v = np.minimum(v[:-span], v[span:])
            span *= 2
        if span < w:
            v = np.minimum(v[:len(v) - (w - span)], v[w - span:])
        at = (_LOW - (v & _LOW)).astype(np.int64)  # anchor of each window
        first = np.flatnonzero(np.r_[True, at[1:] != at[:-1]])
        count = np.diff(np.r_[first, len(at)])
        p = at[first]
        off = p - first
        shape = (off.astype(np.uint64) << np.uint64(32)) | count.astype(np.uint64)
        ch = mix(pre.of(first, first + count + T - 1) ^ mix(shape))
        for o, a in zip(out, (grams[p], ch, first + base, count, off)):
            o.append(a)
    return [np.concatenate(o) if o else np.empty(0, np.int64) for o in out]


# pos packs (first window, number of windows, anchor offset) into one long; T is below 1024
def pack(first, count, off):
    return (first << 20) | (count << 10) | off


def seed_rows(docs: DataFrame, T: int, k: int, units_of: Callable) -> DataFrame:
    """One row per anchor run of every document: ``doc_id, _h, ah, ch, pos``."""
    kind = id_type(docs)

    def run(it: Iterator[pa.RecordBatch]):
        powers, units = Powers(), units_of()
        for b in it:
            out_schema = pa.schema([("doc_id", b.schema.field("doc_id").type), ("_h", pa.binary()), ("ah", pa.int64()),
                                    ("ch", pa.int64()), ("pos", pa.int64())])
            rows, cols, held = [], [[], [], []], 0
            texts = b.column("text")

            def flush():
                n = [len(x) for x in cols[0]]
                take = pa.array(np.repeat(np.array(rows, np.int64), n))
                arrays = [b.column("doc_id").take(take), b.column("_h").take(take)]
                arrays += [pa.array(np.concatenate(c).view(np.int64)) for c in cols]
                return pa.RecordBatch.from_arrays(arrays, schema=out_schema)

            for i in range(b.num_rows):
                u = units(texts[i].as_py())
                if len(u) < T:
                    continue
                ah, ch, first, count, off = anchor_runs(u, T, k, powers)
                rows.append(i)
                for c, a in zip(cols, (ah, ch, pack(first, count, off))):
                    c.append(a)
                held += len(ah)
                if held >= 200_000:
                    yield flush()
                    rows, cols, held = [], [[], [], []], 0
            if rows:
                yield flush()

    return docs.mapInArrow(run, f"doc_id {kind}, _h binary, ah long, ch long, pos long")


def window_rows(text_runs: DataFrame, T: int, units_of: Callable) -> DataFrame:
    """Every window of the given runs: ``ah, ch, copies, j, wh``; j: units of the window before the anchor."""

    def run(it: Iterator[pa.RecordBatch]):
        powers, units = Powers(BASE ^ 0x5851F42D4C957F2E), units_of()
        schema = pa.schema([("ah", pa.int64()), ("ch", pa.int64()), ("copies", pa.int64()), ("j", pa.int32()),
                            ("wh", pa.int64())])
        for b in it:
            for text, runs in zip(b.column("text"), b.column("runs")):
                u = units(text.as_py())
                v = runs.values
                ah, ch, copies, pos = (np.asarray(v.field(c)) for c in ("ah", "ch", "copies", "pos"))
                first, count, off = pos >> 20, (pos >> 10) & 1023, pos & 1023
                pre = Prefix(u, powers)
                which = np.repeat(np.arange(len(pos)), count)
                step = np.arange(len(which)) - np.repeat(np.cumsum(count) - count, count)
                at = first[which] + step
                j = off[which] - step
                wh = mix(pre.of(at, at + T) ^ mix(j.astype(np.uint64))).view(np.int64)
                yield from batches(schema, {"ah": ah[which], "ch": ch[which], "copies": copies[which],
                                            "j": j.astype(np.int32), "wh": wh})

    return text_runs.mapInArrow(run, "ah long, ch long, copies long, j int, wh long")


def texts_with(docs: DataFrame, per_doc: DataFrame, how: str) -> DataFrame:
    """Documents joined to rows of ``per_doc`` (``doc_id, _h, ...``), one row there at most for each."""
    other = [c for c in per_doc.columns if c not in ("doc_id", "_h")]
    return docs.join(per_doc, same_doc(docs, per_doc), how).select(
        docs["doc_id"], docs["_h"], docs["text"], *[per_doc[c] for c in other])


def with_texts(docs: DataFrame, runs: DataFrame) -> DataFrame:
    """Each document that stands for runs, with them in the array ``runs``."""
    per_doc = runs.groupBy("doc_id", "_h").agg(F.collect_list(F.struct("ah", "ch", "copies", "pos")).alias("runs"))
    return texts_with(docs, per_doc, "inner")


def extend_by_windows(docs: DataFrame, runs: DataFrame, T: int, units_of: Callable) -> DataFrame:
    """``ah, ch, lft, rgt``: reach of repeated windows before the anchor's start and from it on, per run."""
    w = window_rows(with_texts(docs, runs), T, units_of)
    again = Table(w.groupBy("ah", "wh").agg(F.sum("copies").alias("n")).where("n > 1").select("ah", "wh"), "windows").df()
    return (w.select("ah", "ch", "j", "wh").join(again, ["ah", "wh"], "left_semi").groupBy("ah", "ch")
            .agg(F.max("j").cast("long").alias("lft"), (F.lit(T) - F.min("j")).cast("long").alias("rgt")))


def taken_once(docs: DataFrame, name: str) -> tuple[DataFrame, DataFrame]:
    """(``keyed`` documents, one row for each key; the keys ``doc_id, _h`` of those with more)."""
    again = Table(docs.groupBy("doc_id", "_h").count().where("count > 1").select("doc_id", "_h"), f"{name}-again").df()
    n = again.count()
    if not n:
        return docs, again
    side = F.broadcast(again) if n <= MOST_SENT else again
    one = docs.join(side, same_doc(docs, side), "left_semi").dropDuplicates(["doc_id", "_h"])
    return docs.join(side, same_doc(docs, side), "left_anti").unionByName(one), again


WHOLE = -1  # start of the span of a document that stands in the table again


def repeated_spans(docs: DataFrame, T: int, k: int, units_of: Callable, extend: Callable, name: str) -> DataFrame:
    """``doc_id, _h, spans`` (array of start, end) of ``keyed`` documents, only those with any; for ``removed_mask``."""
    with Scope() as scope:
        docs, again = taken_once(docs, name)
        seeds = Table(seed_rows(docs, T, k, units_of), f"{name}-seeds")
        occ = seeds.df()
        shared = (occ.groupBy("ah").agg(F.count("*").alias("n"), F.min("ch").alias("c1"), F.max("ch").alias("c2"))
                  .where("n > 1").select("ah", (F.col("c1") != F.col("c2")).alias("mixed")))
        # written, so that both sides of the join are plain exchanges and a hot anchor can be split
        shared = Table(shared, f"{name}-counts").df()
        live = Table(occ.join(shared, "ah"), f"{name}-shared")
        seeds.drop()
        occ = live.df()
        mixed = occ.where("mixed")
        first, count = F.shiftright("pos", 20), F.shiftright("pos", 10).bitwiseAND(F.lit(1023))
        whole = occ.where("not mixed").select("doc_id", "_h", first.alias("s"), (first + count + (T - 1)).alias("e"))
        # each distinct run once, however many copies
        runs = (mixed.groupBy("ah", "ch").agg(F.count("*").alias("copies"), F.min(F.struct("doc_id", "_h", "pos")).alias("r"))
                .select("ah", "ch", "copies", "r.doc_id", "r._h", "r.pos"))
        reach = Table(extend(docs, Table(runs, f"{name}-runs").df(), T, units_of), f"{name}-reach").df()
        anchor = first + F.col("pos").bitwiseAND(F.lit(1023))
        edges = mixed.join(reach, ["ah", "ch"]).select("doc_id", "_h", (anchor - F.col("lft")).alias("s"),
                                                       (anchor + F.col("rgt")).alias("e"))
        gone = again.select("doc_id", "_h", F.lit(WHOLE).cast("long").alias("s"), F.lit(WHOLE).cast("long").alias("e"))
        spans = whole.unionByName(edges).unionByName(gone).groupBy("doc_id", "_h").agg(F.collect_set(F.struct("s", "e")).alias("spans"))
        out = Table(spans, f"{name}-spans")
        scope.drop(but=out)
    return out.df()


def removed_mask(spans, n: int, T: int) -> np.ndarray:
    """Which of n units the spans cover; ``WHOLE`` covers a document of T units or more."""
    if spans is None or len(spans) == 0:
        return np.zeros(n, bool)
    s, e = np.asarray(spans.field("s")), np.asarray(spans.field("e"))
    if (s == WHOLE).any():
        return np.full(n, n >= T)
    d = np.bincount(s, minlength=n + 1) - np.bincount(e, minlength=n + 1)
    return np.cumsum(d[:n]) > 0
