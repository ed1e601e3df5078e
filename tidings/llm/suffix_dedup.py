"""Suffix-array dedup over bytes.

Which byte strings of ``T`` bytes start at two places is decided by sorting suffixes.  The
suffixes that stand for all others start at the winnowed anchors of ``repeats``: every string of
``T`` bytes holds one, at a place that its bytes alone determine, so two equal strings meet in the
sorted suffixes (and in the sorted reversed prefixes) of one anchor.  Anchors that occur once
need no sorting, nor do those of which all runs are equal; of equal runs one takes part.

Sorting is a mergesort over prefix polynomial hashes: two suffixes are compared by a binary
search for their longest common extension, O(log T), and one byte.  Neighbours' common
prefixes are then verified byte by byte; an anchor where a hash lied is sorted plainly.  The
least common prefix between two places of the order gives the extension of any two runs of
an anchor, to the right from the suffixes and to the left from the reversed prefixes; where
both add up to ``T`` bytes the match is removed on either side.

Many runs of one anchor are looked at node by node of the suffix tree instead of pair by pair.
An anchor with more than ``MAX_RUNS`` distinct runs is not gathered in one task: its strings are
counted by their hashes as rows (``extend_by_windows``), which splits it evenly.

The same extension serves other units: ``substring_dedup`` gives word hashes for bytes.

Null and empty texts: no bytes, nothing removed.  Repeated rows are documents of their own, so each loses all it has
if that is ``T`` bytes; see ``repeats`` for how they are taken once.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidings.llm.common import keyed, read, text_key
from tidings.llm.repeats import BASE, Powers, Prefix, extend_by_windows, removed_mask, repeated_spans, with_texts

MIN_BYTES = 400
ANCHOR_BYTES = 32
MAX_RUNS = 16_384  # distinct runs of an anchor that one task sorts, some 10 MB
MATRIX_RUNS = 64   # up to here extensions of all of an anchor's runs are looked at in one matrix
CHUNK_BYTES = 1 << 20


def byte_table() -> np.ndarray:
    """A random 64-bit number for each byte."""
    return np.random.default_rng(1993).integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def byte_units():
    """Factory of the text -> hashed bytes function."""
    table = byte_table()
    return lambda text: table[np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)]


class Suffixes:
    """Suffixes ``start .. end`` of one byte buffer, compared through prefix hashes."""

    def __init__(self, data: np.ndarray, start: np.ndarray, end: np.ndarray, units: np.ndarray, powers: Powers):
        self.data, self.start, self.length = data, start, end - start
        self.pre = Prefix(units, powers)

    def lce(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Longest common extension of suffixes number a and b, by binary search on hashes."""
        sa, sb = self.start[a], self.start[b]
        low = np.zeros(len(a), np.int64)
        high = np.minimum(self.length[a], self.length[b])
        while True:
            open_ = low < high
            if not open_.any():
                return low
            mid = (low + high + 1) >> 1
            same = self.pre.of(sa, sa + mid) == self.pre.of(sb, sb + mid)
            low = np.where(open_ & same, mid, low)
            high = np.where(open_ & ~same, mid - 1, high)

    def less(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Suffix a sorts before suffix b; of equal ones the lower number."""
        n = self.lce(a, b)
        end_a, end_b = n == self.length[a], n == self.length[b]
        last = len(self.data) - 1
        byte_a = self.data[np.minimum(self.start[a] + n, last)]
        byte_b = self.data[np.minimum(self.start[b] + n, last)]
        return np.where(end_a | end_b, np.where(end_a & end_b, a < b, end_a), byte_a < byte_b)

    def sort(self, group_start: np.ndarray, group_size: np.ndarray) -> np.ndarray:
        """Order of the suffixes, group by group (groups are consecutive): a mergesort of all groups at once."""
        order = np.arange(len(self.start))
        base = np.repeat(group_start, group_size)
        size = np.repeat(group_size, group_size)
        local = order - base
        run = 1
        while run < group_size.max(initial=1):
            block = local // run
            s = np.minimum((block ^ 1) * run, size)
            e = np.minimum(s + run, size)
            low, high = s.copy(), e.copy()
            todo = np.flatnonzero(low < high)
            while len(todo):  # how many of the sibling run sort before this one
                mid = (low[todo] + high[todo]) >> 1
                before = self.less(order[base[todo] + mid], order[todo])
                low[todo] = np.where(before, mid + 1, low[todo])
                high[todo] = np.where(before, high[todo], mid)
                todo = todo[low[todo] < high[todo]]
            place = base + (block & ~1) * run + (local - block * run) + (low - s)
            merged = np.empty_like(order)
            merged[place] = order
            order, run = merged, run * 2
        return order

    def neighbours(self, order: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Common prefix of each place with the next, and whether the bytes bear it out."""
        a, b = order[:-1], order[1:]
        n = self.lce(a, b)
        which = np.repeat(np.arange(len(n)), n)
        step = np.arange(len(which)) - np.repeat(np.cumsum(n) - n, n)
        wrong = self.data[self.start[a][which] + step] != self.data[self.start[b][which] + step]
        lied = np.bincount(which, wrong, len(n)) > 0
        return n, lied


def _common(order: np.ndarray, lcp: np.ndarray, n: int) -> np.ndarray:
    """Matrix of common prefixes: the least neighbour value between two places."""
    m = np.zeros((n, n), np.int64)
    for i in range(n - 1):
        m[i, i + 1:] = np.minimum.accumulate(lcp[i:n - 1])
    m += m.T
    back = np.empty(n, np.int64)
    back[order] = np.arange(n)
    return m[back][:, back]


class _RangeMin:
    """Least of consecutive values, by a sparse table."""

    def __init__(self, v: np.ndarray):
        rows, span = [v], 1
        while 2 * span <= len(v):
            low = rows[-1].copy()
            low[:len(v) - span] = np.minimum(rows[-1][:-span], rows[-1][span:])
            rows.append(low)
            span *= 2
        self.rows = np.array(rows)

    def of(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """min(v[a:b]) for a < b."""
        k = np.frexp((b - a).astype(float))[1] - 1
        return np.minimum(self.rows[k, a], self.rows[k, b - (1 << k)])


def _nodes(lcp: np.ndarray, least: int):
    """(first place, last place, common prefix) of every node of the suffix tree with a prefix of ``least`` or more."""
    open_: list[tuple[int, int]] = []  # (first place, prefix)
    for i, r in enumerate([*lcp.tolist(), -1]):
        start = i
        while open_ and open_[-1][1] > r:
            start, value = open_.pop()
            if value >= least:
                yield start, i, value
        if not open_ or open_[-1][1] < r:
            open_.append((start, r))


def _by_nodes(order_r, lcp_r, order_l, lcp_l, most_left: int, T: int):
    """(lft, rgt) of many runs of one anchor.

    Runs below a node share at least its prefix to the right; of them, a run's neighbours in the
    left order share most with it to the left.  Work and memory follow the sizes of the nodes.
    """
    n = len(order_r)
    lft, rgt = np.full(n, -1, np.int64), np.full(n, -1, np.int64)
    rank = np.empty(n, np.int64)
    rank[order_l] = np.arange(n)
    low = _RangeMin(lcp_l)
    for a, b, r in _nodes(lcp_r, T - most_left):
        runs = order_r[a:b + 1]
        runs = runs[np.argsort(rank[runs])]
        near = low.of(rank[runs[:-1]], rank[runs[1:]])
        best = np.maximum(np.r_[near, -1], np.r_[-1, near])
        ok = best + r >= T
        hit = runs[ok]
        lft[hit] = np.maximum(lft[hit], best[ok])
        rgt[hit] = np.maximum(rgt[hit], r)
    return lft, rgt


def _plain(strings: list[np.ndarray]) -> np.ndarray:
    """Common prefixes by plain comparison, for anchors where a hash lied."""
    n = len(strings)
    m = np.zeros((n, n), np.int64)
    for i in range(n):
        for j in range(i):
            a, b = strings[i], strings[j]
            k = next((x for x in range(min(len(a), len(b))) if a[x] != b[x]), min(len(a), len(b)))
            m[i, j] = m[j, i] = k
    return m


def reaches(strings: list[bytes], off: np.ndarray, copies: np.ndarray, first: np.ndarray, size: np.ndarray, T: int,
            table: np.ndarray | None, powers: Powers):
    """(lft, rgt) of every run, -1 where it has no partner; runs of one anchor are consecutive (first, size).

    ``strings`` hold bytes, hashed by ``table``, or without one 64-bit units.
    """
    kind = np.dtype(np.uint8 if table is not None else np.uint64)
    length = np.array([len(s) // kind.itemsize for s in strings], np.int64)
    start = np.cumsum(length) - length
    data = np.frombuffer(b"".join(strings), kind)
    total = len(data)
    hashed = data if table is None else table[data]
    right = Suffixes(data, start + off, start + length, hashed, powers)
    back = data[::-1]
    left = Suffixes(back, total - (start + off), total - start, hashed[::-1], powers)
    order_r, order_l = right.sort(first, size), left.sort(first, size)
    lcp_r, lied_r = right.neighbours(order_r)
    lcp_l, lied_l = left.neighbours(order_l)
    lft, rgt = np.full(len(strings), -1, np.int64), np.full(len(strings), -1, np.int64)
    for f, n in zip(first.tolist(), size.tolist()):
        part = slice(f, f + n)
        lied = lied_r[f:f + n - 1].any() or lied_l[f:f + n - 1].any()
        if n > MATRIX_RUNS and not lied:
            lft[part], rgt[part] = _by_nodes(order_r[part] - f, lcp_r[f:f + n - 1], order_l[part] - f, lcp_l[f:f + n - 1],
                                             int(off[part].max()), T)
            continue
        if lied:
            own = [data[a:a + m] for a, m in zip(start[part], length[part])]
            r = _plain([s[o:] for s, o in zip(own, off[part])])
            l = _plain([s[:o][::-1] for s, o in zip(own, off[part])])
        else:
            r = _common(order_r[part] - f, lcp_r[f:f + n - 1], n)
            l = _common(order_l[part] - f, lcp_l[f:f + n - 1], n)
        ok = (r + l >= T) & ~np.eye(n, dtype=bool)
        lft[part] = np.where(ok, l, -1).max(1)
        rgt[part] = np.where(ok, r, -1).max(1)
    many = copies > 1
    lft[many], rgt[many] = off[many], (length - off)[many]
    return lft, rgt


def run_strings(text_runs: DataFrame, T: int, units_of) -> DataFrame:
    """``ah, ch, copies, off, s``: the units of every run (bytes as they are, else 64 bits each) and the anchor's place in them."""
    plain = units_of is byte_units

    def run(it):
        units = None if plain else units_of()
        for b in it:
            cols = [[], [], [], [], []]
            for text, runs in zip(b.column("text"), b.column("runs")):
                data = text.as_py().encode("utf-8", "surrogatepass") if plain else units(text.as_py())
                for r in runs.as_py():
                    first, count, off = r["pos"] >> 20, (r["pos"] >> 10) & 1023, r["pos"] & 1023
                    part = data[first:first + count + T - 1]
                    for c, v in zip(cols, (r["ah"], r["ch"], r["copies"], off, part if plain else part.tobytes())):
                        c.append(v)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary()))],
                                             names=["ah", "ch", "copies", "off", "s"])

    return text_runs.mapInArrow(run, "ah long, ch long, copies long, off long, s binary")


def extend_by_sorting(docs: DataFrame, runs: DataFrame, T: int, units_of) -> DataFrame:
    """``ah, ch, lft, rgt`` like ``extend_by_windows``, by suffix sorting where an anchor's runs fit a task."""
    size = runs.groupBy("ah").count().where(F.col("count") > MAX_RUNS).select("ah")
    few, many = runs.join(size, "ah", "left_anti"), runs.join(size, "ah", "left_semi")
    strings = run_strings(with_texts(docs, few), T, units_of).repartition("ah").sortWithinPartitions("ah", "ch")
    plain = units_of is byte_units

    def flush(rows, powers, table):
        ah = np.array([r[0] for r in rows], np.int64)
        first = np.flatnonzero(np.r_[True, ah[1:] != ah[:-1]])
        size = np.diff(np.r_[first, len(ah)])
        ch, copies, off = (np.array([r[i] for r in rows], np.int64) for i in (1, 2, 3))
        lft, rgt = reaches([r[4] for r in rows], off, copies, first, size, T, table, powers)
        ok = lft >= 0
        return pa.RecordBatch.from_arrays([pa.array(x[ok]) for x in (ah, ch, lft, rgt)], names=["ah", "ch", "lft", "rgt"])

    def run(it):
        powers = Powers(BASE ^ 0x2545F4914F6CDD1C)
        table = byte_table() if plain else None
        rows, held = [], 0
        for b in it:
            for r in zip(*(b.column(c).to_pylist() for c in ("ah", "ch", "copies", "off", "s"))):
                if held > CHUNK_BYTES and rows[-1][0] != r[0]:
                    yield flush(rows, powers, table)
                    rows, held = [], 0
                rows.append(r)
                held += len(r[4])
        if rows:
            yield flush(rows, powers, table)

    sorted_ = strings.mapInArrow(run, "ah long, ch long, lft long, rgt long")
    return sorted_.unionByName(extend_by_windows(docs, many, T, units_of))


def spans(docs: DataFrame, T: int = MIN_BYTES, k: int = ANCHOR_BYTES) -> DataFrame:
    """``doc_id, _h, spans`` in bytes of ``keyed`` documents; only documents that repeat something."""
    if not 1 < k < T < 1024:
        raise ValueError("need 1 < k < T < 1024")
    return repeated_spans(docs, T, k, byte_units, extend_by_sorting, "bytes")


def _kept(text: pa.Array, found: pa.Array, T: int) -> pa.Array:
    n, gone, runs, kept = [], [], [], []
    for t, s in zip(text, found):
        data = t.as_py().encode("utf-8", "surrogatepass")
        mask = removed_mask(s.values, len(data), T)
        n.append(len(data))
        gone.append(int(mask.sum()))
        runs.append(int((mask & ~np.r_[False, mask[:-1]]).sum()) if len(mask) else 0)
        kept.append(np.frombuffer(data, np.uint8)[~mask].tobytes() if gone[-1] else data)
    return pa.StructArray.from_arrays([pa.array(n, pa.int64()), pa.array(gone, pa.int64()), pa.array(runs, pa.int64()),
                                       pa.array(kept, pa.binary())], names=["n_bytes", "n_removed", "n_spans", "kept"])


def readable(kept: str):
    """Bytes as text, without what is left of a character that was cut."""
    return F.translate(F.make_valid_utf8(F.col(kept).cast("string")), "\ufffd", "")


def remove_repeats(docs: DataFrame, T: int = MIN_BYTES, k: int = ANCHOR_BYTES) -> DataFrame:
    """``row`` (the given columns), ``n_bytes``, ``n_removed``, ``n_spans`` and the ``kept`` bytes."""
    rows = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"))
    text = F.coalesce(F.col("row.text").cast("string"), F.lit(""))
    rows = rows.select("row", F.col("row.doc_id").alias("doc_id"), text_key(text).alias("_h"), text.alias("text"))
    found = spans(keyed(docs), T, k).withColumnsRenamed({"doc_id": "_d", "_h": "_g"})
    kept = F.arrow_udf(lambda t, s: _kept(t, s, T), "n_bytes long, n_removed long, n_spans long, kept binary")
    none = F.array().cast("array<struct<s:bigint,e:bigint>>")
    return (rows.join(found, F.col("doc_id").eqNullSafe(F.col("_d")) & (F.col("_h") == F.col("_g")), "left")
            .select("row", kept("text", F.coalesce("spans", none)).alias("k")).select("row", "k.*"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    found = remove_repeats(docs).select("row.doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"), "kept")
    return found.withColumn("text", readable("kept")).drop("kept")


ORACLE = r"""
with d as (select row_number() over () as rid, doc_id, encode(coalesce(text, '')) as b from documents),
win as (select rid, i, md5(b[i:i + 399]) as s from d, unnest(generate_series(1, octet_length(b) - 399)) as t(i)),
rep as (select s from win group by s having count(*) > 1),
hit as (select rid, i, case when i - lag(i) over (partition by rid order by i) <= 400 then 0 else 1 end as fresh from win join rep using (s)),
run as (select rid, i, sum(fresh) over (partition by rid order by i) as r from hit),
span as (select rid, r, min(i) as s, max(i) + 400 as e from run group by rid, r),
edge as (select rid, s, e, lag(e, 1, 1) over (partition by rid order by s) as before from span
         union all select rid, octet_length(b) + 1, null, coalesce((select max(e) from span where span.rid = d.rid), 1) from d),
part as (select rid, list(b[before:s - 1] order by s) as kept from edge join d using (rid) where before < s group by rid),
gone as (select rid, sum(e - s) as n, count(*) as k from span group by rid),
rest as (select rid, doc_id, b, coalesce(list_reduce(kept, lambda x, y: x || y), ''::blob) as kept from d left join part using (rid))
select doc_id, octet_length(b)::bigint as n_bytes, coalesce(gone.n, 0)::bigint as n_removed, coalesce(gone.k, 0)::bigint as n_spans,
       sha256(kept) as kept_sha256, replace(decode(unhex(regexp_replace(hex(kept), '([0-7].|(?:C[2-9A-F]|D.)[89AB].|E.[89AB].[89AB].|F[0-4][89AB].[89AB].[89AB].)|..',
       '\1', 'g'))), chr(65533), '') as text
from rest left join gone using (rid)
"""
