"""Substring dedup by seed and extend over words.

Winnowed anchors (8 words) are the seeds that documents are joined on.  The distinct runs of words around an
anchor are extended to both sides: sorted by what follows the anchor and by what stands before it, neighbours show how far
matches reach, and maximal matches of at least ``T`` words are removed wherever they occur, all copies alike (see
``repeats`` for the seeds and ``suffix_dedup`` for the extension).  Words are compared by 64-bit hashes.  Null text: no words.
Texts below ``T`` words, empty tables: nothing removed.  Repeated rows: each is a document of its own, so both lose what they share.
"""

from __future__ import annotations


import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidings.llm.common import WORD, keyed, read, text_key
from tidings.llm.repeats import removed_mask, repeated_spans
from tidings.llm.suffix_dedup import extend_by_sorting

MIN_WORDS = 35
ANCHOR_WORDS = 8
_CACHE = 500_000


class _Hashes(dict):
    def __missing__(self, word):
        if len(self) > _CACHE:
            self.clear()
        h = self[word] = xxhash.xxh3_64_intdigest(word)
        return h


def word_units():
    """Factory of the text -> word hashes function (one cache per task)."""
    hashes, find = _Hashes(), WORD.findall

    def units(text: str) -> np.ndarray:
        words = find(text)
        return np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))

    return units


def spans(docs: DataFrame, T: int = MIN_WORDS, k: int = ANCHOR_WORDS) -> DataFrame:
    """``doc_id, _h, spans`` in words of ``keyed`` documents; only documents that repeat something."""
    if not 1 < k < T < 1024:
        raise ValueError("need 1 < k < T < 1024")
    return repeated_spans(docs, T, k, word_units, extend_by_sorting, "words")


def _kept(text: pa.Array, found: pa.Array, T: int) -> pa.Array:
    n, gone, kept = [], [], []
    find = WORD.findall
    for t, s in zip(text, found):
        words = find(t.as_py())
        mask = removed_mask(s.values, len(words), T)
        n.append(len(words))
        gone.append(int(mask.sum()))
        kept.append(" ".join([w for w, m in zip(words, mask.tolist()) if not m]) if gone[-1] else " ".join(words))
    return pa.StructArray.from_arrays(
        [pa.array(n, pa.int64()), pa.array(gone, pa.int64()), pa.array(kept, pa.string())],
        names=["n_words", "n_removed", "text"])


def remove_repeats(docs: DataFrame, T: int = MIN_WORDS, k: int = ANCHOR_WORDS) -> DataFrame:
    """Documents with the kept words as ``text``; ``row`` holds the given columns, ``n_words`` and ``n_removed`` follow."""
    base = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"))
    text = F.coalesce(F.col("row.text").cast("string"), F.lit(""))
    base = base.select("row", F.col("row.doc_id").alias("doc_id"), text_key(text).alias("_h"), text.alias("text"))
    found = spans(keyed(docs), T, k).withColumnsRenamed({"doc_id": "_d", "_h": "_g"})
    kept = F.arrow_udf(lambda t, s: _kept(t, s, T), "n_words long, n_removed long, text string")
    none = F.array().cast("array<struct<s:bigint,e:bigint>>")
    return (base.join(found, F.col("doc_id").eqNullSafe(F.col("_d")) & (F.col("_h") == F.col("_g")), "left")
            .select("row", kept("text", F.coalesce("spans", none)).alias("k"))
            .select("row", "k.n_words", "k.n_removed", "k.text"))



def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return remove_repeats(docs).select("row.doc_id", "n_words", "n_removed",
                                       F.sha2(F.encode("text", "UTF-8"), 256).alias("kept_sha256"))


ORACLE = r"""
with d as (select row_number() over () as rid, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as w from documents),
win as (select rid, i, md5(array_to_string(w[i:i + 34], ' ')) as s from d, unnest(generate_series(1, len(w) - 34)) as t(i)),
rep as (select s from win group by s having count(*) > 1),
cov as (select distinct rid, i + k as p from win join rep using (s), unnest(generate_series(0, 34)) as u(k)),
word as (select rid, p, w[p] as x from d, unnest(generate_series(1, len(w))) as t(p)),
left_ as (select rid, string_agg(x, ' ' order by p) as kept from word anti join cov using (rid, p) group by rid),
gone as (select rid, count(*) as n from cov group by rid)
select doc_id, len(w)::bigint as n_words, coalesce(gone.n, 0)::bigint as n_removed, sha256(coalesce(kept, '')) as kept_sha256
from d left join gone using (rid) left join left_ using (rid)
"""
