"""Toxicity by a factorization machine over hashed terms.

Terms of a text: its words (lower-cased letters) and their prefixes of 4, 5 and 6 letters, each
hashed to 64 bits; a term counts once however often it occurs, so the length of a text adds
nothing by itself.  The model is fitted on a bounded sample of labelled rows (``MAX_TRAIN``
rows, those with the least hash of the id): terms whose chi-square against the label is at
least ``MIN_CHI2`` are its features (``MAX_FEATURES`` at most, an upper bound of the model's size),
with a linear weight and a factor vector each, so pairs of terms that mean more together than
apart are learned as well.  Fitting is stochastic gradient descent on the sparse rows of the
sample; scoring is one pass over all texts with the model sent along.

Only texts are inputs of a score.  Null and empty texts have no terms and score what the bias
gives.  Null ids are never trained on.  Without labelled rows, or with labels of one kind only,
the model is the bias alone.  Repeated rows get equal scores.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidings.llm.common import Table, read

MAX_TRAIN = 20_000
MAX_FEATURES = 20_000
MIN_CHI2 = 25.0
PREFIXES = (4, 5, 6)
RANK = 8
EPOCHS = 30
RATE = 0.2
DECAY = 1e-4
_CACHE = 300_000
_TERM = re.compile(r"[^\W\d_]+")


def terms_of(word: str) -> list[str]:
    """The word as it is and its prefixes, marked apart."""
    return ["=" + word] + [word[:n] for n in PREFIXES if len(word) >= n]


def hashed(term: str) -> int:
    return xxhash.xxh3_64_intdigest(term) >> 1


class _Terms(dict):
    """word -> hashes of its terms."""

    def __missing__(self, word):
        if len(self) > _CACHE:
            self.clear()
        h = self[word] = [hashed(t) for t in terms_of(word)]
        return h


class _Features(dict):
    """word -> indexes of its terms that are features."""

    def __init__(self, index: dict[int, int]):
        super().__init__()
        self.index = index

    def __missing__(self, word):
        if len(self) > _CACHE:
            self.clear()
        at = self[word] = tuple(self.index[h] for h in map(hashed, terms_of(word)) if h in self.index)
        return at


def words(text: str) -> set[str]:
    return set(_TERM.findall(text.lower()))


@dataclass
class Model:
    index: dict[int, int]
    bias: float
    weight: np.ndarray
    factor: np.ndarray

    def raw(self, at: np.ndarray) -> float:
        """Bias, linear part and pairwise part of a row with these features."""
        if not len(at):
            return self.bias
        v = self.factor[at]
        s = v.sum(0)
        return float(self.bias + self.weight[at].sum() + 0.5 * ((s * s).sum() - (v * v).sum()))


def features(text: str, table: _Features) -> np.ndarray:
    found = {i for w in words(text) for i in table[w]}
    return np.array(sorted(found), np.int64)


def term_counts(sample: DataFrame) -> DataFrame:
    """``term, toxic, clean``: rows of either kind with the term."""

    def run(it):
        terms = _Terms()
        for b in it:
            h, y = [], []
            for text, label in zip(b.column("text"), b.column("toxic").to_pylist()):
                own = {t for w in words(text.as_py()) for t in terms[w]}
                h.extend(own)
                y.extend([label] * len(own))
            t, at = np.unique(np.array(h, np.int64), return_inverse=True)
            y = np.array(y, np.int64)
            toxic = np.bincount(at, y, len(t)).astype(np.int64) if len(t) else np.empty(0, np.int64)
            every = np.bincount(at, minlength=len(t)).astype(np.int64) if len(t) else np.empty(0, np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(t), pa.array(toxic), pa.array(every - toxic)], names=["term", "toxic", "clean"])

    rows = sample.select("text", "toxic").mapInArrow(run, "term long, toxic long, clean long")
    return rows.groupBy("term").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))


def fit(rows: list[np.ndarray], label: np.ndarray, index: dict[int, int], seed: int = 7) -> Model:
    """AdaGrad on the logistic loss in small batches."""
    rng = np.random.default_rng(seed)
    n, p = len(rows), len(index)
    rate = label.mean() if n else 0.0
    bias = float(np.log((rate * n + 0.5) / ((1 - rate) * n + 0.5))) if n else 0.0
    m = Model(index, bias, np.zeros(p), rng.normal(0, 0.05, (p, RANK)))
    if not p or not n:
        return m
    gw, gv, gb = np.full(p, 1e-6), np.full((p, RANK), 1e-6), 1e-6
    for _ in range(EPOCHS):
        for at in np.array_split(rng.permutation(n), max(1, n // 64)):
            idx = np.concatenate([rows[i] for i in at])
            own = np.repeat(np.arange(len(at)), [len(rows[i]) for i in at])
            v = m.factor[idx]
            s = np.zeros((len(at), RANK))
            np.add.at(s, own, v)
            q = np.bincount(own, (v * v).sum(1), len(at))
            z = m.bias + np.bincount(own, m.weight[idx], len(at)) + 0.5 * ((s * s).sum(1) - q)
            g = 1 / (1 + np.exp(-np.clip(z, -30, 30))) - label[at]
            db = g.sum()
            gb += db * db
            m.bias -= RATE * db / np.sqrt(gb)
            if not len(idx):
                continue
            dw = np.bincount(idx, g[own], p)
            dv = np.zeros((p, RANK))
            np.add.at(dv, idx, g[own][:, None] * (s[own] - v))
            hit = np.unique(idx)
            dw, dv = dw[hit] + DECAY * m.weight[hit], dv[hit] + DECAY * m.factor[hit]
            gw[hit] += dw * dw
            gv[hit] += dv * dv
            m.weight[hit] -= RATE * dw / np.sqrt(gw[hit])
            m.factor[hit] -= RATE * dv / np.sqrt(gv[hit])
    return m


def train(docs: DataFrame, labels: DataFrame, max_train: int = MAX_TRAIN) -> Model:
    """Fit on the ``toxic`` labels of ``labels`` (``doc_id, toxic``); the caller leaves out what is held out."""
    # at most max_train rows, chosen by hash
    chosen = (labels.where("doc_id is not null and toxic is not null").select("doc_id", F.col("toxic").cast("long").alias("toxic"))
              .orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_train))
    chosen = Table(chosen, "labels").df()
    texts = docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    sample = Table(texts.join(chosen, "doc_id").select("doc_id", "toxic", "text"), "sample").df()
    totals = sample.agg(F.sum("toxic").alias("t"), F.count("*").alias("n")).first()
    n, t = totals["n"], totals["t"] or 0
    if not n or not 0 < t < n:
        rate = (t + 0.5) / (n + 2)  # below one half without labels
        return Model({}, float(np.log(rate / (1 - rate))), np.zeros(0), np.zeros((0, RANK)))
    a, b = F.col("toxic").cast("double"), F.col("clean").cast("double")
    c, d = F.lit(float(t)) - a, F.lit(float(n - t)) - b
    chi2 = n * (a * d - b * c) ** 2 / (F.greatest((a + b) * (c + d), F.lit(1.0)) * float(t) * float(n - t))
    top = (term_counts(sample).withColumn("chi2", chi2).where(F.col("chi2") >= MIN_CHI2)
           .orderBy(F.desc("chi2"), "term").limit(MAX_FEATURES).collect())
    index = {r["term"]: i for i, r in enumerate(sorted(top, key=lambda r: (-r["chi2"], r["term"])))}

    def sparse(texts: pa.Array) -> pa.Array:
        table = _Features(index)
        return pa.array([features(x.as_py(), table).tolist() for x in texts], pa.list_(pa.int32()))

    rows = sample.select("doc_id", "toxic", F.arrow_udf(sparse, "array<int>")("text").alias("x")).orderBy("doc_id").collect()
    return fit([np.array(r["x"], np.int64) for r in rows], np.array([r["toxic"] for r in rows], float), index)


def score(text_col, model: Model):
    """Probability of a text being toxic, as a column."""

    def of(texts: pa.Array) -> pa.Array:
        table = _Features(model.index)
        z = np.array([model.raw(features(x.as_py() or "", table)) for x in texts], float)
        return pa.array(1 / (1 + np.exp(-np.clip(z, -500, 500))))

    return F.arrow_udf(of, "double")(F.coalesce(text_col.cast("string"), F.lit("")))


def held_out(doc_id):
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(5)) == 0, F.lit(False))


def drop_toxic(docs: DataFrame, labels: DataFrame, threshold: float = 0.5) -> DataFrame:
    """The documents that score below the threshold, with their own columns."""
    model = train(docs, labels.where(~held_out(F.col("doc_id"))))
    return docs.where(score(docs["text"], model) < threshold)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    labels = read(spark, sf_dir, "labels").where(~held_out(F.col("doc_id")))
    model = train(docs, labels)
    return docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), score(F.col("text"), model).alias("score")).withColumn(
        "predicted", F.when(F.col("score") >= 0.5, 1).otherwise(0))
