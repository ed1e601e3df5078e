"""Quality rules: robust multivariate outliers per language and source.

Every text gets base counts and a vector of transformed statistics.  Per group (language,
source; null is a group value too) location and scatter are minimum-covariance-determinant
estimates: starting from coordinate-wise medians and their deviations, concentration steps
take the ``support`` share of rows with the least Mahalanobis distance and estimate anew, for
a fixed number of steps.  Every step is two aggregations over all rows with partial sums, so
a hot group is counted in pieces; estimates are one row a group.  A row is rejected if its
squared distance exceeds the group's limit.

Statistics of which most rows of a group share one value have no spread of their own; every
scale has a floor (``FLOORS``), added to the scatter's diagonal.  Every estimate of a group is drawn towards that of
all groups together as if ``SHRINK`` rows of these stood in the group: a small group leans on the others, a large one
on itself, with no size at which the rule changes.  Null and empty texts: no words, so
they fail the base rule; they and other rows that fail it take no part in estimates.  Long texts are counted whole.  Ties and
repeated rows: each counts.  Empty table: no rows.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidings.llm.common import WORD, Table, read

SUPPORT = 0.75
STEPS = 6
SHRINK = 50.0  # weight of all groups in the estimates of one, in rows
# the squared distance beyond which a row is rejected
LIMIT = 150.0

_SYMBOLS = re.compile(r"[#*$%&|<>]")
_MARKS = re.compile(r"[!?.,;:\"()\[\]{}/\\@_=+~^-]")
_UPPER = re.compile(r"[A-ZÀ-ÖØ-Þ]")
_DIGITS = re.compile(r"[0-9]")

COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_distinct", "n_upper", "n_digits", "n_marks",
          "n_lines"]
STATS = ["word_length", "symbols", "dup_lines", "repeats", "distinct", "upper", "digits", "marks"]
# least standard deviation of each statistic, in its transformed unit
FLOORS = dict(word_length=0.05, symbols=0.1, dup_lines=0.5, repeats=0.5, distinct=0.1, upper=0.2, digits=0.4, marks=0.25)


def text_counts(text: str) -> list[int]:
    words = WORD.findall(text)
    n = len(words)
    ids: dict[str, int] = {}
    code = np.array([ids.setdefault(w, len(ids)) for w in words], np.int64)
    repeats = 0
    if n >= 3:
        m = len(ids)
        # exact while the distinct words of one text stay below 2**21, else strings
        three = (code[:-2] * m + code[1:-1]) * m + code[2:] if m < 1 << 21 else np.array([" ".join(words[i:i + 3]) for i in range(n - 2)])
        _, which, count = np.unique(three, return_inverse=True, return_counts=True)
        again = count[which] > 1
        mark = np.zeros(n, bool)
        for i in range(3):
            mark[i:n - 2 + i] |= again
        repeats = int(mark.sum())
    lines = [x for x in text.split("\n") if WORD.search(x)]
    body = "".join(words)
    return [n, len(body), len(_SYMBOLS.findall(text)), len(lines) - len(set(lines)), repeats, len(ids),
            len(_UPPER.findall(body)), len(_DIGITS.findall(body)), len(_MARKS.findall(body)), len(lines)]


def _counts(text: pa.Array) -> pa.Array:
    rows = np.array([text_counts(t.as_py() or "") for t in text], np.int64).reshape(-1, len(COUNTS))
    return pa.StructArray.from_arrays([pa.array(c) for c in rows.T], names=COUNTS)


def with_counts(docs: DataFrame) -> DataFrame:
    """``row`` (all columns), ``lang``, ``source`` and a struct ``c`` of base counts."""
    counts = F.arrow_udf(_counts, ", ".join(f"{c} long" for c in COUNTS))
    group = [(F.col(f"row.{c}").cast("string") if c in docs.columns else F.lit(None).cast("string")).alias(c) for c in ("lang", "source")]
    return (docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"))
            .select("row", *group, counts(F.coalesce(F.col("row.text").cast("string"), F.lit(""))).alias("c")))


def base_failed(c: str = "c"):
    n, r = F.col(f"{c}.n_words"), F.col(f"{c}.n_repeat_words")
    return (n < 50) | (100 * r > 50 * n)


def statistics(c: str = "c"):
    """The transformed statistics as an array column: logarithms of rates, so that scales are relative."""
    g = lambda x: F.col(f"{c}.{x}").cast("double")
    n, chars = F.greatest(g("n_words"), F.lit(1.0)), F.greatest(g("word_chars"), F.lit(1.0))
    rate = lambda x, of: F.log1p(F.lit(20.0) * g(x) / of)
    return F.array(F.log(chars / n), rate("n_symbols", n), rate("n_dup_lines", F.greatest(g("n_lines"), F.lit(1.0))),
                   rate("n_repeat_words", n), F.log(F.greatest(g("n_distinct"), F.lit(1.0))) - F.lit(0.8) * F.log(n),
                   rate("n_upper", chars), rate("n_digits", chars), rate("n_marks", chars))


def _moments(p: int) -> list:
    x = [F.col(f"x{i}") for i in range(p)]
    return ([F.count("*").alias("n")] + [F.sum(v).alias(f"s{i}") for i, v in enumerate(x)]
            + [F.sum(x[i] * x[j]).alias(f"s{i}_{j}") for i in range(p) for j in range(i + 1)])


def _distance(p: int):
    """Squared distance of x to a group's row: with L, the rows of the whitening matrix, |L (x - m)|^2."""
    d = [F.col(f"x{i}") - F.col("m")[i] for i in range(p)]
    total = F.lit(0.0)
    for i in range(p):
        y = F.lit(0.0)
        for j in range(i + 1):
            y = y + F.col("w")[i * p + j] * d[j]
        total = total + y * y
    return total


def _estimates(p: int, floors: np.ndarray, everywhere: np.ndarray, shrink: float):
    """Moments of a group to its location and the whitening (inverse Cholesky) of its scatter.

    ``everywhere``: the moments of all groups together, of which ``shrink`` rows are added.
    """

    def of(*cols):
        a = [c.to_numpy(zero_copy_only=False).astype(float) for c in cols]
        ms, ws = [], []
        for r in zip(*a):
            mean, cov = _location(np.array(r), p)
            mean_all, cov_all = _location(everywhere, p)
            share = r[0] / (r[0] + shrink)
            mean, cov = share * mean + (1 - share) * mean_all, share * cov + (1 - share) * cov_all
            ms.append(mean)
            ws.append(np.linalg.inv(np.linalg.cholesky(cov + np.diag(floors ** 2))).ravel())
        return pa.StructArray.from_arrays([pa.array([m.tolist() for m in ms], pa.list_(pa.float64())),
                                           pa.array([w.tolist() for w in ws], pa.list_(pa.float64()))], names=["m", "w"])

    return F.arrow_udf(of, "m array<double>, w array<double>")


def _location(r: np.ndarray, p: int) -> tuple[np.ndarray, np.ndarray]:
    """Mean and covariance from a row of moments."""
    n = max(r[0], 1.0)
    mean = r[1:p + 1] / n
    cov = np.zeros((p, p))
    cov[np.tril_indices(p)] = r[p + 1:] / n
    cov = cov + np.tril(cov, -1).T - np.outer(mean, mean)
    return mean, cov


def judge(docs: DataFrame, support: float = SUPPORT, steps: int = STEPS, shrink: float = SHRINK, limit: float = LIMIT) -> DataFrame:
    """``row, c`` with ``base_failed``, ``distance`` (null where the base rule failed) and ``kept``."""
    p, floors = len(STATS), np.array([FLOORS[s] for s in STATS])
    c = Table(with_counts(docs), "counts").df()
    stats = statistics()
    group = F.to_json(F.struct("lang", "source"))
    xs = [f"x{i}" for i in range(p)]
    vec = Table(c.where(~base_failed()).select(group.alias("g"), *[stats[i].alias(x) for i, x in enumerate(xs)]), "vectors").df()

    def joined(rows: DataFrame, est: DataFrame) -> DataFrame:
        return rows.join(est.withColumnRenamed("g", "_g"), F.col("g") == F.col("_g")).drop("_g")

    # the start: medians and spreads of each group, leaning on those of all groups
    mid = Table(vec.groupBy("g").agg(F.count("*").alias("n"), *[
        F.percentile_approx(x, F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75)), 1000).alias(f"q{i}") for i, x in enumerate(xs)]), "quartiles").df()
    middle = [F.col(f"q{i}")[1] for i in range(p)]
    wide = [F.greatest((F.col(f"q{i}")[2] - F.col(f"q{i}")[0]) / 1.349, F.lit(float(floors[i]))) for i in range(p)]
    total = F.sum("n")
    all_ = mid.agg(*[(F.sum(F.col("n") * v) / total).alias(f"v{i}") for i, v in enumerate(middle + wide)]).first()  # one row
    if all_[0] is None:  # no row passes the base rule
        return c.select("row", "c", base_failed().alias("base_failed"), F.lit(None).cast("double").alias("distance"), F.lit(False).alias("kept"))
    share = F.col("n") / (F.col("n") + shrink)
    lean = [share * v + (1 - share) * F.lit(all_[i]) for i, v in enumerate(middle + wide)]
    est = mid.select("g", F.array(*lean[:p]).alias("m"),
                     F.array(*[(1 / lean[p + i]) if i == j else F.lit(0.0) for i in range(p) for j in range(p)]).alias("w"))
    names = ["n"] + [f"s{i}" for i in range(p)] + [f"s{i}_{j}" for i in range(p) for j in range(i + 1)]
    for _ in range(steps):
        d = joined(vec, est).select("g", *xs, _distance(p).alias("d"))
        cut = Table(d.groupBy("g").agg(F.percentile_approx("d", support, 1000).alias("cut")), "cuts").df()
        inner = Table(joined(d, cut).where("d <= cut").groupBy("g").agg(*_moments(p)), "moments").df()
        everywhere = np.array(inner.agg(*[F.sum(x).cast("double") for x in names]).first(), float)  # one row
        est = inner.select("g", _estimates(p, floors, everywhere, shrink)(*names).alias("f")).select("g", "f.m", "f.w")
        est = Table(est, "estimates").df()
    # consistency: the median squared distance of a group is made that of the chi-square distribution
    median = float(p) * (1 - 2 / (9 * p)) ** 3  # Wilson-Hilferty
    scale = Table(joined(vec, est).select("g", _distance(p).alias("d")).groupBy("g").agg(
        F.count("*").alias("n"), (F.percentile_approx("d", 0.5, 1000) / median).alias("scale")), "scales").df()
    all_scale = scale.agg(F.sum(F.col("n") * F.col("scale")) / total).first()[0]  # one number
    scale = scale.select("g", F.greatest(share * F.col("scale") + (1 - share) * F.lit(all_scale), F.lit(1.0)).alias("scale"))
    final = Table(joined(est, scale), "final").df().withColumnRenamed("g", "_g")
    rows = c.select("row", "c", group.alias("g"), *[stats[i].alias(x) for i, x in enumerate(xs)])
    j = rows.join(final, F.col("g") == F.col("_g"), "left")
    dist = F.when(~base_failed(), _distance(p) / F.col("scale"))
    return j.select("row", "c", base_failed().alias("base_failed"), dist.alias("distance")).withColumn(
        "kept", ~F.col("base_failed") & F.coalesce(F.col("distance") <= limit, F.lit(True)))


def keep_good(docs: DataFrame, **parameters) -> DataFrame:
    """The documents that pass, with their own columns."""
    return judge(docs, **parameters).where("kept").select("row.*")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    return judge(docs).select("row.doc_id", *[F.col(f"c.{c}") for c in COUNTS[:5]], "base_failed", "kept", "distance")
