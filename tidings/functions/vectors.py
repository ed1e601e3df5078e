"""Dense-vector column expressions (array<double>), all JVM-side."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def dot(a, b) -> Column:
    return F.aggregate(F.zip_with(_c(a), _c(b), lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)


def scale(v, s) -> Column:
    s = _c(s)
    return F.transform(_c(v), lambda x: x * s)


def add(a, b) -> Column:
    return F.zip_with(_c(a), _c(b), lambda x, y: x + y)


def outer(v) -> Column:
    v = _c(v)
    return F.transform(v, lambda b: F.transform(v, lambda c: b * c))


def squared_norm(v) -> Column:
    return F.aggregate(_c(v), F.lit(0.0), lambda s, x: s + x * x)


def init_vector(key, k: int, seed: int = 1, mode: str = "hash") -> Column:
    """Deterministic initial factors with entries in {0, .1, ..., .9}.

    ``mode="arith"``: ((key*7 + d*3 + seed) mod 10) * 0.1 — reproducible by
    integer SQL, period 10 in key and in d, so meant for k <= 2 oracle runs.
    ``mode="hash"``: (xxhash64(key, d, seed) mod 10) * 0.1 — the default.
    """
    key = _c(key)
    dims = F.sequence(F.lit(0), F.lit(k - 1))
    if mode == "arith":
        return F.transform(dims, lambda d: F.pmod(key * 7 + d * 3 + F.lit(seed), F.lit(10)) * F.lit(0.1))
    if mode == "hash":
        return F.transform(dims, lambda d: F.pmod(F.xxhash64(key, d, F.lit(seed)), F.lit(10)) * F.lit(0.1))
    raise ValueError(f"unknown init mode {mode!r}")
