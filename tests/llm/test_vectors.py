"""Whitening, hard negatives and near duplicates of embeddings."""

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from llm_paths import SF001, SF01
from pyspark.sql import functions as F

from tidings.llm import common, hyperplane_tree, jacobi_davidson, projection_passes

ODD = [(None, [1.0, 2.0, 3.0]), (900, None), (901, [1.0, None, 2.0]), (902, [1.0, float("nan"), 0.0]), (903, [float("inf"), 1.0, 2.0]),
       (904, [2.0, 2.0]), (905, []), (906, [0.0, 0.0, 0.0])]


@pytest.mark.parametrize("dim, k", [(1, 4), (7, 7), (40, 12), (260, 32)])
def test_eigenpairs_of_a_matrix_free_product(dim, k):
    rng = np.random.default_rng(dim)
    a = rng.standard_normal((2 * dim, dim)) * np.linspace(0.5, 2, dim)
    v = a.T @ a / len(a)
    e, x = jacobi_davidson.eigenpairs(lambda b: v @ b, dim, k)
    want = np.linalg.eigvalsh(v)[::-1][:k]
    assert np.abs(e - want).max() < 1e-12 * want[0] * dim
    assert np.linalg.norm(v @ x - x * e, axis=0).max() <= 20 * dim * np.finfo(float).eps * want[0]
    assert np.abs(x.T @ x - np.eye(len(e))).max() < 1e-13


def test_eigenpairs_with_ties_and_zeros():
    d = np.array([5.0, 5, 5, 3, 3, 1, 0, 0])
    e, x = jacobi_davidson.eigenpairs(lambda b: d[:, None] * b, 8, 6)
    assert np.allclose(e, d[:6], atol=1e-13) and np.allclose(x.T @ x, np.eye(6), atol=1e-13)
    assert not jacobi_davidson.eigenpairs(lambda b: 0 * b, 8, 3)[0].any()


def test_minres_solves_all_columns():
    rng = np.random.default_rng(3)
    a = rng.standard_normal((20, 20))
    a = a + a.T
    b = rng.standard_normal((20, 4))
    b[:, 3] = 0
    assert np.allclose(jacobi_davidson._minres(lambda v: a @ v, b, 60), np.linalg.solve(a, b), atol=1e-6)


def _whitened(rows, k=32):
    """Brute force over (id, vector) rows of one length."""
    x = np.array([[int(np.floor(64 * float(np.float32(c)))) + 1_000_000 for c in v] for _, v in rows], object)
    n, s = len(x), x.sum(0)
    c = ((x * n - s) / n).astype(float)
    e, u = np.linalg.eigh(c.T @ c / n)
    e, u = e[::-1][:k], u[:, ::-1][:, :k]
    use = e > 1e-11 * e[0]
    return ((x * n - s) ** 2).sum(1), c @ u[:, use] / np.sqrt(e[use]), e[use] / (c * c).sum() * n


def _check_whitening(found, rows, k=32):
    dev, white, explained = _whitened(rows, k)
    comps = white.shape[1]
    assert len(found) == len(rows) * comps
    assert sorted({r["component"] for r in found}) == list(range(1, comps + 1))
    per = {}
    for r in found:
        assert r["n"] == len(rows) and r["identity_error"] < 1e-9 and abs(r["explained"] / explained[r["component"] - 1] - 1) < 1e-9
        per.setdefault(r["vec_id"], []).append(r)
    want = sorted(((i, int(d), tuple(np.round(np.abs(w), 5))) for (i, _), d, w in zip(rows, dev, white)), key=repr)
    got = []
    for i, rs in per.items():
        copies = len(rs) // comps
        rs = sorted(rs, key=lambda r: r["component"])
        for j in range(copies):
            own = rs[j::copies]
            got.append((i, own[0]["deviation"], tuple(np.round(np.abs([r["whitened"] for r in own]), 5))))
    assert [g[:2] for g in sorted(got, key=repr)] == [w[:2] for w in want]
    for g, w in zip(sorted(got, key=repr), want):
        assert np.allclose(g[2], w[2], atol=2e-5)


def test_whitening_against_brute_force(spark):
    rows = [(r["vec_id"], r["embedding"]) for r in common.read(spark, SF001, "embeddings").collect()]
    _check_whitening(jacobi_davidson.query(spark, SF001).collect(), rows)


def test_whitening_of_odd_rows(spark):
    """Nulls, other lengths, repeated rows, rows without an id, clashing column names, rank below the length."""
    rng = np.random.default_rng(12)
    rows = [(i, [float(x) for x in rng.normal(0, 1, 2)]) for i in range(60)]
    rows = [(i, [a, b, a + b]) for i, (a, b) in rows] + [(60, [0.5, 0.25, 0.75])] * 5
    all_rows = [(*r, 1, "k", 2.0) for r in rows + ODD]
    df = spark.createDataFrame(all_rows, "vec_id long, embedding array<float>, n long, kind string, x double")
    part = rows + [(None, [1.0, 2.0, 3.0]), (906, [0.0, 0.0, 0.0])]
    _check_whitening(jacobi_davidson.whiten(df).collect(), part)
    assert jacobi_davidson.whiten(df.limit(0)).count() == 0
    same = spark.createDataFrame([(i, [1.0, 2.0]) for i in range(5)], "vec_id long, embedding array<double>")
    assert jacobi_davidson.whiten(same).count() == 0


def test_deviation_that_fits_no_long(spark):
    rows = [(i, [1e9 * i, float(i % 3)]) for i in range(40)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = jacobi_davidson.whiten(df, components=1).collect()
    x = [[int(64 * a) + 1_000_000, 64 * int(b) + 1_000_000] for _, (a, b) in rows]
    s = [sum(r[d] for r in x) for d in (0, 1)]
    want = [sum((40 * r[d] - s[d]) ** 2 for d in (0, 1)) for r in x]
    assert [r["deviation"] for r in sorted(found, key=lambda r: r["vec_id"])] == [w if w < 1 << 63 else None for w in want]
    assert any(w >= 1 << 63 for w in want)


def test_products_of_many_tasks_are_merged(spark):
    df = common.read(spark, SF001, "embeddings").repartition(80)
    fit = jacobi_davidson.FitList(df)
    fit.tasks = 80
    b = np.eye(fit.dim)[:, :3]
    rows = [r["embedding"] for r in df.collect()]
    x = np.floor(64 * np.array(rows, np.float64))
    assert np.allclose(fit.product(b), np.cov(x.T, bias=True)[:, :3], atol=1e-9)


def _mined(rows, is_anchor):
    """Brute force over (id, label, vector) rows."""
    part = [(i, b, tuple(int(np.floor(256 * float(np.float32(c)))) for c in v)) for i, b, v in rows
            if i is not None and b is not None and v is not None and None not in v and np.isfinite(v).all()]
    out = []
    for i, b, q in {p for p in part if is_anchor(p[0])}:
        near = sorted((-sum(x * y for x, y in zip(q, v)), j, lab) for j, lab, v in part if j != i and len(v) == len(q))
        for s, j, _ in [n for n in near if n[2] == b][:5]:
            far = [n for n in near if n[2] != b and -30 * s <= -100 * n[0] <= -90 * s][:10]
            out += [(i, j, r + 1, f[1], -s, -f[0]) for r, f in enumerate(far)]
    return sorted(out)


def test_negatives_against_sql(spark):
    con = duckdb.connect()
    con.execute(f"create view embeddings as select * from '{SF01}/embeddings.parquet'")
    found = sorted(map(tuple, hyperplane_tree.query(spark, SF01).collect()))
    assert found == sorted(con.execute(hyperplane_tree.ORACLE).fetchall()) and found


def test_negatives_of_odd_rows(spark, monkeypatch):
    """Many cells and shards; nulls, ties, repeated rows and anchors, other lengths, clashing column names."""
    monkeypatch.setattr(hyperplane_tree, "CELL_ROWS", 12)
    monkeypatch.setattr(hyperplane_tree, "SHARD_ROWS", 9)
    monkeypatch.setattr(hyperplane_tree, "BLOCK_QUERIES", 16)
    rng = np.random.default_rng(21)
    centres = rng.normal(0, 1, (6, 5))
    rows = [(i, int(rng.integers(0, 4)), [float(x) for x in np.round(centres[i % 6] + rng.normal(0, 0.2, 5), 2)]) for i in range(150)]
    rows += [(200 + i, i % 3, [1.0, 0.5, 0.25, 0.5, 1.0]) for i in range(40)]  # ties
    rows += [(100, 1, [1.0, 1.0, 0.0, 0.0, 0.0])] * 3 + [(300, 1, [0.0] * 5), (400, 2, [1.0, 2.0]), (401, 2, [2.0, 1.0]), (402, 1, [1.0, 1.0])]
    rows += [(500, None, [1.0] * 5), (None, 1, [1.0] * 5), (600, 1, None), (700, 1, [1.0, None, 1.0, 1.0, 1.0]), (800, 1, [float("inf")] * 5), (900, 1, [])]
    df = spark.createDataFrame([(*r, 1, 2, 3) for r in rows], "vec_id long, label int, embedding array<float>, cell int, shard int, q int")
    found = sorted(map(tuple, hyperplane_tree.hard_negatives(df, F.col("vec_id") % 20 == 0).collect()))
    assert found == _mined(rows, lambda i: i % 20 == 0) and len(found) > 50
    assert hyperplane_tree.hard_negatives(df.limit(0), F.col("vec_id") % 20 == 0).count() == 0


def test_tree_rules_out_siblings_and_stays_exact():
    rng = np.random.default_rng(5)
    centres = rng.integers(-900, 900, (30, 6))
    x = centres[rng.integers(0, 30, 6000)] + rng.integers(-20, 20, (6000, 6))
    labels, ids = rng.integers(0, 4, 6000), np.arange(6000)
    most2 = float((x.astype(float) ** 2).sum(1).max())
    for kind in (float, np.int64):
        tree = hyperplane_tree.Tree(x.astype(kind), ids, labels, most2)
        q, own, label = x[:40].astype(kind), ids[:40], labels[:40]
        first = (q * q).sum(1).astype(np.int64)
        for same, floor, ceiling in ((True, np.full(40, -2 ** 62), np.full(40, 2 ** 62)), (False, first * 30 // 100, first * 90 // 100)):
            top, top_id, n = tree.search(q, own, label, np.full(40, same), floor, ceiling, 5)
            for i in range(40):
                score = (x @ x[i]).astype(np.int64)
                ok = ((labels == label[i]) == same) & (ids != i) & (score >= floor[i]) & (score <= ceiling[i])
                want = sorted(np.flatnonzero(ok), key=lambda j: (-score[j], j))[:5]
                assert top_id[i][:n[i]].tolist() == want and [int(s) for s in top[i][:n[i]]] == [int(score[j]) for j in want]
        assert tree.visited < 0.7 * 80 * len(tree.span)


def test_equal_vectors_make_one_leaf():
    x = np.ones((5000, 3))
    tree = hyperplane_tree.Tree(x, np.arange(5000), np.zeros(5000, np.int64), 3.0)
    top, ids, n = tree.search(x[:1], np.array([0]), np.array([0]), np.array([True]), np.array([-9]), np.array([9]), 5)
    assert len(tree.span) == 1 and ids[0].tolist() == [1, 2, 3, 4, 5] and n.tolist() == [5]


def _linked(rows, cosine=0.9):
    """Brute force over (id, vector) rows: (id, links, component, kept)."""
    vec = []
    for _, v in rows:
        ok = v is not None and len(v) and None not in v and np.isfinite(v).all() and any(v)
        vec.append(np.array([float(np.float32(c)) for c in v]) if ok else None)
    near = [[j for j in range(len(rows)) if vec[i] is not None and vec[j] is not None and len(vec[i]) == len(vec[j])
             and vec[i] @ vec[j] / (np.linalg.norm(vec[i]) * np.linalg.norm(vec[j])) >= cosine] for i in range(len(rows))]
    out = []
    for i, (vec_id, _) in enumerate(rows):
        seen, todo = {i}, [i]
        while todo:
            for j in near[todo.pop()]:
                if j not in seen:
                    seen.add(j)
                    todo.append(j)
        ids = [rows[j][0] for j in seen if rows[j][0] is not None]
        component = min(ids) if ids and vec[i] is not None else vec_id
        out.append((vec_id, max(0, len(near[i]) - 1), component, vec_id is not None and vec_id == component))
    return sorted(out, key=repr)


def _planted(n, groups, dim=16, seed=31):
    """Vectors far from each other, and groups around a centre."""
    rng = np.random.default_rng(seed)
    rows = [rng.standard_normal(dim) for _ in range(n)]
    for size, spread in groups:
        centre = rng.standard_normal(dim)
        rows += [centre + spread * rng.standard_normal(dim) for _ in range(size)]
    return [(i, [float(x) for x in v]) for i, v in enumerate(rows)]


def test_near_vectors_of_odd_rows(spark, monkeypatch):
    """Blocks smaller than the groups; nulls, zeros, lengths, repeated rows and ids, huge and tiny entries, clashing column names."""
    monkeypatch.setattr(projection_passes, "BLOCK", 16)
    rows = _planted(60, [(70, 0.05), (60, 0.25), (50, 0.33), (2, 0.1), (3, 0.2)])
    rows += [(1000 + i, rows[0][1]) for i in range(40)] + [(0, rows[0][1])] * 2 + [(5, rows[70][1]), (None, rows[1][1]), (None, rows[1][1])]
    rows += [(2000, [c * 1e30 for c in rows[2][1]]), (2001, [c * 1e-30 for c in rows[2][1]]), (2002, [0.0] * 16), (2003, [0.0] * 16)]
    rows += [(2010, [1.0, 2.0]), (2011, [2.0, 4.0])] + ODD
    df = spark.createDataFrame([(*r, 1, b"c", 3) for r in rows], "vec_id long, embedding array<float>, dim int, cid binary, links int")
    found = sorted(map(tuple, projection_passes.near_duplicates(df).collect()), key=repr)
    want = _linked(rows)
    same = sum(f == w for f, w in zip(found, want))
    assert len(found) == len(want) and same == len(want), [x for x in zip(found, want) if x[0] != x[1]][:5]
    assert projection_passes.near_duplicates(df.limit(0)).count() == 0


def test_near_vectors_of_the_given_table(spark):
    """No link is reported below the threshold, at least nine of ten are found."""
    rows = [(r["vec_id"], r["embedding"]) for r in common.read(spark, SF001, "embeddings").collect()]
    rows += [(1000 + i, [float(c) for c in np.array(v) + np.random.default_rng(i).normal(0, 0.05, len(v))]) for i, v in rows[:200]]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    found = {r["vec_id"]: r for r in projection_passes.near_duplicates(df).collect()}
    want = {w[0]: w for w in _linked(rows)}
    assert all(found[i]["n_links"] <= want[i][1] for i in want)
    assert sum(r["n_links"] for r in found.values()) >= 0.9 * sum(w[1] for w in want.values()) > 100


def test_balls_prove_whole_blocks():
    rng = np.random.default_rng(2)
    limit = projection_passes.COSINE
    udf = projection_passes._verdicts(limit).func
    for spread, gap in ((0.02, 0.05), (0.1, 0.3), (0.1, 3.0), (0.3, 0.3)):
        c = rng.standard_normal(8)
        x = c + spread * rng.standard_normal((30, 8))
        y = c + gap * rng.standard_normal(8) + spread * rng.standard_normal((30, 8))
        balls = []
        for m in (x, y):
            u = m / np.linalg.norm(m, axis=1)[:, None]
            centre = u.mean(0) / np.linalg.norm(u.mean(0))
            balls.append((centre.tobytes(), float(np.arccos(np.clip(u @ centre, -1, 1)).max())))
        verdict = udf(*[pa.array([b[i]]) for i in (0, 1) for b in balls])[0].as_py()
        near = projection_passes._cosines(x, y) >= limit
        assert verdict == 0 or (verdict == 1 and near.all()) or (verdict == -1 and not near.any())


def test_estimates_are_bounded():
    rng = np.random.default_rng(7)
    u = rng.standard_normal((300, 24))
    u /= np.linalg.norm(u, axis=1)[:, None]
    q, step, rest = projection_passes.small(u)
    z = q * step[:, None]
    assert (np.abs(z @ z.T - u @ u.T) <= rest[:, None] + rest + 3 * rest[:, None] * rest + 1e-12).all()


def test_passes_grow_with_the_table():
    assert projection_passes.passes(1) >= 2 and projection_passes.passes(50_000) < projection_passes.passes(10 ** 9) < 300
