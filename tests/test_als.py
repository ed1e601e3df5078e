import re
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from tidings.operators import als
from tidings.sources.tables import ratings_from_events, ratings_from_orders

from data_paths import SF001, SF01


def _as_dict(df):
    return {r.id: np.array(r.f) for r in df.collect()}


def test_hand_example_solves_correctly(spark):
    # sum v v^T = [[2,1],[1,3]] and sum r v = (1, 0): the solution is (3/5, -1/5)
    r = spark.createDataFrame([(1, 10, 0.0), (1, 11, 1.0), (1, 12, 0.0)], "user_id long, article_id long, rating double")
    v = spark.createDataFrame([(10, [1.0, 1.0]), (11, [1.0, 0.0]), (12, [0.0, 2 ** 0.5])], "id long, f array<double>")
    side = als.layout_side(r, "user_id", "article_id")
    x = _as_dict(als.half_step(side, v, 2, lam=0.0, n_fixed=3))[1]
    assert np.allclose(x, [0.6, -0.2], atol=1e-12)


def test_duplicate_ratings_count_twice(spark):
    r1 = spark.createDataFrame([(1, 10, 1.0), (1, 10, 1.0)], "user_id long, article_id long, rating double")
    r2 = spark.createDataFrame([(1, 10, 1.0)], "user_id long, article_id long, rating double")
    v = spark.createDataFrame([(10, [1.0])], "id long, f array<double>")
    a = _as_dict(als.half_step(als.layout_side(r1, "user_id", "article_id"), v, 1, 0.1, 1))[1][0]
    b = _as_dict(als.half_step(als.layout_side(r2, "user_id", "article_id"), v, 1, 0.1, 1))[1][0]
    assert a == pytest.approx(2 / 2.1) and b == pytest.approx(1 / 1.1)


def test_residual_k35_and_objective_decreases(spark):
    r = ratings_from_orders(spark, SF01)
    hist = []
    m = als.train(r, k=35, iterations=3, history=hist)
    assert all(b <= a + 1e-9 for a, b in zip(hist, hist[1:])), hist
    # user factors solve their normal equations against the final article factors' predecessor:
    # check the last article half-step against the final user factors instead (exact by construction)
    res = als.normal_equation_residual(r, "article_id", "user_id", m.articles, m.users, 0.1)
    assert res < 1e-8


def test_residuals_by_block_equal_plain_ones(spark):
    """Whole and salted keys against numpy; no rating becomes a row per entry."""
    r = ratings_from_events(spark, SF001)
    m = als.train(r, k=5, iterations=1)
    off = m.users.selectExpr("id", "transform(f, x -> x + id * 1e-3) as f")  # not the solution
    users, articles = _as_dict(off), _as_dict(m.articles)
    want = {u: 0.1 * x for u, x in users.items()}
    for u, a, y in r.select("user_id", "article_id", "rating").collect():
        want[u] = want[u] + articles[a] * (articles[a] @ users[u] - y)
    for rows_per_group in (1_000_000, 3):
        res = als.normal_equation_residuals(r, "user_id", "article_id", off, m.articles, 0.1, rows_per_group=rows_per_group)
        assert "posexplode" not in _executed_plan(res)
        got = {row["id"]: row["residual"] for row in res.collect()}
        assert got.keys() == want.keys()
        assert all(abs(got[u] - np.abs(want[u]).max()) < 1e-9 for u in want)


def test_hot_key_path_equals_plain_path(spark):
    r = ratings_from_events(spark, SF001)
    plain = als.train(r, k=4, iterations=2)
    salted = als.train(r, k=4, iterations=2, rows_per_group=3)  # every key is hot
    a, b = _as_dict(plain.users), _as_dict(salted.users)
    assert a.keys() == b.keys()
    assert max(np.abs(a[k] - b[k]).max() for k in a) < 1e-9
    a, b = _as_dict(plain.articles), _as_dict(salted.articles)
    assert max(np.abs(a[k] - b[k]).max() for k in a) < 1e-9


def test_shuffle_join_path_equals_broadcast_path(spark):
    r = ratings_from_events(spark, SF001)
    bc = als.train(r, k=3, iterations=1)
    sh = als.train(r, k=3, iterations=1, max_broadcast_bytes=0)
    a, b = _as_dict(bc.users), _as_dict(sh.users)
    assert a.keys() == b.keys() and max(np.abs(a[k] - b[k]).max() for k in a) < 1e-12


def test_normal_equation_terms(spark):
    r = spark.createDataFrame([(1, 10, 0.5), (1, 11, 2.0), (2, 10, 1.0)], "user_id long, article_id long, rating double")
    v = spark.createDataFrame([(10, [1.0, 2.0]), (11, [3.0, 0.0])], "id long, f array<double>")
    t = {row.id: row.terms for row in als.normal_equation_terms(r, v, "user_id", "article_id", 2).collect()}
    assert t[1] == pytest.approx([10.0, 2.0, 4.0, 6.5, 1.0])
    assert t[2] == pytest.approx([1.0, 2.0, 4.0, 1.0, 2.0])


def test_article_without_factor_is_dropped(spark):
    r = spark.createDataFrame([(1, 10, 1.0), (1, 99, 1.0)], "user_id long, article_id long, rating double")
    v = spark.createDataFrame([(10, [1.0])], "id long, f array<double>")
    x = _as_dict(als.half_step(als.layout_side(r, "user_id", "article_id"), v, 1, 0.1, 1))
    assert x[1][0] == pytest.approx(1 / 1.1)
    assert als.init_factors(r, "article_id", 3).where(F.size("f") != 3).count() == 0


def test_block_path_with_hot_keys_equals_plain(spark):
    r = ratings_from_events(spark, SF001)
    plain = als.train(r, k=3, iterations=2)
    both = als.train(r, k=3, iterations=2, rows_per_group=3, max_broadcast_bytes=0)
    a, b = _as_dict(plain.articles), _as_dict(both.articles)
    assert a.keys() == b.keys() and max(np.abs(a[k] - b[k]).max() for k in a) < 1e-9


def _executed_plan(df):
    df.write.format("noop").mode("overwrite").save()
    return df._jdf.queryExecution().executedPlan().toString()


def test_half_step_plans_never_shuffle_the_ratings(spark):
    from tidings.session import materialize
    r = ratings_from_events(spark, SF001)
    side = als.layout_side(r, "user_id", "article_id")
    v = materialize(als.init_factors(r, "article_id", 3), "factors")
    broadcast_plan = _executed_plan(als._solved_or_packed(side, v, 3, 0.1, 100, als.DEFAULT_MAX_BROADCAST_BYTES))
    assert "Exchange hashpartitioning" not in broadcast_plan
    block_plan = _executed_plan(als._solved_or_packed(side, v, 3, 0.1, 100, 0))
    shuffled = [line for line in block_plan.splitlines() if "Exchange hashpartitioning" in line]
    assert shuffled and all("_blk" in line or "_fid" in line for line in shuffled), shuffled


def test_small_blocks_equal_default_blocks(spark):
    r = ratings_from_events(spark, SF001)
    a = _as_dict(als.train(r, k=3, iterations=1).users)
    b = _as_dict(als.train(r, k=3, iterations=1, rows_per_block=200, rows_per_group=150).users)
    assert a.keys() == b.keys() and max(np.abs(a[k] - b[k]).max() for k in a) < 1e-9


def _shuffles(spark):
    """Shuffles that have files on this machine's disk."""
    blocks = spark.sparkContext._jsc.sc().env().blockManager().diskBlockManager().getAllBlocks().mkString(" ")
    return set(re.findall(r"shuffle_(\d+)_", blocks))


def test_block_plan_in_waves_equals_one_cogroup_and_keeps_no_shuffle(spark, monkeypatch):
    """Copies beyond the bound are dealt wave by wave: same factors and residuals, whole and salted keys; no shuffle stays on disk."""
    r = ratings_from_events(spark, SF001)
    m = als.train(r, k=3, iterations=1)
    off = m.users.selectExpr("id", "transform(f, x -> x + id * 1e-3) as f")  # not the solution

    def residuals(rows_per_group):
        side = als.layout_side(r, "user_id", "article_id", rows_per_group, rows_per_block=20)
        res = als.normal_equation_residuals(r, "user_id", "article_id", off, m.articles, 0.1, side=side)
        return side, {row["id"]: row["residual"] for row in res.collect()}

    for rows_per_group in (1_000_000, 3):
        monkeypatch.setattr(als, "DEFAULT_WAVE_BYTES", 1024 ** 3)
        one = als.train(r, k=3, iterations=2, rows_per_block=20, rows_per_group=rows_per_group, max_broadcast_bytes=0)
        side, want = residuals(rows_per_group)
        assert side.waves(1) == [(0, side.blocks)]
        monkeypatch.setattr(als, "DEFAULT_WAVE_BYTES", 1)
        waves = side.waves(10 ** 6)
        assert len(waves) > 1 and [b for lo, hi in waves for b in range(lo, hi)] == list(range(side.blocks))
        before = _shuffles(spark)
        many = als.train(r, k=3, iterations=2, rows_per_block=20, rows_per_group=rows_per_group, max_broadcast_bytes=0)
        assert _shuffles(spark) <= before
        for a, b in ((one.users, many.users), (one.articles, many.articles)):
            a, b = _as_dict(a), _as_dict(b)
            assert a.keys() == b.keys() and max(np.abs(a[k] - b[k]).max() for k in a) < 1e-9
        got = residuals(rows_per_group)[1]
        assert got.keys() == want.keys() and all(abs(got[u] - want[u]) < 1e-9 for u in want)


def test_blocks_stay_within_the_bucket_limit(spark, monkeypatch):
    """More blocks than Spark allows buckets: fewer, larger ones, worked off in tiles, same factors."""
    r = ratings_from_events(spark, SF001)
    a = _as_dict(als.train(r, k=3, iterations=1).users)
    spark.conf.set("spark.sql.sources.bucketing.maxBuckets", "4")
    monkeypatch.setattr(als, "_TILE_ROWS", 16)
    monkeypatch.setattr(als, "_TILE_KEYS", 3)
    try:
        side = als.layout_side(r, "user_id", "article_id", rows_per_block=1)
        assert side.blocks == 4
        side.release()
        for size in (als.DEFAULT_MAX_BROADCAST_BYTES, 0):
            b = _as_dict(als.train(r, k=3, iterations=1, rows_per_block=1, max_broadcast_bytes=size).users)
            assert a.keys() == b.keys() and max(np.abs(a[k] - b[k]).max() for k in a) < 1e-9
    finally:
        spark.conf.unset("spark.sql.sources.bucketing.maxBuckets")


def test_superseded_files_are_deleted(spark):
    import os

    from tidings.session import checkpoint_dir
    root = os.path.join(checkpoint_dir(spark).removeprefix("file:"), "tables")
    before = set(os.listdir(root)) if os.path.isdir(root) else set()
    m = als.train(ratings_from_events(spark, SF001), k=3, iterations=3)
    assert len({x for x in set(os.listdir(root)) - before if x.startswith(("factors", "tidings_layout", "needs"))}) == 2
    assert m.users.count() > 0 and m.articles.count() > 0


def test_salts_follow_from_the_row(spark):
    """Two evaluations of a salted layout agree row by row."""
    r = ratings_from_events(spark, SF001)
    side = als.layout_side(r, "user_id", "article_id", rows_per_group=50, checkpoint=False)
    assert sorted(map(tuple, side.data.collect())) == sorted(map(tuple, side.data.repartition(3).collect()))


@settings(max_examples=50, deadline=None)
@given(n=st.integers(1, 80), n_keys=st.integers(1, 12), k=st.integers(1, 5), seed=st.integers(0, 10_000))
def test_solve_runs_property(n, n_keys, k, seed):
    rng = np.random.default_rng(seed)
    keys = rng.integers(-n_keys, n_keys, n).astype(np.int64)
    salts = rng.integers(0, 2, n).astype(np.int32)
    hot_keys = set(rng.choice(np.unique(keys), size=min(2, len(np.unique(keys))), replace=False).tolist())
    hot = np.array([x in hot_keys for x in keys])
    fm = rng.normal(size=(n, k))
    r = rng.normal(size=n)
    lam = 0.1
    iu = np.triu_indices(k)
    out = als._solve_runs(keys, salts, hot, np.arange(n), fm, r, k, lam, iu).to_pylist()
    assert len(out) == len({(a, b) for a, b in zip(keys, salts)})
    for row in out:
        sel = (keys == row["id"]) & (salts == row["salt"])
        g, b = fm[sel].T @ fm[sel], fm[sel].T @ r[sel]
        assert row["hot"] == (row["id"] in hot_keys)
        if row["hot"]:
            assert np.allclose(row["x"], np.concatenate([g[iu], b]))
        else:
            assert np.allclose(row["x"], np.linalg.solve(g + lam * np.eye(k), b))


class _Sent:
    """Stands for broadcast factors."""

    def __init__(self, fid, fmat):
        self.value = fid, fmat


def _block_batches(keys, salts, hot, other, rating, sizes):
    cols = [pa.array(keys, pa.int64()), pa.array(salts, pa.int32()), pa.array(hot, pa.bool_()), pa.array(other, pa.int64()), pa.array(rating)]
    b = pa.RecordBatch.from_arrays(cols, names=["user_id", "salt", "hot", "article_id", "rating"])
    start = 0
    for n in sizes:
        yield b.slice(start, n)
        start += n
    yield b.slice(start)


@settings(max_examples=60, deadline=None)
@given(n=st.integers(0, 80), n_keys=st.integers(1, 12), k=st.integers(1, 5), tile=st.integers(1, 20), seed=st.integers(0, 10_000))
def test_streamed_block_equals_whole_block(n, n_keys, k, tile, seed):
    """However a block is cut into batches and tiles, each run comes out once with the same sums."""
    rng = np.random.default_rng(seed)
    keys, salts = rng.integers(-n_keys, n_keys, n), rng.integers(0, 3, n)
    order = np.lexsort((salts, keys))
    keys, salts, hot = keys[order], salts[order], keys[order] % 3 == 0
    other, r = rng.integers(0, 9, n), rng.normal(size=n)
    fid = np.sort(rng.choice(9, 6, replace=False))
    fmat = rng.normal(size=(6, k))
    iu = np.triu_indices(k)
    block = pa.Table.from_batches(list(_block_batches(keys, salts, hot, other, r, [])))
    want = {(x["id"], x["salt"]): x for x in als._look_up(block, fid, fmat, "user_id", "article_id", k, 0.1, iu).to_pylist()}
    was, als._TILE_ROWS = als._TILE_ROWS, tile
    try:
        sizes = rng.integers(0, 9, 12).tolist()
        parts = als._stream_kernel(_Sent(fid, fmat), "user_id", "article_id", k, 0.1)(_block_batches(keys, salts, hot, other, r, sizes))
        got = [x for p in parts for x in p.to_pylist()]
    finally:
        als._TILE_ROWS = was
    assert len(got) == len(want)
    for x in got:
        w = want[x["id"], x["salt"]]
        assert x["hot"] == w["hot"] and np.allclose(x["x"], w["x"])


def test_streamed_block_needs_the_order_of_keys():
    parts = als._stream_kernel(_Sent(np.arange(3), np.ones((3, 1))), "user_id", "article_id", 1, 0.1)(
        _block_batches([2, 1], [0, 0], [False, False], [0, 1], [1.0, 1.0], [1]))
    with pytest.raises(RuntimeError):
        list(parts)


def test_memory_of_a_block_does_not_grow_with_its_rows():
    """One block of ten and of a hundred tiles, of many keys and of a single one."""
    k, rows = 8, 20_000
    fid, fmat = np.arange(500), np.random.default_rng(1).normal(size=(500, k))

    def batches(n, single):
        for i in range(n):
            at = np.arange(i * rows, (i + 1) * rows)
            yield next(_block_batches(at * 0 if single else at // 40, at * 0, at < 0, at % 500, at % 7 / 7.0, []))

    def peak(n, single):
        kernel = als._stream_kernel(_Sent(fid, fmat), "user_id", "article_id", k, 0.1)
        tracemalloc.start()
        out = sum(p.num_rows for p in kernel(batches(n, single)))
        most = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        assert out == (1 if single else n * rows // 40)
        return most

    for single in (False, True):
        assert peak(100, single) < 1.3 * peak(10, single)


def test_partial_sums_are_added_as_arrays(spark):
    rows = [(i % 7, [float(i), 1.0, 2.0 * i, 0.0, -1.0]) for i in range(1000)]
    df = spark.createDataFrame(rows, "id long, x array<double>")
    got = {r.id: r.p for r in als._merged(df, 2).collect()}
    assert got == {j: [sum(x[1][c] for x in rows if x[0] == j) for c in range(5)] for j in range(7)}
    assert als._merged(df.limit(0), 2).count() == 0
    r = ratings_from_events(spark, SF001)
    v = als.init_factors(r, "article_id", 2)
    plan = _executed_plan(als.normal_equation_terms(r, v, "user_id", "article_id", 2, n_fixed=100))
    assert "Generate" not in plan and "MapInArrow" in plan
