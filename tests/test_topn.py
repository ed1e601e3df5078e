import numpy as np
from pyspark.sql import functions as F

from tidings.operators import als, topn
from tidings.sources.tables import ratings_from_events

from data_paths import SF001


def brute(uid, umat, aid, vmat, rated, n):
    out = {}
    for i, u in enumerate(uid):
        sc = vmat @ umat[i]
        cand = [(-sc[j], aid[j]) for j in range(len(aid)) if sc[j] > 0 and (u, aid[j]) not in rated]
        out[u] = [a for _, a in sorted(cand)[:n]]
    return out


def test_block_top_n_matches_brute_force_with_ties():
    rng = np.random.default_rng(3)
    uid = np.arange(40, dtype=np.int64) * 3 - 20
    umat = rng.integers(-2, 3, size=(40, 3)).astype(float)
    aid = np.sort(rng.choice(np.arange(-500, 500), size=300, replace=False)).astype(np.int64)
    vmat = rng.integers(-2, 3, size=(300, 3)).astype(float)  # many exact ties
    pairs = [(uid[i], aid[j]) for i in range(40) for j in rng.choice(300, 30, replace=False)]
    mu = np.array([p[0] for p in pairs], np.int64)
    ma = np.array([p[1] for p in pairs], np.int64)
    for chunk in (7, 64, 1000):
        rr, kk, art, sc = topn.block_top_n(uid, umat, aid, vmat, mu, ma, 5, chunk)
        got = {}
        for r, k, a in sorted(zip(rr, kk, art), key=lambda t: (t[0], t[1])):
            got.setdefault(uid[r], []).append(a)
        want = brute(uid, umat, aid, vmat, set(pairs), 5)
        assert {u: v for u, v in want.items() if v} == got


def test_hand_example_true_top_two(spark):
    u = spark.createDataFrame([(1, [1.0])], "id long, f array<double>")
    v = spark.createDataFrame([(0, [3.0]), (1, [5.0])], "id long, f array<double>")
    ranked = topn.recommend(u, v, None, n=2)
    assert [(r.rank, r.article_id) for r in ranked.orderBy("rank").collect()] == [(1, 1), (2, 0)]


def test_properties_and_blocked_path_equal(spark):
    r = ratings_from_events(spark, SF001)
    m = als.train(r, k=5, iterations=2)
    a = topn.recommend(m.users, m.articles, r, n=10, users_per_block=7)
    b = topn.recommend(m.users, m.articles, r, n=10, max_broadcast_bytes=0, articles_per_block=13, users_per_block=11)
    rows_a = sorted((x.userid, x.rank, x.article_id) for x in a.collect())
    rows_b = sorted((x.userid, x.rank, x.article_id) for x in b.collect())
    assert rows_a == rows_b and rows_a
    rated = {(x.user_id, x.article_id) for x in r.collect()}
    assert not any((u, art) in rated for u, _, art in rows_a)
    assert a.where(F.col("score") <= 0).count() == 0
    lists = topn.to_lists(a, 10, require_full=False).collect()
    for row in lists:
        assert len(set(row.recommendations)) == len(row.recommendations) >= 1
    sc = {(x.userid, x.rank): x.score for x in a.collect()}
    assert all(sc[(u, k)] >= sc[(u, k + 1)] for (u, k) in sc if (u, k + 1) in sc)


def test_require_full_filters(spark):
    ranked = spark.createDataFrame([(1, 1, 5, 1.0), (1, 2, 6, 0.5), (2, 1, 7, 1.0)],
                                   "userid long, rank int, article_id long, score double")
    assert {r.userid for r in topn.to_lists(ranked, 2, True).collect()} == {1}
    assert {r.userid for r in topn.to_lists(ranked, 2, False).collect()} == {1, 2}
    rows = topn.lists_to_rows(topn.to_lists(ranked, 2, True)).collect()
    assert [(r.rank, r.article_id) for r in rows] == [(1, 5), (2, 6)]


def test_rating_edge_cases(spark):
    # user 1 rated everything, user 2 one article with rating 0, user 3 one article; article -7 is negative
    rows = [(1, a, 0.5) for a in (-7, 1, 2, 3)] + [(2, 1, 0.0), (3, -7, 1.0), (3, -7, 1.0)]
    r = spark.createDataFrame(rows, "user_id long, article_id long, rating double")
    m = als.train(r, k=2, iterations=2)
    assert {x.id for x in m.users.collect()} == {1, 2, 3}
    assert {x.id for x in m.articles.collect()} == {-7, 1, 2, 3}
    ranked = topn.recommend(m.users, m.articles, r, n=10).collect()
    assert not any(x.userid == 1 for x in ranked)          # nothing left to recommend
    assert all(x.score > 0 for x in ranked)
    rated = {(u, a) for u, a, _ in rows}
    assert not any((x.userid, x.article_id) in rated for x in ranked)
    from tidings.streaming import ratings as stream
    users = spark.createDataFrame([(1,), (3,)], "userid long")
    fresh = {x.userid: x.recommendations for x in
             stream.refresh_lists(users, r, m.articles, 2, n=10, n_articles=4).collect()}
    assert fresh[1] == [] and 3 in fresh and -7 not in fresh[3]


from hypothesis import given, settings, strategies as st


@settings(max_examples=60, deadline=None)
@given(n_users=st.integers(1, 30), n_arts=st.integers(1, 60), k=st.integers(1, 4), n=st.integers(1, 7),
       chunk=st.integers(1, 70), tile=st.integers(1, 35), seed=st.integers(0, 10_000), levels=st.integers(2, 6))
def test_block_top_n_property(n_users, n_arts, k, n, chunk, tile, seed, levels):
    rng = np.random.default_rng(seed)
    uid = rng.choice(np.arange(-100, 100), n_users, replace=False).astype(np.int64)
    aid = np.sort(rng.choice(np.arange(-500, 500), n_arts, replace=False)).astype(np.int64)
    umat = rng.integers(-levels // 2, levels, size=(n_users, k)).astype(float)   # few levels: many exact ties
    vmat = rng.integers(-levels // 2, levels, size=(n_arts, k)).astype(float)
    m = int(rng.integers(0, n_users * n_arts + 1))
    pairs = {(uid[rng.integers(n_users)], aid[rng.integers(n_arts)]) for _ in range(m)}
    mu = np.array([p[0] for p in pairs], np.int64)
    ma = np.array([p[1] for p in pairs], np.int64)
    rr, kk, art, sc = topn.block_top_n(uid, umat, aid, vmat, mu, ma, n, chunk, tile)
    got = {}
    for r, rank, a in sorted(zip(rr, kk, art), key=lambda t: (t[0], t[1])):
        got.setdefault(uid[r], []).append(a)
    want = {u: v for u, v in brute(uid, umat, aid, vmat, pairs, n).items() if v}
    assert got == want


def test_mask_is_dealt_once(spark):
    """Rated pairs are shuffled by the users' block alone, never by (user, article)."""
    r = ratings_from_events(spark, SF001)
    m = als.train(r, k=2, iterations=1)
    for size in (topn.DEFAULT_MAX_BROADCAST_BYTES, 0):
        out = topn.recommend(m.users, m.articles, r, n=5, k=2, n_users=m.n_users, n_articles=m.n_articles, max_broadcast_bytes=size)
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert "hashpartitioning(user_id" not in plan and "hashpartitioning(article_id" not in plan
        assert out.count() > 0


def test_blocks_of_short_articles_are_not_sent(spark, monkeypatch):
    """Users meet only the blocks by norm that can reach their lists; ties and masks hold; equal to the broadcast plan."""
    rng = np.random.default_rng(9)
    vmat = np.abs(rng.normal(size=(400, 3))) / (1 + np.arange(400)[:, None] / 8)
    vmat[390:395] = vmat[7]  # ties with a long vector, under other ids
    umat = np.abs(rng.normal(size=(30, 3)))
    umat[29] = 0.0
    v = spark.createDataFrame([(int(i), [float(x) for x in f]) for i, f in enumerate(vmat)], "id long, f array<double>")
    u = spark.createDataFrame([(int(i), [float(x) for x in f]) for i, f in enumerate(umat)], "id long, f array<double>")
    r = spark.createDataFrame([(int(i), int(a)) for i in range(30) for a in rng.integers(0, 40, 12)], "user_id long, article_id long")
    sent, real = [], topn._cells

    def counted(left, *args):
        sent.append(left.count())
        return real(left, *args)

    monkeypatch.setattr(topn, "_cells", counted)
    for mask in (None, r):
        a = topn.recommend(u, v, mask, n=5)
        assert not sent
        b = topn.recommend(u, v, mask, n=5, max_broadcast_bytes=0, articles_per_block=20, users_per_block=8)
        assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))
        assert sent[0] == 30 and sent[1] < 30 * 19 / 2
        sent.clear()


def test_factors_through_the_driver_stay_small():
    """Six half-steps and a catalogue at the bound, whatever the rank, are a tenth of a driver's thousand MB."""
    assert 7 * als.DEFAULT_MAX_BROADCAST_BYTES < 120e6 and topn.DEFAULT_MAX_BROADCAST_BYTES == als.DEFAULT_MAX_BROADCAST_BYTES


def test_walk_by_norm_skips_chunks_and_keeps_ties():
    """Lists equal brute force while most of the catalogue is never scored; equal scores at the end of a list go to the smaller id."""
    rng = np.random.default_rng(8)
    vmat = rng.normal(size=(4000, 6)) / (1 + np.arange(4000)[:, None] / 40)
    vmat[3000:3010] = vmat[5]  # ties with a long vector, under other ids
    aid = rng.permutation(4000).astype(np.int64) - 1000
    uid, umat = np.arange(60, dtype=np.int64), rng.normal(size=(60, 6))
    mu, ma = np.repeat(uid, 50), np.concatenate([rng.choice(aid, 50, replace=False) for _ in uid])
    seen = {}
    rr, kk, art, sc = topn.catalogue_top_n(uid, umat, topn.Catalogue(aid, vmat, 64), mu, ma, 10, 16, seen)
    got = {}
    for r, _, a in sorted(zip(rr, kk, art), key=lambda t: (t[0], t[1])):
        got.setdefault(uid[r], []).append(a)
    assert got == brute(uid, umat, aid, vmat, set(zip(mu.tolist(), ma.tolist())), 10)
    assert seen["scored"] + seen["skipped"] == 60 * 4000 and seen["skipped"] > 0.5 * 60 * 4000


def test_walk_does_not_stop_before_equal_scores():
    """Vectors of one norm in many chunks: a later chunk can only tie, and its smaller ids win."""
    vmat = np.ones((40, 1))
    aid = np.arange(40, 0, -1).astype(np.int64)
    cat = topn.Catalogue(aid, vmat, 4)
    none = np.empty(0, np.int64)
    _, _, art, _ = topn.catalogue_top_n(np.array([1]), np.ones((1, 1)), cat, none, none, 5)
    assert art.tolist() == [1, 2, 3, 4, 5]
    odd = topn.Catalogue(aid, np.where(aid[:, None] % 7 == 0, np.nan, vmat), 4)
    _, _, art, _ = topn.catalogue_top_n(np.array([1]), np.ones((1, 1)), odd, none, none, 8)
    assert art.tolist() == [1, 2, 3, 4, 5, 6, 8, 9]
