import glob
import os
import re
import time

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from tidings.functions.messages import encode_ratings
from tidings.operators import topn
from tidings.plans import fixtures as fx
from tidings.plans import jobs
from tidings.sources import snapshots
from tidings.streaming import ratings as stream

from data_paths import SF001

LISTS = "userid long, recommendations array<bigint>"
NO_RATINGS = "user_id long, article_id long, rating double"


def _rows(df):
    return sorted((r.userid, r.rank, r.article_id) for r in topn.lists_to_rows(df).collect())


def _store(spark, root, lists=None, factors=None, buckets=4):
    store = stream.open_store(spark, os.path.join(root, "state"), buckets)
    if lists is not None:
        stream.put_model(store, lists, factors)
    return store


def _run(spark, root, store, m, files_per_trigger, ckpt):
    state = stream.StreamState(store, fx.ratings(spark, SF001, "events_before"), m.articles, m.k, n=fx.TABLE_N, n_articles=m.n_articles)
    src = stream.text_messages(spark, os.path.join(root, "in"), files_per_trigger)
    stream.run_stream(src, state, os.path.join(root, ckpt), available_now=True).awaitTermination()
    return stream.read_lists(store)


def test_stream_matches_set_wise_batch_and_replays(spark, scratch):
    m = fx.model(spark, SF001, "events_before")
    table = fx.lists_table(spark, SF001)
    after = fx.events_ratings(spark, SF001, "after").drop("event_id")
    encode_ratings(after).select("value").write.text(os.path.join(scratch, "in"))
    store = _store(spark, scratch, table)
    once = _rows(_run(spark, scratch, store, m, None, "ck1"))
    batch = stream.update_lists(table, after, fx.ratings(spark, SF001, "events"), m.articles, m.k,
                                n=fx.TABLE_N, n_articles=m.n_articles)
    assert once == _rows(batch)
    # all messages again (checkpoint lost): the lists end the same
    again = _rows(_run(spark, scratch, store, m, None, "ck2"))
    assert again == once


def test_many_micro_batches_never_list_a_rated_article(spark, scratch):
    m = fx.model(spark, SF001, "events_before")
    after = fx.events_ratings(spark, SF001, "after").drop("event_id")
    encode_ratings(after).select("value").repartition(4).write.text(os.path.join(scratch, "in"))
    store = _store(spark, scratch, fx.lists_table(spark, SF001))
    final = _run(spark, scratch, store, m, 1, "ck")
    assert store.snapshot().fact("last") >= 3
    rated = {(r.user_id, r.article_id) for r in fx.ratings(spark, SF001, "events").collect()}
    rows = _rows(final)
    assert rows and not any((u, a) in rated for u, _, a in rows)
    assert final.groupBy("userid").count().where(F.col("count") > 1).count() == 0


def test_apply_ratings_keeps_order_and_allows_empty(spark):
    lists = spark.createDataFrame([(1, [5, 6, 7]), (2, [8]), (3, [9])], "userid long, recommendations array<bigint>")
    ev = spark.createDataFrame([(1, 6, 1.0), (2, 8, 0.5), (4, 1, 1.0)], "user_id long, article_id long, rating double")
    out = {r.userid: r.recommendations for r in stream.apply_ratings(lists, ev).collect()}
    assert out == {1: [5, 7], 2: []}
    assert [r.userid for r in stream.users_to_refresh(stream.apply_ratings(lists, ev)).collect()] == [2]


def test_stream_starts_from_latest_version(spark, scratch):
    lists = spark.createDataFrame([(1, [5, 6]), (2, [7, 8])], LISTS)
    older = spark.createDataFrame([(1, [9, 9]), (2, [9, 9])], LISTS)
    arts = spark.createDataFrame([(i, [1.0]) for i in range(5, 10)], "id long, f array<double>")
    store = _store(spark, scratch, older, arts)
    stream.put_model(store, lists, arts)
    os.makedirs(os.path.join(scratch, "in"))
    with open(os.path.join(scratch, "in", "a.txt"), "w") as fh:
        fh.write("1,5,0.5\n")
    state = stream.StreamState(store, spark.createDataFrame([], NO_RATINGS), k=1, n=2)
    stream.run_stream(stream.text_messages(spark, os.path.join(scratch, "in")), state,
                      os.path.join(scratch, "ck"), available_now=True).awaitTermination()
    assert state.log[0]["base"] == 1 and store.snapshot().fact("version") == 1
    assert _lists(spark, store) == {1: [6], 2: [7, 8]}


def test_read_lists_merges_latest_delta_per_user(spark, scratch):
    store = _store(spark, scratch, spark.createDataFrame([(1, [5, 6]), (2, [7, 8])], LISTS))

    def delta(rows, batch):
        part = store.write(spark.createDataFrame(rows, LISTS).withColumn("batch", F.lit(batch).cast("long")), stream.LISTS, "userid", len(rows),
                           first=batch, last=batch)
        return store.update(lambda s: ({stream.LISTS: [*s.parts(stream.LISTS), part]}, {"last": batch}))

    first = delta([(1, [6])], 0)
    delta([(1, []), (2, [8])], 1)
    assert _lists(spark, store) == {1: [], 2: [8]}
    before = {r.userid: r.recommendations for r in stream.read_lists(store, first).collect()}
    assert before == {1: [6], 2: [7, 8]}
    only = spark.createDataFrame([(2,), (77,)], "userid long")
    assert [r.userid for r in stream.read_lists(store, users=only).collect()] == [2]


def _small(spark, scratch, lists, **kw):
    arts = spark.createDataFrame([(i, [1.0 / i]) for i in range(5, 10)], "id long, f array<double>")
    store = _store(spark, scratch, spark.createDataFrame(lists, LISTS), arts)
    return stream.StreamState(store, spark.createDataFrame([], NO_RATINGS), k=1, n=2, **kw)


def _lists(spark, store):
    return {r.userid: r.recommendations for r in stream.read_lists(store).collect()}


def _values(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "value string")


def _pairs(store):
    return sorted((r.user_id, r.article_id) for r in stream.stored_ratings(store).collect())


def test_process_batch_counts_rejects_and_unknown_users(spark, scratch):
    state = _small(spark, scratch, [(1, [5, 6])])
    out = stream.process_batch(state, _values(spark, "1,5,0.5", "9,5,1", "x,5,1", ""), 0)
    assert out["rejects"] == 2 and out["unknown_users"] == 1
    assert _lists(spark, state.store) == {1: [6]}


def test_batches_of_rejects_only(spark, scratch):
    state = _small(spark, scratch, [(1, [5, 6])])
    assert stream.process_batch(state, _values(spark, "x", ",,"), 0)["rejects"] == 2
    assert stream.process_batch(state, _values(spark).limit(0), 1)["rejects"] == 0
    assert _lists(spark, state.store) == {1: [5, 6]}
    stream.process_batch(state, _values(spark, "1,5,1"), 2)
    assert _lists(spark, state.store) == {1: [6]}


def test_stream_moves_to_a_new_version(spark, scratch):
    state = _small(spark, scratch, [(1, [5, 6]), (2, [7, 8])])
    stream.process_batch(state, _values(spark, "1,5,1"), 0)
    # a version made from ratings up to batch 0; batch 1 arrives on the old one before it is committed
    stream.process_batch(state, _values(spark, "2,7,1"), 1)
    stream.put_model(state.store, spark.createDataFrame([(1, [6, 7]), (2, [7, 9])], LISTS), taken=0)
    assert stream.process_batch(state, _values(spark, "1,6,1"), 2)["base"] == 1
    assert _lists(spark, state.store) == {1: [7], 2: [9]}  # also what batch 1 rated
    # a replay of a committed batch changes nothing, whatever came after it
    stream.put_model(state.store, spark.createDataFrame([(1, [5, 6])], LISTS), taken=2)
    number = state.store.snapshot().number
    assert stream.process_batch(state, _values(spark, "1,6,1"), 2)["replayed"]
    assert state.store.snapshot().number == number and _lists(spark, state.store) == {1: [5, 6]}


def test_compaction_of_a_running_stream(spark, scratch):
    state = _small(spark, scratch, [(1, [5, 6]), (2, [7, 8])])
    stream.process_batch(state, _values(spark, "1,5,1"), 0)
    assert stream.compact(state.store) == 1
    assert len(state.store.snapshot().parts(stream.LISTS)) == 1
    assert _lists(spark, state.store) == {1: [6], 2: [7, 8]}
    assert stream.process_batch(state, _values(spark, "2,8,1"), 1)["base"] == 1
    assert _lists(spark, state.store) == {1: [6], 2: [7]}


def test_lost_checkpoint_stores_no_rating_twice(spark, scratch):
    state = _small(spark, scratch, [(1, [5, 6]), (2, [7, 8])])
    os.makedirs(os.path.join(scratch, "in"))
    for i, line in enumerate(["1,5,1", "2,7,1", "1,9,1"]):
        with open(os.path.join(scratch, "in", f"{i}.txt"), "w") as fh:
            fh.write(line + "\n")
    for n, ckpt in ((1, "a"), (2, "b"), (3, "c")):  # another split into batches each time
        stream.run_stream(stream.text_messages(spark, os.path.join(scratch, "in"), n), state, os.path.join(scratch, ckpt),
                          available_now=True).awaitTermination()
        assert _pairs(state.store) == [(1, 5), (1, 9), (2, 7)]
        assert _lists(spark, state.store) == {1: [6], 2: [8]}


def test_batch_job_trains_on_streamed_ratings(spark, scratch):
    hist = spark.createDataFrame([(u, a, 1.0) for u in (1, 2) for a in (5, 6)] + [(3, a, 1.0) for a in range(5, 10)], NO_RATINGS)
    store = _store(spark, scratch)
    state = stream.StreamState(store, hist, k=2, n=2)
    stream.process_batch(state, _values(spark, "1,7,1", "9,5,1"), 4)
    run = jobs.run_batch(hist, store, k=2, n=2)
    lists = {u: set(x) for u, x in _lists(spark, store).items()}
    assert 7 not in lists[1] and 9 in {r.id for r in run["model"].users.collect()}
    assert store.snapshot().fact("trained") == 4
    # the same from ratings kept in the store
    stream.put_base_ratings(store, hist)
    jobs.run_batch(None, store, k=2, n=2)
    assert {u: set(x) for u, x in _lists(spark, store).items()} == lists


# ------------------------------------------------------------ commits

def _half_written(store, table, schema="user_id long, article_id long, rating double, batch long", rows=((1, 8, 1.0, 7),)):
    """What a writer leaves that died before its commit: whole files, a file of a task that wasn't finished."""
    part = store.write(store.spark.createDataFrame(list(rows), schema), table, "user_id", len(rows), first=7, last=7)
    os.makedirs(f"{store.root}/{part.path}/_temporary/0/task_1")
    with open(f"{store.root}/{part.path}/_temporary/0/task_1/part-0.parquet", "wb") as fh:
        fh.write(b"PAR1")
    return part


def test_a_half_written_batch_is_neither_trained_on_nor_compacted(spark, scratch):
    state = _small(spark, scratch, [(1, [5, 6]), (2, [7, 8])])
    stream.process_batch(state, _values(spark, "1,5,1"), 0)
    _half_written(state.store, stream.STREAMED)
    with open(f"{state.store.root}/_log/.draft-unfinished", "w") as fh:
        fh.write('{"number": 99')
    assert state.store.snapshot().fact("last") == 0 and _pairs(state.store) == [(1, 5)]
    hist = spark.createDataFrame([(3, a, 1.0) for a in range(5, 10)], NO_RATINGS)
    jobs.run_batch(hist, state.store, k=1, n=2)
    assert state.store.snapshot().fact("trained") == 0
    stream.compact(state.store)
    assert _pairs(state.store) == [(1, 5)]
    # the batch comes again and is taken in whole
    stream.process_batch(state, _values(spark, "1,8,1"), 1)
    assert _pairs(state.store) == [(1, 5), (1, 8)]


def test_a_batch_that_died_between_ratings_and_lists_is_worked_out_anew(spark, scratch, monkeypatch):
    state = _small(spark, scratch, [(1, [5, 6]), (2, [7, 8])])
    write = state.store.write

    def dies(df, table, *a, **kw):
        if table == stream.LISTS:
            raise RuntimeError("lost")
        return write(df, table, *a, **kw)

    monkeypatch.setattr(state.store, "write", dies)
    with pytest.raises(RuntimeError):
        stream.process_batch(state, _values(spark, "1,5,1"), 0)
    assert state.store.snapshot().fact("last") == -1 and _pairs(state.store) == [] and _lists(spark, state.store) == {1: [5, 6], 2: [7, 8]}
    monkeypatch.undo()
    stream.process_batch(state, _values(spark, "1,5,1"), 0)
    assert _pairs(state.store) == [(1, 5)] and _lists(spark, state.store) == {1: [6], 2: [7, 8]}


def test_commits_are_made_once_and_conflicts_worked_out_again(spark, scratch):
    a, b = _store(spark, scratch), _store(spark, scratch)
    old = a.snapshot()
    a.commit(old, facts={"x": 1})
    with pytest.raises(snapshots.Conflict):
        b.commit(old, facts={"x": 2})
    assert a.snapshot().facts["x"] == 1 and not glob.glob(f"{a.root}/_log/.draft*")
    seen = []

    def change(snap):
        seen.append(snap.number)
        if len(seen) == 1:
            a.commit(snap, facts={"y": 5})  # somebody else is first
        return {}, {"x": snap.fact("x") + 10}

    assert b.update(change).facts == {"buckets": 4, "x": 11, "y": 5} and seen == [0, 1]
    assert b.update(lambda snap: None).number == 2
    assert _store(spark, scratch, buckets=99).buckets == 4  # a store keeps its buckets


def test_a_stream_batch_and_a_batch_job_at_once(spark, scratch):
    """The batch job commits while a stream batch is being worked out: it is worked out again on the new lists."""
    state = _small(spark, scratch, [(1, [5, 6]), (2, [7, 8])])
    commit, first = state.store.commit, []

    def late(base, *a, **kw):
        if not first:
            first.append(1)
            stream.put_model(_store(spark, scratch), spark.createDataFrame([(1, [5, 9]), (2, [5, 8])], LISTS), taken=-1)
        return commit(base, *a, **kw)

    state.store.commit = late
    assert stream.process_batch(state, _values(spark, "1,5,1"), 0)["base"] == 1
    assert _lists(spark, state.store) == {1: [9], 2: [5, 8]}


# ------------------------------------------------------------ pruned reads, upkeep

def _scanned(df):
    """Buckets that a plan's scans read, from their partition filters; None for a scan without one."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    out = []
    for scan in re.findall(r"FileScan parquet [^\n]*", plan):
        m = re.search(r"PartitionFilters: \[[^\]]*bucket#\d+ (?:IN \(([\d,]+)\)|= (\d+))", scan)
        out.append({int(x) for x in (m[1] or m[2]).split(",")} if m else None)
    return out


def test_only_buckets_of_the_batch_are_scanned(spark, scratch, monkeypatch):
    monkeypatch.setattr(snapshots, "FLAT_ROWS", 0)
    store = _store(spark, scratch, buckets=16)
    stream.put_model(store, spark.createDataFrame([(u, [5, 6]) for u in range(200)], LISTS))
    stream.put_base_ratings(store, spark.createDataFrame([(u, 7, 1.0) for u in range(200)], NO_RATINGS))
    users = spark.createDataFrame([(3,), (4,), (3,)], "userid long")
    touched = set(store.buckets_of(users, "userid"))
    assert 1 <= len(touched) <= 2
    lists, mine = stream.read_lists(store, users=users), stream.stored_ratings(store, users=users)
    assert touched in _scanned(lists) and touched in _scanned(mine)
    assert sorted(r.userid for r in lists.collect()) == [3, 4] and sorted(r.user_id for r in mine.collect()) == [3, 4]


def test_small_writes_are_pruned_by_statistics(spark, scratch):
    store = _store(spark, scratch, spark.createDataFrame([(u, [5, 6]) for u in range(50)], LISTS))
    df = stream.read_lists(store, users=spark.createDataFrame([(3,)], "userid long"))
    assert "PushedFilters: [EqualTo(bucket," in df._jdf.queryExecution().executedPlan().toString().replace("IsNotNull(bucket), ", "")
    assert [r.userid for r in df.collect()] == [3]


def test_two_hundred_batches_leave_few_folders(spark, scratch):
    state = _small(spark, scratch, [(u, [5, 6]) for u in range(40)], fanout=8, retention=0.0)
    store = state.store
    users = spark.createDataFrame([(u,) for u in range(40)], "u long")
    bucket = {r.u: r.b for r in users.select("u", snapshots.bucket_of("u", store.buckets).alias("b")).collect()}

    def part(table, b, **columns):  # as Store.write leaves a small batch, without a Spark job for each
        path = f"data/{table}/small-{b}"
        os.makedirs(f"{store.root}/{path}")
        pq.write_table(pa.table({c: pa.array([v], t) for c, (v, t) in columns.items()} | {"batch": pa.array([b], pa.int64()),
                                "bucket": pa.array([bucket[b % 40]], pa.int32())}), f"{store.root}/{path}/part-0.parquet")
        return snapshots.Part(path, 1, first=b, last=b)

    for b in range(200):
        ratings = part(stream.STREAMED, b, user_id=(b % 40, pa.int64()), article_id=(5 + b // 40 % 2, pa.int64()), rating=(1.0, pa.float64()))
        delta = part(stream.LISTS, b, userid=(b % 40, pa.int64()), recommendations=([b], pa.list_(pa.int64())))
        store.update(lambda s, b=b, p=ratings, d=delta: (
            {stream.STREAMED: [*s.parts(stream.STREAMED), p], stream.LISTS: [*s.parts(stream.LISTS), d]}, {"last": b, "applied": b}))
        if b % 25 == 24:
            stream.maintain(store, state.fanout, state.retention)
    time.sleep(0.1)
    store.clean(0.0)
    snap = store.snapshot()
    assert len(snap.parts(stream.STREAMED)) <= 3 * 7 and len(snap.parts(stream.LISTS)) <= 3 * 7 + 1
    folders = glob.glob(f"{store.root}/data/*/*")
    assert {f[len(store.root) + 1:] for f in folders} == snap.paths()
    assert len(glob.glob(f"{store.root}/_log/*.json")) <= 2
    assert stream.stored_ratings(store).count() == 200
    assert _lists(spark, store) == {u: [160 + u] for u in range(40)}
    assert stream.process_batch(state, _values(spark, "1,9,1"), 199)["replayed"]
    stream.process_batch(state, _values(spark, "1,161,1"), 200)
    assert stream.stored_ratings(store).count() == 201 and 161 not in _lists(spark, store)[1]


def test_retention_keeps_what_a_running_reader_holds(spark, scratch):
    state = _small(spark, scratch, [(1, [5, 6]), (2, [7, 8])], fanout=2)
    stream.process_batch(state, _values(spark, "1,5,1"), 0)
    held = state.store.snapshot()
    reader = stream.read_lists(state.store, held)
    for b in range(1, 6):
        stream.process_batch(state, _values(spark, "2,7,1"), b)
    assert state.store.snapshot().dropped
    assert {r.userid: r.recommendations for r in reader.collect()} == {1: [6], 2: [7, 8]}
    time.sleep(0.1)
    assert state.store.clean(0.0) > 0 and not state.store.snapshot().dropped
    assert _lists(spark, state.store) == {1: [6], 2: [8]}


# ------------------------------------------------------------ the trigger

def test_processing_time_trigger_with_a_restart(spark, scratch):
    state = _small(spark, scratch, [(1, [5, 6]), (2, [7, 8])])
    folder, ckpt = os.path.join(scratch, "in"), os.path.join(scratch, "ck")
    os.makedirs(folder)

    def put(name, line):
        with open(os.path.join(scratch, name), "w") as fh:
            fh.write(line + "\n")
        os.rename(os.path.join(scratch, name), os.path.join(folder, name))

    def wait(query, last):
        end = time.time() + 60
        while state.store.snapshot().fact("last") < last and time.time() < end:
            assert query.exception() is None
            time.sleep(0.2)
        assert state.store.snapshot().fact("last") >= last

    put("a.txt", "1,5,1")
    q = stream.run_stream(stream.text_messages(spark, folder), state, ckpt)  # the fixed interval of two seconds
    wait(q, 0)
    put("b.txt", "2,7,1")
    wait(q, 1)
    q.stop()
    assert _lists(spark, state.store) == {1: [6], 2: [8]}
    put("c.txt", "2,8,1")  # arrives while the stream is down
    q = stream.run_stream(stream.text_messages(spark, folder), state, ckpt, interval="1 second")
    wait(q, 2)
    q.stop()
    assert _pairs(state.store) == [(1, 5), (2, 7), (2, 8)]
    assert _lists(spark, state.store)[1] == [6] and not {7, 8} & set(_lists(spark, state.store)[2])
