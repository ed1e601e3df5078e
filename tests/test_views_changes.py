from pyspark.sql import functions as F

from tidings.operators import changes, views


def test_parse_sort_allow_list():
    assert views.parse_sort(["-userid", "bogus", "recommendations"], views.RECOMMENDATION_SORT_KEYS) == [
        ("userid", True), ("recommendations", False)]


def test_array_sort_key_and_positions(spark):
    df = spark.createDataFrame([(1, [5, 9]), (2, [1, 7]), (3, [3, 4]), (4, None)], "userid long, recommendations array<bigint>")
    asc = views.listing(df, views.parse_sort(["recommendations"], views.RECOMMENDATION_SORT_KEYS), tiebreak="userid")
    assert [r.userid for r in asc.orderBy("pos").collect()] == [4, 2, 3, 1]
    desc = views.listing(df, views.parse_sort(["-recommendations"], views.RECOMMENDATION_SORT_KEYS), limit=2)
    assert [(r.userid, r.pos) for r in desc.orderBy("pos").collect()] == [(1, 0), (2, 1)]


def test_graph(spark):
    lists = spark.createDataFrame([(1, [5, 5, 6]), (2, [6])], "userid long, recommendations array<bigint>")
    nodes = {r.id: r for r in views.graph_nodes(lists).collect()}
    assert set(nodes) == {"user1", "user2", "article5", "article6"}
    assert nodes["article5"].x == 0.0 and nodes["user1"].color == "#0000ff" and nodes["article6"].color == "#ff0000"
    edges = sorted(r.id for r in views.graph_edges(lists).collect())
    assert edges == ["user1-5", "user1-6", "user2-6"]
    assert views.graph_json(lists).count() == 7


def test_apply_changes_semantics(spark):
    snap = spark.createDataFrame([(1, "a", "x"), (2, "b", "y"), (3, "c", "z")], "id long, username string, segment string")
    ch = spark.createDataFrame([
        (1, "update", 1, "A1", None), (2, "update", 1, None, "X2"), (3, "update", 1, "A3", None),  # per-column last wins
        (1, "delete", 2, None, None), (2, "update", 2, "B", None),  # delete then update: stays deleted
        (1, "insert", 9, "new", "n"), (2, "update", 9, None, "m"),  # insert then update
        (1, "update", 7, "ghost", None),  # update of a missing key: no row
        (5, "delete", 3, None, None), (6, "insert", 3, "back", "r"),  # delete then insert: new row
    ], "seq long, op string, id long, username string, segment string")
    out = {r.id: (r.username, r.segment) for r in changes.apply_changes(snap, ch, "id", ["username", "segment"]).collect()}
    assert out == {1: ("A3", "X2"), 3: ("back", "r"), 9: ("new", "m")}


def test_sequential_ids_after_delete(spark):
    existing = spark.createDataFrame([(0,), (1,), (5,)], "id long")
    new = spark.createDataFrame([("q",), ("p",)], "name string")
    out = sorted((r.name, r.id) for r in changes.append_sequential_ids(existing, new, "id", ["name"]).collect())
    assert out == [("p", 6), ("q", 7)]


def test_stamp_changes(spark):
    from pyspark.sql import functions as F
    ch = spark.createDataFrame([(1, "insert", 1, None, None), (2, "update", 1, None, None), (3, "delete", 2, None, None)],
                               "seq long, op string, id long, creation_date timestamp, update_date timestamp")
    out = {r.seq: r for r in changes.stamp_changes(ch, "2020-06-01 12:00:00").collect()}
    assert out[1].creation_date is not None and out[1].update_date is not None
    assert out[2].creation_date is None and out[2].update_date is not None
    assert out[3].creation_date is None and out[3].update_date is None
    assert changes.stamp_changes(ch, F.current_timestamp()).where("op = 'update' and update_date is null").count() == 0


def test_month_walk_reports_gaps(spark):
    from tidings.sources.archive import missing_months
    present = spark.createDataFrame([("2017-03",), ("2017-01",), ("2016-11",), ("2017-03",)], "month string")
    rows = [(r.year, r.month, r.present) for r in missing_months(present).orderBy("step").collect()]
    assert rows == [(2017, 3, True), (2017, 2, False), (2017, 1, True), (2016, 12, False), (2016, 11, True)]


def test_listing_without_a_sort_parameter(spark):
    df = spark.createDataFrame([(3, "c"), (1, None), (2, "b")], "id int, name string")
    assert [(r.id, r.pos) for r in views.listing(df, [], limit=2).collect()] == [(1, 0), (2, 1)]
    assert sorted((r.pos, r.id) for r in views.listing(df, []).collect()) == [(0, 1), (1, 2), (2, 3)]
    assert [(r.id, r.pos) for r in views.listing(df, [], limit=2, tiebreak="id").collect()] == [(1, 0), (2, 1)]


def test_changes_read_the_snapshot_once(spark, scratch):
    spark.range(50).withColumn("v", F.lit("a")).write.parquet(f"{scratch}/snap")
    ch = spark.createDataFrame([(1, "update", 3, "b"), (2, "delete", 3, None), (3, "insert", 3, "c"), (4, "update", 3, "d"),
                                (1, "update", 99, "x"), (2, "delete", 4, None), (5, "update", 5, None)], "seq long, op string, id long, v string")
    out = changes.apply_changes(spark.read.parquet(f"{scratch}/snap"), ch, "id", ["v"])
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and plan.count("Join") <= 2
    got = {r.id: r.v for r in out.collect()}
    assert got[3] == "d" and 4 not in got and 99 not in got and got[5] == "a" and len(got) == 49


def test_stored_changes_rewrite_touched_buckets_only(spark, scratch):
    from tidings.operators import changes
    from tidings.sources.snapshots import Store

    store = Store(spark, scratch + "/store", buckets=16)
    rows = spark.createDataFrame([(i, f"u{i}", None) for i in range(200)], "id long, username string, email string")
    changes.put_table(store, "users", rows, "id")
    before = store.snapshot()
    files = lambda snap: {(p.path, b) for p in snap.parts("users") for b in (p.buckets or range(16))}
    ch = spark.createDataFrame([(1, "update", 3, "X", None), (2, "delete", 4, None, None), (3, "insert", 500, "new", "e"), (4, "update", 900, "no", None)],
                               "seq long, op string, id long, username string, email string")
    touched = changes.apply_to_store(store, "users", rows.schema, ch, "id")
    after = store.snapshot()
    assert 1 <= len(touched) <= 4 and after.number == before.number + 1
    # all other buckets are the files they were
    assert len(files(before) & files(after)) == 16 - len(touched)
    got = {r.id: (r.username, r.email) for r in changes.read_table(store, "users", rows.schema).collect()}
    want = {i: (f"u{i}", None) for i in range(200) if i != 4} | {3: ("X", None), 500: ("new", "e")}
    assert got == want
    # readers of the earlier snapshot still see it
    assert changes.read_table(store, "users", rows.schema, before).count() == 200
    # buckets that lose all their rows, and no changes at all
    drop = spark.createDataFrame([(1, "delete", i, None, None) for i in got], ch.schema)
    assert len(changes.apply_to_store(store, "users", rows.schema, drop, "id")) == 16
    assert changes.read_table(store, "users", rows.schema).count() == 0
    assert changes.apply_to_store(store, "users", rows.schema, ch.limit(0), "id") == []
    changes.apply_to_store(store, "users", rows.schema, ch, "id")
    assert [r.id for r in changes.read_table(store, "users", rows.schema).collect()] == [500]
