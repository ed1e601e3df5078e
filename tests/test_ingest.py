import json
import os

from pyspark.sql import functions as F

from tidings.operators import ingest
from tidings.operators.ranking import group_ranks, with_positions
from tidings.plans import jobs
from tidings.sources.archive import explode_docs, month_sequence, parse_archive_text, read_archives


def _docs(n, month, same_date=False):
    return [{"web_url": f"http://x/{month}/{i}", "pub_date": f"{month}-01T00:00:00Z" if same_date
             else f"{month}-{i % 28 + 1:02d}T00:00:00Z", "headline": {"main": f"t{i}"}, "other": i} for i in range(n)]


def test_split_counts_disjoint_complete(spark, scratch):
    root = os.path.join(scratch, "archive")
    months = {"2017-03": 0, "2017-02": 1, "2017-01": 3, "2016-12": 4, "2016-11": 9}
    paths = []
    for m, n in months.items():
        y, mo = m.split("-")
        os.makedirs(os.path.join(root, y), exist_ok=True)
        p = os.path.join(root, y, f"{int(mo)}.json")
        with open(p, "w") as fh:
            json.dump({"response": {"docs": _docs(n, m, same_date=(m == "2016-11"))}}, fh, indent=1)
        paths.append(p)
    # a month with a null docs array and one with no response at all
    with open(os.path.join(root, "2017", "9.json"), "w") as fh:
        json.dump({"response": {"docs": None}}, fh)
    with open(os.path.join(root, "2017", "10.json"), "w") as fh:
        json.dump({"status": "ERROR"}, fh)
    paths += [os.path.join(root, "2017", "9.json"), os.path.join(root, "2017", "10.json")]
    arts = ingest.articles_from_docs(explode_docs(parse_archive_text(read_archives(spark, paths)), keep=["month"]))
    routed = ingest.route_articles(arts).collect()
    by = {}
    for r in routed:
        by.setdefault(r.month, []).append(r)
    stored = {m: sum(x.route == "stored" for x in rows) for m, rows in by.items()}
    assert stored == {"2017-02": 0, "2017-01": 2, "2016-12": 3, "2016-11": 6}
    assert len(routed) == 17 and len({r.id for r in routed}) == 17
    # stored rows are never newer than stream rows of the same month
    for rows in by.values():
        s = [x.pub_date for x in rows if x.route == "stored"]
        t = [x.pub_date for x in rows if x.route == "stream"]
        assert not s or not t or max(s) <= min(t)
    out = os.path.join(scratch, "articles")
    for _ in range(2):  # a re-run replaces, never duplicates
        run = jobs.run_ingest(spark, paths, out)
        assert run.articles.count() == 17
        assert run.rejects.count() == 1  # the month without a response; one without documents is none
        assert {r.month: r.n for r in run.articles.where("route = 'stored'").groupBy("month").agg(F.count("*").alias("n")).collect()} \
            == {k: v for k, v in stored.items() if v}
    # other fields of a document pass through
    assert {json.loads(r.doc)["other"] for r in run.articles.where("month = '2016-11'").collect()} == set(range(9))
    # a file that now holds less leaves nothing behind; a month that ends empty goes
    with open(os.path.join(root, "2016", "11.json"), "w") as fh:
        json.dump({"response": {"docs": _docs(2, "2016-11")}}, fh)
    with open(os.path.join(root, "2016", "12.json"), "w") as fh:
        fh.write("{broken")
    run = jobs.run_ingest(spark, [os.path.join(root, "2016", m) for m in ("11.json", "12.json")], out)
    assert {r.month: r["count"] for r in run.articles.groupBy("month").count().collect()} == {"2017-02": 1, "2017-01": 3, "2016-11": 2}
    assert run.rejects.count() == 1
    walk = jobs.run_ingest_walk(spark, root, os.path.join(scratch, "walk"), 2017, 3, 6)
    assert walk.missing == ["2016-10"] and walk.articles.count() == 6 and walk.rejects.count() == 1


def test_undated_articles_are_kept(spark, scratch):
    """A null month is a group of its own; in a dated archive, undated documents belong to its month."""
    df = spark.createDataFrame([(1, None, "a"), (2, None, "b"), (3, "2017-01-01", "c")], "n int, pub_date string, web_url string")
    out = ingest.route_articles(ingest.articles_from_docs(df))
    assert sorted((r.n, r.month) for r in out.collect()) == [(1, None), (2, None), (3, "2017-01")]
    os.makedirs(os.path.join(scratch, "2017"))
    for name, date in (("1.json", None), ("x.json", None)):
        with open(os.path.join(scratch, "2017", name), "w") as fh:
            json.dump({"response": {"docs": [{"web_url": f"u{i}{name}", "pub_date": date, "headline": None} for i in range(4)]}}, fh)
    run = jobs.run_ingest(spark, [os.path.join(scratch, "2017")], os.path.join(scratch, "out"))
    assert sorted((r.month, r.route) for r in run.articles.collect()) == [("2017-01", "stored")] * 3 + [("2017-01", "stream")] + [
        ("undated", "stored")] * 3 + [("undated", "stream")]


def test_month_walk_wraps_year(spark):
    rows = month_sequence(spark, 2017, 3, 5).orderBy("step").collect()
    assert [(r.year, r.month) for r in rows] == [(2017, 3), (2017, 2), (2017, 1), (2016, 12), (2016, 11)]


def test_positions_and_hot_group_ranks(spark):
    # one group holds most rows: ranks must still be exact
    df = spark.range(0, 5000).select(F.when(F.col("id") < 4000, F.lit(0)).otherwise(F.col("id") % 7).alias("g"),
                                     (F.col("id") * 7919 % 5000).alias("v"))
    pos = with_positions(df, ["v"]).collect()
    assert sorted(r.pos for r in pos) == list(range(5000))
    assert all(r.pos == r.v for r in pos)  # v is a permutation of 0..4999
    ranks = group_ranks(df, "g", ["v"]).collect()
    by = {}
    for r in ranks:
        by.setdefault(r.g, []).append((r.v, r.rank, r.group_size))
    for g, rows in by.items():
        rows.sort()
        assert [k for _, k, _ in rows] == list(range(1, len(rows) + 1))
        assert {s for _, _, s in rows} == {len(rows)}


def test_malformed_archive_text_is_rejected_not_fatal(spark):
    from tidings.sources.archive import parse_archive_text, split_archive_rejects
    docs = [('{"response": {"docs": [{"web_url": "u1", "pub_date": "2017-03-01T00:00:00Z", "headline": {"main": "a"}}]}}',),
            ('{not json',), ('{"status": "ERROR"}',), ('{"response": {"docs": []}}',)]
    parsed = parse_archive_text(spark.createDataFrame(docs, "body string"))
    good, rejects = split_archive_rejects(parsed)
    assert good.count() == 2 and rejects.count() == 2
    arts = ingest.articles_from_docs(explode_docs(good, "archive"))
    assert [(r.web_url, r.month) for r in arts.collect()] == [("u1", "2017-03")]


from hypothesis import given, settings, strategies as st


@settings(max_examples=8, deadline=None)
@given(n=st.integers(1, 400), groups=st.integers(1, 6), hot=st.floats(0.0, 0.9), seed=st.integers(0, 1000))
def test_group_ranks_property(spark, n, groups, hot, seed):
    import random
    rnd = random.Random(seed)
    rows = [(0 if rnd.random() < hot else rnd.randrange(groups), rnd.randrange(5), i) for i in range(n)]
    df = spark.createDataFrame(rows, "g int, v int, id int")
    got = {r.id: (r.rank, r.group_size) for r in group_ranks(df, "g", ["v", "id"]).collect()}
    want = {}
    for g in {r[0] for r in rows}:
        members = sorted((r for r in rows if r[0] == g), key=lambda r: (r[1], r[2]))
        for i, r in enumerate(members):
            want[r[2]] = (i + 1, len(members))
    assert got == want


def test_archive_stream_routes_only_touched_months(spark, scratch):
    import json
    import os

    from tidings.streaming import archive

    def put(year, month, urls):
        os.makedirs(f"{scratch}/archive/{year}", exist_ok=True)
        docs = [{"web_url": u, "pub_date": f"{year}-{month:02d}-0{i + 1}T00:00:00Z", "headline": {"main": u}} for i, u in enumerate(urls)]
        with open(f"{scratch}/archive/{year}/.{month}.json", "w") as fh:
            fh.write(json.dumps({"response": {"docs": docs}}, indent=1) if urls is not None else "{")
        os.rename(f"{scratch}/archive/{year}/.{month}.json", f"{scratch}/archive/{year}/{month}.json")

    log, out = [], f"{scratch}/articles"

    def run():
        texts = archive.archive_texts(spark, f"{scratch}/archive")
        archive.run_archive_stream(texts, out, f"{scratch}/ck", log=log).awaitTermination()
        return {r.month: (r.articles, r.stored, r.files) for r in archive.month_counts(spark, out).collect()}

    put(2020, 1, ["http://a/1", "http://a/2", "http://a/3", "http://a/4"])
    put(2020, 2, ["http://b/1"])
    assert run() == {"2020-01": (4, 3, 1), "2020-02": (1, 0, 1)}
    first = {r.f for r in spark.read.parquet(f"{out}/month=2020-01").selectExpr("_metadata.file_path as f").collect()}
    put(2020, 3, ["http://c/1", "http://c/2"])
    assert run() == {"2020-01": (4, 3, 1), "2020-02": (1, 0, 1), "2020-03": (2, 1, 1)}
    assert [x["months"] for x in log] == [["2020-01", "2020-02"], ["2020-03"]]
    # a month that no new file touches keeps its files
    assert {r.f for r in spark.read.parquet(f"{out}/month=2020-01").selectExpr("_metadata.file_path as f").collect()} == first
    assert run()["2020-03"] == (2, 1, 1) and len(log) == 2  # nothing new
