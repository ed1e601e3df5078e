import json
import os

from tidings.functions.messages import encode_ratings
from tidings.plans import cli
from tidings.plans import fixtures as fx
from tidings.sources.sinks import write_messages
from tidings.streaming import ratings as stream

from data_paths import SF001


def test_batch_then_stream_then_ingest(spark, scratch):
    hist = fx.ratings(spark, SF001, "events_before")
    hist.write.parquet(os.path.join(scratch, "ratings"))
    out = os.path.join(scratch, "state")
    r = cli.main(["batch", "--ratings", os.path.join(scratch, "ratings"), "--keep-ratings", "--state", out, "--k", "4", "--n", "3"])
    assert r["version"] == 0
    store = stream.open_store(spark, out)
    lists = stream.read_lists(store)
    assert lists.count() > 0 and all(len(x.recommendations) == 3 for x in lists.collect())
    assert set(stream.article_factors(store).columns) == {"articleId", "latentFactors"}

    after = fx.events_ratings(spark, SF001, "after").drop("event_id")
    write_messages(encode_ratings(after), "text", os.path.join(scratch, "msgs"))
    s = cli.main(["stream", "--messages", os.path.join(scratch, "msgs"), "--state", out, "--k", "4", "--n", "3", "--once"])
    assert s["version"] == 0 and s["last_batch"] >= 0
    final = stream.read_lists(store).collect()
    rated = {(x.user_id, x.article_id) for x in fx.ratings(spark, SF001, "events").collect()}
    assert not any((row.userid, a) in rated for row in final for a in row.recommendations)

    before = sorted((row.userid, tuple(row.recommendations)) for row in final)
    c = cli.main(["compact", "--state", out])
    assert c["version"] == 1 and len(store.snapshot().parts(stream.LISTS)) == 1
    after = sorted((row.userid, tuple(row.recommendations)) for row in stream.read_lists(store).collect())
    assert after == before
    # a later batch run needs no ratings, and takes the stream's along
    assert cli.main(["batch", "--state", out, "--k", "4", "--n", "3"])["version"] == 2
    assert store.snapshot().fact("trained") == store.snapshot().fact("last")

    arch = os.path.join(scratch, "archive")
    os.makedirs(arch)
    with open(os.path.join(arch, "3.json"), "w") as fh:
        json.dump({"response": {"docs": [{"web_url": f"http://n/{i}", "pub_date": f"2017-03-0{i + 1}T00:00:00Z",
                                          "headline": {"main": str(i)}} for i in range(4)]}}, fh, indent=2)
    g = cli.main(["ingest", "--archive", arch, "--out", os.path.join(scratch, "articles")])
    assert g["rows"] == 4
    routes = sorted(x.route for x in spark.read.parquet(os.path.join(scratch, "articles")).collect())
    assert routes == ["stored", "stored", "stored", "stream"]
