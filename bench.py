"""Headline timings: prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8).  Each
query is forced with the ``noop`` sink (full computation, nothing collected).
Parameters are the reference's batch configuration: rank 35, 3 iterations,
lambda 0.1, top 10.
"""

from __future__ import annotations

import json
import os
import re
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tidings.functions.messages import encode_ratings  # noqa: E402
from tidings.operators import als, topn  # noqa: E402
from tidings.plans import fixtures as fx  # noqa: E402
from tidings.plans import queries as q  # noqa: E402
from tidings.session import build_session  # noqa: E402
from tidings.streaming import ratings as stream  # noqa: E402


def force(df):
    df.write.format("noop").mode("overwrite").save()


def main():
    d = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    scratch = tempfile.mkdtemp(prefix="tidings-bench-")
    spark = build_session(f"local[{cpus}]", max(8, cpus), extra={
        "spark.checkpoint.dir": os.path.join(scratch, "ckpt"), "spark.driver.memory": "16g"})
    times = {}

    def timed(name, fn):
        t = time.time()
        out = fn()
        times[name] = round(time.time() - t, 3)
        return out

    r = fx.ratings(spark, d, "orders")
    model = timed("als_train_k35", lambda: als.train(r, k=35, iterations=3))
    timed("recommend_top10", lambda: force(topn.to_lists(
        topn.recommend(model.users, model.articles, r, n=10, k=35, n_users=model.n_users, n_articles=model.n_articles,
                       n_ratings=model.n_ratings), 10, require_full=True)))

    # set-up, not timed: the history model with its table, and the full lists that the graph shows
    hist = fx.ratings(spark, d, "events_before")
    m = als.train(hist, k=35, iterations=3)
    table = topn.to_lists(topn.recommend(m.users, m.articles, hist, n=fx.TABLE_N, k=35, n_users=m.n_users,
                                         n_articles=m.n_articles), fx.TABLE_N)
    store = stream.open_store(spark, os.path.join(scratch, "stream"))
    stream.put_model(store, table, m.articles)
    stream.put_base_ratings(store, hist)
    state = stream.StreamState(store, k=35, n=fx.TABLE_N)
    messages = encode_ratings(fx.events_ratings(spark, d, "after").drop("event_id")).select("value")
    fx.full_lists(spark, d)

    timed("stream_batch_k35", lambda: stream.process_batch(state, messages, 0))
    for name in ["temporal_split", "article_routes", "archive_ingest", "decode_rating_messages", "ratings_listing",
                 "users_listing", "apply_changes", "graph_edges"]:
        timed(name, lambda n=name: force(q.QUERIES[n](spark, d)))
    sf = re.search(r"sf([0-9.]+)", d)
    print(json.dumps({"metric": "total_sec", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": float(sf.group(1)) if sf else d}))
    spark.stop()


if __name__ == "__main__":
    main()
