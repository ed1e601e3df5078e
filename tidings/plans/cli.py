"""Command line for the engine's jobs (run with ``spark-submit`` or ``python -m``).

    python -m tidings.plans.cli batch  --ratings <parquet> --state <folder> [--keep-ratings] [--k 35 --iterations 3 --lam 0.1 --n 10]
    python -m tidings.plans.cli ingest --archive <folder or files...> --out <folder> [--json-lines | --walk 12 --start 2017-3]
    python -m tidings.plans.cli stream --messages <folder> --state <folder> [--ratings <parquet>] [--once]
    python -m tidings.plans.cli compact --state <folder>

``--ratings`` holds (user_id, article_id, rating) or the stored form (userId, articleId, rating).  ``--keep-ratings`` stores
them by user bucket: later runs of ``batch`` and ``stream`` need no ``--ratings``, and the stream reads only its users' ones.
The session's ``spark.checkpoint.dir`` must name shared storage on a cluster.
"""

from __future__ import annotations

import argparse
import json
import os

from pyspark.sql import DataFrame, SparkSession

from tidings.plans import jobs
from tidings.session import DEFAULT_ITERATIONS, DEFAULT_LAMBDA, DEFAULT_RANK, DEFAULT_TOP_N, checkpoint_dir
from tidings.sources.archive import START_MONTH, START_YEAR
from tidings.sources.tables import stored_ratings
from tidings.streaming import ratings as stream


def _ratings(spark: SparkSession, path: str) -> DataFrame:
    df = spark.read.parquet(path)
    return stored_ratings(df) if "userId" in df.columns else df.select("user_id", "article_id", "rating")


def main(argv: list[str] | None = None) -> dict:
    p = argparse.ArgumentParser(prog="tidings")
    sub = p.add_subparsers(dest="cmd", required=True)
    b = sub.add_parser("batch")
    b.add_argument("--ratings")
    b.add_argument("--keep-ratings", action="store_true")
    b.add_argument("--state", "--out", required=True, help="folder of lists, factors and the stream's ratings")
    b.add_argument("--k", type=int, default=DEFAULT_RANK)
    b.add_argument("--iterations", type=int, default=DEFAULT_ITERATIONS)
    b.add_argument("--lam", type=float, default=DEFAULT_LAMBDA)
    b.add_argument("--n", type=int, default=DEFAULT_TOP_N)
    i = sub.add_parser("ingest")
    i.add_argument("--archive", required=True, nargs="+")
    i.add_argument("--out", required=True)
    i.add_argument("--json-lines", action="store_true")
    i.add_argument("--walk", type=int, default=0, help="walk this many months of <archive>/<year>/<month>.json backwards")
    i.add_argument("--start", default=f"{START_YEAR}-{START_MONTH}", help="first month of the walk")
    s = sub.add_parser("stream")
    s.add_argument("--messages", required=True, help="folder of text messages (or kafka servers with --kafka)")
    s.add_argument("--kafka", action="store_true")
    s.add_argument("--state", required=True, help="folder of the batch job output (lists, factors)")
    s.add_argument("--ratings", help="ratings the model was trained on (default: those kept by the batch job)")
    s.add_argument("--k", type=int, default=DEFAULT_RANK)
    s.add_argument("--n", type=int, default=DEFAULT_TOP_N)
    s.add_argument("--lam", type=float, default=DEFAULT_LAMBDA)
    s.add_argument("--topic", default="ratings")
    s.add_argument("--once", action="store_true", help="process what is available, then stop")
    c = sub.add_parser("compact", help="merge stream deltas into a new full version of the lists")
    c.add_argument("--state", required=True)
    a = p.parse_args(argv)

    spark = SparkSession.builder.appName(f"tidings-{a.cmd}").getOrCreate()
    checkpoint_dir(spark)
    if a.cmd == "batch":
        store = stream.open_store(spark, a.state)
        ratings = _ratings(spark, a.ratings) if a.ratings else None
        if ratings is not None and a.keep_ratings:
            stream.put_base_ratings(store, ratings)
            ratings = None
        run = jobs.run_batch(ratings, store, k=a.k, iterations=a.iterations, lam=a.lam, n=a.n)
        result = {"version": run["version"], "state": a.state}
    elif a.cmd == "compact":
        result = {"version": stream.compact(stream.open_store(spark, a.state))}
    elif a.cmd == "ingest":
        if a.walk:
            run = jobs.run_ingest_walk(spark, a.archive[0], a.out, *map(int, a.start.split("-")), months=a.walk)
        else:
            run = jobs.run_ingest(spark, a.archive, a.out, multi_line=not a.json_lines)
        result = {"articles": a.out, "rows": run.articles.count(), "rejects": run.rejects.count(), "missing": run.missing}
    else:
        source = (stream.kafka_messages(spark, a.messages, a.topic) if a.kafka
                  else stream.text_messages(spark, a.messages))
        state = stream.StreamState(stream.open_store(spark, a.state), _ratings(spark, a.ratings) if a.ratings else None,
                                   k=a.k, lam=a.lam, n=a.n, rereads=not a.kafka)
        q = stream.run_stream(source, state, os.path.join(a.state, "_stream_checkpoint"), available_now=a.once)
        q.awaitTermination()
        snap = state.store.snapshot()
        result = {"state": a.state, "version": snap.fact("version"), "last_batch": snap.fact("last")}
    print(json.dumps(result))
    return result


if __name__ == "__main__":
    main()
