import duckdb

import __spark_entry__ as entry
from tidings.plans.queries import QUERIES

from data_paths import SF001

def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.columns == ["userid", "rank", "article_id"]
    assert df.count() > 0


def test_every_query_has_an_oracle_or_is_declared_rows_only():
    qs, orc = entry.queries(), entry.oracle_sql()
    assert set(orc) <= set(qs)
    # the training-data operators have tests of their own
    assert not set(QUERIES) - set(orc)


def _norm(rows):
    return sorted((tuple(round(v, 6) if isinstance(v, float) else v for v in r) for r in rows), key=repr)


def test_oracle_parity_small(spark):
    con = duckdb.connect()
    for t in ["customer", "supplier", "orders", "lineitem", "events", "pages"]:
        con.execute(f"create view {t} as select * from read_parquet('{SF001}/{t}.parquet')")
    qs, orc = entry.queries(), entry.oracle_sql()
    for name in QUERIES:
        df = qs[name](spark, SF001)
        cols = sorted(df.columns)
        got = _norm(df.select(*cols).collect())
        res = con.execute(f"select {', '.join(cols)} from ({orc[name]}) t").fetchall()
        assert got == _norm(res), name
