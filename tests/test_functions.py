import pytest
from pyspark.sql import functions as F

from tidings.functions.dates import display_date, millis_to_timestamp, timestamp_to_millis
from tidings.functions.hashing import string_hash32
from tidings.functions.messages import decode_ratings, encode_ratings, split_decoded
from tidings.functions.vectors import add, dot, init_vector, outer, scale

from data_paths import SF01


def java_hash(s: str) -> int:
    data = s.encode("utf-16-le")
    h = 0
    for i in range(0, len(data), 2):  # UTF-16 code units, as the JVM hashes them
        h = (31 * h + int.from_bytes(data[i:i + 2], "little")) & 0xFFFFFFFF
    return h - (1 << 32) if h >= (1 << 31) else h


def test_string_hash_matches_jvm_rule_on_pages(spark):
    rows = spark.read.parquet(f"{SF01}/pages.parquet").select("url", string_hash32("url").alias("h")).collect()
    assert len(rows) == 250
    assert all(r.h == java_hash(r.url) for r in rows)
    assert sum(r.h < 0 for r in rows) > 0  # negative ids occur


@pytest.mark.parametrize("s", ["", "a", "Aa", "BB", "héllo wörld", "日本語", "x" * 500, "a😀b", "𝄞" * 3 + "z"])
def test_string_hash_edge_cases(spark, s):
    got = spark.createDataFrame([(s,)], "u string").select(string_hash32("u")).first()[0]
    assert got == java_hash(s)


def test_string_hash_null(spark):
    assert spark.createDataFrame([(None,)], "u string").select(string_hash32("u")).first()[0] is None


def test_decode_fixture_table(spark):
    rows = [("1,2,0.5",), ("x,2,0.5",), ("1,2",), ("",), ("3,4,abc",), ("5, 6 ,1",)]
    out = decode_ratings(spark.createDataFrame(rows, "value string")).collect()
    got = [(r.user_id, r.article_id, r.rating, r.ok) for r in out]
    assert got == [(1, 2, 0.5, True), (None, 2, 0.5, False), (1, 2, None, True), (None, None, None, False),
                   (3, 4, None, True), (5, 6, 1.0, True)]
    good, rejects = split_decoded(decode_ratings(spark.createDataFrame(rows, "value string")))
    assert good.count() == 4 and rejects.count() == 2


def test_encode_decode_roundtrip(spark):
    df = spark.createDataFrame([(1, -2, 0.00076), (3, 4, 1e-12), (5, 6, 0.1)], "user_id long, article_id long, rating double")
    enc = encode_ratings(df)
    assert enc.where(F.col("key").isNotNull()).count() == 0
    back = decode_ratings(enc).select("user_id", "article_id", "rating")
    assert sorted(back.collect()) == sorted(df.collect())


def test_dates_absent_is_null_not_before_epoch(spark):
    df = spark.createDataFrame([(-1,), (0,), (1500000000000,)], "m long")
    out = df.select(millis_to_timestamp("m").alias("t")).select("t", timestamp_to_millis("t").alias("m"),
                                                                 display_date("t").alias("s")).collect()
    assert out[0].t is None and out[0].m == -1 and out[0].s == "n/a"
    assert out[1].m == 0 and out[1].s == "Jan 01, 1970"
    assert out[2].m == 1500000000000 and out[2].s == "Jul 14, 2017"


def test_vector_expressions(spark):
    df = spark.createDataFrame([([1.0, 2.0], [3.0, 4.0], 2.0)], "a array<double>, b array<double>, r double")
    r = df.select(dot("a", "b").alias("d"), scale("a", "r").alias("s"), add("a", "b").alias("p"),
                  outer("a").alias("o")).first()
    assert r.d == 11.0 and r.s == [2.0, 4.0] and r.p == [4.0, 6.0] and r.o == [[1.0, 2.0], [2.0, 4.0]]


def test_init_vector_modes(spark):
    df = spark.createDataFrame([(3,), (-7,)], "id long")
    r = df.select(init_vector("id", 2, 1, "arith").alias("a"), init_vector("id", 35, 1, "hash").alias("h")).collect()
    assert [round(x, 9) for x in r[0].a] == [round(((3 * 7 + 1) % 10) * 0.1, 9), round(((3 * 7 + 4) % 10) * 0.1, 9)]
    assert all(0 <= x <= 0.9 + 1e-12 for row in r for x in row.a + row.h)
    assert len(r[1].h) == 35 and len(set(r[1].h)) > 1


def test_rating_forms_and_factor_roundtrip(spark):
    from tidings.sources.sinks import loaded_factors, stored_factors
    from tidings.sources.tables import stored_ratings, web_ratings
    stored = spark.createDataFrame([(1, -5, 0.5)], "userId long, articleId long, rating double")
    web = spark.createDataFrame([(7, 1, -5, 3)], "id int, user int, article int, rating int")
    assert stored_ratings(stored).collect()[0].asDict() == {"user_id": 1, "article_id": -5, "rating": 0.5}
    assert web_ratings(web).collect()[0].asDict() == {"user_id": 1, "article_id": -5, "rating": 3.0}
    f = spark.createDataFrame([(3, [0.1, 0.2])], "id long, f array<double>")
    assert stored_factors(f).columns == ["articleId", "latentFactors"]
    assert loaded_factors(stored_factors(f)).collect() == f.collect()


def test_json_forms_read_back_and_reject(spark):
    from pyspark.sql import functions as F

    from tidings.functions import documents
    texts = spark.createDataFrame([('{"id":1,"user":2,"article":3,"rating":4}',), ('{"id":1,"user":2}',), ("[1]",), ("{x",), (None,), ("",)],
                                  "json string")
    out = documents.decode_rating_json(texts)
    assert [tuple(r)[:4] for r in out.where("ok").collect()] == [(1, 2, 3, 4)] and out.where("not ok").count() == 5
    lists = spark.createDataFrame([(1, [5, 6]), (2, [])], "userid long, recommendations array<bigint>")
    back = documents.decode_list_json(documents.list_json(lists).select("json"))
    assert sorted((r.userid, r.recommendations) for r in back.where("ok").collect()) == [(1, [5, 6]), (2, [])]
    users = spark.createDataFrame([('{"username":"a"}',), ('{"id":7,"username":"b","email":"e","creationDate":1000,"updateDate":-1}',),
                                   ('{"id":8}',)], "json string")
    got = documents.decode_user_json(users).where("ok").orderBy("id").select("id", "username", "email", F.unix_millis("creation_date"),
                                                                             "update_date").collect()
    assert [tuple(r) for r in got] == [(-1, "a", None, None, None), (7, "b", "e", 1000, None)]
