"""Explicit schemas and canonical column names (no inference anywhere)."""

from pyspark.sql import types as T

# canonical rating row: one event of a user scoring an article
RATINGS = T.StructType([
    T.StructField("user_id", T.LongType()),
    T.StructField("article_id", T.LongType()),
    T.StructField("rating", T.DoubleType()),
])

# a latent factor table: key + dense vector of k doubles
FACTORS = T.StructType([
    T.StructField("id", T.LongType()),
    T.StructField("f", T.ArrayType(T.DoubleType())),
])

# stored form of the article factors
STORED_FACTORS = T.StructType([
    T.StructField("articleId", T.LongType()),
    T.StructField("latentFactors", T.ArrayType(T.DoubleType())),
])

# one recommendation list per user, best article first
RECOMMENDATIONS = T.StructType([
    T.StructField("userid", T.LongType()),
    T.StructField("recommendations", T.ArrayType(T.LongType())),
])

# exploded form of the lists: easier to compare, join and rank
RANKED = T.StructType([
    T.StructField("userid", T.LongType()),
    T.StructField("rank", T.IntegerType()),
    T.StructField("article_id", T.LongType()),
    T.StructField("score", T.DoubleType()),
])

# the typed fields of an archive document; the document itself is kept as JSON, all fields included
ARCHIVE_DOC = T.StructType([
    T.StructField("web_url", T.StringType()),
    T.StructField("pub_date", T.StringType()),
    T.StructField("headline", T.StructType([T.StructField("main", T.StringType())])),
])
# a monthly archive: response.docs[], each document as its JSON text
ARCHIVE = T.StructType([
    T.StructField("response", T.StructType([
        T.StructField("docs", T.ArrayType(T.StringType())),
    ])),
    T.StructField("_corrupt_record", T.StringType()),
])

USERS = T.StructType([
    T.StructField("id", T.LongType()),
    T.StructField("username", T.StringType()),
    T.StructField("email", T.StringType()),
    T.StructField("creation_date", T.TimestampType()),
    T.StructField("update_date", T.TimestampType()),
])

# rating message: a single text value "user_id,article_id,rating", null key
MESSAGE = T.StructType([T.StructField("value", T.StringType())])
