"""Listings, keyed lookups and the user/article graph.

A listing takes repeated sort parameters (``"-x"`` = descending), keeps only
allow-listed keys (others are silently dropped), sorts (ascending: nulls
first; descending: nulls last, as a document store orders missing fields),
and optionally limits.  An array key sorts by its smallest element ascending
and by its largest descending.  ``pos`` gives the order as a column.  Without a
sort parameter the tie-break gives the order, without one all columns do.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidings.operators.ranking import with_positions

# Allowed sort keys per collection, and the page size of the article list.
ARTICLE_SORT_KEYS = ("headline.main", "web_url")
RATING_SORT_KEYS = ("user", "article")
RECOMMENDATION_SORT_KEYS = ("userid", "recommendations")
USER_SORT_KEYS = ("username", "email", "creationDate", "updateDate")
ARTICLE_PAGE = 10

# Graph node sizes and colours, edge size, id prefixes.
USER_COLOR = "#0000ff"
ARTICLE_COLOR = "#ff0000"
NODE_SIZE = 10
EDGE_SIZE = 1


def parse_sort(params, allowed, columns: dict | None = None) -> list[tuple[str, bool]]:
    """["-a", "b", "zzz"] -> [("a", True), ("b", False)] for allowed keys only.

    ``columns`` maps an allowed public key to the column that holds it.
    """
    out = []
    for p in params or []:
        desc = p.startswith("-")
        name = p[1:] if desc else p
        if name in allowed:
            out.append(((columns or {}).get(name, name), desc))
    return out


def _key(df: DataFrame, name: str, desc: bool) -> Column:
    c = F.col(name)
    if dict(df.dtypes).get(name, "").startswith("array"):
        c = F.array_max(c) if desc else F.array_min(c)
    return c.desc_nulls_last() if desc else c.asc_nulls_first()


def listing(df: DataFrame, sort: list[tuple[str, bool]], limit: int | None = None,
            tiebreak: str | None = None, pos_col: str = "pos") -> DataFrame:
    keys = [_key(df, n, d) for n, d in sort]
    if tiebreak:
        keys.append(F.col(tiebreak).asc())
    if not keys:
        keys = [F.col(f"`{c}`").asc_nulls_first() for c, t in df.dtypes if "map<" not in t and t != "variant"]
    if limit is not None:
        top = df.orderBy(*keys).limit(limit)
        # at most ``limit`` rows here, so a global window is harmless
        return top.withColumn(pos_col, (F.row_number().over(Window.orderBy(*keys)) - 1).cast("bigint"))
    return with_positions(df, keys, pos_col)


# Fixed value: the web view writes the title under this flat key (the dot is part of the name).
ARTICLE_TITLE_KEY = "headline.main"


def article_json(articles: DataFrame) -> DataFrame:
    """(id, json) web form of an article: id, flat ``headline.main`` title, ``web_url``."""
    return articles.select("id", F.to_json(F.struct(F.col("id"), F.col("headline.main").alias(ARTICLE_TITLE_KEY),
                                                    F.col("web_url"))).alias("json"))


def lookup(df: DataFrame, key: str, keys: DataFrame, keys_col: str | None = None) -> DataFrame:
    """Rows of ``df`` whose key is among ``keys`` (a set-wise point lookup, pushed into a semi join)."""
    k = keys.select(F.col(keys_col or key).alias(key)).distinct()
    return df.join(k, key, "left_semi")


def lookup_one(df: DataFrame, key: str, value) -> DataFrame:
    return df.where(F.col(key) == F.lit(value)).limit(1)


def _unit_hash(c: Column, mult: int) -> Column:
    """Repeatable stand-in for a random coordinate in [0, 1)."""
    m = F.lit(4294967296)
    return F.pmod(F.pmod(c, m) * F.lit(mult), m) / F.lit(4294967296.0)


def graph_nodes(lists: DataFrame) -> DataFrame:
    """Distinct users (blue, spread) and distinct recommended articles (red, at the origin)."""
    users = lists.select(F.col("userid").alias("n")).distinct()
    arts = lists.select(F.explode("recommendations").alias("n")).distinct()
    u = users.select(F.concat(F.lit("user"), F.col("n").cast("string")).alias("id"),
                     F.concat(F.lit("user"), F.col("n").cast("string")).alias("label"),
                     _unit_hash(F.col("n"), 1640531527).alias("x"), _unit_hash(F.col("n"), 1013904223).alias("y"),
                     F.lit(NODE_SIZE).alias("size"), F.lit(USER_COLOR).alias("color"))
    a = arts.select(F.concat(F.lit("article"), F.col("n").cast("string")).alias("id"),
                    F.concat(F.lit("article"), F.col("n").cast("string")).alias("label"),
                    F.lit(0.0).alias("x"), F.lit(0.0).alias("y"),
                    F.lit(NODE_SIZE).alias("size"), F.lit(ARTICLE_COLOR).alias("color"))
    return u.unionByName(a)


def graph_edges(lists: DataFrame) -> DataFrame:
    """One edge per distinct (user, article) of a list."""
    pairs = lists.select("userid", F.explode(F.array_distinct("recommendations")).alias("a"))
    name = F.concat(F.lit("user"), F.col("userid").cast("string"), F.lit("-"), F.col("a").cast("string"))
    return pairs.select(name.alias("id"), name.alias("label"),
                        F.concat(F.lit("user"), F.col("userid").cast("string")).alias("source"),
                        F.concat(F.lit("article"), F.col("a").cast("string")).alias("target"),
                        F.lit(EDGE_SIZE).alias("size"))


def graph_json(lists: DataFrame) -> DataFrame:
    """The graph as JSON lines: (kind, id, json); written with ``write.text`` it streams, never one document."""
    n = graph_nodes(lists)
    e = graph_edges(lists)
    coord = lambda c: F.round(c, 6).cast("decimal(10,6)").alias(c)  # noqa: E731  (plain notation, 6 places)
    nodes = n.select(F.lit("node").alias("kind"), "id",
                     F.to_json(F.struct(coord("x"), coord("y"), "size", "color", "id", "label")).alias("json"))
    edges = e.select(F.lit("edge").alias("kind"), "id",
                     F.to_json(F.struct("source", "target", "size", "id", "label")).alias("json"))
    return nodes.unionByName(edges)
