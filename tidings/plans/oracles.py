"""DuckDB SQL oracles, one per registered query that SQL can express.

The k=2 factorisation is unrolled as materialised CTEs (Cramer's rule for the
2x2 solve); the arithmetic initialisation is integer SQL.  Doubles from linear
algebra are rounded to 6 decimals, as in the Spark queries.
"""

from __future__ import annotations

from tidings.plans import fixtures as fx

LAM = "cast(0.1 as double)"
CUT = f"timestamp '{fx.EVENT_CUT}'"

R_EVENTS = ("select user_id, cast(props->>'$.k' as bigint) as article_id, value / 500 as rating "
            "from events where props->>'$.k' is not null and value is not null")
R_EVENTS_ID = ("select event_id, event_type, user_id, cast(props->>'$.k' as bigint) as article_id, "
               "value / 500 as rating, ts from events where props->>'$.k' is not null and value is not null")
R_BEFORE = R_EVENTS + f" and ts < {CUT}"
R_AFTER = R_EVENTS + f" and ts >= {CUT}"
R_SECOND_HISTORY = R_EVENTS + f" and ts < timestamp '{fx.SECOND_CUT}'"
R_LATE = R_EVENTS + f" and ts >= timestamp '{fx.SECOND_CUT}'"
R_ORDERS = ("select o_custkey as user_id, l_partkey as article_id, l_quantity / 50 as rating "
            "from lineitem join orders on l_orderkey = o_orderkey")

HASH = ("cast(case when h >= 2147483648 then h - 4294967296 else h end as integer)")


def _hash_of(col: str) -> str:
    # a code point above U+FFFF counts as its UTF-16 surrogate pair
    step = ("case when c > 65535 then (a * 961 + 31 * (55296 + ((c - 65536) >> 10)) + (56320 + (c - 65536) % 1024)) "
            "% 4294967296 else (a * 31 + c) % 4294967296 end")
    return (f"(select {HASH} from (select list_reduce(list_transform(string_split({col}, ''), "
            f"lambda c: cast(ascii(c) as bigint)), lambda a, c: {step}, cast(0 as bigint)) as h))")


def _init_dim(d: int) -> str:
    return (f"cast((((id * 7 + {d * 3 + fx.ORACLE_SEED}) % 10) + 10) % 10 as double) * cast(0.1 as double)")


def _step(name: str, src: str, key: str, other: str, r: str = "r") -> str:
    return (f"{name} as materialized (select id, (bb * ra - ab * rb) / (aa * bb - ab * ab) as a, "
            f"(aa * rb - ab * ra) / (aa * bb - ab * ab) as b from (select q.{key} as id, "
            f"sum(p.a * p.a) + {LAM} as aa, sum(p.a * p.b) as ab, sum(p.b * p.b) + {LAM} as bb, "
            f"sum(p.a * q.rating) as ra, sum(p.b * q.rating) as rb from {r} q join {src} p on q.{other} = p.id "
            f"group by q.{key}))")


def als_ctes(r_sql: str, iterations: int = 3, prefix: str = "") -> list[str]:
    """r, v0, u1, v1, ..., u<it>, v<it> (names carry ``prefix``)."""
    p = prefix
    ctes = [f"{p}r as materialized ({r_sql})",
            f"{p}v0 as materialized (select id, {_init_dim(0)} as a, {_init_dim(1)} as b "
            f"from (select distinct article_id as id from {p}r))"]
    for i in range(1, iterations + 1):
        ctes.append(_step(f"{p}u{i}", f"{p}v{i - 1}", "user_id", "article_id", f"{p}r"))
        ctes.append(_step(f"{p}v{i}", f"{p}u{i}", "article_id", "user_id", f"{p}r"))
    return ctes


def _with(ctes: list[str], body: str) -> str:
    return "with " + ",\n".join(ctes) + "\n" + body


def _factors(src: str) -> str:
    return f"select id, round(a, 6) as f0, round(b, 6) as f1 from {src}"


def _topn(u: str, v: str, n: int, mask: str | None, score: bool = False) -> str:
    cond = f"where u.a * v.a + u.b * v.b > 0"
    if mask:
        cond += f" and not exists (select 1 from {mask} m where m.user_id = u.id and m.article_id = v.id)"
    sc = ", round(sc, 6) as score" if score else ""
    return (f"select userid, rank, article_id{sc} from (select u.id as userid, v.id as article_id, "
            f"u.a * v.a + u.b * v.b as sc, cast(row_number() over (partition by u.id order by "
            f"u.a * v.a + u.b * v.b desc, v.id) as integer) as rank from {u} u cross join {v} v {cond}) t "
            f"where rank <= {n}")


def _full(ranked: str, n: int) -> str:
    return (f"select userid, rank, article_id from ({ranked}) x where userid in "
            f"(select userid from ({ranked}) y group by userid having count(*) = {n})")


def _full_lists() -> list[str]:
    """CTEs ending in ``lists``: full lists of ten of the model of all events."""
    return als_ctes(R_EVENTS, prefix="h") + [f"lists as materialized ({_full(_topn('hu3', 'hv3', 10, 'hr'), 10)})"]


def _list_table(hist: str = R_BEFORE) -> list[str]:
    """CTEs ending in ``lists`` (userid, rank, article_id): full lists of the history model."""
    return als_ctes(hist, prefix="h") + [
        f"lists as materialized ({_full(_topn('hu3', 'hv3', fx.TABLE_N, 'hr'), fx.TABLE_N)})"]


def _after_removal(hist: str = R_BEFORE, batch: str = R_AFTER) -> list[str]:
    return _list_table(hist) + [
        f"batch as materialized ({batch})",
        "affected as materialized (select distinct userid from lists where userid in (select user_id from batch))",
        "kept as materialized (select l.userid, l.article_id, cast(row_number() over (partition by l.userid "
        "order by l.rank) as integer) as rank from lists l where l.userid in (select userid from affected) "
        "and not exists (select 1 from batch b where b.user_id = l.userid and b.article_id = l.article_id))",
        "refresh as materialized (select userid from affected where userid not in (select userid from kept))",
    ]


def _refreshed(hist: str = R_BEFORE, batch: str = R_AFTER) -> list[str]:
    """Fold-in for emptied lists over all their ratings, top-N any."""
    return _after_removal(hist, batch) + [
        f"allr as materialized ({R_EVENTS})",
        "fr as materialized (select * from allr where user_id in (select userid from refresh))",
        _step("fu", "hv3", "user_id", "article_id", "fr"),
        f"fresh as materialized ({_topn('fu', 'hv3', fx.TABLE_N, 'fr')})",
    ]


def _updated_rows_tail() -> str:
    return ("select userid, rank, article_id from lists where userid not in (select userid from affected) "
            "union all select userid, rank, article_id from kept")


def _stream_users() -> str:
    return f"select distinct user_id from ({R_AFTER}) s"


def _articles_sql() -> str:
    day = f"(date '{fx.ARCHIVE_EPOCH}' + cast(floor(page_id / 3) as integer))"
    return (f"select {_hash_of('url')} as id, url as web_url, strftime({day}, '%Y-%m-%dT00:00:00Z') as pub_date, "
            f"regexp_extract(html, '{fx.TITLE_PATTERN}', 1) as title, strftime({day}, '%Y-%m') as month, "
            f"page_id, cast(length(html) as bigint) as word_count from pages")


def _messages_sql() -> str:
    u, a, r = "cast(user_id as varchar)", "cast(article_id as varchar)", "cast(rating as varchar)"
    return (f"select event_id, case when event_type = 'error' then concat_ws(',', 'x', {a}, {r}) "
            f"when event_type = 'signup' then concat_ws(',', {u}, {a}) "
            f"when event_type = 'view' then concat(' ', {u}, ' , ', {a}, ' ,', {r}) "
            f"when event_type = 'click' then concat_ws(',', {u}, {a}, 'abc') "
            f"else concat_ws(',', {u}, {a}, {r}) end as value from ({R_EVENTS_ID}) e")


def _field(i: int, typ: str) -> str:
    return f"try_cast(trim(string_split(value, ',')[{i}]) as {typ})"


_MILLIS = "(1500000000000 + c_custkey * 86400000)"


def _users_sql() -> str:
    return (f"select c_custkey as id, c_name as username, case when c_custkey % 3 = 0 then null else "
            f"concat(lower(replace(c_name, '#', '.')), '@example.com') end as email, "
            f"case when c_custkey % 5 = 0 then null else make_timestamp({_MILLIS} * 1000) end as creation_date, "
            f"case when c_custkey % 5 = 0 then null else make_timestamp(({_MILLIS} + 3600000) * 1000) end "
            f"as update_date from customer")


def _lists_pretty() -> str:
    return ("select userid, string_agg(cast(article_id as varchar), ',' order by rank) as recommendations, "
            "min(article_id) as mn, max(article_id) as mx from lists group by userid")


def _new_users() -> str:
    return ("select (select max(c_custkey) + 1 from customer) + row_number() over (order by s_suppkey) - 1 as id, "
            "s_suppkey, s_name as username from supplier")


def _node_hash(col: str, mult: int) -> str:
    m = 4294967296
    base = f"(({col} % {m}) + {m}) % {m}"
    return f"round(cast(((({base}) * {mult}) % {m} + {m}) % {m} as double) / {m}.0, 6)"


def oracle_sql() -> dict[str, str]:
    q: dict[str, str] = {}
    q["ratings_typed"] = R_EVENTS
    q["distinct_articles"] = f"select distinct article_id from ({R_EVENTS}) r"
    q["ratings_of_users"] = f"select * from ({R_EVENTS}) r where user_id in ({_stream_users()})"
    q["init_factors"] = _with(als_ctes(R_EVENTS, 0), _factors("v0"))
    q["factor_entries"] = _with(als_ctes(R_EVENTS, 0), "select id, 0 as dim, round(a, 6) as value from v0 "
                                                        "union all select id, 1, round(b, 6) from v0")
    sums = ("select q.user_id, round(sum(p.a * p.a), 6) as g00, round(sum(p.a * p.b), 6) as g01, "
            "round(sum(p.b * p.b), 6) as g11, round(sum(p.a * q.rating), 6) as b0, round(sum(p.b * q.rating), 6) "
            "as b1 from r q join v0 p on q.article_id = p.id group by q.user_id")
    q["gram_sums"] = _with(als_ctes(R_EVENTS, 0), f"select user_id, g00, g01, g11 from ({sums}) s")
    q["weighted_vector_sums"] = _with(als_ctes(R_EVENTS, 0), f"select user_id, b0, b1 from ({sums}) s")
    q["als_user_halfstep"] = _with(als_ctes(R_EVENTS, 1), _factors("u1"))
    q["als_article_halfstep"] = _with(als_ctes(R_EVENTS, 1), _factors("v1"))
    q["als_user_factors"] = _with(als_ctes(R_EVENTS), _factors("u3"))
    q["als_article_factors"] = _with(als_ctes(R_EVENTS), _factors("v3"))
    q["als_user_factors_orders"] = _with(als_ctes(R_ORDERS), _factors("u3"))
    q["als_article_factors_orders"] = _with(als_ctes(R_ORDERS), _factors("v3"))
    q["als_scores"] = _with(als_ctes(R_EVENTS), _topn("u3", "v3", 10, None, score=True))
    q["als_unrated_scores"] = _with(als_ctes(R_EVENTS), _topn("u3", "v3", 10, "r", score=True))
    q["als_recommend_any"] = _with(als_ctes(R_EVENTS), _topn("u3", "v3", 10, "r"))
    q["als_recommend_full"] = _with(als_ctes(R_EVENTS), _full(_topn("u3", "v3", 50, "r"), 50))
    q["als_recommend_full_orders"] = _with(als_ctes(R_ORDERS), _full(_topn("u3", "v3", 10, "r"), 10))
    fold = als_ctes(R_BEFORE, prefix="h") + [
        f"fr as materialized (select * from ({R_EVENTS}) a where user_id in ({_stream_users()}))",
        _step("fu", "hv3", "user_id", "article_id", "fr")]
    q["fold_in_factors"] = _with(fold, _factors("fu"))
    q["fold_in_topn"] = _with(fold, _topn("fu", "hv3", 10, "fr"))
    q["article_id_hash"] = f"select page_id, url, {_hash_of('url')} as id from pages"
    q["archive_docs"] = f"select id, web_url, pub_date, title, month from ({_articles_sql()}) a"
    q["article_routes"] = (
        f"select id, month, case when rn <= floor(n * 0.75) then 'stored' else 'stream' end as route from ("
        f"select id, month, row_number() over (partition by month order by pub_date nulls first, id, web_url) as rn, "
        f"count(*) over (partition by month) as n from ({_articles_sql()}) a) t")
    ranked = (f"select *, row_number() over (partition by month order by pd nulls first, id, web_url) as rn, count(*) over "
              f"(partition by month) as n from (select *, {{pd}} as pd from ({_articles_sql()}) a0) a1")
    route = "case when rn <= floor(n * 0.75) then 'stored' else 'stream' end as route"
    q["archive_ingest"] = f"select id, month, {route}, word_count from ({ranked.format(pd='pub_date')}) t"
    q["archive_ingest_two_runs"] = q["archive_ingest"]
    q["archive_stream"] = q["archive_ingest"]
    q["archive_stream_months"] = ("select month, count(*) as articles, count(*) filter (where route = 'stored') as stored "
                                  f"from ({q['archive_ingest']}) a group by month")
    q["archive_ingest_undated"] = (
        f"select id, month, {route}, pd as pub_date from "
        f"({ranked.format(pd=f'case when word_count <= {fx.UNDATED_CHARS} then pub_date end')}) t")
    chunk = f"floor(page_id / {fx.DOCS_PER_FILE})"
    q["archive_rejects"] = (
        f"select month, cast(sum(case when {chunk} % 3 = 0 then 0 else 1 end) as bigint) as articles, "
        f"cast(count(distinct case when {chunk} % 3 = 0 then {chunk} end) as bigint) as rejects "
        f"from ({_articles_sql()}) a group by month")
    q["batch_job_lists"] = q["als_recommend_full_orders"].replace(R_ORDERS, R_EVENTS)
    q["stored_article_factors"] = _with(als_ctes(R_EVENTS), "select id as articleId, 0 as dim, round(a, 6) as value "
                                                             "from v3 union all select id, 1, round(b, 6) from v3")
    q["archive_months"] = (
        "with p as (select distinct strftime(o_orderdate, '%Y-%m') as m from orders), "
        "b as (select max(strptime(m || '-01', '%Y-%m-%d')) as hi, min(strptime(m || '-01', '%Y-%m-%d')) as lo from p), "
        "w as (select cast(row_number() over (order by d desc) - 1 as integer) as step, d from b, "
        "unnest(generate_series(hi, lo, interval '-1 month')) as t(d)) "
        "select step, cast(year(d) as integer) as year, cast(month(d) as integer) as month, "
        "strftime(d, '%Y-%m') in (select m from p) as present from w")
    q["temporal_split"] = (
        "select o_orderkey, month, case when rn <= floor(n * 0.75) then 'stored' else 'stream' end as route from ("
        "select o_orderkey, strftime(o_orderdate, '%Y-%m') as month, row_number() over (partition by "
        "strftime(o_orderdate, '%Y-%m') order by o_orderdate, o_orderkey) as rn, count(*) over (partition by "
        "strftime(o_orderdate, '%Y-%m')) as n from orders) t")
    q["encode_rating_messages"] = (
        f"select cast(null as varchar) as key, concat_ws(',', cast(user_id as varchar), cast(article_id as varchar)) "
        f"as ids, rating from ({R_EVENTS}) r")
    q["decode_rating_messages"] = (
        f"select user_id, article_id, rating, user_id is not null and article_id is not null as ok from ("
        f"select {_field(1, 'bigint')} as user_id, {_field(2, 'bigint')} as article_id, "
        f"{_field(3, 'double')} as rating from ({_messages_sql()}) m) d")
    q["apply_ratings"] = _with(_after_removal(), "select userid, rank, article_id from kept")
    q["users_to_refresh"] = _with(_after_removal(), "select userid from refresh")
    q["upsert_recommendations"] = _with(_after_removal(), _updated_rows_tail())
    q["stream_apply_ratings"] = _with(_refreshed(), _updated_rows_tail() +
                                      " union all select userid, rank, article_id from fresh")
    q["stream_then_batch_lists"] = _with(_refreshed(R_SECOND_HISTORY, R_LATE), _updated_rows_tail() +
                                         " union all select userid, rank, article_id from fresh")
    q["batch_beside_open_stream"] = q["stream_then_batch_lists"]
    q["stream_rejects"] = (
        f"select 'stored' as kind, count(*) as n from ({q['decode_rating_messages']}) x where ok "
        f"union all select 'rejected', count(*) from ({q['decode_rating_messages']}) x where not ok")
    q["article_listing"] = (
        f"select id, title, web_url as url, cast(row_number() over (order by title desc nulls last, web_url asc "
        f"nulls first, id) - 1 as bigint) as pos from ({_articles_sql()}) a order by pos limit 10")
    q["article_listing_default"] = (
        f"select id, title, web_url as url, cast(row_number() over (order by id, title nulls first, web_url nulls first) - 1 as bigint) "
        f"as pos from ({_articles_sql()}) a order by pos limit 10")
    q["users_listing_default"] = (f"select id, username, email, cast(row_number() over (order by id) - 1 as bigint) as pos "
                                  f"from ({_users_sql()}) u")
    q["als_residual_k35"] = f"select distinct user_id as id, true as solved from ({R_ORDERS}) r"
    q["article_json"] = (f"select id, to_json(struct_pack(id := id, \"headline.main\" := title, web_url := web_url)) "
                         f"as json from ({_articles_sql()}) a")
    q["ratings_listing"] = (
        f"select event_id as id, user_id as user, article_id as article, cast(row_number() over (order by user_id "
        f"nulls first, article_id desc nulls last, event_id) - 1 as bigint) as pos from ({R_EVENTS_ID}) r")
    q["recommendations_listing"] = _with(_full_lists(), (
        f"select userid, recommendations, cast(row_number() over (order by mx desc nulls last, userid nulls first) - 1 "
        f"as bigint) as pos from ({_lists_pretty()}) p"))
    q["users_listing"] = (
        "select id, username, email, coalesce(strftime(creation_date, '%b %d, %Y'), 'n/a') as created, "
        "coalesce(strftime(update_date, '%b %d, %Y'), 'n/a') as updated, cast(row_number() over (order by "
        f"creation_date desc nulls last, username nulls first, id) - 1 as bigint) as pos from ({_users_sql()}) u")
    q["lookup_by_key"] = _with(_full_lists(), f"select userid, rank, article_id from lists where userid in "
                                              f"({_stream_users()})")
    q["lookup_one_user"] = _with(_full_lists(), (
        "select userid, rank, article_id from lists where userid = (select user_id from events "
        "order by ts desc, event_id desc limit 1)"))
    q["user_dates"] = (
        f"select id, coalesce(epoch_ms(creation_date), -1) as creation_millis, coalesce(epoch_ms(update_date), -1) "
        f"as update_millis, strftime(creation_date, '%Y-%m-%d %H:%M:%S') as created from ({_users_sql()}) u")
    q["rating_json"] = (
        "select event_id as id, to_json(struct_pack(id := event_id, user := user_id, article := article_id, "
        f"rating := cast(round(rating * 500) as bigint))) as json from ({R_EVENTS_ID}) r")
    q["recommendation_json"] = _with(_full_lists(), (
        "select userid, to_json(struct_pack(userid := userid, recommendations := list(article_id order by rank))) as json "
        "from lists group by userid"))
    q["user_json"] = (
        "select id, to_json(struct_pack(id := id, username := username, email := email, \"creationDate\" := "
        "coalesce(epoch_ms(creation_date), -1), \"updateDate\" := coalesce(epoch_ms(update_date), -1))) as json "
        f"from ({_users_sql()}) u")
    q["decode_user_json"] = (
        f"select case when c.c_mktsegment = 'FURNITURE' then -1 else u.id end as id, u.username, u.email, "
        f"coalesce(epoch_ms(u.creation_date), -1) as creation_millis, coalesce(epoch_ms(u.update_date), -1) as update_millis "
        f"from ({_users_sql()}) u join customer c on u.id = c.c_custkey where c.c_mktsegment not in ('BUILDING', 'MACHINERY')")
    nodes = ("select concat('user', cast(userid as varchar)) as id, concat('user', cast(userid as varchar)) as label, "
             f"{_node_hash('userid', 1640531527)} as x, {_node_hash('userid', 1013904223)} as y, 10 as size, "
             "'#0000ff' as color from (select distinct userid from lists) u union all "
             "select concat('article', cast(article_id as varchar)), concat('article', cast(article_id as varchar)), "
             "0.0, 0.0, 10, '#ff0000' from (select distinct article_id from lists) a")
    q["graph_nodes"] = _with(_full_lists(), f"select id, label, cast(x as double) as x, cast(y as double) as y, "
                                            f"cast(size as integer) as size, color from ({nodes}) n")
    edges = ("select concat('user', cast(userid as varchar), '-', cast(article_id as varchar)) as id, "
             "concat('user', cast(userid as varchar), '-', cast(article_id as varchar)) as label, "
             "concat('user', cast(userid as varchar)) as source, concat('article', cast(article_id as varchar)) "
             "as target, cast(1 as integer) as size from (select distinct userid, article_id from lists) e")
    q["graph_edges"] = _with(_full_lists(), edges)
    q["graph_json"] = _with(_full_lists(), (
        "select 'node' as kind, id, concat('{\"x\":', printf('%.6f', x), ',\"y\":', printf('%.6f', y), "
        "',\"size\":', size, ',\"color\":\"', color, '\",\"id\":\"', id, '\",\"label\":\"', label, "
        f"'\"}}') as json from ({nodes}) n union all "
        "select 'edge', id, concat('{\"source\":\"', source, '\",\"target\":\"', target, '\",\"size\":', size, "
        f"',\"id\":\"', id, '\",\"label\":\"', label, '\"}}') from ({edges}) e"))
    q["append_sequential_ids"] = _new_users()
    q["apply_changes"] = (
        "with snap as (select c_custkey as id, c_name as username, c_mktsegment as segment, c_acctbal, "
        "c_nationkey from customer) "
        "select id, case when segment = 'AUTOMOBILE' then upper(username) else username end as username, "
        "case when c_nationkey = 3 then 'MOVED' else segment end as segment from snap where c_acctbal >= 0 "
        f"union all select id, username, 'NEW' from ({_new_users()}) n")
    q["stored_changes"] = q["apply_changes"]
    asof = "timestamp '2020-06-01 12:00:00'"
    q["apply_user_changes"] = (
        f"with u as ({_users_sql()}), c as (select c_custkey, c_acctbal, c_mktsegment from customer) "
        "select u.id, case when c.c_mktsegment = 'MACHINERY' then lower(u.username) else u.username end as username, "
        "u.email, coalesce(epoch_ms(u.creation_date), -1) as creation_millis, "
        f"case when c.c_mktsegment = 'MACHINERY' then epoch_ms({asof}) else coalesce(epoch_ms(u.update_date), -1) end "
        "as update_millis from u join c on u.id = c.c_custkey where c.c_acctbal >= 0 "
        f"union all select id, username, null, epoch_ms({asof}), epoch_ms({asof}) from ({_new_users()}) n")
    return q
