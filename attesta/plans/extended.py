"""Registered queries over whole listings: merge, facts, audits, coverage, scans, runs, display; each with its DuckDB oracle."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import listings as L
from ..functions import nodes as P
from ..functions import text as T
from ..operators import browse as B
from ..operators import coverage as C
from ..operators import pool as O
from ..operators import records as X
from ..operators import resolve as M
from ..operators import runs as Z
from ..operators import scan as N
from ..sources import archives as A
from .catalogue import query, t

S = "string"

# Order lines stand for listings: parts are models, line numbers sources, quantities and rates what a source says.
LISTINGS_SQL = """listings AS (SELECT 'zz' || l_partkey AS title, CASE l_linenumber WHEN 1 THEN 'zol' WHEN 2 THEN '京东' WHEN 3 THEN '太平洋' WHEN 4 THEN 'jd + ZOL' ELSE 'Other' END AS source,
  CASE l_linenumber WHEN 1 THEN ['ZOL'] WHEN 2 THEN ['JD'] WHEN 3 THEN ['PConline'] WHEN 4 THEN ['JD', 'ZOL'] ELSE ['OTHER'] END AS sources,
  CASE WHEN l_discount <= 0.05 THEN l_extendedprice END AS price, CASE WHEN l_tax > 0.02 THEN repeat('n', (l_quantity % 12)::INT) || l_linestatus END AS note,
  CASE l_returnflag WHEN 'A' THEN true WHEN 'N' THEN NULL ELSE l_quantity > 2 END AS keypad, CASE WHEN l_linestatus = 'O' THEN true END AS backlight,
  'https://h/' || l_orderkey AS url, (l_orderkey % 1000)::INT AS rank, l_linestatus AS said, l_orderkey, l_linenumber, l_suppkey, l_quantity, l_extendedprice FROM lineitem),
ordered AS (SELECT *, row(-len(sources), -((price IS NOT NULL)::INT + (note IS NOT NULL)::INT + (keypad IS NOT NULL)::INT + (backlight IS NOT NULL)::INT), l_orderkey, l_linenumber, l_suppkey, l_quantity, l_extendedprice) AS best,
  row(l_orderkey, l_linenumber, l_suppkey, l_quantity, l_extendedprice) AS ord FROM listings)"""


def listings(spark, d):
    n = F.col("l_linenumber")
    source = F.when(n == 1, "zol").when(n == 2, "京东").when(n == 3, "太平洋").when(n == 4, "jd + ZOL").otherwise("Other")
    note = F.when(F.col("l_tax") > 0.02, F.concat(F.repeat(F.lit("n"), (F.col("l_quantity") % 12).cast("int")), "l_linestatus"))
    keypad = F.when(F.col("l_returnflag") == "A", True).when(F.col("l_returnflag") != "N", F.col("l_quantity") > 2)
    return t(spark, d, "lineitem").select(
        F.concat(F.lit("zz"), F.col("l_partkey").cast(S)).alias("title"), F.lit("i7-13700H").alias("cpu"), source.alias("source"), F.when(F.col("l_discount") <= 0.05, F.col("l_extendedprice")).alias("price"), note.alias("note"),
        keypad.alias("numeric_keypad"), F.when(F.col("l_linestatus") == "O", True).alias("keyboard_backlight"), F.concat(F.lit("https://h/"), F.col("l_orderkey").cast(S)).alias("source_url"),
        (F.col("l_orderkey") % 1000).cast("int").alias("source_rank"), F.create_map(F.lit("cpu"), "l_linestatus").alias("evidence"), F.struct("l_orderkey", "l_linenumber", "l_suppkey", "l_quantity", "l_extendedprice").alias("ord"),
    )


@query(f"""WITH {LISTINGS_SQL}, one AS (SELECT title, arg_min(price, row(CASE WHEN price IS NULL THEN 0 ELSE -3 END, best)) AS price, arg_min(note, row(-least(10, coalesce(length(note), 0)), best)) AS note, bool_and(keypad) AS keypad, bool_and(backlight) AS backlight,
  arg_max(said, ord) AS said, count(*) AS records, min(rank) AS rank FROM ordered GROUP BY title), per AS (SELECT title, unnest(sources) AS source, url, ord, rank FROM ordered),
urls AS (SELECT title, source, arg_min(url, ord) AS url, min(rank) AS rank FROM per GROUP BY ALL), maps AS (SELECT title, string_agg(source, '+' ORDER BY source) AS source, count(*) AS source_count, string_agg(source || '=' || url, ',' ORDER BY source) AS urls, string_agg(source || '=' || rank, ',' ORDER BY source) AS ranks FROM urls GROUP BY title)
SELECT substr(sha256('|' || title || '|intel-i7-13700h'), 1, 24) AS identity_key, title, price, note, keypad, backlight, said, records, rank, source, source_count, urls, ranks, coalesce(keypad, false) AND coalesce(backlight, false) AS eligible FROM one JOIN maps USING (title)""")
def record_merge(spark, d):
    m = X.merge_records(listings(spark, d), "ord")
    pairs = lambda c: F.array_join(F.transform(F.array_sort(F.map_entries(c)), lambda e: F.concat(e["key"], F.lit("="), e["value"].cast(S))), ",")
    return m.select("identity_key", "title", "price", "note", F.col("numeric_keypad").alias("keypad"), F.col("keyboard_backlight").alias("backlight"), F.col("evidence")["cpu"].alias("said"), "records", F.col("source_rank").alias("rank"), "source",
                    F.col("source_count").cast("long").alias("source_count"), pairs("source_urls").alias("urls"), pairs("source_ranks").alias("ranks"), F.col("publish_eligible").alias("eligible"))


# Facts are the first words of part names, by size every third, the other sizes open.
TITLED_SQL = "titled AS (SELECT p_partkey, p_name || ' ' || (10 + p_size % 8) || '英寸 x' AS title, replace(p_name, ' ', '') || 'x' AS series, (10 + p_size % 8) || '英寸' AS size FROM part)"
FACTS_SQL = "facts AS (SELECT w AS series, CASE WHEN k % 3 = 0 THEN '' ELSE (10 + k % 8) || '英寸' END AS size_inch, k AS fact_id FROM (SELECT string_split(p_name, ' ')[1 + p_partkey % 2] AS w, p_partkey AS k FROM part))"


def titled(spark, d):
    return t(spark, d, "part").withColumn("title", F.concat("p_name", F.lit(" "), (F.col("p_size") % 8 + 10).cast(S), F.lit("英寸 x")))


def known_facts(spark, d):
    k = F.col("p_partkey")
    size = F.when(k % 3 == 0, "").otherwise(F.concat((k % 8 + 10).cast(S), F.lit("英寸")))
    return t(spark, d, "part").select(k.alias("fact_id"), F.element_at(F.split("p_name", " "), (k % 2 + 1).cast("int")).alias("series"), size.alias("size_inch"))


@query(f"WITH {TITLED_SQL}, {FACTS_SQL} SELECT p_partkey, arg_min(fact_id, row((size_inch = '')::INT, fact_id)) AS fact_id FROM titled JOIN facts ON contains(titled.series, facts.series) AND (size_inch = '' OR size_inch = size) GROUP BY p_partkey")
def fact_lookup(spark, d):
    return M.fact_for(titled(spark, d), known_facts(spark, d), "p_partkey", F.col("title")).select("p_partkey", F.col("fact.fact_id").alias("fact_id"))


def payload(spark, d):
    """Parts as published items, some of them wrong."""
    k, key = F.col("p_partkey"), F.concat(F.lit("key"), F.format_string("%07d", F.col("p_partkey")))
    return t(spark, d, "part").select(
        F.when(k % 50 == 7, F.lit(None).cast(S)).when(k % 50 == 9, "keydup").otherwise(key).alias("identity_key"), F.format_string("%07d", k).alias("place"), F.lit("m").alias("title"), F.when(k % 3 != 0, True).alias("numeric_keypad"), F.lit(True).alias("keyboard_backlight"),
        F.when(k % 4 != 0, "standard_performance").otherwise("low_power").alias("cpu_voltage_type"), F.when(k % 5 == 0, "").otherwise("zol+jd").alias("source"), F.when(k % 6 == 0, 1).otherwise(2).alias("source_count"),
    )


PAYLOAD_SQL = """items AS (SELECT p_partkey AS k, printf('%07d', p_partkey) AS place, CASE WHEN p_partkey % 50 = 7 THEN NULL WHEN p_partkey % 50 = 9 THEN 'keydup' ELSE 'key' || printf('%07d', p_partkey) END AS key FROM part),
named AS (SELECT *, coalesce(key, 'None') AS name, concat_ws(',', CASE WHEN k % 3 = 0 THEN 'numeric_keypad_not_confirmed' END, CASE WHEN k % 4 = 0 THEN 'cpu_voltage_not_allowed:low_power' END) AS why, CASE WHEN k % 5 = 0 THEN 0 ELSE 2 END AS n, CASE WHEN k % 6 = 0 THEN 1 ELSE 2 END AS said FROM items)"""


@query(f"""WITH {PAYLOAD_SQL} SELECT 0 AS check_ord, '' AS row_ord, 'count mismatch: metadata=5 actual=' || count(*) AS error FROM named UNION ALL SELECT 1, '', 'every item must have identity_key' UNION ALL SELECT 2, '', 'duplicate identity_key values'
UNION ALL SELECT 3, place, 'ineligible item ' || name || ': ' || why FROM named WHERE why <> '' UNION ALL SELECT 4, place, 'item ' || name || ' has no atomic source' FROM named WHERE n = 0 UNION ALL SELECT 5, place, 'item ' || name || ' source_count mismatch' FROM named WHERE n <> said
UNION ALL SELECT 6, '', 'source regression: missing PConline'""")
def payload_audit(spark, d):
    items = payload(spark, d)
    return X.audit_payload(items, 5, items.withColumn("source", F.lit("pconline+zol")), "place").select(F.col("check_ord").cast("int").alias("check_ord"), "row_ord", "error")


@query("SELECT unnest(['JD', 'OTHER', 'ZOL']) AS source")
def payload_source_union(spark, d):
    declared = spark.createDataFrame([("other",), (" ",)], "source string")
    return X.payload_sources(X.completed(payload(spark, d)), declared)


# Two sides of a part, whose title or fields say memory and storage.
SPEC_SQL = """specs AS (SELECT p_partkey, CASE WHEN p_partkey % 3 = 0 THEN (8 * (1 + p_size % 2))::DOUBLE WHEN p_partkey % 3 = 1 THEN 16.0 END AS ma, CASE WHEN p_partkey % 3 = 0 THEN 512.0 WHEN p_partkey % 3 = 1 THEN 1024.0 END AS sa,
  16.0 AS mb, CASE WHEN p_size % 5 = 0 THEN NULL WHEN p_partkey % 3 = 0 THEN 512.0 ELSE 1024.0 END AS sb FROM part)"""


@query(f"""WITH {SPEC_SQL} SELECT p_partkey, CASE WHEN ma <> mb OR sa <> sb THEN 'incompatible' WHEN ma IS NULL OR mb IS NULL OR sa IS NULL OR sb IS NULL THEN 'unknown' ELSE 'compatible' END AS kind,
CASE WHEN ma <> mb OR sa <> sb THEN concat_ws('; ', CASE WHEN ma <> mb THEN 'memory ' || ma || 'GB vs ' || mb || 'GB' END, CASE WHEN sa <> sb THEN 'storage ' || sa || 'GB vs ' || sb || 'GB' END) WHEN ma IS NULL OR mb IS NULL OR sa IS NULL OR sb IS NULL THEN 'insufficient config fields to confirm' ELSE 'memory/storage consistent' END AS why FROM specs""")
def overlap_configuration(spark, d):
    k, size, none = F.col("p_partkey") % 3, F.col("p_size"), F.lit(None).cast(S)
    a = C.configuration(F.when(k == 0, (size % 2 + 1) * 8).cast(S), F.when(k == 0, F.lit("512")), F.when(k == 1, "m 16GB/1TB x").otherwise("m"))
    b = C.configuration(F.lit("16"), F.when(size % 5 != 0, F.when(k == 0, "512").otherwise("1024")), none)
    x = t(spark, d, "part").select("p_partkey", a.alias("a"), b.alias("b"))
    kind, why = C.same_configuration(F.col("a"), F.col("b"))
    return x.select("p_partkey", kind.alias("kind"), why.alias("why"))


DOC_SQL = "docs AS (SELECT doc_id, source, sha256(lower(regexp_replace(text, '[^\\p{L}\\p{N}]+', '', 'g'))) AS key, CASE WHEN doc_id % 7 = 0 THEN [source, 'src1'] ELSE [source] END AS raw FROM documents WHERE source IS NOT NULL), listed AS (SELECT doc_id, source, key, list_sort(list_distinct(raw)) AS sources FROM docs)"


def listed(spark, d):
    names = F.when(F.col("doc_id") % 7 == 0, F.concat("source", F.lit(" + 仅src1"))).otherwise(F.col("source"))
    return t(spark, d, "documents").where("source IS NOT NULL").select("doc_id", "source", F.sha2(T.identity_text(F.col("text")), 256).alias("identity"), names.alias("来源")).transform(lambda x: C.sources_of(x.withColumnRenamed("source", "one"), ("来源",)))


@query(f"WITH {DOC_SQL}, per AS (SELECT key, list_sort(list_distinct(flatten(list(sources)))) AS sources, count(*) AS n, count(*) FILTER (len(sources) = 1) AS one FROM listed GROUP BY key) SELECT key AS identity, array_to_string(sources, '+') AS sources, CASE WHEN len(sources) = 1 THEN n ELSE one END AS rows, CASE WHEN len(sources) = 1 THEN 'identity_only_single' ELSE 'cross_source_merge_gap' END AS cause FROM per WHERE len(sources) = 1 OR one > 0")
def merge_gaps(spark, d):
    return C.gaps(listed(spark, d)).select("identity", F.array_join("sources", "+").alias("sources"), "rows", "cause")


@query(f"WITH {DOC_SQL} SELECT source, count(*) AS rows FROM (SELECT unnest(sources) AS source FROM listed WHERE len(sources) = 1) GROUP BY source")
def single_source_by_source(spark, d):
    return C.single_by_source(listed(spark, d).where(F.size("sources") == 1), "sources")


@query(f"WITH {DOC_SQL}, s AS (SELECT doc_id, CASE WHEN doc_id % 11 = 0 THEN NULL ELSE key END AS key, sources FROM listed WHERE len(sources) = 1), o AS (SELECT s.doc_id, list_sort(list(DISTINCT d.source)) AS m FROM s JOIN docs d ON s.key = d.key AND NOT list_contains(s.sources, d.source) GROUP BY s.doc_id) SELECT s.doc_id, CASE WHEN s.key IS NULL THEN 'unparseable_identity' WHEN m IS NULL THEN 'no_match' ELSE 'match_found' END AS status, coalesce(array_to_string(m, '+'), '') AS matched FROM s LEFT JOIN o ON s.doc_id = o.doc_id")
def single_source_elsewhere(spark, d):
    x = listed(spark, d)
    single = x.where(F.size("sources") == 1).withColumn("identity", F.when(F.col("doc_id") % 11 != 0, F.col("identity")))
    return C.elsewhere(single, x, "identity", "sources", "one").select("doc_id", "status", F.array_join("matched_sources", "+").alias("matched"))


@query("WITH g AS (SELECT lang AS series, (n_chars % 5)::VARCHAR AS id, list_filter([CASE WHEN bool_or(contains(source, 'src1')) THEN 'A' END, CASE WHEN bool_or(contains(source, 'src2') OR contains(source, 'src3')) THEN 'B' END], lambda x: x IS NOT NULL) AS s, count(*) AS rows, count(*) AS single_rows FROM documents WHERE source IS NOT NULL AND lang IS NOT NULL GROUP BY ALL) SELECT series, id, array_to_string(s, '+') AS sources, rows, single_rows FROM g")
def series_coverage(spark, d):
    x = t(spark, d, "documents").where("source IS NOT NULL AND lang IS NOT NULL").withColumn("id", (F.col("n_chars") % 5).cast(S))
    return C.by_series(x, "lang", "id", "source", {"A": ("src1",), "B": ("src2", "src3")}).select("series", "id", F.array_join("sources", "+").alias("sources"), "rows", "single_rows")


# Events stand for the cards of list pages: a hundred a page, users are the items.
@query("WITH c AS (SELECT event_id // 100 AS page, event_id % 100 AS place, user_id FROM events), f AS (SELECT user_id, arg_min(page, row(page, place)) AS page FROM c GROUP BY user_id) SELECT p.page, p.cards, coalesce(a.added, 0) AS added FROM (SELECT page, count(*) AS cards FROM c GROUP BY page) p LEFT JOIN (SELECT page, count(*) AS added FROM f WHERE user_id % 10 <> 0 GROUP BY page) a ON p.page = a.page")
def scan_new_by_page(spark, d):
    x = t(spark, d, "events").select(F.expr("event_id div 100").alias("page"), (F.col("event_id") % 100).alias("place"), F.col("user_id").cast(S).alias("key"))
    return N.new_by_page(x, x.where("key % 10 = 0").select("key"), "key", "page", "place").select("page", "cards", "added")


@query("SELECT user_id, first FROM (SELECT user_id, min(event_id) AS first FROM events GROUP BY user_id) ORDER BY first LIMIT 30")
def scan_one_shot(spark, d):
    x = t(spark, d, "events").select(F.expr("event_id div 100").alias("page_no"), (F.col("event_id") % 100).alias("place"), N.item_key(F.col("user_id"), F.lit("")).alias("key"), "user_id", F.col("event_id").alias("first"))
    return N.scanned(x.select("page_no"), x, "key", 30).select("user_id", "first")


@query("SELECT p_partkey, 'https://detail.zol.com.cn/notebook_index/subcate16_0_list_1_0_1_2_0_' || p_partkey || '.html' AS zol, 'https://product.pconline.com.cn/notebook/' || CASE WHEN p_partkey > 1 THEN ((p_partkey - 1) * 25)::VARCHAR ELSE '' END || 's10.shtml' AS pc, 'https://detail.zol.com.cn/' || ((p_partkey * 777 + 999) // 1000) || '/' || (p_partkey * 777) || '/param.shtml' AS detail FROM part")
def scan_urls(spark, d):
    k = F.col("p_partkey")
    id_ = N.product_id(F.concat(F.lit("https://h/notebook/index"), (k * 777).cast(S), F.lit(".shtml")))
    return t(spark, d, "part").select("p_partkey", N.list_url("ZOL", k).alias("zol"), N.list_url("PConline", k).alias("pc"), N.detail_url(id_).alias("detail"))


# Every third part's detail page is missing, every fifth failed.
@query("SELECT p_partkey, CASE WHEN p_partkey % 3 = 0 THEN 'detail_failed:missing' WHEN p_partkey % 5 = 0 THEN 'detail_failed:Timeout' END AS crawl_warning, CASE WHEN p_partkey % 3 = 0 OR p_partkey % 5 = 0 THEN 8 ELSE p_size END AS memory_gb, CASE WHEN p_partkey % 3 = 0 OR p_partkey % 5 = 0 THEN NULL ELSE 'USB，HDMI' END AS ports, CASE WHEN p_partkey % 3 = 0 OR p_partkey % 5 = 0 THEN NULL ELSE p_size % 2 = 0 END AS numeric_keypad FROM part")
def detail_fields(spark, d):
    s, k = (lambda x: F.lit(x)), F.col("p_partkey")
    items = t(spark, d, "part").select("p_partkey", F.concat(F.lit("m "), F.lit("8GB/1TB")).alias("title"), N.detail_url(k).alias("spec_url"))
    keys = F.when(F.col("p_size") % 2 == 0, "数字小键盘").otherwise("无数字小键盘")
    specs = F.create_map(s("内存容量"), F.concat(F.col("p_size").cast(S), F.lit(".9GB")), s("键盘描述"), keys, s("数据接口"), s("USB； "), s("视频接口"), s("HDMI"))
    pages = t(spark, d, "part").where("p_partkey % 3 <> 0").select(N.detail_url(k).alias("url"), F.when(k % 5 != 0, specs).alias("specs"), F.when(k % 5 == 0, "Timeout").alias("error"))
    return N.assembled(N.with_details(items, pages)).select("p_partkey", "crawl_warning", "memory_gb", F.array_join("ports", "，").alias("ports"), "numeric_keypad")


RUNS_SQL = """runs AS (SELECT event_id AS id, ['Crawl ZOL', 'Crawl PConline', 'Deploy'][1 + event_id % 3] AS name, CASE WHEN event_id % 7 < 3 THEN 'failure' WHEN event_id % 7 < 6 THEN 'success' END AS conclusion, event_id % 8 AS m, ts FROM events)"""
MARKS = ["", "Exit code: 10", "exit code 10 and 503 rows: 250", "403 while 连续3页为空", "只有 12 行", "CONFLICT (content)", "无代理，直接运行 crawl", "wrote 150 PConline popularity-ranked records 半月周期"]


def finished(spark, d):
    e, k = t(spark, d, "events"), F.col("event_id")
    pick = lambda xs, n: F.element_at(F.array(*map(F.lit, xs)), (k % n + 1).cast("int"))
    return e.select(k.alias("id"), pick(["Crawl ZOL", "Crawl PConline", "Deploy"], 3).alias("name"), F.when(k % 7 < 3, "failure").when(k % 7 < 6, "success").alias("conclusion"), pick(MARKS, 8).alias("text"), "ts")


@query(f"""WITH {RUNS_SQL}, f AS (SELECT *, ['unknown', 'progress_exit', 'progress_exit', 'site_breakage', 'data_quality_guard', 'transient_infra', 'unknown', 'unknown'][1 + m] AS failed,
  CASE WHEN name = 'Deploy' THEN 'not_crawler' WHEN m = 7 THEN CASE WHEN name = 'Crawl PConline' THEN 'low_output' ELSE 'expected_skip' END WHEN m = 1 THEN 'expected_progress_exit' WHEN m = 6 THEN 'proxy_degraded' ELSE 'expected_success' END AS good FROM runs)
SELECT id, CASE conclusion WHEN 'failure' THEN failed WHEN 'success' THEN good ELSE 'conclusion_unknown' END AS class, coalesce(conclusion = 'failure' AND failed IN ('site_breakage', 'unknown') OR conclusion = 'success' AND good = 'low_output', false) AS fix FROM f""")
def run_classes(spark, d):
    c = Z.run_class(F.col("name"), F.col("conclusion"), F.col("text"))
    return finished(spark, d).select("id", c.alias("c")).select("id", F.col("c.class").alias("class"), F.coalesce("c.fix", F.lit(False)).alias("fix"))


@query(f"""WITH {RUNS_SQL}, w AS (SELECT *, hour(ts + INTERVAL 8 HOUR) * 60 + minute(ts + INTERVAL 8 HOUR) AS mins FROM runs)
SELECT id, CASE WHEN name = 'Deploy' THEN 'not_crawler' WHEN m = 6 AND NOT (mins BETWEEN 480 AND 750 OR mins BETWEEN 780 AND 1320) THEN 'crawler_ran_outside_window' WHEN m = 6 THEN 'proxy_direct_fallback' ELSE 'expected_success' END AS class FROM w""")
def drift_classes(spark, d):
    return finished(spark, d).select("id", Z.drift_class(F.col("name"), F.col("text"), F.col("ts"))["class"].alias("class"))


@query("""WITH a AS (SELECT l_orderkey AS route, CASE WHEN l_quantity < 40 THEN 'rate_limited' WHEN l_quantity < 45 THEN 'availability_error' WHEN l_quantity < 48 THEN 'request_error' ELSE 'auth_error' END AS kind FROM lineitem),
p AS (SELECT route, bool_and(kind = 'rate_limited') AS lim, bool_or(kind = 'auth_error') AS au, bool_or(kind = 'request_error') AS rq, count(*) AS n FROM a GROUP BY route)
SELECT o_orderkey AS route, CASE WHEN lim THEN 'all_free_429' WHEN o_orderkey % 5 = 0 THEN 'no_credentials' WHEN au THEN 'auth_error' WHEN rq THEN 'request_error' WHEN n > 0 THEN 'free_unavailable' ELSE 'no_credentials' END AS status FROM orders LEFT JOIN p ON o_orderkey = route""")
def route_statuses(spark, d):
    """Orders as routes, their lines as what was tried."""
    q = F.col("l_quantity")
    kind = Z.attempt_kind(F.when(q < 40, 429).when(q < 45, 503).when(q < 48, 404).otherwise(401))
    tries = t(spark, d, "lineitem").select(F.col("l_orderkey").alias("route"), kind.alias("kind"))
    return Z.route_status(tries, "route", "kind", t(spark, d, "orders").select(F.col("o_orderkey").alias("route"), (F.col("o_orderkey") % 5 != 0).alias("configured"))).select("route", "status")


ASSET_SQL = "SELECT o_custkey, o_orderkey, lower('App-Linux-amd64' || CASE WHEN o_orderkey % 3 = 0 THEN '-compatible' ELSE '' END || '-' || o_orderkey || CASE WHEN o_orderkey % 4 = 0 THEN '.deb' ELSE '.gz' END) AS name FROM orders"


@query(f"SELECT o_custkey, arg_max('u' || o_orderkey, row(CASE WHEN contains(name, 'compatible') THEN 10 ELSE 0 END, name)) AS url FROM ({ASSET_SQL}) WHERE name LIKE '%.gz' GROUP BY o_custkey")
def asset_choice(spark, d):
    k = F.col("o_orderkey").cast(S)
    name = F.concat(F.lit("App-Linux-amd64"), F.when(F.col("o_orderkey") % 3 == 0, "-compatible").otherwise(""), F.lit("-"), k, F.when(F.col("o_orderkey") % 4 == 0, ".deb").otherwise(".gz"))
    return Z.choose_asset(t(spark, d, "orders").select("o_custkey", name.alias("name"), F.concat(F.lit("u"), k).alias("url")), ["o_custkey"])


def shelf(spark, d):
    k, size = F.col("p_partkey"), F.col("p_size")
    return t(spark, d, "part").select("p_partkey", F.when(k % 4 != 0, size % 3).alias("source_count"), F.when(k % 5 != 0, k % 40).alias("source_rank"), F.when(k % 6 != 0, F.col("p_retailprice")).alias("price"), F.concat((size % 9 + 10).cast(S), F.lit(".5 inch")).alias("screen_size"),
                                      (size % 4 * 60).cast(S).alias("refresh_rate"), F.when(k % 3 != 0, size).alias("memory_gb"), (size * 64).alias("storage_gb"), F.when(k % 2 == 0, size > 20).alias("numeric_keypad"), (size < 9).alias("keyboard_backlight"))


SHELF_SQL = """shelf AS (SELECT p_partkey, CASE WHEN p_partkey % 4 <> 0 THEN p_size % 3 END AS source_count, CASE WHEN p_partkey % 5 <> 0 THEN p_partkey % 40 END AS source_rank, CASE WHEN p_partkey % 6 <> 0 THEN p_retailprice END AS price, p_size % 9 + 10.5 AS screen_size,
  p_size % 4 * 60 AS refresh_rate, CASE WHEN p_partkey % 3 <> 0 THEN p_size END AS memory_gb, p_size * 64 AS storage_gb, CASE WHEN p_partkey % 2 = 0 THEN (p_size > 20)::INT END AS numeric_keypad, (p_size < 9)::INT AS keyboard_backlight FROM part)"""
RANKED = "coalesce(source_rank, 9007199254740991)"
ORDERS = {"source_rank": f"coalesce(source_count, 0) DESC, {RANKED}", "source_count": f"coalesce(source_count, 0) DESC, {RANKED}", "price_asc": "coalesce(price, 9007199254740991)", "price_desc": "coalesce(price, -1) DESC"}
ORDERS |= {mode: f"coalesce({c}, 0) DESC, {RANKED}" for mode, c in (("screen_desc", "screen_size"), ("refresh_desc", "refresh_rate"), ("memory_desc", "memory_gb"), ("storage_desc", "storage_gb"), ("numpad_first", "numeric_keypad"), ("backlight_first", "keyboard_backlight"))}


@query(f"WITH {SHELF_SQL} " + " UNION ALL ".join(f"(SELECT '{mode}' AS mode, p_partkey FROM shelf ORDER BY {by}, p_partkey LIMIT 20)" for mode, by in ORDERS.items()))
def browse_sorts(spark, d):
    """The first twenty in each of the ten modes, a top-k report."""
    from functools import reduce

    x = shelf(spark, d)
    return reduce(lambda a, b: a.unionAll(b), [B.sorted_by(x, mode, "p_partkey").limit(20).select(F.lit(mode).alias("mode"), "p_partkey") for mode in B.SORTS])


@query("SELECT p_partkey, CASE WHEN p_partkey % 6 <> 0 THEN '¥' || format('{:,}', round(p_retailprice)::BIGINT) ELSE '价格待确认' END AS price, CASE WHEN p_partkey % 3 <> 0 THEN p_size || 'GB' ELSE '—' END AS memory, CASE WHEN p_partkey % 2 = 0 THEN 'https://a/' || p_partkey ELSE 'https://b' END AS link, CASE WHEN p_partkey % 4 = 0 THEN '桌面级 CPU · 形态已核验' ELSE 'H 系' END || ',集显,数字键盘,背光' AS tags FROM part")
def browse_cards(spark, d):
    k = F.col("p_partkey")
    x = shelf(spark, d).select("*", F.when(k % 2 == 0, F.concat(F.lit("https://a/"), k.cast(S))).alias("source_url"), F.create_map(F.lit("JD"), F.lit(""), F.lit("ZOL"), F.lit("https://b")).alias("source_urls"), F.lit("t").alias("title"), F.lit("m").alias("model"), F.lit(None).cast(S).alias("brand"),
                               F.when(k % 4 == 0, "desktop_performance").alias("cpu_voltage_type"), F.lit(None).cast("boolean").alias("dedicated_gpu"), F.lit(None).cast(S).alias("cpu"), F.lit(None).cast(S).alias("gpu"), F.lit(None).cast(S).alias("resolution"), F.lit(None).cast("array<string>").alias("atomic_source_names"))
    shown = B.presented(x.withColumn("source_rank", F.col("p_partkey")))  # the rank stands for the key
    return shown.select(F.col("rank").cast("long").alias("p_partkey"), "price", "memory", "link", F.array_join("tags", ",").alias("tags"))


@query("WITH u AS (SELECT o_custkey, count(*) FILTER (o_orderstatus <> 'F') AS success, count(*) FILTER (o_orderstatus = 'F') AS fail FROM orders GROUP BY o_custkey), n AS (SELECT c_custkey, c_name, coalesce(success, 0) AS success, coalesce(fail, 0) AS fail FROM customer LEFT JOIN u ON c_custkey = o_custkey) SELECT c_name, CASE WHEN success + fail > 0 THEN success || '/' || (success + fail) ELSE 'N/A' END AS rate FROM n WHERE fail::DOUBLE / greatest(success + fail, 1) < 0.8 ORDER BY c_custkey LIMIT 50")
def pool_listing(spark, d):
    """Customers as nodes, their orders as uses; those without orders have no rate. The first 50 are what a listing shows."""
    stats = O.counters(t(spark, d, "orders"), "o_custkey", F.col("o_orderstatus") != "F", "o_orderdate").withColumnRenamed("o_custkey", "c_custkey")
    return O.listing(O.available(O.with_stats(t(spark, d, "customer").select("c_custkey", "c_name"), stats, "c_custkey")), "c_name", "c_custkey")


@query("SELECT event_id, '{\"event_id\":' || event_id || ',\"event_type\":' || coalesce('\"' || event_type || '\"', 'null') || ',\"user_id\":' || user_id || '}' AS line FROM events")
def canonical_rows(spark, d):
    return t(spark, d, "events").select("event_id", T.canonical_json(["user_id", "event_type", "event_id"]).alias("line"))


@query("SELECT event_id, (event_id % 3)::INT = 0 AS strict FROM events")
def strict_json(spark, d):
    from ..sources import payload as P

    k = F.col("event_id")
    text = F.when(k % 3 == 0, F.concat(F.lit('{"note": "NaN 1e999 \\" Infinity", "a": '), k.cast(S), F.lit("}"))).when(k % 3 == 1, '{"a": 1e999}').otherwise('{"a": 1, "a": 2}')
    return t(spark, d, "events").select("event_id", P.strict_json(text).alias("strict"))


@query("SELECT doc_id, concat_ws(', ', CASE WHEN doc_id % 3 = 0 THEN 'another number' END, CASE WHEN doc_id % 4 = 0 THEN 'no name' END, CASE WHEN doc_id % 5 = 0 THEN 'unknown address' END, CASE WHEN doc_id % 6 = 0 THEN 'no year allowed' END, CASE WHEN doc_id % 7 = 0 THEN 'fewer than 4 specifications' END) AS faults FROM documents")
def record_validity(spark, d):
    k = F.col("doc_id")
    on = lambda n, bad, good: F.when(k % n == 0, F.lit(bad)).otherwise(F.lit(good))
    fields = {"phone_id": F.when(k % 3 == 0, k + 1).otherwise(k).cast(S), "型号": on(4, " ", "m"), "品牌": F.lit("b"), "source": F.lit("PConline"), "url": on(5, "https://h/x", "https://product.pconline.com.cn/x"), "上市时间": on(6, "2019年", "2024年"),
              "CPU型号": on(7, "无", "c"), "内存容量": F.lit("16"), "存储容量": F.lit("1")}
    text = F.to_json(F.struct(*(v.alias(n) for n, v in fields.items())))
    return t(spark, d, "documents").select("doc_id", F.array_join(A.record_faults(text, k.cast(S)), ", ").alias("faults"))


@query("SELECT p_partkey, CASE p_size % 4 WHEN 0 THEN 'ZOL' WHEN 1 THEN 'JD' WHEN 2 THEN 'PConline' ELSE 'SHOP' || p_size END AS source, CASE p_size % 3 WHEN 0 THEN '联想' WHEN 1 THEN '华硕' ELSE upper(left(p_name, 1)) || substr(string_split(p_name, ' ')[1], 2) END AS brand FROM part")
def names_of_listings(spark, d):
    n, size = F.col("p_size") % 4, F.col("p_size")
    source = F.when(n == 0, "ＺＯＬ 中关村-在线").when(n == 1, "京东_商城").when(n == 2, " pc online").otherwise(F.concat(F.lit("shop"), size.cast(S)))
    title = F.when(size % 3 == 0, F.concat(F.lit("Ｌｅｎｏｖｏ "), "p_name")).when(size % 3 == 1, F.concat(F.lit("x ASUS "), "p_name")).otherwise(F.concat(F.upper(F.substring("p_name", 1, 1)), F.substring("p_name", 2, 99)))
    return t(spark, d, "part").select("p_partkey", L.source_name(source).alias("source"), L.brand_of_title(T.compatible(title)).alias("brand"))


@query("SELECT p_partkey, substr(sha256('联想|y' || p_size || 'p|intel-i9-13900hx'), 1, 24) AS key FROM part")
def listing_identity(spark, d):
    size, k = F.col("p_size").cast(S), F.col("p_partkey")
    model = F.when(k % 2 == 0, F.concat(F.lit("联想 Ｙ"), size, F.lit("P（16GB/1TB）"))).otherwise(F.concat(F.lit("【自营】联想(Lenovo)Y"), size, F.lit("P i9-13900HX 16G 1T 黑色")))
    sources = F.when(k % 2 == 0, F.array(F.lit("ZOL"))).otherwise(F.array(F.lit("JD")))
    return t(spark, d, "part").select("p_partkey", L.listing_key(F.lit("Lenovo"), model, model, F.when(k % 2 == 0, "酷睿 i9-13900HX").otherwise("i9 13900 HX"), sources, F.lit("")).alias("key"))


@query("SELECT p_partkey, CASE WHEN p_size % 2 = 0 THEN '' ELSE 'desktop_cpu_product_form_not_confirmed' END AS reasons FROM part")
def portable_desktops(spark, d):
    none, k = F.lit(""), F.col("p_size") % 2 == 0
    portable = L.portable_form(F.lit("notebook"), F.col("p_name"), none, F.when(k, "移动工作站").otherwise(""), F.create_map(F.lit("cpu"), F.lit("LGA 1700")))
    reasons = L.admission_reasons(F.lit("支持"), F.lit(True), L.voltage(none, F.lit("i9-13900K"), none), portable)
    return t(spark, d, "part").select("p_partkey", F.array_join(reasons, ",").alias("reasons"))


@query("""SELECT c_custkey, CASE c_custkey % 6 WHEN 0 THEN 'vless' WHEN 1 THEN 'ss' WHEN 2 THEN 'hysteria2' WHEN 3 THEN 'tuic' WHEN 4 THEN 'vmess' ELSE 'wireguard' END AS type, c_name AS name, 'h' || c_nationkey || '.example' AS server, 1000 + c_nationkey AS port, 'k' || c_custkey AS secret,
CASE c_custkey % 6 WHEN 0 THEN 'true' WHEN 1 THEN 'aes' WHEN 2 THEN 's.example' WHEN 3 THEN 'cubic' WHEN 4 THEN 'auto' ELSE '1280' END AS more FROM customer WHERE c_custkey % 7 <> 3""")
def node_schemes(spark, d):
    """Links of six schemes; those without a port are broken and give nothing."""
    k, c = F.col("c_custkey"), lambda *x: F.concat(*(F.lit(y) if isinstance(y, str) else y for y in x))
    key, host = c("k", k.cast(S)), c("h", F.col("c_nationkey").cast(S), ".example")
    port = F.when(k % 7 != 3, (F.col("c_nationkey") + 1000).cast(S)).otherwise("x")
    name, b64 = F.url_encode("c_name"), lambda t: F.base64(F.encode(t, "UTF-8"))
    at = c("@", host, ":", port)
    vmess = b64(F.to_json(F.struct(F.col("c_name").alias("ps"), host.alias("add"), port.alias("port"), key.alias("id"))))
    links = [c("vless://", key, at, "?security=tls&sni=s#", name), c("ss://", b64(c("aes:", key)), at, "#", name), c("hysteria2://", key, at, "?sni=s.example#", name), c("tuic://", key, ":pw", at, "#", name), c("vmess://", vmess), c("wireguard://", key, at, "#", name)]
    link = F.element_at(F.array(*links), (k % 6 + 1).cast("int"))
    n = t(spark, d, "customer").select("c_custkey", F.inline(F.filter(F.array(P.parse_node(link)), lambda x: x.isNotNull())))  # a generator reads each link once for all its columns
    first = lambda *names: F.coalesce(*(F.try_element_at("opts", F.lit(x)) for x in names))
    more = F.when(F.col("type") == "vless", first("tls")).when(F.col("type").isin("ss", "vmess"), first("cipher")).when(F.col("type") == "hysteria2", first("sni")).when(F.col("type") == "tuic", first("congestion-controller")).otherwise(first("mtu"))
    return n.select("c_custkey", "type", "name", "server", "port", F.when(F.col("type") == "wireguard", first("private-key")).otherwise(first("uuid", "password")).alias("secret"), more.alias("more"))
