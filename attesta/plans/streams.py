"""Registered queries over scans that are resumed, tables that are upserted, and exact places: each with its DuckDB oracle."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import browse as B
from ..operators import pool as O
from ..operators.postings import Postings
from ..operators.protect import PublishGuardError
from ..operators.publication import Publication
from ..operators.staging import scratch
from ..sources import payload as S
from ..streaming import lists
from ..streaming.keyed import KeyedTable
from .catalogue import query, t

#: Events are list pages of their types' users: so many on a page.
ON_PAGE = 40


@query(f"""WITH n AS (SELECT event_type AS source, user_id AS key, row_number() OVER (PARTITION BY event_type ORDER BY event_id) - 1 AS n FROM events),
firsts AS (SELECT source, key, min(n) AS n FROM n WHERE key IS NOT NULL GROUP BY ALL),
pages AS (SELECT n.source, n.n // {ON_PAGE} + 1 AS page_no, count(f.n) AS added FROM n LEFT JOIN firsts f ON n.source = f.source AND n.n = f.n GROUP BY ALL),
runs AS (SELECT *, max(added) OVER w AS best, count(*) OVER w AS k FROM pages WINDOW w AS (PARTITION BY source ORDER BY page_no ROWS 2 PRECEDING)),
ends AS (SELECT p.source, coalesce(min(page_no) FILTER (best = 0 AND k = 3), max(page_no) + 1) AS last, CASE WHEN count(*) FILTER (best = 0 AND k = 3) > 0 THEN 'repeats' ELSE 'empty' END AS reason FROM runs p GROUP BY p.source)
SELECT source, (n // {ON_PAGE} + 1)::INT AS page_no, 'item' AS kind, (n % {ON_PAGE})::INT AS place, key::VARCHAR AS key FROM firsts JOIN ends USING (source) WHERE n // {ON_PAGE} + 1 <= last
UNION ALL SELECT source, last::INT, 'end', NULL, reason FROM ends""")
def list_scan_resumed(spark, d):
    """A scan of list pages in batches that go on where the last ended: 5 pages a source, 10 more, and then to the end of each."""
    where, events = scratch(spark, "lists"), t(spark, d, "events")
    addresses = lists.pages_of(events, "event_type", "event_id", "user_id", ON_PAGE, f"{where}/pages")
    most = events.groupBy("event_type").count().agg(F.max("count")).first()[0] or 0
    done: dict[str, int] = {}
    for step in (5, 10, most // ON_PAGE + 2):
        done = lists.goal(spark, addresses, step, done, f"{where}/events" if done else None)
        lists.scan(spark, addresses, done, f"{where}/events", f"{where}/state")
    return spark.read.schema(lists.EVENTS).parquet(f"{where}/events").where("kind IN ('item', 'end')")


@query("SELECT user_id, max(event_id) AS event_id, arg_max(event_type, event_id) AS event_type, arg_max(value, event_id) AS value FROM events GROUP BY user_id")
def keyed_upserts(spark, d):
    """Users' last events, upserted in four batches by time, each tried twice: a delta for each, buckets with three of them rewritten."""
    events = t(spark, d, "events").select("user_id", "event_id", "event_type", F.coalesce("value", F.lit(float("nan"))).alias("value"))
    table = KeyedTable(spark, scratch(spark, "users"), "user_id", buckets=8, compact_after=3)
    low, high = events.agg(F.min("event_id"), F.max("event_id")).first()
    for batch in range(4):
        part = events.where(F.floor((F.col("event_id") - low) * 4 / (high - low + 1)) == batch)
        table.upsert(part, "event_id", batch)
        table.upsert(part, "event_id", batch)
    table.vacuum()
    return table.read().withColumn("value", F.nanvl("value", F.lit(None).cast("double")))


@query("""SELECT l_orderkey, l_linenumber, l_returnflag, row_number() OVER (PARTITION BY l_returnflag ORDER BY CASE WHEN l_discount > 0.05 THEN 9999 ELSE l_quantity END, l_orderkey * 8 + l_linenumber) AS place,
  min(l_orderkey * 8 + l_linenumber) OVER (PARTITION BY l_returnflag) AS group_ord FROM lineitem""")
def ranked_lines(spark, d):
    """Exact places in three groups, one of them with half of all rows, and many rows of each without a rank."""
    lines = t(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag", F.when(F.col("l_discount") <= 0.05, F.col("l_quantity")).cast("int").alias("r"), (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("o"))
    return B.grouped(lines, "l_returnflag", "r", "o").select("l_orderkey", "l_linenumber", "l_returnflag", F.col("place").cast("long").alias("place"), "group_ord")


@query("""WITH ring AS (SELECT n_name, row_number() OVER (ORDER BY n_name) - 1 AS k FROM nation), turns AS (SELECT event_id, (row_number() OVER (ORDER BY event_id) - 1) % (SELECT count(*) FROM nation) AS k FROM events)
SELECT event_id, n_name AS node FROM turns JOIN ring USING (k)""")
def dealt_requests(spark, d):
    """All events as requests, dealt round robin over the nations in one pass."""
    return O.dealt(t(spark, d, "events").select("event_id"), "event_id", t(spark, d, "nation"), "n_name").select("event_id", "node")


#: So many orders' keys are one document.
IN_DOCUMENT = 1 << 20


@query(f"SELECT o_orderkey, o_custkey, o_orderstatus, CAST(row_number() OVER (PARTITION BY o_orderkey // {IN_DOCUMENT} ORDER BY o_orderkey) AS BIGINT) AS pos FROM orders")
def payload_in_splits(spark, d):
    """All orders written as JSON documents with their records under ``items``, and read back in splits; the first record of a document is a heading."""
    orders = t(spark, d, "orders").withColumn("doc", F.floor(F.col("o_orderkey") / IN_DOCUMENT))
    line = F.concat(F.lit(","), F.to_json(F.struct("o_orderkey", "o_custkey", "o_orderstatus", F.lit('a "}" ,{[').alias("note"))))
    docs = orders.select("doc").distinct()
    head, tail = docs.select("doc", F.lit(-1).alias("o"), F.lit('{"made": {"by": "[orders"}, "items": [{}').alias("value")), docs.select("doc", F.lit(2**62).alias("o"), F.lit('], "data": [{}, {}]}').alias("value"))
    lines = orders.select("doc", F.col("o_orderkey").alias("o"), line.alias("value")).unionAll(head).unionAll(tail)
    where = scratch(spark, "orders-json")
    lines.repartition("doc").sortWithinPartitions("doc", "o").drop("o").write.partitionBy("doc").text(where)
    records = S.read_payload(spark, where).where("n_keys > 0").select("pos", F.from_json("raw", "o_orderkey long, o_custkey long, o_orderstatus string").alias("r"))
    return records.select("r.*", F.col("pos").cast("long").alias("pos"))


RELEASED_SQL = "SELECT p_partkey, p_size, 'key' || printf('%07d', p_partkey) AS identity_key FROM part WHERE p_partkey % 3 <> 0"


@query(f"""WITH ok AS ({RELEASED_SQL}) SELECT 1 AS version, identity_key FROM ok UNION ALL SELECT 2, identity_key FROM ok WHERE p_size > 10
UNION ALL SELECT 3, identity_key FROM ok UNION ALL SELECT 4, identity_key FROM ok WHERE p_size > 20""")
def publication_versions(spark, d):
    """All parts released, then fewer, then a release refused for a source that it lost, then the first version again, then fewer still: what each version holds."""
    k, ok = F.col("p_partkey"), F.col("p_partkey") % 3 != 0
    parts = t(spark, d, "part").select(
        "p_size", F.concat(F.lit("key"), F.format_string("%07d", k)).alias("identity_key"), F.col("p_name").alias("title"), F.when(ok, True).alias("numeric_keypad"), F.lit(True).alias("keyboard_backlight"), F.lit("standard_performance").alias("cpu_voltage_type"),
        F.lit("zol+jd").alias("source"), F.array(F.lit("JD"), F.lit("ZOL")).alias("atomic_source_names"), F.lit(2).alias("source_count"), k.cast("int").alias("source_rank"),
        F.filter(F.array(F.when(~ok, "numeric_keypad_not_confirmed")), lambda r: r.isNotNull()).alias("rejection_reasons"), ok.alias("publish_eligible"),
    )
    p = Publication(spark, scratch(spark, "publication"))
    p.release(parts, "first")
    p.release(parts.where("p_size > 10"), "second")
    try:
        p.release(parts.withColumns({"source": F.lit("zol"), "atomic_source_names": F.array(F.lit("ZOL")), "source_count": F.lit(1)}), "third")
    except PublishGuardError:
        p.roll_back()
    p.release(parts.where("p_size > 20"), "fourth")
    out = [p.items(v).select(F.lit(v).alias("version"), "identity_key") for v in p.versions()]
    return out[0].unionAll(out[1]).unionAll(out[2]).unionAll(out[3])


@query("""WITH asked AS (SELECT DISTINCT needle FROM (SELECT substr(s_name, 14) AS needle FROM supplier UNION ALL SELECT lower(substr(c_mktsegment, 3, 5)) FROM customer UNION ALL SELECT substr(n_name, 1, 2) FROM nation))
SELECT needle, c_custkey FROM asked JOIN customer ON contains(lower(c_name || ' ' || c_mktsegment), lower(needle))""")
def index_search(spark, d):
    """Customers indexed in two segments, and searched for the numbers of suppliers, parts of segments' names, and the first two letters of nations."""
    customers, said = t(spark, d, "customer"), F.concat("c_name", F.lit(" "), F.col("c_mktsegment"))
    index = Postings(spark, scratch(spark, "customers"))
    for k in range(2):
        index.add(customers.where(F.col("c_custkey") % 2 == k).select("c_custkey", "c_name", "c_mktsegment"), said, f"part{k}")
    asked = t(spark, d, "supplier").select(F.substring("s_name", 14, 99).alias("needle")).unionAll(customers.select(F.lower(F.substring("c_mktsegment", 3, 5)))).unionAll(t(spark, d, "nation").select(F.substring("n_name", 1, 2)))
    return index.search(asked).select("needle", "row.c_custkey")


@query("""WITH asked AS (SELECT DISTINCT substr(text, 10, 24) AS needle FROM conversations WHERE conv_id % 100 = 0 AND text IS NOT NULL)
SELECT needle, conv_id, turn FROM asked JOIN conversations ON contains(coalesce(text, ''), needle)""")
def index_search_turns(spark, d):
    """All turns of all conversations indexed, and searched for 24 characters of each turn of every hundredth conversation."""
    turns = t(spark, d, "conversations").select("conv_id", "turn", "text")
    index = Postings(spark, scratch(spark, "turns"), fold=False)
    index.add(turns.select("conv_id", "turn", "text"), F.col("text"), "all")
    return index.search(turns.where("conv_id % 100 = 0").select(F.substring("text", 10, 24))).select("needle", "row.conv_id", "row.turn")


@query("SELECT p_partkey, p_name FROM part WHERE contains(lower(p_name || ' ' || p_type), 'st') AND p_size >= 10")
def browse_search_indexed(spark, d):
    parts = t(spark, d, "part")
    index = Postings(spark, scratch(spark, "parts"))
    index.add(parts, F.concat("p_name", F.lit(" "), F.col("p_type")), "all")
    return B.browse(parts, {"search": (["p_name", "p_type"], "St "), "least": {"p_size": 10}}, index=index).select("p_partkey", "p_name")
