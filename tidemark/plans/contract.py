"""Queries of the change-data operators over the driver's tables, and the SQL that must give the same rows.

Where no table of changes fits an operator's input, the log is a view of `events`: an id that is null now and
then, fields of an item, a delete flag, a partition and a sequence number.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators import decode, ledger, maintain, merge, monitor, mutate, validate, workload
from tidemark.session import work_dir
from tidemark.sources import catalog
from tidemark.sources.log import parquet_stream, snapshot_then_changes as tagged_union
from tidemark.sources.tables import table
from tidemark.store import Files, SnapshotTable

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
ITEM = ("id", "name", "description", "price", "on_offer", "operation", "seq")
_NOW = "2024-02-15 00:00:00"


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


# -- the log, its base and its batch

_LOG = """log AS (SELECT CASE WHEN event_id % 97 = 0 THEN NULL ELSE CAST(user_id AS INT) END AS id, event_type AS name, props AS description,
  CAST(floor(value) AS INT) AS price, event_type = 'purchase' AS on_offer, event_type = 'error' AS deleted,
  CAST(user_id % 3 AS INT) AS partition_id, event_id AS seq, ts,
  CASE WHEN event_type = 'error' THEN 'd' WHEN event_id % 97 = 0 OR user_id IS NULL THEN 'c' ELSE 'u' END AS operation FROM events)"""
_SIDES = f"""{_LOG},
  lo AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY seq DESC) AS rn FROM log WHERE seq < (SELECT max(seq) FROM log) / 2),
  hi AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY seq DESC) AS rn FROM log WHERE NOT seq < (SELECT max(seq) FROM log) / 2),
  base AS (SELECT * FROM lo WHERE rn = 1 AND (id IS NULL OR id % 3 <> 0)),
  src AS (SELECT * FROM hi WHERE rn = 1 AND (id IS NULL OR id % 5 <> 0))"""
_COLS = ", ".join(ITEM)


def log(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "events")
    out = e.select(
        F.when(F.col("event_id") % 97 != 0, F.col("user_id").cast("int")).alias("id"),
        F.col("event_type").alias("name"),
        F.col("props").alias("description"),
        F.floor("value").cast("int").alias("price"),
        (F.col("event_type") == "purchase").alias("on_offer"),
        (F.col("event_type") == "error").alias("deleted"),
        (F.col("user_id") % 3).cast("int").alias("partition_id"),
        F.col("event_id").alias("seq"),
        "ts",
    )
    return out.withColumn("operation", decode.classify(F.col("deleted"), F.col("id")))


def sides(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    rows = log(spark, d)
    half = rows.agg(F.max("seq")).first()[0] / 2
    lo, hi = (merge.latest_per_key(x, "id", ("seq",)) for x in (rows.where(F.col("seq") < half), rows.where(F.col("seq") >= half)))
    return lo.where("id IS NULL OR id % 3 <> 0"), hi.where("id IS NULL OR id % 5 <> 0")


# -- scans and point reads


@query("SELECT * FROM events")
def scan_table(spark, d):
    return table(spark, d, "events")


@query("SELECT * FROM part")
def select_all(spark, d):
    return mutate.select_all(table(spark, d, "part"))


@query("SELECT * FROM part WHERE p_partkey = 42")
def select_by_id(spark, d):
    return mutate.select_by_key(table(spark, d, "part"), 42, "p_partkey")


@query("SELECT event_id, ts, event_type FROM events WHERE ts > (SELECT max(ts) FROM events) - INTERVAL 30 HOURS ORDER BY ts DESC, event_id LIMIT 100")
def recent_top100(spark, d):
    e = table(spark, d, "events")
    last = e.agg(F.max("ts")).first()[0]
    return validate.recent(e, "ts", F.lit(last) - F.expr("INTERVAL 30 HOURS"), "event_id").select("event_id", "ts", "event_type")


@query("SELECT 1 AS one")
def session_smoke(spark, d):
    return spark.sql("SELECT 1 AS one")


@query("SELECT * FROM (VALUES ('before', false), ('created', true), ('created again', true), ('dropped', false)) AS v(step, found)")
def table_exists(spark, d):
    space = f"tidemark_{uuid.uuid4().hex[:12]}"
    catalog.create_namespace(spark, space)
    name, steps = f"{space}.items", []
    probe = lambda step: steps.append((step, catalog.table_exists(spark, name)))
    try:
        probe("before")
        for step in ("created", "created again"):
            catalog.create_items(spark, name)
            probe(step)
        catalog.drop_table(spark, name)
        probe("dropped")
    finally:
        spark.sql(f"DROP NAMESPACE IF EXISTS {space} CASCADE")
    return spark.createDataFrame(steps, "step string, found boolean")


@query("SELECT * FROM (VALUES ('items', 10), ('offsets', 5), ('batches', 3)) AS v(name, n_columns)")
def catalog_tables(spark, d):
    """The tables of a new namespace, with as many columns as each has."""
    space = f"tidemark_{uuid.uuid4().hex[:12]}"
    catalog.create_namespace(spark, space)
    try:
        assert catalog.namespaces(spark).where(F.col("namespace") == space).count() == 1
        catalog.create_items(spark, f"{space}.items")
        catalog.create_ledgers(spark, f"{space}.offsets", f"{space}.batches")
        out = [(n, len(spark.table(f"{space}.{n}").columns)) for n in ("items", "offsets", "batches")]
    finally:
        spark.sql(f"DROP NAMESPACE IF EXISTS {space} CASCADE")
    return spark.createDataFrame(out, "name string, n_columns int")


# -- decoding


def _messages(spark: SparkSession, d: str) -> DataFrame:
    rows = log(spark, d)
    payload = F.struct("id", "name", "description", "price", "on_offer", F.col("deleted").cast("string").alias("__deleted"))
    text = F.to_json(F.struct(F.struct(F.lit(3).alias("v")).alias("schema"), payload.alias("payload")))
    return rows.select("partition_id", "seq", "ts", F.encode(text, "UTF-8").alias("value"))


@query(f"WITH {_LOG} SELECT seq, id, name, description, price, on_offer, operation FROM log")
def envelope_decode(spark, d):
    return decode.parse(_messages(spark, d)).where("reason IS NULL").select("seq", "item.*")


@query(f"WITH {_LOG} SELECT seq, id, name, description, price, on_offer, operation, strftime(ts, '%Y') AS year, strftime(ts, '%m') AS month, 'batch-1' AS batch_id FROM log")
def project_items(spark, d):
    good, _ = decode.decode(_messages(spark, d), time=F.col("ts"), batch_id="batch-1", keep=("seq",))
    return good.drop("processing_time")


@query("SELECT CASE event_id % 3 WHEN 0 THEN false WHEN 1 THEN NULL ELSE true END AS on_offer, count(*) AS n FROM events GROUP BY 1")
def default_missing_key(spark, d):
    m = F.col("event_id") % 3
    text = F.when(m == 0, '{"payload":{"id":1}}').when(m == 1, '{"payload":{"id":1,"on_offer":null}}').otherwise('{"payload":{"id":1,"on_offer":true}}')
    return decode.parse(table(spark, d, "events").select(text.alias("value"))).groupBy("item.on_offer").agg(F.count("*").alias("n"))


@query("""SELECT CASE WHEN event_id % 50 = 0 THEN 'empty' WHEN event_id % 51 = 0 THEN 'blank' WHEN event_id % 53 = 0 THEN 'bad_json' WHEN event_id % 54 = 0 THEN 'no_payload'
  WHEN event_id % 59 = 0 THEN 'null' WHEN event_id % 61 = 0 THEN 'bad_type' WHEN event_id % 67 = 0 THEN 'bad_payload' ELSE 'ok' END AS reason, count(*) AS n FROM events GROUP BY 1""")
def reject_reasons(spark, d):
    i = F.col("event_id")
    bad = {50: " empty\n", 51: " \t\r\n ", 53: "{bad", 54: '{"payload": {}}', 59: None, 61: '{"payload": {"id": 1.5}}', 67: '{"payload": [1]}'}
    value = F.when(i < 0, "")
    for m, v in bad.items():
        value = value.when(i % m == 0, F.lit(v).cast("string"))
    return decode.reasons(table(spark, d, "events").select(value.otherwise('{"payload": {"id": 1}}').alias("value")))


#: The topic's messages with their fields as JSON, and why one is refused.
_TOPIC = r"""a AS (SELECT *, CASE WHEN value IS NULL THEN NULL ELSE trim(coalesce(try(decode(value)), '{bad'), ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) END AS t FROM topic_log),
  b AS (SELECT *, CASE WHEN json_valid(t) THEN json_extract(t, '$.payload') END AS p FROM a),
  f AS (SELECT *, CAST(p AS VARCHAR) AS pt, json_extract(p, '$.id') AS jid, json_extract(p, '$.name') AS jname, json_extract(p, '$.description') AS jdesc, json_extract(p, '$.price') AS jprice,
    json_extract(p, '$.on_offer') AS joffer, json_extract_string(p, '$.__deleted') AS jdel FROM b),
  g AS (SELECT *, jid IS NOT NULL AND json_type(jid) <> 'NULL' AND (NOT regexp_full_match(CAST(jid AS VARCHAR), '-?\d{1,11}') OR try_cast(CAST(jid AS VARCHAR) AS INTEGER) IS NULL) AS bad_id,
    jprice IS NOT NULL AND json_type(jprice) <> 'NULL' AND (NOT regexp_full_match(CAST(jprice AS VARCHAR), '-?\d{1,11}') OR try_cast(CAST(jprice AS VARCHAR) AS INTEGER) IS NULL) AS bad_price,
    joffer IS NOT NULL AND json_type(joffer) NOT IN ('NULL', 'BOOLEAN') AS bad_offer FROM f),
  m AS (SELECT *, CASE WHEN value IS NULL THEN 'null' WHEN t = '' THEN 'blank' WHEN t = 'empty' THEN 'empty' WHEN NOT json_valid(t) THEN 'bad_json'
    WHEN pt IS NULL OR pt IN ('null', '{}', '[]', '""', '0', '0.0', 'false') THEN 'no_payload' WHEN json_type(p) <> 'OBJECT' THEN 'bad_payload' WHEN bad_id OR bad_price OR bad_offer THEN 'bad_type' ELSE 'ok' END AS reason FROM g)"""


@query(f"WITH {_TOPIC} SELECT reason, count(*) AS n FROM m GROUP BY reason")
def topic_log_reasons(spark, d):
    return decode.reasons(table(spark, d, "topic_log"))


@query(f"WITH {_LOG} SELECT operation, count(*) AS n FROM log GROUP BY operation")
def classify_operation(spark, d):
    return log(spark, d).groupBy("operation").agg(F.count("*").alias("n"))


@query("SELECT strftime(ts, '%Y') AS year, strftime(ts, '%m') AS month, count(*) AS n FROM events GROUP BY 1, 2")
def derive_partitions(spark, d):
    return decode.with_partitions(table(spark, d, "events"), "ts").groupBy("year", "month").agg(F.count("*").alias("n"))


# -- latest per key, merges


@query(f"WITH {_LOG}, r AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY seq DESC) AS rn FROM log) SELECT {_COLS} FROM r WHERE rn = 1")
def dedup_latest(spark, d):
    return merge.latest_per_key(log(spark, d), "id", ("seq",)).select(*ITEM)


@query(f"WITH {_LOG} SELECT count(*) AS records, count(DISTINCT id) + max(CASE WHEN id IS NULL THEN 1 ELSE 0 END) AS distinct_ids FROM log")
def batch_stats(spark, d):
    return log(spark, d).agg(F.count("*").alias("records"), (F.count_distinct("id") + F.max(F.col("id").isNull().cast("int"))).alias("distinct_ids"))


_MERGED = f"""merged AS (SELECT {_COLS}, ts FROM base t WHERE NOT EXISTS (SELECT 1 FROM src s WHERE s.id = t.id)
  UNION ALL SELECT {_COLS}, ts FROM src s WHERE s.operation <> 'd' OR NOT EXISTS (SELECT 1 FROM base t WHERE t.id = s.id))"""


@query(f"WITH {_SIDES}, {_MERGED} SELECT {_COLS} FROM merged")
def merge_apply(spark, d):
    base, src = sides(spark, d)
    return merge.merge(base.select(*ITEM), src.select(*ITEM), plan="outer")


@query(f"WITH {_SIDES}, {_MERGED} SELECT {_COLS} FROM merged")
def merge_small_batch(spark, d):
    base, src = sides(spark, d)
    return merge.merge(base.select(*ITEM), src.select(*ITEM))


@query(f"""WITH {_SIDES}, {_MERGED} SELECT {_COLS} FROM merged m WHERE m.operation <> 'd' OR EXISTS (SELECT 1 FROM base b WHERE b.seq = m.seq)""")
def merge_without_tombstones(spark, d):
    base, src = sides(spark, d)
    return merge.merge(base.select(*ITEM), src.select(*ITEM), tombstones="ignore")


@query(f"""WITH {_SIDES}, t AS (SELECT *, CASE WHEN seq % 4 = 0 THEN NULL ELSE 'b' || (seq % 3) END AS batch_id FROM base), s AS (SELECT *, 'b' || (seq % 3) AS batch_id FROM src)
  SELECT {_COLS}, batch_id FROM t WHERE NOT EXISTS (SELECT 1 FROM s WHERE s.id = t.id AND t.batch_id <> s.batch_id)
  UNION ALL SELECT {_COLS}, batch_id FROM s WHERE s.operation <> 'd' OR NOT EXISTS (SELECT 1 FROM t WHERE s.id = t.id AND t.batch_id <> s.batch_id)""")
def merge_batch_guard(spark, d):
    base, src = sides(spark, d)
    name = F.concat(F.lit("b"), (F.col("seq") % 3).cast("string"))
    t = base.select(*ITEM, F.when(F.col("seq") % 4 != 0, name).alias("batch_id"))
    return merge.merge(t, src.select(*ITEM, name.alias("batch_id")), guard="batch_id", plan="outer")


@query(f"""WITH {_SIDES}, moved AS (SELECT {_COLS}, ts + INTERVAL 40 DAYS AS ts FROM src),
  m AS (SELECT {_COLS}, ts FROM base t WHERE NOT EXISTS (SELECT 1 FROM moved s WHERE s.id = t.id) UNION ALL SELECT {_COLS}, ts FROM moved s WHERE s.operation <> 'd' OR NOT EXISTS (SELECT 1 FROM base t WHERE t.id = s.id))
  SELECT strftime(ts, '%Y') AS year, strftime(ts, '%m') AS month, count(*) AS n FROM m GROUP BY 1, 2""")
def merge_partition_move(spark, d):
    base, src = sides(spark, d)
    moved = src.select(*ITEM, (F.col("ts") + F.expr("INTERVAL 40 DAYS")).alias("ts"))
    return decode.with_partitions(merge.merge(base.select(*ITEM, "ts"), moved), "ts").groupBy("year", "month").agg(F.count("*").alias("n"))


@query(f"WITH {_SIDES} SELECT count(*) AS repeated FROM (SELECT id FROM src WHERE id IS NOT NULL GROUP BY id HAVING count(*) > 1)")
def merge_source_unique(spark, d):
    return merge.repeated_keys(sides(spark, d)[1]).agg(F.count("*").alias("repeated"))


@query(f"WITH {_SIDES}, {_MERGED} SELECT {_COLS} FROM merged")
def exactly_once_replay(spark, d):
    base, src = sides(spark, d)
    t = merge.MergeTable(spark, work_dir(spark, "replay"))
    t.merge_batch(base.select(*ITEM), 0)
    for _ in range(2):  # the second changes nothing
        t.merge_batch(src.select(*ITEM), 1)
    return t.rows()


@query(f"WITH {_SIDES} SELECT id, name, description, price, on_offer, seq, 'r' AS operation FROM base UNION ALL SELECT id, name, description, price, on_offer, seq, operation FROM src")
def snapshot_then_changes(spark, d):
    base, src = sides(spark, d)
    return tagged_union(base.select(*ITEM), src.select(*ITEM))


@query(f"""WITH {_SIDES} SELECT id, name, price, 'false' AS _deleted FROM base t WHERE NOT EXISTS (SELECT 1 FROM src s WHERE s.id = t.id)
  UNION ALL SELECT id, name, price, CASE WHEN deleted THEN 'true' ELSE 'false' END FROM src s WHERE NOT deleted OR NOT EXISTS (SELECT 1 FROM base t WHERE t.id = s.id)""")
def sink_rename_upsert(spark, d):
    base, src = sides(spark, d)
    target = base.select("id", "name", "price", F.lit("false").alias("_deleted"), F.lit("u").alias("operation"))
    source = src.select("id", "name", "price", F.col("deleted").cast("string").alias("__deleted")).withColumnRenamed("__deleted", "_deleted")
    return merge.merge(target, source.withColumn("operation", decode.classify(F.col("_deleted"), F.col("id")))).drop("operation")


@query(f"""WITH {_TOPIC}, i AS (SELECT topic, "partition", "offset", append_time AS processing_time, try_cast(CAST(jid AS VARCHAR) AS INTEGER) AS id,
    CASE json_type(jname) WHEN 'VARCHAR' THEN json_extract_string(p, '$.name') WHEN 'NULL' THEN NULL ELSE CAST(jname AS VARCHAR) END AS name,
    CASE json_type(jdesc) WHEN 'VARCHAR' THEN json_extract_string(p, '$.description') WHEN 'NULL' THEN NULL ELSE CAST(jdesc AS VARCHAR) END AS description,
    try_cast(CAST(jprice AS VARCHAR) AS INTEGER) AS price, CASE WHEN joffer IS NULL THEN false WHEN json_type(joffer) = 'NULL' THEN NULL ELSE CAST(joffer AS VARCHAR) = 'true' END AS on_offer,
    lower(coalesce(jdel, 'false')) = 'true' AS gone FROM m WHERE reason = 'ok'),
  r AS (SELECT *, row_number() OVER (PARTITION BY coalesce(CAST(id AS VARCHAR), topic || '/' || "partition" || '/' || "offset") ORDER BY processing_time DESC NULLS LAST, "offset" DESC, topic DESC, "partition" DESC) AS rn FROM i)
  SELECT topic, "partition", "offset", id, name, description, price, on_offer, CASE WHEN id IS NULL THEN 'c' ELSE 'u' END AS operation, processing_time, strftime(processing_time, '%Y') AS year, strftime(processing_time, '%m') AS month
  FROM r WHERE rn = 1 AND NOT gone""")
def stream_current_items(spark, d):
    """The log comes in three micro-batches that share it out by hash, so younger events come before older ones."""
    from tidemark.streaming import items

    at = work_dir(spark, "stream")
    log = table(spark, d, "topic_log")
    log.repartition(3, F.xxhash64("topic", "partition", "offset")).write.parquet(f"{at}/log")
    t = items.item_table(spark, f"{at}/table")
    items.start(parquet_stream(spark, f"{at}/log", log.schema), t, f"{at}/checkpoint", SnapshotTable(spark, f"{at}/rejects"), every=None).awaitTermination()
    return items.current_items(t).drop("batch_id")


# -- ledgers


@query("""WITH r AS (SELECT *, row_number() OVER (PARTITION BY topic, "partition" ORDER BY commit_time DESC NULLS LAST, "offset" DESC NULLS LAST, batch_id NULLS LAST) AS rn FROM kafka_offsets)
  SELECT topic, "partition", "offset", commit_time, batch_id FROM r WHERE rn = 1""")
def offsets_latest(spark, d):
    return ledger.latest_offsets(table(spark, d, "kafka_offsets")).select("topic", "partition", "offset", "commit_time", "batch_id")


@query("""WITH r AS (SELECT *, row_number() OVER (PARTITION BY topic, "partition" ORDER BY commit_time DESC NULLS LAST, "offset" DESC NULLS LAST) AS rn FROM kafka_offsets)
  SELECT topic, "partition", "offset" + 1 AS start_offset FROM r WHERE rn = 1""")
def resume_offsets(spark, d):
    return ledger.resume_offsets(table(spark, d, "kafka_offsets"))


@query("""SELECT topic, "partition", count(*) AS n FROM kafka_offsets WHERE topic IS NULL OR topic <> 'shopdb.public.items' GROUP BY 1, 2""")
def offsets_after_reset(spark, d):
    return ledger.reset(table(spark, d, "kafka_offsets"), "shopdb.public.items").groupBy("topic", "partition").agg(F.count("*").alias("n"))


_BATCHES = f"{_LOG}, b AS (SELECT *, CAST(floor((row_number() OVER (PARTITION BY partition_id ORDER BY seq) - 1) / 100) AS BIGINT) AS batch_no FROM log)"


@query(f"WITH {_BATCHES} SELECT partition_id, batch_no, max(seq) AS end_offset, count(*) AS records FROM b GROUP BY 1, 2")
def batch_end_offsets(spark, d):
    return ledger.batch_end_offsets(ledger.microbatches(log(spark, d), ("partition_id",), "seq"), ("partition_id", "batch_no"), "seq")


@query(f"WITH {_BATCHES} SELECT partition_id, batch_no, count(*) AS records, count(DISTINCT id) AS ids, max(seq) AS last_seq FROM b GROUP BY 1, 2")
def microbatch_assign(spark, d):
    return ledger.microbatches(log(spark, d), ("partition_id",), "seq").groupBy("partition_id", "batch_no").agg(F.count("*").alias("records"), F.count_distinct("id").alias("ids"), F.max("seq").alias("last_seq"))


@query(f"""WITH {_BATCHES} SELECT topic, "partition", "offset", batch_id FROM kafka_offsets
  UNION ALL SELECT 'log', partition_id, max(seq), 'log-' || batch_no FROM b GROUP BY partition_id, batch_no""")
def ledger_append(spark, d):
    ends = ledger.batch_end_offsets(ledger.microbatches(log(spark, d), ("partition_id",), "seq"), ("partition_id", "batch_no"), "seq")
    new = ends.select(F.lit("log").alias("topic"), F.col("partition_id").alias("partition"), F.col("end_offset").alias("offset"), F.concat(F.lit("log-"), F.col("batch_no").cast("string")).alias("batch_id"))
    return ledger.append(table(spark, d, "kafka_offsets").select("topic", "partition", "offset", "batch_id"), new)


@query("SELECT topic, count(*) AS n FROM item_changes WHERE batch_id IN (SELECT batch_id FROM processed_batches WHERE batch_id IS NOT NULL) GROUP BY topic")
def batch_seen(spark, d):
    return ledger.seen(table(spark, d, "item_changes"), table(spark, d, "processed_batches")).groupBy("topic").agg(F.count("*").alias("n"))


# -- changes by request

_REQ = """req AS (SELECT p_partkey + 1000000 AS p_partkey, CASE WHEN p_partkey % 50 = 0 THEN p_name ELSE 'New ' || p_name END AS p_name, p_brand, p_type, p_size, p_retailprice FROM part WHERE p_partkey % 10 = 0)"""


def _requests(spark: SparkSession, d: str) -> DataFrame:
    p = table(spark, d, "part").where("p_partkey % 10 = 0")
    name = F.when(F.col("p_partkey") % 50 == 0, F.col("p_name")).otherwise(F.concat(F.lit("New "), "p_name"))
    return p.withColumn("p_name", name).withColumn("p_partkey", F.col("p_partkey") + 1000000)


@query(f"""WITH {_REQ}, r AS (SELECT *, row_number() OVER (PARTITION BY p_name ORDER BY p_partkey DESC) AS rn FROM req)
  SELECT * FROM part UNION ALL SELECT p_partkey, p_name, p_brand, p_type, p_size, p_retailprice FROM r WHERE rn = 1 AND p_name NOT IN (SELECT p_name FROM part WHERE p_name IS NOT NULL)""")
def insert_if_absent(spark, d):
    return mutate.insert_if_absent(table(spark, d, "part"), _requests(spark, d), "p_name")[0]


@query("""SELECT p_partkey, CASE WHEN p_partkey % 7 = 0 THEN 'X ' || p_name ELSE p_name END AS p_name, p_brand, p_type, p_size, CASE WHEN p_partkey % 7 = 0 THEN p_retailprice + 1 ELSE p_retailprice END AS p_retailprice FROM part""")
def update_by_id(spark, d):
    p = table(spark, d, "part")
    req = p.where("p_partkey % 7 = 0").select("p_partkey", F.concat(F.lit("X "), "p_name").alias("p_name"), (F.col("p_retailprice") + 1).alias("p_retailprice"))
    return mutate.update_by_key(p, req, "p_partkey", ("p_name", "p_retailprice"))[0]


@query("SELECT * FROM part WHERE p_partkey % 11 <> 0")
def delete_by_id(spark, d):
    p = table(spark, d, "part")
    return mutate.delete_by_key(p, p.where("p_partkey % 11 = 0").select("p_partkey"), "p_partkey")[0]


# -- validation


@query("""WITH c AS (SELECT (SELECT count(*) FROM events) AS s, (SELECT count(*) FROM events WHERE event_id % 1000 <> 0) AS t)
  SELECT s AS source_count, t AS target_count, abs(s - t) AS difference, CAST(abs(s - t) AS DOUBLE) / s * 100 AS difference_percentage, CAST(abs(s - t) AS DOUBLE) / s * 100 <= 0.1 AS is_valid FROM c""")
def row_count_check(spark, d):
    e = table(spark, d, "events")
    return validate.row_count(e, e.where("event_id % 1000 <> 0"))


@query("""WITH t AS (SELECT o_orderkey || '#' || coalesce(o_orderstatus, '') || '#' || coalesce(o_orderpriority, '') AS t FROM orders),
  n AS (SELECT t, t || '*' || count(*) AS one FROM t GROUP BY t), p6 AS (SELECT substr(md5(t), 1, 6) AS p, md5(string_agg(one, ',' ORDER BY one)) AS m FROM n GROUP BY 1),
  p4 AS (SELECT substr(p, 1, 4) AS q, md5(string_agg(p || ':' || m, ',' ORDER BY p || ':' || m)) AS m FROM p6 GROUP BY 1), p AS (SELECT substr(q, 1, 2) AS p, md5(string_agg(q || ':' || m, ',' ORDER BY q || ':' || m)) AS m FROM p4 GROUP BY 1)
  SELECT md5(string_agg(p || ':' || m, ',' ORDER BY p || ':' || m)) AS checksum FROM p""")
def table_checksum(spark, d):
    return validate.table_checksum(table(spark, d, "orders"), ("o_orderkey", "o_orderstatus", "o_orderpriority"))


@query("""SELECT 'in another order' AS target, count(*) AS rows, true AS is_valid FROM orders UNION ALL SELECT 'a value changed', count(*), count(*) = 0 FROM orders
  UNION ALL SELECT 'a row twice', count(*), count(*) = 0 FROM orders""")
def checksum_match(spark, d):
    o = table(spark, d, "orders")
    columns = ("o_orderkey", "o_orderstatus", "o_orderpriority")
    last = o.agg(F.max("o_orderkey")).first()[0]
    changed = o.withColumn("o_orderstatus", F.when(F.col("o_orderkey") == last, "?").otherwise(F.col("o_orderstatus")))
    targets = {"in another order": o.repartition(7, "o_custkey"), "a value changed": changed, "a row twice": o.unionByName(o.where(F.col("o_orderkey") == last))}
    out = None
    for name, target in targets.items():
        one = validate.checksum_match(o, target, columns).select(F.lit(name).alias("target"), "source.rows", "is_valid")
        out = one if out is None else out.unionByName(one)
    return out


_SAMPLE = """k AS (SELECT o_orderkey FROM orders ORDER BY md5(CAST(o_orderkey AS VARCHAR)), o_orderkey LIMIT 1000),
  t AS (SELECT o_orderkey FROM orders WHERE o_orderkey % 50 <> 0 UNION ALL SELECT o_orderkey FROM orders WHERE o_orderkey % 49 = 0 AND o_orderkey % 50 <> 0),
  n AS (SELECT k.o_orderkey, count(t.o_orderkey) AS n FROM k LEFT JOIN t ON k.o_orderkey = t.o_orderkey GROUP BY 1)"""


def _sampled(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    o = table(spark, d, "orders").select("o_orderkey")
    kept = o.where("o_orderkey % 50 <> 0")
    return o, kept.unionByName(kept.where("o_orderkey % 49 = 0"))


@query(f"""WITH {_SAMPLE}, m AS (SELECT count(*) AS s, count(*) FILTER (WHERE n = 1) AS m FROM n)
  SELECT s AS sample_size, m AS matched_records, CAST(m AS DOUBLE) / s AS match_rate, s - m AS mismatch_count, CAST(m AS DOUBLE) / s >= 0.99 AS is_valid FROM m""")
def sample_match(spark, d):
    return validate.sample_match(*_sampled(spark, d), "o_orderkey")


@query(f"WITH {_SAMPLE} SELECT o_orderkey, n > 0 AS found_in_target, n > 1 AS multiple_matches FROM n WHERE n <> 1 ORDER BY o_orderkey LIMIT 5")
def sample_mismatches(spark, d):
    return validate.sample_mismatches(*_sampled(spark, d), "o_orderkey")


@query("""SELECT 'orders' AS t, count(*) AS rows, count(*) - count(DISTINCT o_orderkey) AS surplus, count(*) = count(DISTINCT o_orderkey) AS is_unique FROM orders
  UNION ALL SELECT 'lineitem', count(*), (SELECT count(*) FROM (SELECT l_orderkey FROM lineitem GROUP BY 1 HAVING count(*) > 1)), false FROM lineitem""")
def pk_uniqueness(spark, d):
    def of(name: str, key: str) -> DataFrame:
        return validate.primary_key_check(table(spark, d, name), key).select(F.lit(name).alias("t"), "rows", F.col("duplicate_keys").alias("surplus"), "is_unique")

    return of("orders", "o_orderkey").unionByName(of("lineitem", "l_orderkey"))


@query("""WITH l AS (SELECT CAST(event_id % 600 AS DOUBLE) AS lag FROM events)
  SELECT avg(lag) AS avg_lag_seconds, min(lag) AS min_lag_seconds, max(lag) AS max_lag_seconds, count(*) AS samples_count, avg(lag) <= 300 AS is_acceptable FROM l""")
def combined_lag(spark, d):
    e = table(spark, d, "events").select("ts", "event_id")
    loads = e.select("ts", F.expr("ts + make_interval(0, 0, 0, 0, 0, 0, event_id % 600)").alias("loaded_at"))
    return validate.combined_lag(e, loads, "ts", "loaded_at")


@query("""SELECT max(ts) AS latest, (epoch_us(TIMESTAMP '2024-01-31 00:00:00') - epoch_us(max(ts))) / 1e6 AS age_seconds,
  epoch_us(TIMESTAMP '2024-01-31 00:00:00') - epoch_us(max(ts)) <= 1800000000 AS is_fresh FROM events""")
def data_freshness(spark, d):
    return validate.data_freshness(table(spark, d, "events"), "ts", F.lit("2024-01-31 00:00:00").cast("timestamp"))


@query("SELECT operation AS event_type, count(*) AS events FROM item_changes GROUP BY 1")
def cdc_event_type_counts(spark, d):
    return validate.event_type_counts(table(spark, d, "item_changes"))


@query("""WITH h AS (SELECT topic, "partition", min("offset") AS lo, max("offset") AS last_offset FROM topic_log WHERE "offset" IS NOT NULL GROUP BY 1, 2),
  p AS (SELECT topic, "partition", max("offset") AS processed_offset FROM kafka_offsets WHERE "offset" >= 0 GROUP BY 1, 2)
  SELECT h.topic, h."partition", last_offset, processed_offset, greatest(0, last_offset - coalesce(processed_offset, lo - 1)) AS behind FROM h LEFT JOIN p ON h.topic = p.topic AND h."partition" = p."partition" """)
def message_lag(spark, d):
    return validate.message_lag(table(spark, d, "topic_log"), table(spark, d, "kafka_offsets"))


@query("""SELECT * FROM (VALUES ('row_count'), ('sampling'), ('checksum'), ('combined_lag'), ('message_tracking'), ('event_types'), ('freshness')) AS v(name)""")
def validation_report(spark, d):
    """The names of a suite's results, as they come back from its saved report; an error in one of them is raised."""
    at = work_dir(spark, "report")
    target = table(spark, d, "items")
    got = validate.run_suite(spark, table(spark, d, "items_source"), target, time="processing_time", columns=("id", "price"), log=table(spark, d, "topic_log"), offsets=table(spark, d, "kafka_offsets"))
    lag = validate.run_suite(spark, target, target, source_time="processing_time")["results"]["combined_lag"]
    got["results"]["combined_lag"] = lag
    if bad := {n: r["error"] for n, r in got["results"].items() if "error" in r}:
        raise RuntimeError(str(bad))
    saved = validate.save_results(spark, got, at, "items")
    kept = json.loads(Files(spark, at).read(saved))["results"]
    return spark.createDataFrame([(n,) for n in kept], "name string")


# -- monitoring

_STATE = "CASE WHEN s_suppkey % 7 = 0 THEN 'FAILED' WHEN s_suppkey % 5 = 0 THEN 'PAUSED' ELSE 'RUNNING' END"


@query(f"""WITH s AS (SELECT s_name AS connector, {_STATE} AS connector_state, CASE WHEN s_suppkey % 4 = 0 THEN 0 ELSE 2 END AS tasks, CASE WHEN s_suppkey % 4 <> 0 AND s_suppkey % 3 = 0 THEN 1 ELSE 0 END AS failed_tasks FROM supplier)
  SELECT *, connector_state = 'RUNNING' AND failed_tasks = 0 AS running, CASE WHEN failed_tasks > 0 THEN 't' END AS failure FROM s""")
def connector_status(spark, d):
    k = F.col("s_suppkey")
    state = F.when(k % 7 == 0, "FAILED").when(k % 5 == 0, "PAUSED").otherwise("RUNNING")
    second = F.when(k % 3 == 0, "FAILED").otherwise("RUNNING")
    doc = F.format_string('{"name": "x", "connector": {"state": "%s"}, "tasks": %s}', state, F.when(k % 4 == 0, F.lit("[]")).otherwise(F.format_string('[{"id": 0, "state": "RUNNING"}, {"id": 1, "state": "%s", "trace": "t"}]', second)))
    return monitor.connector_status(table(spark, d, "supplier").select(F.col("s_name").alias("connector"), doc.alias("status")))


@query(f"""WITH s AS (SELECT s_name AS connector, {_STATE} AS state, CASE WHEN s_suppkey % 6 = 0 THEN NULL ELSE s_suppkey * 1000 END AS lag_millis FROM supplier)
  SELECT *, state = 'RUNNING' AND coalesce(lag_millis <= 60000, true) AS is_acceptable FROM s""")
def replication_lag(spark, d):
    k = F.col("s_suppkey")
    state = F.when(k % 7 == 0, "FAILED").when(k % 5 == 0, "PAUSED").otherwise("RUNNING")
    doc = F.when(k % 6 == 0, '{"tasks": [{"metrics": {}}]}').otherwise(F.format_string('{"tasks": [{"metrics": {"lag-in-millis": %d}}, {"metrics": {"lag-in-millis": 5}}]}', k * 1000))
    return monitor.replication_lag(table(spark, d, "supplier").select(F.col("s_name").alias("connector"), state.alias("state"), doc.alias("metrics")))


# -- health and upkeep

_SNAPS = "snaps AS (SELECT event_id AS snapshot_id, ts AS made_current_at FROM events)"
_BALANCE = """bal AS (SELECT count(*) AS partitions, min(n) AS least_rows, max(n) AS most_rows, avg(n) AS mean_rows, count(*) FILTER (WHERE n < 1000) AS small_partitions, coalesce(max(n) > 10 * avg(n), false) AS is_skewed
  FROM (SELECT user_id, count(*) AS n FROM events GROUP BY 1))"""


def _snapshots(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "events").select(F.col("event_id").alias("snapshot_id"), F.col("ts").alias("made_current_at"))


@query(f"WITH {_BALANCE} SELECT * FROM bal")
def partition_balance(spark, d):
    return validate.partition_balance(table(spark, d, "events"), ("user_id",))


@query(f"""WITH {_SNAPS}, {_BALANCE}, x AS (SELECT (SELECT count(*) FROM snaps) AS snapshots_count, (SELECT count(*) FROM snaps WHERE made_current_at < TIMESTAMP '{_NOW}' - INTERVAL 7 DAYS) AS old_snapshots,
    (SELECT max(made_current_at) FROM snaps) AS last_modified, (SELECT count(*) FROM data_files) AS manifests_count),
  y AS (SELECT *, CAST(100 - CASE WHEN old_snapshots > 5 THEN least(20, 2 * old_snapshots) ELSE 0 END - CASE WHEN manifests_count > 100 THEN least(20, (manifests_count - 100) // 10) ELSE 0 END
    - CASE WHEN is_skewed THEN 15 ELSE 0 END - CASE WHEN small_partitions > 10 THEN least(10, small_partitions // 2) ELSE 0 END AS INT) AS health_score FROM x, bal)
  SELECT *, CASE WHEN health_score < 70 THEN 'Poor' WHEN health_score < 90 THEN 'Warning' ELSE 'Good' END AS health_level FROM y""")
def table_health(spark, d):
    e = table(spark, d, "events")
    return validate.table_health(_snapshots(spark, d), table(spark, d, "data_files"), validate.partition_balance(e, ("user_id",)), F.lit(_NOW).cast("timestamp"))


def _three_versions(spark: SparkSession, d: str) -> SnapshotTable:
    t = SnapshotTable(spark, work_dir(spark, "versions"))
    p = table(spark, d, "part")
    t.replace(p)
    t.append(p.where("p_partkey = 42"))
    t.replace(p)
    return t


@query("SELECT * FROM (VALUES (1, 0, 'replace', 1), (2, 1, 'append', 2), (3, 2, 'replace', 1)) AS v(version, parent, operation, parts)")
def snapshot_history(spark, d):
    return _three_versions(spark, d).history().drop("made_current_at")


@query("SELECT CAST(3 AS BIGINT) AS manifests")
def manifest_count(spark, d):
    return _three_versions(spark, d).history().agg(F.count("*").alias("manifests"))


@query("SELECT * FROM part UNION ALL SELECT * FROM part WHERE p_partkey = 42")
def read_older_version(spark, d):
    return _three_versions(spark, d).live(2)


@query(f"WITH {_SNAPS} SELECT * FROM snaps ORDER BY made_current_at DESC, snapshot_id DESC LIMIT 1")
def latest_snapshot(spark, d):
    return maintain.latest_snapshot(_snapshots(spark, d))


@query(f"WITH {_SNAPS} SELECT * FROM snaps WHERE made_current_at < TIMESTAMP '{_NOW}' - INTERVAL 7 DAYS")
def old_snapshots(spark, d):
    return maintain.old_snapshots(_snapshots(spark, d), F.lit(_NOW).cast("timestamp"))


@query(f"""WITH {_SNAPS}, r AS (SELECT *, row_number() OVER (ORDER BY made_current_at DESC, snapshot_id DESC) AS rn FROM snaps)
  SELECT snapshot_id, made_current_at FROM r WHERE rn > 5 AND made_current_at < TIMESTAMP '{_NOW}' - INTERVAL 30 DAYS""")
def expire_snapshots(spark, d):
    return maintain.expired_snapshots(_snapshots(spark, d), F.lit(_NOW).cast("timestamp"))


@query("SELECT year, month, count(*) AS files, CAST(sum(b) AS BIGINT) AS bytes FROM (SELECT year, month, file_path, max(file_size_in_bytes) AS b FROM data_files WHERE removed_time IS NULL AND file_path IS NOT NULL GROUP BY 1, 2, 3) GROUP BY 1, 2 HAVING count(*) >= 5")
def compaction_plan(spark, d):
    return maintain.compaction_plan(table(spark, d, "data_files").where("removed_time IS NULL"), ("year", "month"), size="file_size_in_bytes")


@query("SELECT DISTINCT file_path FROM data_files WHERE added_time < TIMESTAMP '2025-11-01' - INTERVAL 3 DAYS AND file_path NOT IN (SELECT file_path FROM data_files WHERE removed_time IS NULL)")
def orphan_files(spark, d):
    f = table(spark, d, "data_files")
    return maintain.orphan_files(f, f.where("removed_time IS NULL"), F.lit("2025-11-01").cast("timestamp"), modified="added_time").select("file_path").distinct()


@query("""WITH v AS (SELECT event_type <> 'error' AS passed FROM events), s AS (SELECT count(*) AS checks, count(*) FILTER (WHERE passed) AS passed_checks FROM v)
  SELECT *, CAST(passed_checks AS DOUBLE) / checks * 100 AS success_rate, CASE WHEN CAST(passed_checks AS DOUBLE) / checks * 100 >= 95 THEN 'Good' WHEN CAST(passed_checks AS DOUBLE) / checks * 100 >= 80 THEN 'Warning' ELSE 'Poor' END AS level FROM s""")
def suite_summary(spark, d):
    return validate.suite_summary(table(spark, d, "events").select((F.col("event_type") != "error").alias("passed")))


@query("SELECT 'Test Item ' || (i // 5) || '-' || (i % 5) AS name, CAST(i % 5 * 1000 AS INT) AS price, i % 5 % 2 = 0 AS on_offer FROM range(50) AS t(i)")
def workload_seed(spark, d):
    return workload.seed_items(spark)


@query("SELECT CAST(1000 AS BIGINT) AS operations, CAST(1000 AS BIGINT) AS numbers, true AS prices, true AS users, true AS repeated")
def workload_operations(spark, d):
    """A workload has each number once, prices and users within their limits, and is the same when made again, in other partitions."""
    one, two = workload.workload(spark, 1000, seed=7), workload.workload(spark, 1000, seed=7, partitions=3)
    differing = one.exceptAll(two).count()
    return one.agg(F.count("*").alias("operations"), F.count_distinct("operation_no").alias("numbers"), F.every(F.col("price").between(500, 10_000)).alias("prices"), F.every(F.col("user").between(0, 9)).alias("users"), F.lit(differing == 0).alias("repeated"))


@query("SELECT CASE WHEN event_id % 12 < 3 THEN 'list' WHEN event_id % 12 < 7 THEN 'get' WHEN event_id % 12 < 9 THEN 'create' WHEN event_id % 12 < 11 THEN 'update' ELSE 'delete' END AS action, count(*) AS n FROM events GROUP BY 1")
def workload_mix(spark, d):
    return workload.mix(table(spark, d, "events"), F.col("event_id")).groupBy("action").agg(F.count("*").alias("n"))
