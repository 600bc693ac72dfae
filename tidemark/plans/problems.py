"""Queries of the general data problems, each through its operator over the whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators import compare, history, messages
from tidemark.operators.changes import ChangeTable
from tidemark.operators.compaction import Compactor
from tidemark.operators.incremental import IncrementalReader, ledger_positions
from tidemark.session import work_dir
from tidemark.sources.tables import table


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    reader = IncrementalReader(spark, work_dir(spark, "p1"))
    reader.run(table(spark, d, "topic_log"), ledger_positions(table(spark, d, "kafka_offsets"), table(spark, d, "processed_batches")))
    return reader.new_records().select("topic", "partition", "offset")


def p1_runs(spark: SparkSession, d: str) -> DataFrame:
    """Three runs while the log grows, one of which dies before its commit and is repeated: the run that gave each message."""
    reader = IncrementalReader(spark, work_dir(spark, "p1"))
    log = table(spark, d, "topic_log")
    start = ledger_positions(table(spark, d, "kafka_offsets"), table(spark, d, "processed_batches"))
    last = log.agg(F.max("offset")).first()[0] or 0
    for n in (1, 2, 3):
        grown = log.where(F.col("offset") <= last * n // 3)
        if n == 2:
            reader.table.write_part(reader.between(grown, reader.plan(grown, start)))  # written, never committed
        reader.run(grown, start)
    runs = [reader.new_records(v).select("topic", "partition", "offset", F.lit(v).alias("run")) for v in reader.table.versions()]
    return runs[0].unionByName(runs[1]).unionByName(runs[2])


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    return messages.repeated_messages(table(spark, d, "item_changes"))


def p2_messages(spark: SparkSession, d: str) -> DataFrame:
    return messages.first_copies(table(spark, d, "item_changes"))


def p2_store(spark: SparkSession, d: str) -> DataFrame:
    """The deliveries of each quarter as a batch of their own, every batch ranked and anti-joined with what is stored."""
    store, rows = messages.MessageStore(spark, work_dir(spark, "p2")), table(spark, d, "item_changes")
    quarter = F.floor((F.col("year").cast("int") * 12 + F.col("month").cast("int") - 1) / 3)
    first, last = rows.agg(F.min(quarter), F.max(quarter)).first()
    for q in range(first or 0, (last or 0) + 1):
        store.add(rows.where(quarter == q), f"quarter-{q}")
    return store.rows()


def _applied(spark: SparkSession, d: str) -> DataFrame:
    t = ChangeTable(spark, work_dir(spark, "p3"))
    t.apply(table(spark, d, "item_changes"))
    return t.current()


def p3_incremental(spark: SparkSession, d: str) -> DataFrame:
    """The same changes in five runs that share messages out by batch, so copies and late rows come in any order; the last run repeats the first."""
    t, rows = ChangeTable(spark, work_dir(spark, "p3")), table(spark, d, "item_changes")
    run = F.pmod(F.xxhash64("batch_id", F.lit("run")), F.lit(4))
    for n in (2, 0, 3, 1, 2):
        t.apply(rows.where(run == n))
    return t.current().select("id", "name", "description", "price", "on_offer", "processing_time")


def p3_touched(spark: SparkSession, d: str) -> DataFrame:
    """What a change of one item rewrites: buckets touched, whether all others carry their folders over, and the item's new price."""
    t, rows = ChangeTable(spark, work_dir(spark, "p3")), table(spark, d, "item_changes")
    before = t.apply(rows)["parts"]
    one = rows.where("id IS NOT NULL AND processing_time IS NOT NULL").orderBy(F.col("id").desc(), F.col("processing_time").desc(), *messages.MESSAGE_KEY).limit(1)
    change = one.withColumns({"topic": F.lit("after"), "processing_time": F.expr("processing_time + INTERVAL 1 DAY"), "price": F.lit(-1), "operation": F.lit("u")})
    m = t.apply(change)
    rewritten = {k.partition("/")[2] for k in before.keys() | m["parts"].keys() if before.get(k) != m["parts"].get(k)}
    return t.current().where("topic = 'after'").select("id", "price", F.lit(m["properties"]["touched"]).cast("bigint").alias("touched"), F.lit(len(rewritten)).cast("bigint").alias("rewritten"))


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    return _applied(spark, d).select("id", "topic", "partition", "offset")


def p3_current_items(spark: SparkSession, d: str) -> DataFrame:
    return _applied(spark, d).select("id", "name", "description", "price", "on_offer", "processing_time")


def _differences(spark: SparkSession, d: str) -> DataFrame:
    target = compare.latest(table(spark, d, "items"), "id", "processing_time")
    target = target.where(~F.coalesce(F.col("operation") == "d", F.lit(False)))
    return compare.differences(spark, table(spark, d, "items_source"), target, "id", ("name", "description", "price", "on_offer"), "missing_in_items_source", "missing_in_items", work_dir(spark, "p4"))


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    return _differences(spark, d).select("id", "field")


def p4_values(spark: SparkSession, d: str) -> DataFrame:
    return _differences(spark, d)


def _compacted(spark: SparkSession, d: str) -> Compactor:
    out = Compactor(spark, work_dir(spark, "p5"))
    out.compact(table(spark, d, "item_changes"), table(spark, d, "data_files"), table(spark, d, "processed_batches"))
    return out


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    return _compacted(spark, d).replaced().select("file_path")


def p5_rows(spark: SparkSession, d: str) -> DataFrame:
    return _compacted(spark, d).rows()


def p5_table(spark: SparkSession, d: str) -> DataFrame:
    """Every row of a recorded run, those of groups that are not worth a rewrite included."""
    return _compacted(spark, d).consolidated(table(spark, d, "item_changes"), table(spark, d, "processed_batches"))


def _ledger(spark: SparkSession, d: str) -> history.HistoryTable:
    """Readings made on time found the ledger; the late ones are a second load."""
    t, readings = history.HistoryTable(spark, work_dir(spark, "p6")), table(spark, d, "item_snapshots")
    grid = history.slots(readings)
    on_time, late = history.on_time_and_late(readings, grid)
    t.load(on_time, "on time", grid)
    t.load(late, "late", grid)
    return t


def _versions(spark: SparkSession, d: str) -> DataFrame:
    t = _ledger(spark, d)
    return history.versions(history.as_of(t.ledger()), t.grid())


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    text = lambda x: F.date_format(x, "yyyy-MM-dd HH:mm:ss")
    return _versions(spark, d).select("id", text("valid_from").alias("valid_from"), F.coalesce(text("valid_to"), F.lit("open")).alias("valid_to"))


def p6_versions(spark: SparkSession, d: str) -> DataFrame:
    return _versions(spark, d).select("id", "values.price", "values.on_offer", "valid_from", "valid_to")


def p6_ledger(spark: SparkSession, d: str) -> DataFrame:
    """Everything the ledger ever held, with the times from and up to which it did."""
    t = _ledger(spark, d)
    return _by_slot(t.ledger(), t.grid(), "recorded_from", "recorded_to")


def _by_slot(ledger: DataFrame, grid: DataFrame, *more: str) -> DataFrame:
    rows = ledger.join(grid.select(F.col("slot").alias("slot_from"), "slot_at", "slot_end"), "slot_from")
    return rows.select("id", "values.price", "values.on_offer", F.col("slot_at").alias("valid_from"), F.col("slot_end").alias("valid_to"), *more)


def p6_as_of(spark: SparkSession, d: str) -> DataFrame:
    """What was held at four recorded times, from a ledger that was loaded in four turns by recorded time."""
    t, readings = history.HistoryTable(spark, work_dir(spark, "p6")), table(spark, d, "item_snapshots")
    grid = history.slots(readings)
    times = [r[0] for r in grid.where("slot % 6 = 0").orderBy("slot").select(F.col("slot_at").cast("string")).limit(4).collect()]
    recorded = F.coalesce("loaded_time", F.lit("1900-01-01").cast("timestamp"))
    since = F.lit("0001-01-01").cast("timestamp")
    for n, x in enumerate([*times, "9999-01-01"]):
        until = F.lit(x).cast("timestamp")
        t.load(readings.where((recorded > since) & (recorded <= until)), f"load-{n}", grid)
        since = until
    ledger, out = t.ledger(), None
    for x in times:
        held = _by_slot(history.as_of(ledger, x), t.grid()).withColumn("as_of", F.lit(x))
        out = held if out is None else out.unionByName(held)
    return out if out is not None else _by_slot(ledger, t.grid()).withColumn("as_of", F.lit("")).limit(0)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (p1_found, p1_runs, p2_found, p2_messages, p2_store, p3_found, p3_current_items, p3_incremental, p3_touched, p4_found, p4_values, p5_found, p5_rows, p5_table, p6_found, p6_versions, p6_ledger, p6_as_of)
}

ORACLES: dict[str, str] = {
    "p1_found": """
        WITH pos AS (
          SELECT topic, "partition", max("offset") AS position FROM kafka_offsets
          WHERE batch_id IN (SELECT batch_id FROM processed_batches WHERE batch_id IS NOT NULL) GROUP BY topic, "partition")
        SELECT DISTINCT l.topic, l."partition", l."offset" FROM topic_log l LEFT JOIN pos p ON l.topic = p.topic AND l."partition" = p."partition"
        WHERE p.position IS NULL OR p.position < 0 OR l."offset" > p.position""",
    "p1_runs": """
        WITH pos AS (
          SELECT topic, "partition", max("offset") AS position FROM kafka_offsets
          WHERE batch_id IN (SELECT batch_id FROM processed_batches WHERE batch_id IS NOT NULL) GROUP BY topic, "partition"),
        g AS (SELECT max("offset") AS last FROM topic_log)
        SELECT DISTINCT l.topic, l."partition", l."offset", CASE WHEN l."offset" <= last // 3 THEN 1 WHEN l."offset" <= last * 2 // 3 THEN 2 ELSE 3 END AS run
        FROM topic_log l CROSS JOIN g LEFT JOIN pos p ON l.topic = p.topic AND l."partition" = p."partition"
        WHERE p.position IS NULL OR p.position < 0 OR l."offset" > p.position""",
    "p2_store": """
        SELECT topic, "partition", "offset", id, name, description, price, on_offer, operation, processing_time, year, month, batch_id FROM (
          SELECT *, row_number() OVER (PARTITION BY topic, "partition", "offset" ORDER BY (CAST(year AS INT) * 12 + CAST(month AS INT) - 1) // 3, processing_time NULLS LAST, id NULLS LAST, name NULLS LAST,
            description NULLS LAST, price NULLS LAST, on_offer NULLS LAST, operation NULLS LAST, year NULLS LAST, month NULLS LAST, batch_id NULLS LAST) AS rn
          FROM item_changes) WHERE rn = 1""",
    "p3_touched": """SELECT max(id) AS id, -1 AS price, CAST(1 AS BIGINT) AS touched, CAST(1 AS BIGINT) AS rewritten FROM item_changes WHERE processing_time IS NOT NULL""",
    "p6_as_of": """
        WITH grid AS (SELECT row_number() OVER (ORDER BY t) AS slot, t, lead(t) OVER (ORDER BY t) AS e FROM (SELECT DISTINCT processing_time AS t FROM item_snapshots WHERE processing_time IS NOT NULL)),
        x AS (SELECT t AS until FROM grid WHERE slot % 6 = 0 ORDER BY slot LIMIT 4),
        r AS (SELECT s.*, x.until, row_number() OVER (PARTITION BY x.until, id, processing_time ORDER BY coalesce(loaded_time, TIMESTAMP '1900-01-01') DESC, price DESC NULLS LAST, on_offer DESC NULLS LAST) AS rn
          FROM item_snapshots s JOIN x ON coalesce(loaded_time, TIMESTAMP '1900-01-01') <= x.until WHERE id IS NOT NULL AND processing_time IS NOT NULL)
        SELECT id, price, on_offer, processing_time AS valid_from, e AS valid_to, strftime(until, '%Y-%m-%d %H:%M:%S') AS as_of FROM r JOIN grid ON r.processing_time = grid.t WHERE rn = 1""",
    "p2_found": """SELECT topic, "partition", "offset" FROM item_changes GROUP BY topic, "partition", "offset" HAVING count(*) >= 2""",
    "p2_messages": """
        SELECT topic, "partition", "offset", id, name, description, price, on_offer, operation, processing_time, year, month, batch_id FROM (
          SELECT *, row_number() OVER (PARTITION BY topic, "partition", "offset" ORDER BY processing_time NULLS LAST, id NULLS LAST, name NULLS LAST,
            description NULLS LAST, price NULLS LAST, on_offer NULLS LAST, operation NULLS LAST, year NULLS LAST, month NULLS LAST, batch_id NULLS LAST) AS rn
          FROM item_changes) WHERE rn = 1""",
    "p3_found": """
        WITH m AS (SELECT topic, "partition", "offset", id, min(processing_time) AS t, max(CASE WHEN lower(trim(operation)) = 'd' THEN 1 ELSE 0 END) AS gone
          FROM item_changes WHERE id IS NOT NULL AND processing_time IS NOT NULL GROUP BY ALL),
        r AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY t DESC, "offset" DESC, topic DESC, "partition" DESC) AS rn FROM m)
        SELECT id, topic, "partition", "offset" FROM r WHERE rn = 1 AND gone = 0""",
}

_P4 = """
    t AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY processing_time DESC NULLS LAST) AS rn FROM items WHERE id IS NOT NULL) WHERE rn = 1 AND (operation IS NULL OR operation <> 'd')),
    s AS (SELECT * FROM items_source WHERE id IS NOT NULL),
    f AS (
      SELECT s.id, 'missing_in_items' AS field, NULL AS value_a, NULL AS value_b FROM s LEFT JOIN t ON s.id = t.id WHERE t.id IS NULL
      UNION ALL SELECT t.id, 'missing_in_items_source', NULL, NULL FROM t LEFT JOIN s ON s.id = t.id WHERE s.id IS NULL
      UNION ALL SELECT s.id, 'name', s.name, t.name FROM s JOIN t ON s.id = t.id WHERE s.name IS DISTINCT FROM t.name
      UNION ALL SELECT s.id, 'description', s.description, t.description FROM s JOIN t ON s.id = t.id WHERE s.description IS DISTINCT FROM t.description
      UNION ALL SELECT s.id, 'price', CAST(s.price AS VARCHAR), CAST(t.price AS VARCHAR) FROM s JOIN t ON s.id = t.id WHERE s.price IS DISTINCT FROM t.price
      UNION ALL SELECT s.id, 'on_offer', CAST(s.on_offer AS VARCHAR), CAST(t.on_offer AS VARCHAR) FROM s JOIN t ON s.id = t.id WHERE s.on_offer IS DISTINCT FROM t.on_offer)"""

_P5 = """
    small AS (SELECT DISTINCT file_path, year, month FROM data_files WHERE removed_time IS NULL AND file_size_in_bytes < 16777216 AND batch_id IN (SELECT batch_id FROM processed_batches WHERE batch_id IS NOT NULL)),
    chosen AS (SELECT file_path, year, month FROM small WHERE (year, month) IN (SELECT (year, month) FROM small GROUP BY year, month HAVING count(*) >= 5))"""

_P6 = """
    grid AS (SELECT row_number() OVER (ORDER BY t) AS slot, t, lead(t) OVER (ORDER BY t) AS e FROM (SELECT DISTINCT processing_time AS t FROM item_snapshots WHERE processing_time IS NOT NULL)),
    r AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY id, processing_time ORDER BY loaded_time DESC NULLS LAST, price DESC NULLS LAST, on_offer DESC NULLS LAST) AS rn FROM item_snapshots WHERE id IS NOT NULL) WHERE rn = 1),
    m AS (SELECT id, price, on_offer, slot, t, e, lag(slot) OVER w AS ps, lag(price) OVER w AS pp, lag(on_offer) OVER w AS po FROM r JOIN grid ON r.processing_time = grid.t WINDOW w AS (PARTITION BY id ORDER BY slot)),
    k AS (SELECT *, sum(CASE WHEN ps = slot - 1 AND pp IS NOT DISTINCT FROM price AND po IS NOT DISTINCT FROM on_offer THEN 0 ELSE 1 END) OVER (PARTITION BY id ORDER BY slot) AS run FROM m),
    v AS (SELECT id, run, min(t) AS valid_from, max(slot) AS s2 FROM k GROUP BY id, run)"""

ORACLES |= {
    "p3_current_items": """
        WITH m AS (SELECT topic, "partition", "offset", id, min(processing_time) AS t FROM item_changes WHERE id IS NOT NULL AND processing_time IS NOT NULL GROUP BY ALL),
        r AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY t DESC, "offset" DESC, topic DESC, "partition" DESC) AS rn FROM m),
        p AS (SELECT i.id, i.name, i.description, i.price, i.on_offer, i.operation, i.processing_time, row_number() OVER (PARTITION BY i.id ORDER BY i.name NULLS LAST, i.description NULLS LAST, i.price NULLS LAST, i.on_offer NULLS LAST, i.operation NULLS LAST, i.year, i.month, i.batch_id NULLS LAST) AS k
          FROM item_changes i JOIN r ON r.rn = 1 AND i.id = r.id AND i.topic = r.topic AND i."partition" = r."partition" AND i."offset" = r."offset" AND i.processing_time = r.t)
        SELECT id, name, description, price, on_offer, processing_time FROM p WHERE k = 1 AND coalesce(lower(trim(operation)), '') <> 'd'""",
    "p4_found": f"WITH {_P4} SELECT id, field FROM f",
    "p4_values": f"WITH {_P4} SELECT id, field, value_a, value_b FROM f",
    "p5_found": f"WITH {_P5} SELECT file_path FROM chosen",
    "p5_rows": f"""WITH {_P5} SELECT topic, "partition", "offset", id, name, description, price, on_offer, operation, processing_time, year, month, batch_id FROM item_changes
        WHERE (year, month) IN (SELECT (year, month) FROM chosen) AND batch_id IN (SELECT batch_id FROM processed_batches WHERE batch_id IS NOT NULL)""",
    "p5_table": """SELECT topic, "partition", "offset", id, name, description, price, on_offer, operation, processing_time, year, month, batch_id FROM item_changes
        WHERE batch_id IN (SELECT batch_id FROM processed_batches WHERE batch_id IS NOT NULL)""",
    "p6_found": f"""WITH {_P6} SELECT id, strftime(valid_from, '%Y-%m-%d %H:%M:%S') AS valid_from, coalesce(strftime(e, '%Y-%m-%d %H:%M:%S'), 'open') AS valid_to FROM v JOIN grid ON grid.slot = v.s2""",
    "p6_versions": f"""WITH {_P6} SELECT v.id, k.price, k.on_offer, valid_from, grid.e AS valid_to FROM v JOIN grid ON grid.slot = v.s2 JOIN k ON k.id = v.id AND k.t = v.valid_from""",
    "p6_ledger": """
        WITH grid AS (SELECT t, lead(t) OVER (ORDER BY t) AS e FROM (SELECT DISTINCT processing_time AS t FROM item_snapshots WHERE processing_time IS NOT NULL)),
        r AS (SELECT *, row_number() OVER (PARTITION BY id, processing_time, coalesce(loaded_time, TIMESTAMP '1900-01-01') ORDER BY price DESC NULLS LAST, on_offer DESC NULLS LAST) AS rn FROM item_snapshots WHERE id IS NOT NULL AND processing_time IS NOT NULL),
        a AS (SELECT id, price, on_offer, processing_time AS t, coalesce(loaded_time, TIMESTAMP '1900-01-01') AS rec FROM r WHERE rn = 1),
        b AS (SELECT *, row_number() OVER w AS k, lag(price) OVER w AS pp, lag(on_offer) OVER w AS po FROM a WINDOW w AS (PARTITION BY id, t ORDER BY rec)),
        n AS (SELECT * FROM b WHERE k = 1 OR pp IS DISTINCT FROM price OR po IS DISTINCT FROM on_offer)
        SELECT id, price, on_offer, n.t AS valid_from, e AS valid_to, rec AS recorded_from, lead(rec) OVER (PARTITION BY id, n.t ORDER BY rec) AS recorded_to FROM n JOIN grid ON n.t = grid.t""",
}
ORACLES["p3_incremental"] = ORACLES["p3_current_items"]
