"""Decoding of change messages: JSON envelopes to typed item rows, with a reason for every message refused.

All rules are column expressions, so decoding runs inside the scan's stage. A message is refused, never dropped
unseen: `null` (a tombstone), `blank`, `empty` (that literal), `bad_json`, `no_payload` (missing, null, or a value
that counts as nothing, or JSON that is no object), `bad_payload` (a payload that is no object), `bad_type` (an id
or price that is no 32-bit integer, an on_offer that is no boolean).

Nulls and the like: bytes that are no UTF-8 are replaced before parsing; an absent `on_offer` is false, a JSON null
stays null; other absent fields are null, unknown ones are dropped; a name or description of another JSON type is
kept as its JSON text; `__deleted` of any type counts by its text in lower case; texts of any length are parsed
whole; equal messages stay as they are; extra columns of the log are carried (names that start with `decode_`, `reason`
and `item` are reserved).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.columns import c

#: What counts as space at the ends of a value.
SPACE = " \t\r\n\f\x0b"
#: Payloads that count as nothing.
FALSY = ("null", "{}", "[]", '""', "0", "0.0", "false", "-0", "-0.0")


def _stage(df: DataFrame, **columns: Column) -> DataFrame:
    """Columns computed once, whatever is built on them.

    A later filter would otherwise be pushed below a projection with all its expressions spelled out, and parsing
    would run again for each of their uses. A generator of one row stops that and stays in generated code.
    """
    return df.select("*", F.inline(F.array(F.struct(*(x.alias(n) for n, x in columns.items())))))


def _integer(value: Column, text: Column) -> Column:
    return F.when(text.rlike(r"^-?\d{1,11}$"), text.try_cast("int"))


def _string(value: Column, text: Column) -> Column:
    return F.when(text == "null", F.lit(None).cast("string")).when(text.startswith('"'), F.try_variant_get(value, "$", "string")).otherwise(text)


def _bad(text: Column, typed: Column) -> Column:
    return text.isNotNull() & (text != "null") & typed.isNull()


def classify(deleted: Column, key: Column) -> Column:
    """d, c or u: a delete by its flag; a row without id is a creation; all others are updates."""
    return F.when(F.lower(F.coalesce(deleted.cast("string"), F.lit("false"))) == "true", "d").when(key.isNull(), "c").otherwise("u")


def with_partitions(df: DataFrame, time: str = "processing_time") -> DataFrame:
    """year and month, as zero-padded text, of a time column."""
    return df.withColumns({"year": F.date_format(c(time), "yyyy"), "month": F.date_format(c(time), "MM")})


def parse(log: DataFrame, value: str = "value") -> DataFrame:
    """The log with `reason` (null if the message is good) and the decoded fields in the struct `item`."""
    if any(x.lower().startswith("decode_") or x.lower() in ("reason", "item") for x in log.columns):
        raise ValueError("reason, item and column names that start with decode_ are reserved")
    raw = c(value).cast("string")
    text = F.make_valid_utf8(raw) if log.schema[value].dataType.typeName() == "binary" else raw
    col = lambda n: F.col(f"decode_{n}")
    get = lambda v, n: F.try_variant_get(v, f"$.{n}", "variant")
    names = ("id", "name", "description", "price", "on_offer", "__deleted")
    df = _stage(log, decode_text=F.trim(text, F.lit(SPACE)))
    df = _stage(df, decode_json=F.try_parse_json(col("text")))
    df = _stage(df, decode_payload=get(col("json"), "payload"))
    df = _stage(df, decode_payload_text=F.to_json(col("payload")), **{f"decode_{n}": get(col("payload"), n) for n in names})
    df = _stage(df, **{f"decode_{n}_text": F.to_json(col(n)) for n in names})
    string = lambda n: _string(col(n), col(f"{n}_text"))
    key, price = _integer(col("id"), col("id_text")), _integer(col("price"), col("price_text"))
    offer = F.when(col("on_offer_text") == "true", True).when(col("on_offer_text") == "false", False)
    bad_type = _bad(col("id_text"), key) | _bad(col("price_text"), price) | _bad(col("on_offer_text"), offer)
    reason = (
        F.when(c(value).isNull(), "null")
        .when(col("text") == "", "blank")
        .when(col("text") == "empty", "empty")
        .when(col("json").isNull(), "bad_json")
        .when(col("payload_text").isNull() | col("payload_text").isin(*FALSY), "no_payload")
        .when(~col("payload_text").startswith("{"), "bad_payload")
        .when(bad_type, "bad_type")
    )
    item = F.struct(
        key.alias("id"),
        string("name").alias("name"),
        string("description").alias("description"),
        price.alias("price"),
        F.when(col("on_offer_text").isNull(), F.lit(False)).otherwise(offer).alias("on_offer"),
        classify(F.coalesce(string("__deleted"), F.lit("false")), key).alias("operation"),
    )
    df = _stage(df, reason=reason, item=item).drop(*(x for x in df.columns if x.startswith("decode_")))
    return df.withColumn("item", F.when(F.col("reason").isNull(), F.col("item")))


def decode(log: DataFrame, value: str = "value", time: Column | None = None, batch_id: str | None = None, keep: Sequence[str] = ("topic", "partition", "offset")) -> tuple[DataFrame, DataFrame]:
    """(item rows with their place in the log, refused messages with their reason)."""
    parsed = parse(log, value)
    good = parsed.where("reason IS NULL").select(*(c(k) for k in keep if k in log.columns), "item.*", (F.current_timestamp() if time is None else time).alias("processing_time"))
    good = with_partitions(good).withColumn("batch_id", F.lit(batch_id).cast("string"))
    return good, parsed.where("reason IS NOT NULL").drop("item")


def reasons(log: DataFrame, value: str = "value") -> DataFrame:
    """reason, n: how many messages are refused for each reason, and how many are good (`ok`)."""
    return parse(log, value).groupBy(F.coalesce("reason", F.lit("ok")).alias("reason")).agg(F.count("*").alias("n"))
