"""Message envelopes and topics: decoding, typed messages, publishing."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.numbers import safe_double
from tidemark.functions.payload import has_key, is_json_object, scalar_only
from tidemark.functions.times import moment
from tidemark.plans.once import compute_once
from tidemark.sources.schemas import BROKER_RECORD, MARKET_MESSAGE_AVRO

# topics' retention in hours and the source when none is named.
RETENTION_HOURS = {"bronze": 24, "dead_letter": 168}
UNKNOWN_SOURCE = "unknown"

# Causes of a rejected message.
EMPTY = "Empty message data"
UNDECODABLE = "Deserialization failed"
REFUSED = "Handler returned failure"

# Bytes in front of an Avro value written through a schema registry.
_REGISTRY_HEADER = 5


def resolve_source(attributes: Column, payload: Column) -> Column:
    """Source named by the attributes, else by the payload, else unknown."""
    return F.coalesce(
        F.try_element_at(attributes, F.lit("source")),
        F.get_json_object(payload, "$.source"),
        F.lit(UNKNOWN_SOURCE),
    )


def decode_envelope(df: DataFrame) -> DataFrame:
    """Pushed messages to (message_id, payload, source, publish_time, error).

    Data is base64 of UTF-8 JSON and must be an object. A message that is not
    keeps its row with the cause in ``error``. One without an id is named by a
    hash of its content, which stays the same on a replay.
    """
    raw = F.try_to_binary(F.col("data"), F.lit("base64"))
    decoded = compute_once(df, {"_text": F.try_validate_utf8(raw.cast("string"))})
    text = F.col("_text")
    error = F.when(F.col("data").isNull() | (F.col("data") == ""), EMPTY).when(
        ~F.coalesce(is_json_object(text), F.lit(False)), UNDECODABLE
    )
    usable = F.col("error").isNull()
    return compute_once(decoded, {"error": error}).select(
        F.coalesce("id", F.sha2(F.coalesce("data", F.lit("")), 256)).alias("message_id"),
        F.when(usable, text).alias("payload"),
        "data",
        F.when(usable, resolve_source(F.col("attributes"), text)).alias("source"),
        "publish_time",
        "error",
    )


def decode_json(records: DataFrame) -> DataFrame:
    """Topic records with their value as JSON text; null where it is no JSON object.

    The raw value stays, so a rejected record loses nothing.
    """
    text = F.col("_text")
    decoded = compute_once(
        records, {"_text": F.try_validate_utf8(F.col("value").cast("string"))}
    )
    payload = {"payload": F.when(is_json_object(text), text)}
    return compute_once(decoded, payload).drop("_text")


def decode_avro(
    records: DataFrame, schema: str = MARKET_MESSAGE_AVRO, framed: bool = True
) -> DataFrame:
    """Topic records with their Avro value as JSON text; null where undecodable.

    Needs the spark-avro package on the cluster. ``framed`` values carry a
    registry header in front.
    """
    from pyspark.sql.avro.functions import from_avro

    value = F.col("value")
    if framed:
        value = F.substring(value, F.lit(_REGISTRY_HEADER + 1), F.length(value))
    record = from_avro(value, schema, {"mode": "PERMISSIVE"})
    decoded = records.withColumn("_record", record)
    return decoded.withColumn(
        "payload",
        F.when(
            F.col("_record.id").isNotNull(),
            F.to_json("_record", {"ignoreNullFields": "false"}),
        ),
    ).drop("_record")


def read_messages(spark: SparkSession, fmt: str = "kafka", **options: str) -> DataFrame:
    """Stream of topic records, from the start unless told otherwise.

    Progress lives in the query's checkpoint, which plays the part of committed
    offsets. Any other format must deliver the columns of a broker record.
    """
    reader = spark.readStream.format(fmt)
    if fmt == "kafka":
        options = {"startingOffsets": "earliest", **options}
    else:
        reader = reader.schema(BROKER_RECORD)
    path = options.pop("path", None)
    return reader.options(**options).load(path)


def _field(payload: Column, key: str) -> Column:
    return scalar_only(payload, key, F.get_json_object(payload, f"$.{key}"))


def typed_message(df: DataFrame, as_of: str | datetime | Column) -> DataFrame:
    """Payloads as typed market messages; rows lacking id or symbol carry an error.

    A default stands in only where the key is absent; an explicit null stays null.
    """
    payload = F.col("payload")

    def or_absent(key: str, value: Column, default: Column) -> Column:
        return F.when(has_key(payload, key), value).otherwise(default)

    def number(key: str) -> Column:
        return or_absent(key, safe_double(_field(payload, key)), F.lit(0.0)).alias(key)

    now = F.date_format(moment(as_of, "timestamp_ntz"), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    missing = F.concat_ws(
        ", ", *[F.when(~has_key(payload, key), F.lit(key)) for key in ("id", "symbol")]
    )
    return df.select(
        _field(payload, "id").alias("id"),
        _field(payload, "symbol").alias("symbol"),
        number("price_usd"),
        number("volume_24h"),
        number("market_cap"),
        number("percent_change_24h"),
        _field(payload, "news_headline").alias("news_headline"),
        or_absent("source", _field(payload, "source"), F.lit(UNKNOWN_SOURCE)).alias("source"),
        or_absent("timestamp", _field(payload, "timestamp"), now).alias("timestamp"),
        F.when(missing != "", F.concat(F.lit("missing "), missing)).alias("error"),
    )


def message_records(df: DataFrame, key: str | None = None) -> DataFrame:
    """Rows as (key, value) topic records with JSON values; nulls stay in the JSON."""
    value = F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"})
    name = F.col(key).cast("string") if key else F.lit(None).cast("string")
    return df.select(name.alias("key"), value.alias("value"))


def avro_records(
    df: DataFrame, key: str | None = None, schema: str = MARKET_MESSAGE_AVRO
) -> DataFrame:
    """Rows as (key, value) topic records with Avro values; needs spark-avro."""
    from pyspark.sql.avro.functions import to_avro

    name = F.col(key).cast("string") if key else F.lit(None).cast("string")
    return df.select(
        name.alias("key"), to_avro(F.struct(*df.columns), schema).alias("value")
    )


def publish(
    df: DataFrame,
    topic: str,
    key: str | None = None,
    fmt: str = "kafka",
    encode: Callable[[DataFrame, str | None], DataFrame] = message_records,
    **options: str,
) -> None:
    """Write rows to a topic, or in another format to ``path``."""
    records = encode(df, key).withColumn("topic", F.lit(topic))
    path = options.pop("path", None)
    records.write.format(fmt).mode("append").options(**options).save(path)
