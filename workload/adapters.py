"""The given tables seen as the lakehouse's own inputs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.numbers import clamp_score
from tidemark.functions.times import latest_time
from tidemark.plans.once import compute_once

# The event types of the given table, in alphabetical order.
EVENT_TYPES = ["click", "error", "purchase", "signup", "view"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def as_of(spark: SparkSession, sf_dir: str) -> str:
    """Newest event time: the moment all replays are run at."""
    return latest_time(spark.read.parquet(f"{sf_dir}/events.parquet"), "ts")


def k_of(props: str = "props") -> Column:
    return F.get_json_object(props, "$.k").try_cast("int")


def _json_text(text: Column) -> Column:
    return F.concat(F.lit('"'), text, F.lit('"'))


def _payload(k: Column) -> Column:
    """Raw JSON of a message, with the irregularities real feeds show.

    Price is a JSON string for k % 7 = 0; the headline is absent for k % 4 = 0
    and an explicit null for other even k; the symbol is null for k = 13.
    """
    value = F.col("value")
    price = value.cast("string")
    fields = [
        F.concat(
            F.lit('"symbol": '),
            F.when(k == 13, "null").otherwise(_json_text(F.col("event_type"))),
        ),
        F.concat(
            F.lit('"price_usd": '),
            F.when(k % 7 == 0, _json_text(price)).otherwise(price),
        ),
        F.concat(F.lit('"volume_24h": '), (value * k).cast("string")),
        F.concat(F.lit('"market_cap": '), (value * 1000).cast("string")),
        F.concat(F.lit('"percent_change_24h": '), ((k - 50) / 10.0).cast("string")),
        F.when(
            k % 4 != 0,
            F.concat(
                F.lit('"news_headline": '),
                F.when(k % 2 == 0, "null").otherwise(_json_text(headline_of(k))),
            ),
        ),
    ]
    return F.concat(F.lit("{"), F.concat_ws(", ", *fields), F.lit("}"))


def headline_of(k: Column) -> Column:
    return F.when(k % 2 != 0, F.concat("event_type", F.lit(" moved")))


def score_of(k: Column) -> Column:
    return F.when(k % 10 != 0, clamp_score(5 + (k - 50) / 10.0))


def bronze(events: DataFrame) -> DataFrame:
    """Every event as a bronze row."""
    k = F.col("_k")
    return compute_once(events, {"_k": k_of()}).select(
        F.concat(F.lit("evt-"), "event_id").alias("id"),
        _payload(k).alias("raw_payload"),
        F.concat(F.lit("src"), F.col("user_id") % 20).alias("source"),
        F.col("ts").alias("ingested_at"),
        score_of(k).alias("sentiment_score"),
        F.concat(F.lit("k="), k).alias("sentiment_reasoning"),
        F.lit('{"function_version": "2.0.0"}').alias("processing_metadata"),
    )


def staged_columns(events: DataFrame) -> DataFrame:
    """Message fields straight from the events, without the JSON round trip."""
    k = F.col("_k")
    return compute_once(events, {"_k": k_of()}).select(
        F.concat(F.lit("evt-"), "event_id").alias("id"),
        F.when(k != 13, F.col("event_type")).alias("symbol"),
        F.col("value").alias("price_usd"),
        (F.col("value") * k).alias("volume_24h"),
        (F.col("value") * 1000).alias("market_cap"),
        ((k - 50) / 10.0).alias("percent_change_24h"),
        headline_of(k).alias("news_headline"),
        F.concat(F.lit("src"), F.col("user_id") % 20).alias("source"),
        F.col("ts").alias("ingested_at"),
        score_of(k).alias("sentiment_score"),
        F.concat(F.lit("k="), k).alias("sentiment_reasoning"),
        k.alias("k"),
        "event_type",
        "user_id",
        "event_id",
    )


def envelopes(events: DataFrame) -> DataFrame:
    """Every event as a pushed message; some are broken, by the value of k.

    k = 1 carries no data, 2 no base64, 3 unfinished JSON, 4 a JSON list; 5 has
    no id and a payload that names its own source.
    """
    k = F.col("_k")

    def encoded(text: Column) -> Column:
        return F.base64(F.encode(text, "UTF-8"))

    opening = F.concat(F.lit('{"symbol": "'), "event_type", F.lit('"'))
    data = (
        F.when(k == 1, "")
        .when(k == 2, "@@@")
        .when(k == 3, encoded(opening))
        .when(k == 4, encoded(F.lit("[1]")))
        .when(k == 5, encoded(F.concat(opening, F.lit(', "source": "feed"}'))))
        .otherwise(encoded(_payload(k)))
    )
    named = F.create_map(F.lit("source"), F.concat(F.lit("src"), F.col("user_id") % 20))
    return compute_once(
        compute_once(events, {"_k": k_of()}), {"data": data}
    ).select(
        F.when(k != 5, F.concat(F.lit("evt-"), "event_id")).alias("id"),
        "data",
        F.when(k % 3 == 0, named).alias("attributes"),
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss").alias("publish_time"),
    )


def topic_records(events: DataFrame) -> DataFrame:
    """Every event as a broker record whose JSON value has gaps, by the value of k.

    The id is absent for k = 13, the value is no UTF-8 for 17 and no object for
    19; price is absent for k % 5 = 0 and null for 1; source is absent for odd k
    and the timestamp for k % 3 = 0.
    """
    k = F.col("_k")
    fields = [
        F.when(k != 13, F.concat(F.lit('"id": "evt-'), "event_id", F.lit('"'))),
        F.concat(F.lit('"symbol": "'), "event_type", F.lit('"')),
        F.when(
            k % 5 != 0,
            F.concat(
                F.lit('"price_usd": '),
                F.when(k % 5 == 1, "null").otherwise(F.col("value").cast("string")),
            ),
        ),
        F.concat(F.lit('"volume_24h": '), k.cast("string")),
        F.when(k % 2 == 0, F.concat(F.lit('"source": "src'), k, F.lit('"'))),
        F.when(k % 3 != 0, F.lit('"timestamp": "2024-01-01T00:00:00"')),
    ]
    text = F.concat(F.lit("{"), F.concat_ws(", ", *fields), F.lit("}"))
    value = (
        F.when(k == 17, F.unhex(F.lit("FFFE41")))
        .when(k == 19, F.encode(F.lit("[]"), "UTF-8"))
        .otherwise(F.encode(text, "UTF-8"))
    )
    return compute_once(events, {"_k": k_of()}).select(
        F.encode("event_type", "UTF-8").alias("key"),
        value.alias("value"),
        F.lit("market-data").alias("topic"),
        F.lit(0).alias("partition"),
        F.col("event_id").alias("offset"),
        F.col("ts").cast("timestamp").alias("timestamp"),
    )


def replies(events: DataFrame) -> DataFrame:
    """A model reply per event, usable or not by the last digit of k."""
    k = F.col("_k")
    digit = k % 10
    reply = (
        F.when(digit == 0, F.lit(None))
        .when(digit == 1, "")
        .when(digit == 2, "not json")
        .when(digit == 3, "[1, 2]")
        .when(digit == 4, '{"score": "7", "reasoning": "text"}')
        .when(digit == 5, '{"reasoning": "no score"}')
        .when(digit == 6, '{"score": null}')
        .when(digit == 7, '{"score": {"a": 1}}')
        .when(digit == 8, '{"score": 11.5}')
        .otherwise(
            F.concat(
                F.lit('{"score": '),
                (k / 10.0).cast("string"),
                F.lit(', "reasoning": "k='),
                k,
                F.lit('"}'),
            )
        )
    )
    return compute_once(events, {"_k": k_of()}).select("event_id", reply.alias("reply"))


def vector_records(embeddings: DataFrame) -> DataFrame:
    """Every embedding as a stored vector record; label 0 lacks its metadata."""
    from tidemark.functions.vectors import vector_metadata
    from tidemark.operators.vectors import NAMESPACE

    label = F.col("label")
    metadata = vector_metadata(
        F.concat(F.lit("sym"), label),
        F.lit(None),
        (1 + label).cast("double"),
        F.lit(None),
        label.cast("double") - 5,
        F.concat(F.lit("headline "), label),
        F.lit(None),
        F.lit("2024-01-01T00:00:00"),
    )
    return embeddings.select(
        F.lit(NAMESPACE).alias("namespace"),
        F.col("vec_id").cast("string").alias("id"),
        F.col("embedding").alias("values"),
        F.when(label != 0, metadata).alias("metadata"),
    )


def label_centroids(embeddings: DataFrame) -> DataFrame:
    """Mean vector of every label, as a batch of query vectors."""
    dims = embeddings.select(F.size("embedding")).first()[0]
    mean = F.array(*[F.avg(F.col("embedding")[i].cast("double")) for i in range(dims)])
    return embeddings.groupBy(F.col("label").cast("string").alias("query_id")).agg(
        mean.alias("values")
    )


def client_actions(events: DataFrame) -> DataFrame:
    """Every event as an action of its user on live subscriptions, by event type."""
    k = F.col("_k")
    types = F.array(*[F.lit(t) for t in EVENT_TYPES])

    def pick(index: Column) -> Column:
        return F.element_at(types, (1 + index).cast("int"))

    action = (
        F.when(F.col("event_type") == "purchase", "connect")
        .when(F.col("event_type") == "signup", "unsubscribe")
        .when((F.col("event_type") == "error") & (k < 50), "disconnect")
        .otherwise("subscribe")
    )
    return compute_once(events, {"_k": k_of()}).select(
        F.concat(F.lit("c"), "user_id").alias("client"),
        "ts",
        F.col("event_id").alias("seq"),
        action.alias("action"),
        F.concat(pick(k % 5), F.lit(" , "), pick(F.floor(k / 5) % 5)).alias("symbols"),
    )


def metric_events(events: DataFrame) -> DataFrame:
    """Every event as a metric record; sign-ups carry an unregistered name."""
    k = F.col("_k")
    name = (
        F.when(F.col("event_type") == "click", "request_count")
        .when(F.col("event_type") == "view", "request_latency")
        .when(F.col("event_type") == "purchase", "bigquery_rows")
        .when(F.col("event_type") == "error", "processing_latency")
        .otherwise("unheard_of")
    )
    attributes = F.when(
        k % 3 != 0,
        F.create_map(
            F.lit("zone"), (k % 2).cast("string"), F.lit("app"), F.lit("web")
        ),
    )
    return compute_once(events, {"_k": k_of()}).select(
        "event_id", "ts", name.alias("name"), attributes.alias("attributes"), "value"
    )


def connection_events(events: DataFrame) -> DataFrame:
    """Sign-ups open a connection, errors close one, other events change nothing."""
    change = (
        F.when(F.col("event_type") == "signup", 1)
        .when(F.col("event_type") == "error", -1)
        .otherwise(0)
    )
    return events.select(
        "event_id",
        "ts",
        F.lit("active_connections").alias("name"),
        change.cast("bigint").alias("value"),
    )
