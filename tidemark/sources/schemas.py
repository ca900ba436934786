"""Declared schemas of tables, messages and records."""

from __future__ import annotations

from pyspark.sql import types as T


def _struct(*fields: tuple[str, T.DataType, bool]) -> T.StructType:
    return T.StructType([T.StructField(n, t, nullable) for n, t, nullable in fields])


_S, _D, _L, _TS = T.StringType(), T.DoubleType(), T.LongType(), T.TimestampType()

BRONZE = _struct(
    ("id", _S, False),
    ("raw_payload", _S, False),
    ("source", _S, True),
    ("ingested_at", _TS, False),
    ("sentiment_score", _D, True),
    ("sentiment_reasoning", _S, True),
    ("processing_metadata", _S, True),
)

SILVER = _struct(
    ("id", _S, False),
    ("symbol", _S, False),
    ("price_usd", _D, True),
    ("volume_24h", _D, True),
    ("market_cap", _D, True),
    ("percent_change_24h", _D, True),
    ("sentiment_score", _D, True),
    ("sentiment_reasoning", _S, True),
    ("ingested_at", _TS, False),
    ("processed_at", _TS, False),
)

QUALITY_LOG = _struct(
    ("checkpoint_name", _S, True),
    ("status", _S, True),
    ("success_percent", _D, True),
    ("failed_count", _L, True),
    ("failed_expectations", _S, True),
    ("run_time", _TS, True),
    ("table_name", _S, True),
    ("row_count", _L, True),
    ("metadata", _S, True),
)

MARKET_MESSAGE = _struct(
    ("id", _S, False),
    ("symbol", _S, False),
    ("price_usd", _D, False),
    ("volume_24h", _D, False),
    ("market_cap", _D, False),
    ("percent_change_24h", _D, False),
    ("news_headline", _S, True),
    ("source", _S, False),
    ("timestamp", _S, False),
)

DEAD_LETTER = _struct(
    ("original_message", _S, True),
    ("error", _S, True),
    ("timestamp", _S, True),
    ("topic", _S, True),
)

VECTOR_METADATA = _struct(
    ("symbol", _S, True),
    ("source", _S, True),
    ("sentiment_score", _D, True),
    ("sentiment_category", _S, True),
    ("price_usd", _D, True),
    ("percent_change_24h", _D, True),
    ("news_headline", _S, True),
    ("reasoning", _S, True),
    ("timestamp", _S, True),
)

VECTOR_RECORD = _struct(
    ("namespace", _S, False),
    ("id", _S, False),
    ("values", T.ArrayType(T.FloatType()), False),
    ("metadata", VECTOR_METADATA, True),
)

# What a message broker hands over, whichever connector reads it.
BROKER_RECORD = _struct(
    ("key", T.BinaryType(), True),
    ("value", T.BinaryType(), True),
    ("topic", _S, True),
    ("partition", T.IntegerType(), True),
    ("offset", _L, True),
    ("timestamp", _TS, True),
)

# Envelope of a pushed message: data is base64 text.
PUSH_ENVELOPE = _struct(
    ("id", _S, True),
    ("data", _S, True),
    ("attributes", T.MapType(_S, _S), True),
    ("publish_time", _S, True),
)

# Avro schema of a market message on the topic.
MARKET_MESSAGE_AVRO = """
{"type": "record", "name": "MarketData", "fields": [
  {"name": "id", "type": "string"},
  {"name": "symbol", "type": "string"},
  {"name": "price_usd", "type": "double"},
  {"name": "volume_24h", "type": "double"},
  {"name": "market_cap", "type": "double"},
  {"name": "percent_change_24h", "type": "double"},
  {"name": "news_headline", "type": ["null", "string"], "default": null},
  {"name": "source", "type": "string"},
  {"name": "timestamp", "type": "string"}
]}
"""
