"""Records as brokers and queues wrap them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from zonewise.functions.once import once
from zonewise.schemas import BREACH, CHANGE_RECORD, DELIVERY


def _decoded(df: DataFrame, text: str, schema: StructType, name: str) -> DataFrame:
    """Adds the parsed record and ``decode_error`` (null when the text is a JSON object)."""
    object_text = F.ltrim(F.col(text), F.lit(" \t\n\r")).startswith("{") & F.try_parse_json(F.col(text)).isNotNull()
    usable = F.coalesce(object_text, F.lit(False))
    read = df.withColumn("__ok", usable).withColumn(name, once(F.when(F.col("__ok"), F.from_json(text, schema))))
    return read.withColumn("decode_error", F.when(~F.col("__ok"), F.lit("undecodable record"))).drop("__ok")


def decode_stream_records(records: DataFrame, data: str = "data") -> DataFrame:
    """Base64 JSON of a breach; adds ``breach`` and ``decode_error``."""
    text = F.decode(F.try_to_binary(F.col(data), F.lit("base64")), "UTF-8")
    return _decoded(records.withColumn("__text", text), "__text", BREACH, "breach").drop("__text")


def decode_queue_records(messages: DataFrame, body: str = "body") -> DataFrame:
    """JSON body of a delivery message; adds ``alert`` and ``decode_error``."""
    return _decoded(messages, body, DELIVERY, "alert")


def encode_stream_records(breaches: DataFrame, *keep: str) -> DataFrame:
    """Breach events as base64 JSON in ``data``."""
    event = F.struct(*[F.col(f.name) for f in BREACH])
    return breaches.select(*keep, F.base64(F.to_json(event).cast("binary")).alias("data"))


def decode_change_records(lines: DataFrame, raw: str = "raw") -> DataFrame:
    """JSON lines of zone change records as ``schemas.CHANGE_RECORD`` columns."""
    return lines.select(once(F.from_json(raw, CHANGE_RECORD)).alias("r")).select("r.*")
