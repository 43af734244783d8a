"""Message topics. The connector is a separate Spark package; the options are built here."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from ..functions.scalar import decode_bytes, strip_wire_header


def topic_options(servers: str, topic: str, start: str | dict[int, int] = "earliest", end: str | dict[int, int] | None = None,
                  max_per_trigger: int | None = None, extra: dict[str, str] | None = None) -> dict[str, str]:
    """Reader options. ``start`` / ``end``: earliest, latest, or an offset per partition."""
    place = lambda x: x if isinstance(x, str) else json.dumps({topic: {str(p): o for p, o in sorted(x.items())}})
    o = {"kafka.bootstrap.servers": servers, "subscribe": topic, "startingOffsets": place(start), "includeHeaders": "true"}
    if end is not None:
        o["endingOffsets"] = place(end)
    if max_per_trigger:
        o["maxOffsetsPerTrigger"] = str(max_per_trigger)
    return {**o, **(extra or {})}


def read_topic(spark: SparkSession, options: dict[str, str], stream: bool = True) -> DataFrame:
    r = spark.readStream if stream and "endingOffsets" not in options else spark.read
    return r.format("kafka").options(**options).load()


def parse_values(df: DataFrame, schema: T.StructType | str, framed: bool = False, value: str = "value",
                 keep_meta: bool = True) -> DataFrame:
    """Typed columns from a binary JSON value; ``framed`` values carry a registry header first."""
    body = decode_bytes(strip_wire_header(value) if framed else value)
    meta = [c for c in ("key", "topic", "partition", "offset", "timestamp", "headers") if c in df.columns] if keep_meta else []
    return df.select(*meta, F.from_json(body, schema).alias("__v")).select(*meta, "__v.*")
