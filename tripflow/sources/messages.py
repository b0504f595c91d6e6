"""Message streams: topics, captured topics and text files."""

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripflow.schemas import MESSAGE


def kafka_options(broker, group, user=None, password=None):
    """Options of the Kafka source; without user and password the connection is plain."""
    options = {
        "kafka.bootstrap.servers": broker,
        "kafka.group.id": group,
        "startingOffsets": "earliest",
    }
    if user is not None or password is not None:
        login = "org.apache.kafka.common.security.plain.PlainLoginModule"
        options |= {
            "kafka.security.protocol": "SASL_PLAINTEXT",
            "kafka.sasl.mechanism": "PLAIN",
            "kafka.sasl.jaas.config":
                f'{login} required username="{user}" password="{password}";',
        }
    return options


def read_messages(spark, src, fmt="text", opts=None, streaming=True):
    """Messages as ``schemas.MESSAGE``: value, topic, arrival time and arrival number.

    ``kafka``: ``src`` is a topic. ``text``: a folder ``<topic>/*`` of files with one
    message per line; the file time is the arrival time, and ``seq`` is NULL. ``parquet``:
    a captured topic in the message schema. Rows without a value are dropped.
    """
    reader = (spark.readStream if streaming else spark.read).options(**(opts or {}))
    if fmt == "kafka":
        rows = reader.format("kafka").option("subscribe", src).load().select(
            F.col("value").cast("string").alias("value"),
            "topic",
            F.col("timestamp").alias("ingest_ts"),
            # Unique over the partitions of a topic, and in order within each.
            F.shiftleft("offset", 16).bitwiseOR(F.col("partition")).alias("seq"),
        )
    elif fmt == "text":
        rows = reader.option("recursiveFileLookup", True).text(src).select(
            "value",
            F.element_at(F.split("_metadata.file_path", "/"), -2).alias("topic"),
            F.col("_metadata.file_modification_time").alias("ingest_ts"),
            F.lit(None).cast("bigint").alias("seq"),
        )
    else:
        rows = reader.schema(MESSAGE).parquet(src)
    return rows.filter("value IS NOT NULL")


def to_messages(df, ts_cols=(), zone_z="yyyy-MM-dd'T'HH:mm:ss'Z'"):
    """Each row as one JSON text ``value``: times as ISO with ``Z``, NULL kept, NaN bare."""
    floating = [
        f.name for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))
    ]
    typed = df.withColumns({c: F.date_format(f"`{c}`", zone_z) for c in ts_cols})
    value = F.to_json(
        F.struct(*[F.col(f"`{c}`") for c in typed.columns]), {"ignoreNullFields": "false"}
    )
    for name in floating:
        # Spark quotes NaN; the feeds carry it bare.
        value = F.replace(value, F.lit(f'"{name}":"NaN"'), F.lit(f'"{name}":NaN'))
    return typed.select(value.alias("value"))
