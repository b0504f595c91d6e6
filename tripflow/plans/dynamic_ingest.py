"""First-generation ingest: columns come from the messages themselves."""

from pyspark.sql import functions as F

from tripflow.operators.cleanse import (
    message_columns,
    message_texts,
    snake_name,
    with_message_fields,
)
from tripflow.operators.ingest import ingest_summary
from tripflow.operators.upsert import read_table, upsert
from tripflow.schemas import CHICAGO_MESSAGE_KEY


def ingest_dynamic(messages, table, keys=CHICAGO_MESSAGE_KEY, buckets=16):
    """Store messages (value, consumer, ingest_ts, seq) by key and count per consumer.

    Fields the table lacks become new text columns, the most frequent ones; the others stay in its map
    column. A column of the table stays one. A message that is no object or lacks a
    key field is an insert error. Batch; returns the summary per consumer.
    """
    names = [snake_name(k) for k in keys]
    stored_before = read_table(messages.sparkSession, table, evolving=True)
    known = [*names, *(stored_before.columns if stored_before is not None else [])]
    columns, beyond = message_columns(messages, known=known)
    judged = with_message_fields(messages)
    unusable = F.col("_fields").isNull()
    for key in keys:
        value = F.col("_fields")[key]
        unusable = unusable | value.isNull() | (value == '"NaN"')
    judged = judged.withColumn("disposition", F.when(unusable, "errored").otherwise("ok"))
    stored = judged.filter("disposition = 'ok'").select(
        *message_texts(columns, beyond),
        "ingest_ts",
        "seq",
    )
    upsert(stored, table, names, ["ingest_ts", "seq"], buckets, evolving=True)
    return ingest_summary(judged)
