"""Tables with a primary key, kept as batches of newest rows."""

import json
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripflow.streaming.files import delete_folders

# What a keyed table is: written once beside its rows, read by every later call.
TERMS = """
    keys ARRAY<STRING>, order_cols ARRAY<STRING>, partition_cols ARRAY<STRING>, buckets INT,
    columns STRING
"""


def latest_per_key(df, keys, order_cols):
    """The newest row of each key.

    ``row_number() = 1`` lets Spark keep one row per key in each task before the shuffle,
    so a key with very many versions sends one row per task.
    """
    newest_first = Window.partitionBy(*keys).orderBy(*[F.desc(c) for c in order_cols])
    return df.withColumn("_rn", F.row_number().over(newest_first)).filter("_rn = 1").drop("_rn")


def table_terms(spark, table):
    """Keys, order, partitions and bucket number of a keyed table; None if there is none."""
    try:
        return spark.read.schema(TERMS).json(f"{table}/terms").first()
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def read_table(spark, table, evolving=False):
    """The newest row of each key; None if the table does not exist yet.

    Filters on partition columns and keys reach the files. Partition columns have the types
    they were written with, so a text such as ``007`` stays one.
    """
    terms = table_terms(spark, table)
    if terms is None:
        return None
    rows = _all_rows(spark, table, terms, evolving).drop("batch_id", "bucket")
    return latest_per_key(rows, [*terms.partition_cols, *terms.keys], terms.order_cols)


def upsert(df, table, keys, order_cols, buckets=64, batch_id=None, partition_cols=(),
           evolving=False):
    """Add a batch of rows by key: the row newest by ``order_cols`` is the one read.

    A batch is reduced to the newest row per key and appended as its own folder, by
    ``partition_cols`` (part of the key) and a hash of the key; nothing stored is read or
    rewritten, so the cost is that of the batch. A batch id owns its folder: a repeat, also
    after a crash half way, writes the same folder again. Without an id a repeat adds rows
    that readers reduce to the same result. ``compact_table`` merges batches.

    The keys, the order and the bucket number belong to the table; others are refused.
    ``evolving`` tables take new columns; their readers merge the schemas of all files.
    """
    spark = df.sparkSession
    place = [*partition_cols, "bucket"]
    terms = table_terms(spark, table)
    if terms is None:
        given = (list(keys), list(order_cols), list(partition_cols), buckets, df.schema.json())
        spark.createDataFrame([given], TERMS).coalesce(1).write.mode("overwrite").json(f"{table}/terms")
    else:
        _same_terms(terms, table, keys, order_cols, partition_cols, buckets)
        stored = T.StructType.fromJson(json.loads(terms.columns))
        if not evolving:
            if set(stored.names) != set(df.columns):
                raise ValueError(f"columns of {table} differ from those to be written")
            df = df.select(*[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in stored])
    name = uuid.uuid4().hex if batch_id is None else str(batch_id)
    bucket = F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")
    rows = latest_per_key(df, [*partition_cols, *keys], order_cols).withColumn("bucket", bucket)
    _write_batch(rows, table, name, place)


def compact_table(spark, table, batches=None, evolving=False):
    """Merge batches (all, or those named) into one that keeps their newest row per key.

    Merge the small ones often and all of them rarely: the cost is that of the batches merged.
    The merged batch is complete before the old folders go, and rows in both are the same, so
    a crash in between loses and changes nothing. Not while readers of the old folders run.
    """
    terms = table_terms(spark, table)
    stored = _all_rows(spark, table, terms, evolving)
    names = stored.select(F.col("batch_id").cast("string").alias("name")).distinct()
    merged = sorted(r.name for r in names.collect() if batches is None or r.name in batches)
    if len(merged) < 2:
        return
    place = [*terms.partition_cols, "bucket"]
    rows = stored.filter(F.col("batch_id").isin(merged)).drop("batch_id")
    newest = latest_per_key(rows, [*place, *terms.keys], terms.order_cols)
    _write_batch(newest, table, uuid.uuid4().hex, place)
    delete_folders(spark, [f"{table}/rows/batch_id={name}" for name in merged])


def _write_batch(rows, table, name, place):
    # Rows are unique by key here, so buckets are even.
    path = f"{table}/rows/batch_id={name}"
    rows.repartition(*place).write.mode("overwrite").partitionBy(*place).parquet(path)


def _all_rows(spark, table, terms, evolving):
    """Rows of all batches; ``batch_id`` and partition columns are texts or as declared."""
    declared = T.StructType.fromJson(json.loads(terms.columns))
    place = T.StructType([declared[c] for c in terms.partition_cols])
    place.add("bucket", T.IntegerType()).add("batch_id", T.StringType())
    fields = [f for f in declared if f.name not in terms.partition_cols]
    if evolving:
        found = spark.read.option("mergeSchema", True).parquet(f"{table}/rows").schema
        named = {f.name for f in [*declared, *place]}
        fields += [f for f in found if f.name not in named]
    return spark.read.schema(T.StructType([*fields, *place])).parquet(f"{table}/rows").select(
        *[f"`{f.name}`" for f in declared],
        *[f"`{f.name}`" for f in fields if f.name not in declared.names],
        "bucket",
        "batch_id",
    )


def _same_terms(terms, table, keys, order_cols, partition_cols, buckets):
    given = (list(keys), list(order_cols), list(partition_cols), buckets)
    if given != (terms.keys, terms.order_cols, terms.partition_cols, terms.buckets):
        raise ValueError(f"{table} has other keys, order, partitions or number of buckets")


def append_table(df, keyspace, table):
    """Append rows to a catalog table, which is made if needed."""
    df.sparkSession.sql(f"CREATE DATABASE IF NOT EXISTS `{keyspace}`")
    df.write.mode("append").saveAsTable(f"`{keyspace}`.`{table}`")
