"""Proportional stratified interleaving of rows into shards."""

from pyspark.sql import functions as F

from tripflow.session import settle
from tripflow.sources.files import number_rows

SEED = 20_240_601


def interleave(docs, shards, source="source", key=("doc_id",), seed=SEED):
    """Adds ``shard`` (from 0) and ``slot`` (from 0 in each shard, without gaps).

    Rows of each source are shuffled by a seeded hash of ``key`` and ranked; all rows are sorted by
    ``(rank + 1/2) / rows of the source`` and cut into ``shards`` runs whose lengths differ by one at
    most. So every shard, and every stretch of one, has the sources' proportions up to rounding.

    Law: ``rows``. Rows with equal keys follow each other in any order; a null source is a source
    of its own; no rows give no rows. Columns of these two names are replaced. Ranks come from
    one numbering of all rows by source and hash over range partitions, so a source with a third of
    the rows is no single task; pass narrow rows, they are written twice.
    """
    columns = [c for c in docs.columns if c not in ("shard", "slot")]
    mix = F.xxhash64(F.lit(seed), *key)
    rows = docs.select(
        F.struct(*columns).alias("row"), F.col(source).isNull().alias("none"),
        F.coalesce(F.col(source).cast("string"), F.lit("")).alias("source"), mix.alias("mix"),
        F.struct(*[F.col(c) for c in key]).alias("key"),
    )
    ranked = number_rows(rows, ["none", "source", "mix", "key"])
    sizes = settle(
        ranked.groupBy("none", "source").agg(F.min("row_no").alias("first"), F.count(F.lit(1)).alias("n")),
        "source-sizes",
    )
    total = sizes.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    fraction = (2 * (F.col("row_no") - F.col("first")) + 1) / (2 * F.col("n"))
    mixed = ranked.join(sizes, ["none", "source"]).select(
        "row", fraction.alias("fraction"), "none", "source", "mix", "key"
    )
    placed = number_rows(mixed, ["fraction", "none", "source", "mix", "key"])
    return placed.withColumn("shard", F.expr(f"cast(row_no * {shards} div {max(total, 1)} as int)")).select(
        "row.*", "shard",
        (F.col("row_no") - F.expr(f"(shard * {total} + {shards - 1}) div {shards}")).alias("slot"),
    )


def write_shards(docs, path, shards, **options):
    """Write the rows as one folder per shard, in slot order, over several files a shard."""
    (
        interleave(docs, shards, **options)
        .repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot")
        .write.partitionBy("shard").parquet(path)
    )


def shard_report(docs, shards=8):
    """Shard and slot of all documents; the texts themselves are not moved."""
    whole = F.coalesce(F.col("text"), F.lit(""))
    narrow = settle(
        docs.select(
            "doc_id", "source", (F.octet_length(whole).cast("long") + 1).alias("size"),
            F.crc32(whole).alias("text_crc32"),
        ),
        "document-sizes",
    )
    return interleave(narrow, shards, key=("doc_id", "text_crc32", "size")).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
