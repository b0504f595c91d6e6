"""Staged files against service agreements.

Files: ``schemas.STAGED_FILE``; agreements: ``schemas.AGREEMENT``, whose ``id`` is the tenant.
Both are metadata; their sizes are known to Spark, which picks the join.
"""

from pyspark.sql import Window
from pyspark.sql import functions as F

from tripflow.functions.units import per_second, to_mb
from tripflow.session import settle


def with_agreement(files, agreements):
    """Each file beside the agreement of its tenant."""
    return files.join(agreements.withColumnRenamed("id", "tenant"), "tenant")


def file_type_check(files, agreements):
    """Add ``accepted`` and ``reason``: the agreement must allow the file's extension."""
    allowed = F.coalesce(F.try_element_at("fileTypesSupported", F.col("ext")), F.lit(False))
    return (
        with_agreement(files, agreements)
        .withColumn("accepted", allowed)
        .withColumn("reason", F.when(allowed, "").otherwise("unsupported_type"))
        .select(*files.columns, "accepted", "reason")
    )


def staging_usage(files):
    """Number of files and used storage per tenant, unsupported files included."""
    return (
        files.groupBy("tenant")
        .agg(F.count(F.lit(1)).alias("num_files"), F.sum("bytes").alias("used_bytes"))
        .withColumn("used_mb", to_mb(F.col("used_bytes")))
    )


def admission(files, agreements):
    """May a tenant's files be ingested? The first broken rule is the decision."""
    used = F.coalesce(F.col("used_bytes"), F.lit(0))
    count = F.coalesce(F.col("num_files"), F.lit(0))
    return (
        agreements.withColumnRenamed("id", "tenant")
        .join(staging_usage(files), "tenant", "left")
        .select(
            "tenant",
            count.alias("num_files"),
            used.alias("used_bytes"),
            F.when(count == 0, "no_files")
            .when(count > F.col("maxNumFiles"), "too_many_files")
            .when(used > F.col("maxStagingStorage") * 1_000_000, "storage_exceeded")
            .otherwise("admitted")
            .alias("decision"),
        )
    )


def quota_batches(files, agreements):
    """Ingest interval of each accepted file of the admitted tenants.

    In file order a tenant goes on until the bytes of the interval reach the quota; the
    file that crosses it is still taken. So the file after an interval that starts at ``f`` is the
    first one whose bytes before it reach those before ``f`` plus the quota: a jump known from
    prefix sums alone. The files that start an interval are those that jumps reach from a tenant's
    first; they are found by doubling the jumps, and their number among them is the interval's.
    No list of a tenant's files is built.
    """
    admitted = admission(files, agreements).filter("decision = 'admitted'").select("tenant")
    accepted = (
        file_type_check(files, agreements)
        .filter("accepted")
        .select("tenant", "file", "bytes")
        .join(admitted, "tenant", "left_semi")
    )
    # A file's number and the bytes before it. A tenant with more than ``maxNumFiles`` is not admitted.
    in_order = Window.partitionBy("tenant").orderBy("file", "bytes")
    numbered = settle(
        accepted.select(
            "tenant", "file", "bytes", (F.row_number().over(in_order) - 1).alias("no"),
            (F.sum("bytes").over(in_order.rowsBetween(Window.unboundedPreceding, 0)) - F.col("bytes")).alias("before"),
        ),
        "numbered-files",
    )
    # Without a quota all files are one interval.
    quota = agreements.select(
        F.col("id").alias("tenant"), F.ceil(F.col("maxIngestionIntervalSize") * 1_000_000).alias("_quota")
    ).filter("_quota IS NOT NULL")
    jumps = settle(_jumps(numbered, quota), "interval-jumps")
    starts = settle(_reached(jumps), "interval-starts")
    opened = numbered.join(starts, ["tenant", "no"], "left")
    last_start = F.max("interval_no").over(Window.partitionBy("tenant").orderBy("no"))
    # A tenant without a jump has one interval.
    return opened.select("tenant", "file", "bytes", F.coalesce(last_start, F.lit(0)).alias("interval_no"))


def _jumps(numbered, quota):
    """``tenant, no, next``: the file that starts the next interval, if one starts at ``no``.

    A file and the quota mark of each file are points on the line of a tenant's bytes; the next file
    at or after a mark is a running minimum from above. A mark comes before the files at its place,
    and files of no bytes follow the file that they stand behind.
    """
    files = numbered.select("tenant", F.col("before").alias("place"), F.lit(1).alias("kind"), "no")
    marks = numbered.join(quota, "tenant").select(
        "tenant", (F.col("before") + F.col("_quota")).alias("place"), F.lit(0).alias("kind"), "no"
    )
    from_above = Window.partitionBy("tenant").orderBy(F.desc("place"), F.desc("kind"), F.desc("no"))
    reach = F.min(F.when(F.col("kind") == 1, F.col("no"))).over(
        from_above.rowsBetween(Window.unboundedPreceding, 0)
    )
    # At least one file is taken; a quota of nothing takes one file an interval.
    return (
        files.unionAll(marks).withColumn("_next", reach).filter("kind = 0 AND _next IS NOT NULL")
        .select("tenant", "no", F.greatest("_next", F.col("no") + 1).alias("next"))
    )


def _reached(jumps):
    """``tenant, no, interval_no`` of the files that jumps reach from a tenant's first.

    Round k knows the first 2**k starts and the jumps over 2**k intervals; a round takes both
    twice as far.
    """
    known = jumps.select("tenant").distinct().select(
        "tenant", F.lit(0).alias("no"), F.lit(0).alias("interval_no")
    )
    step = 1
    while True:
        more = known.join(jumps, ["tenant", "no"]).select(
            "tenant", F.col("next").alias("no"), (F.col("interval_no") + step).alias("interval_no")
        )
        if more.isEmpty():
            return known
        known = settle(known.unionAll(more), "interval-starts")
        onward = jumps.select("tenant", F.col("no").alias("next"), F.col("next").alias("_next"))
        jumps = settle(
            jumps.join(onward, ["tenant", "next"]).select("tenant", "no", F.col("_next").alias("next")), "interval-jumps"
        )
        step *= 2


def batch_run_stats(file_runs):
    """Totals per tenant run over its ingested files (``seconds`` and ``bytes`` per file)."""
    return (
        file_runs.groupBy("tenant", "run")
        .agg(
            F.count(F.lit(1)).alias("files"),
            F.sum("seconds").alias("seconds"),
            to_mb(F.sum("bytes")).alias("mb"),
        )
        .withColumn("mb_per_second", per_second(F.col("mb"), F.col("seconds")))
    )
