"""Batch ingest: staged files -> agreement checks -> clean rows -> keyed tables."""

import time

from pyspark.sql import Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripflow.operators.cleanse import (
    CHICAGO_CASTS,
    cast_trips,
    drop_unused,
    fill_area,
    snake_columns,
)
from tripflow.operators.sla import admission, file_type_check, quota_batches
from tripflow.operators.upsert import upsert
from tripflow.plans.registry import register_pipeline, transform_for
from tripflow.schemas import CHICAGO_KEY, CHICAGO_RAW
from tripflow.session import settle
from tripflow.sources.files import (
    exact_paths,
    file_path,
    folder_tenant,
    header_lines,
    in_header_order,
    list_staged,
    read_staged,
    staging_folder,
)
from tripflow.streaming.files import delete_files, exists

# Staged times are US 12-hour texts, so all columns of a CSV row are read as declared texts
# or numbers; these columns say where a row came from and which of two rows is newer.
SOURCE_ORDER = ["run", "source_file", "source_block", "source_row"]


def clean_chicago(df):
    """Raw Chicago columns to the stored form; trips without an area get area -1."""
    return fill_area(cast_trips(snake_columns(drop_unused(df)), CHICAGO_CASTS))


register_pipeline("clean_chicago", clean_chicago)


def tenant_folders(spark, staging_dir, agreements):
    """``{folder: tenant}`` of the agreements whose ``fileStorageLocation`` is not the tenant's own name
    below the staging folder, and exists. A name per such tenant reaches the driver."""
    own = F.concat(F.lit("/"), F.col("id"))
    rows = agreements.filter(F.col("fileStorageLocation").isNotNull() & (F.col("fileStorageLocation") != own))
    folders = {
        staging_folder(staging_dir, r.fileStorageLocation): r.id for r in rows.select("id", "fileStorageLocation").collect()
    }
    return {folder: tenant for folder, tenant in folders.items() if exists(spark, folder)}


def staging_decisions(spark, staging_dir, agreements, folders=None):
    """Every staged file with its fate: accepted or not, why, and its ingest interval.

    Files lie in the folder that their tenant's agreement names. A tenant without agreement has its
    files rejected as ``no_agreement``.
    """
    folders = tenant_folders(spark, staging_dir, agreements) if folders is None else folders
    files = list_staged(spark, staging_dir, folders)
    unknown = files.join(agreements.select(F.col("id").alias("tenant")), "tenant", "left_anti")
    checked = file_type_check(files, agreements)
    intervals = quota_batches(files, agreements).drop("bytes")
    decisions = admission(files, agreements).select("tenant", "decision")
    return (
        checked.join(decisions, "tenant")
        .join(intervals, ["tenant", "file"], "left")
        .withColumn(
            "reason",
            F.when(F.col("decision") != "admitted", F.col("decision")).otherwise(F.col("reason")),
        )
        .drop("decision")
        .unionByName(
            unknown.withColumns({"accepted": F.lit(False), "reason": F.lit("no_agreement")}),
            allowMissingColumns=True,
        )
    )


def _staged_rows(spark, paths, ext, schema, run, folders):
    rows = read_staged(spark, exact_paths(paths), ext, schema)
    names = T.StructType.fromDDL(CHICAGO_RAW).names
    path = file_path()
    return rows.select(
        *[F.col(f"`{name}`") for name in names],
        folder_tenant(path, folders).alias("tenant"),
        path.alias("source_path"),
        F.lit(run).alias("run"),
        F.col("_metadata.file_name").alias("source_file"),
        F.col("_metadata.file_block_start").alias("source_block"),
        F.monotonically_increasing_id().alias("source_row"),
    )


def ingest_staged(spark, staging_dir, agreements, table, run=0, intervals=None, buckets=64,
                  delete=False):
    """Ingest the admitted files of all tenants, one read per transform and file type.

    Rows go by key to the keyspace and table of the tenant's agreement, which are
    partitions of ``table``; a row of a later run, or later file, replaces an earlier one.
    CSV columns go by the names in each file's header; a file whose header has other names
    is rejected as ``unknown_header``. ``intervals`` keeps the files of those quota
    intervals; ``delete`` removes the files of which every row was handed to the table,
    never a rejected one. Returns the decisions, among them those of the rejected files, with the
    ``run`` and the ``seconds`` of each ingested file: its share by size of the time of its read, as
    ``operators.sla.batch_run_stats`` sums them up. Rows are counted by the write itself.

    Only file names and headers reach the driver, at most ``maxNumFiles`` per tenant.
    """
    folders = tenant_folders(spark, staging_dir, agreements)
    decisions = settle(staging_decisions(spark, staging_dir, agreements, folders), "decisions")
    taken = decisions.filter("interval_no IS NOT NULL")
    if intervals is not None:
        taken = taken.filter(F.col("interval_no").isin(list(intervals)))
    terms = agreements.select(
        F.col("id").alias("tenant"),
        "pipeline",
        F.col("coredmsKeyspace").alias("keyspace"),
        F.col("coredmsTable").alias("table"),
        F.col("fileStorageLocation").alias("location"),
    )
    files = taken.join(terms, "tenant").orderBy("tenant", "file").collect()
    headers = {}
    for ext, sep in (("csv", ","), ("txt", "\t")):
        if paths := [row.path for row in files if row.ext == ext]:
            headers |= {r.path: tuple(r.header) for r in header_lines(spark, paths, sep).collect()}
    reads: dict[tuple, list] = {}
    misfits, times = [], []
    for row in files:
        header = headers.get(row.path)
        if header is not None and in_header_order(CHICAGO_RAW, header) is None:
            misfits.append((row.path,))
            continue
        transform = transform_for(row.pipeline, row.tenant, row.location)
        reads.setdefault((transform, row.ext, header), []).append(row)
    for (transform, ext, header), taken_files in reads.items():
        schema = in_header_order(CHICAGO_RAW, header) if header else CHICAGO_RAW
        read, stored, n = Observation(), Observation(), F.count(F.lit(1)).alias("n")
        staged = _staged_rows(spark, [f.path for f in taken_files], ext, schema, run, folders)
        rows = transform(staged.observe(read, n)).join(terms.drop("pipeline", "location"), "tenant").observe(stored, n)
        started = time.monotonic()
        upsert(
            rows.drop("source_path"),
            table,
            CHICAGO_KEY,
            SOURCE_ORDER,
            buckets,
            partition_cols=["keyspace", "table"],
        )
        seconds, size = time.monotonic() - started, sum(f.bytes for f in taken_files)
        times += [(f.path, run, seconds * f.bytes / size if size else 0.0) for f in taken_files]
        if delete:
            whole = read.get["n"] == stored.get["n"]
            delete_files(spark, [f.path for f in taken_files] if whole else _handed_over(staged, rows))
    timed = spark.createDataFrame(times, "path STRING, run BIGINT, seconds DOUBLE")
    decisions = decisions.join(timed, "path", "left")
    if not misfits:
        return decisions
    odd = spark.createDataFrame(misfits, "path STRING").withColumn("_odd", F.lit(True))
    return decisions.join(odd, "path", "left").select(
        *[
            F.when(F.col("_odd"), {"accepted": F.lit(False), "reason": F.lit("unknown_header")}.get(
                name, F.lit(None)
            )).otherwise(F.col(name)).alias(name)
            if name in ("accepted", "reason", "interval_no") else F.col(name)
            for name in decisions.columns
        ]
    )


def _handed_over(staged, rows):
    """Paths of the files of which as many rows went to the table as were read."""
    count = lambda df, name: df.groupBy("source_path").agg(F.count(F.lit(1)).alias(name))
    both = count(staged, "read").join(count(rows, "stored"), "source_path", "left")
    return [r.source_path for r in both.filter(F.col("read") == F.col("stored")).collect()]
