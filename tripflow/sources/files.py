"""Staged files, silver files and sample files."""

import re

from pyspark.sql import Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripflow.functions.text import file_ext
from tripflow.schemas import SILVER
from tripflow.session import fresh_dir, settle

_POSITION_BITS = 33  # of monotonically_increasing_id: the position within a partition


def file_path():
    """The path of a row's file, as a listing gives it; the metadata column has it URL-encoded."""
    decoded = F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B")))
    return F.regexp_replace(decoded, "^file:/+", "file:/")


def exact_paths(paths):
    """Paths whose names are not read as glob patterns."""
    return [re.sub(r"([\\\[\]{}*?])", r"\\\1", path) for path in paths]


def header_lines(spark, paths, sep=","):
    """``path, header``: the first line of each CSV file, as an array of names."""
    names = F.transform(F.split("header", sep), lambda name: F.trim(F.replace(name, F.lit('"'))))
    return (
        spark.read.text(exact_paths(paths))
        .select(
            file_path().alias("path"), "value",
            F.struct("_metadata.file_block_start", F.monotonically_increasing_id()).alias("place"),
        )
        .groupBy("path").agg(F.min_by("value", "place").alias("header"))
        .withColumn("header", names)
    )


def in_header_order(schema, header):
    """The declared columns in the order of a header; None if the header has other columns."""
    fields = {f.name: f for f in T.StructType.fromDDL(schema).fields}
    if sorted(fields) != sorted(header):
        return None
    return T.StructType([fields[name] for name in header])


def read_staged_csv(spark, path, schema):
    """CSV files with a header; the schema is declared, so the data is read once. Its columns
    must be in the header's order (see ``in_header_order``)."""
    return spark.read.schema(schema).option("header", True).csv(path)


def read_staged(spark, path, ext, schema):
    """Staged files of any format an agreement can allow."""
    reader = spark.read.schema(schema)
    if ext == "csv":
        return read_staged_csv(spark, path, schema)
    if ext == "json":
        return reader.json(path)
    if ext == "xml":
        return reader.option("rowTag", "row").xml(path)
    if ext == "parquet":
        return reader.parquet(path)
    if ext == "txt":
        return reader.option("sep", "\t").option("header", True).csv(path)
    raise ValueError(f"no reader for files of type {ext!r}")


def stream_staged_csv(spark, directory, schema, after="off", archive_dir=None):
    """New staged CSV files as a stream; ``after`` is what becomes of taken files.

    ``off`` keeps them, ``archive`` moves them below ``archive_dir``, ``delete`` deletes
    them. The checkpoint is what prevents a second read.
    """
    reader = spark.readStream.schema(schema).option("header", True).option("cleanSource", after)
    if archive_dir:
        reader = reader.option("sourceArchiveDir", archive_dir)
    return reader.csv(directory)


def read_silver(spark, paths, fmt="csv"):
    """Silver files in one read; CSV ones have no header, columns go by position."""
    rows = spark.read.schema(SILVER).option("recursiveFileLookup", True)
    return rows.csv(paths) if fmt == "csv" else rows.parquet(*_listed(paths))


def _listed(paths):
    return [paths] if isinstance(paths, str) else paths


def read_trips_parquet(spark, path):
    return spark.read.parquet(path)


def staging_folder(directory, location):
    """The folder of a ``fileStorageLocation``: one with a scheme as it is, else below ``directory``."""
    return location.rstrip("/") if "://" in location else f"{directory.rstrip('/')}/{location.strip('/')}"


def folder_tenant(path, folders):
    """The tenant of a file by its folder: one of ``folders`` (folder name -> tenant), else the folder's name.

    ``folders`` holds those whose name is not the tenant's, by the end of their path.
    """
    folder = F.regexp_replace(F.regexp_replace(path, "/[^/]*$", ""), "^[a-z0-9+.-]+:/+", "/")
    tenant = F.element_at(F.split(path, "/"), -2)
    for name, owner in folders.items():
        tenant = F.when(folder == re.sub("^[a-z0-9+.-]+:/+", "/", name), owner).otherwise(tenant)
    return tenant


def list_staged(spark, directory, folders=None):
    """Staged files below ``<directory>/<tenant>/`` and in the ``folders`` (folder -> tenant) elsewhere:
    tenant, file, bytes, ext, path.

    Only the listing is used; no file is opened, as the content column is not selected.
    """
    folders = folders or {}
    parts = F.split("path", "/")
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .load([directory, *(f for f in folders if not f.startswith(f"{directory.rstrip('/')}/"))])
        .select(
            folder_tenant(F.col("path"), folders).alias("tenant"),
            F.element_at(parts, -1).alias("file"),
            F.col("length").alias("bytes"),
            file_ext(F.element_at(parts, -1)).alias("ext"),
            "path",
        )
    )


def new_silver(spark, directory, hour=None, done=None):
    """Silver CSV files not processed yet, as ``path``; an empty result means: stop.

    ``hour`` keeps one hourly directory; ``done`` (``path``) lists files already taken.
    The exactly-once form is ``streaming.runs.run_gold_incremental``.
    """
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", "*.csv")
        .load(directory)
        .select("path")
        .filter(~F.contains(F.element_at(F.split("path", "/"), -1), F.lit("processed")))
    )
    if hour is not None:
        files = files.filter(F.contains("path", F.lit(f"/{hour}/")))
    return files if done is None else files.join(done, "path", "left_anti")


def number_rows(df, order_cols):
    """Add ``row_no`` (from 0) in the order of ``order_cols``, which must be unique.

    Rows are range-partitioned and sorted, and written with their position in the
    partition; the partition sizes then give each partition's first number. So no task
    sees more than its range, and the numbers do not depend on a second evaluation.
    """
    spark = df.sparkSession
    path = fresh_dir(spark, "numbered")
    (
        df.repartitionByRange(*order_cols)
        .sortWithinPartitions(*order_cols)
        .withColumn("_position", F.monotonically_increasing_id())
        .write.parquet(path)
    )
    rows = spark.read.parquet(path).withColumn(
        "_part", F.shiftright("_position", _POSITION_BITS)
    )
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    # One row per partition of the shuffle; written, so that its size is known to the join.
    offsets = settle(
        rows.groupBy("_part")
        .agg(F.count(F.lit(1)).alias("_rows"))
        .select("_part", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_offset")),
        "offsets",
    )
    within = F.col("_position").bitwiseAND(F.lit((1 << _POSITION_BITS) - 1))
    return rows.join(offsets, "_part").select(
        *df.columns, (F.col("_offset") + within).alias("row_no")
    )


def split_samples(df, n_files, rows_per_file, order_cols):
    """Cut a data set into ``n_files`` samples of ``rows_per_file`` rows, in order.

    ``n_files`` None cuts all of it. Adds ``sample_id`` from 0.
    """
    rows = number_rows(df, order_cols).withColumn(
        "sample_id", F.expr(f"row_no div {rows_per_file}")
    )
    return rows if n_files is None else rows.filter(F.col("sample_id") < n_files)


def write_samples(samples, directory):
    """Sample files with a header, one folder per sample."""
    (
        samples.repartition("sample_id")
        .sortWithinPartitions("sample_id", "row_no")
        .drop("row_no")
        .write.partitionBy("sample_id")
        .option("header", True)
        .csv(directory)
    )
