"""Staged files and agreements, and sample files, from orders and customers."""

from pyspark.sql import functions as F

from tripflow.catalog.fixtures import FILES_CTE, agreements, staged_files, table
from tripflow.catalog.registry import query
from tripflow.operators.sla import (
    admission,
    batch_run_stats,
    file_type_check,
    quota_batches,
    staging_usage,
    with_agreement,
)
from tripflow.sources.files import split_samples


def _inputs(spark, sf_dir):
    files = staged_files(table(spark, sf_dir, "orders"), table(spark, sf_dir, "customer"))
    return files, agreements(table(spark, sf_dir, "nation"))


@query(
    "with_agreement",
    f"""WITH RECURSIVE {FILES_CTE} SELECT tenant, file, bytes, 'keyspace' || tenant AS keyspace,
        max_files::INTEGER AS max_files FROM files JOIN agreement USING (tenant)""",
)
def paired(spark, sf_dir):
    return with_agreement(*_inputs(spark, sf_dir)).select(
        "tenant",
        "file",
        "bytes",
        F.col("coredmsKeyspace").alias("keyspace"),
        F.col("maxNumFiles").alias("max_files"),
    )


@query(
    "staging_usage",
    f"""WITH RECURSIVE {FILES_CTE} SELECT tenant, num_files, used_bytes,
        round(used_bytes / 1000000.0, 6) AS used_mb FROM usage""",
)
def usage(spark, sf_dir):
    return staging_usage(_inputs(spark, sf_dir)[0]).withColumn("used_mb", F.round("used_mb", 6))


@query(
    "file_type_check",
    f"""WITH RECURSIVE {FILES_CTE} SELECT tenant, file, bytes, ext, accepted,
        CASE WHEN accepted THEN '' ELSE 'unsupported_type' END AS reason FROM checked""",
)
def type_check(spark, sf_dir):
    return file_type_check(*_inputs(spark, sf_dir))


@query(
    "admission",
    f"WITH RECURSIVE {FILES_CTE} SELECT tenant, num_files, used_bytes, decision FROM admitted",
)
def admitted(spark, sf_dir):
    return admission(*_inputs(spark, sf_dir))


QUOTA_CTE = f"""WITH RECURSIVE {FILES_CTE}, taken AS (
  SELECT c.tenant, c.file, c.bytes, quota_mb * 1000000 AS quota,
    row_number() OVER (PARTITION BY c.tenant ORDER BY c.file) AS i
  FROM checked c JOIN admitted a ON a.tenant = c.tenant JOIN agreement g ON g.tenant = c.tenant
  WHERE accepted AND decision = 'admitted'
), fold AS (
  SELECT tenant, file, bytes, quota, i, bytes AS used, 0 AS interval_no FROM taken WHERE i = 1
  UNION ALL
  SELECT t.tenant, t.file, t.bytes, t.quota, t.i,
    CASE WHEN f.used >= t.quota THEN t.bytes ELSE f.used + t.bytes END,
    f.interval_no + CASE WHEN f.used >= t.quota THEN 1 ELSE 0 END
  FROM fold f JOIN taken t ON t.tenant = f.tenant AND t.i = f.i + 1
)"""


@query("quota_batches", f"{QUOTA_CTE} SELECT tenant, file, bytes, interval_no FROM fold")
def quotas(spark, sf_dir):
    return quota_batches(*_inputs(spark, sf_dir))


@query(
    "batch_run_stats",
    f"""{QUOTA_CTE}, s AS (SELECT tenant, interval_no AS run, count(*) AS files,
          sum(bytes / 1000000.0::DOUBLE) AS seconds, sum(bytes) / 1000000.0::DOUBLE AS mb FROM fold GROUP BY 1, 2)
        SELECT tenant, run, files, round(seconds, 3) AS seconds, round(mb, 6) AS mb,
          round(mb / seconds, 3) AS mb_per_second FROM s""",
)
def run_stats(spark, sf_dir):
    # Each file takes its size in MB as seconds.
    runs = quota_batches(*_inputs(spark, sf_dir)).select(
        "tenant",
        F.col("interval_no").alias("run"),
        "bytes",
        (F.col("bytes") / 1_000_000.0).alias("seconds"),
    )
    return batch_run_stats(runs).withColumns(
        {
            "seconds": F.round("seconds", 3),
            "mb": F.round("mb", 6),
            "mb_per_second": F.round("mb_per_second", 3),
        }
    )


@query(
    "split_samples",
    """SELECT o_orderkey, row_number() OVER (ORDER BY o_orderdate, o_orderkey) - 1 AS row_no,
         (row_number() OVER (ORDER BY o_orderdate, o_orderkey) - 1) // 1000 AS sample_id FROM orders""",
)
def samples(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    return split_samples(orders, None, 1000, ["o_orderdate", "o_orderkey"]).drop("o_orderdate")


@query(
    "first_samples",
    """SELECT * FROM (SELECT o_orderkey, (row_number() OVER (ORDER BY o_orderdate, o_orderkey) - 1) // 200 AS sample_id
       FROM orders) WHERE sample_id < 5""",
)
def first_samples(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    return split_samples(orders, 5, 200, ["o_orderdate", "o_orderkey"]).select(
        "o_orderkey", "sample_id"
    )
