"""Alerts, warnings and recommended actions."""

from pyspark.sql import functions as F

from tripflow.schemas import DEFAULT_LIMITS, LIMITS, QUALITY_LIMIT, ROW_BYTES
from tripflow.session import interval_seconds


def default_limits(spark):
    return spark.createDataFrame(DEFAULT_LIMITS, LIMITS)


def quality_alerts(wq, limit=QUALITY_LIMIT):
    """Windows whose data quality is below the limit."""
    return wq.filter(F.col("data_quality") < limit)


# Limits of a tenant that states none: any report without rows warns, as does one of bad rows only.
ANY_LIMITS = {"minimumIngestionSpeed": 0.0, "minRowsProcessed": 1, "maxDiscardedRowsRelation": 0.5}


def with_limits(rows, limits, default=None):
    """Adds the limits of each row's ``tenant``; a tenant without limits, or with a null among them, has
    the ``default``. The limits are measured, not assumed to be small, and a hot tenant is split."""
    default = default or ANY_LIMITS
    joined = rows.join(limits.select("tenant", *default), "tenant", "left")
    return joined.withColumns({name: F.coalesce(name, F.lit(value)) for name, value in default.items()})


def _judged(status, limits, default):
    rows, discarded = F.col("rows_processed"), F.col("discarded_rows")
    relation = F.when(rows > 0, discarded / (discarded + rows)).otherwise(1.0)
    speed = F.coalesce(F.col("rows_per_second"), F.lit(0.0)) * ROW_BYTES
    warning = (
        F.when(relation > F.col("maxDiscardedRowsRelation"), "maxDiscardedRowsRelation")
        .when(rows < F.col("minRowsProcessed"), "minRowsProcessed")
        .when(speed < F.col("minimumIngestionSpeed"), "minimumIngestionSpeed")
    )
    return (
        with_limits(status.withColumnRenamed("tenant_id", "tenant"), limits, default)
        .withColumn("warning", warning)
        .select("tenant", *[c for c in status.columns if c != "tenant_id"], "warning")
    )


def status_warnings(status, limits, default=None):
    """The first limit each status report breaks, for the reports that break one.

    ``rows_processed`` already holds the discarded rows; the ratio adds them once more, as
    the limits were set for that formula. The speed is rows/s times the bytes of a row. A
    report without a rate has speed 0. Tenants without limits have the ``default`` ones.
    """
    return _judged(status, limits, default).filter("warning IS NOT NULL")


def breaches(status, limits, default=None, before=None, every=False):
    """Warnings that the tenant's report before did not give, each with its action: one for a breach,
    however many reports it lasts.

    ``status``: the reports of each tenant without gaps in ``interval_no``. ``before`` (``tenant,
    interval_no, warning``): reports judged earlier. A report finds the one before it by its number,
    so no task orders a tenant's history. ``every`` keeps all reports and adds ``is_new``.
    """
    judged = _judged(status, limits, default)
    earlier = judged.select("tenant", "interval_no", "warning")
    if before is not None:
        earlier = earlier.unionByName(before)
    earlier = earlier.select(
        "tenant", (F.col("interval_no") + 1).alias("interval_no"), F.col("warning").alias("_before")
    )
    is_new = F.col("warning").isNotNull() & ~F.col("warning").eqNullSafe(F.col("_before"))
    rows = recommend_actions(judged.join(earlier, ["tenant", "interval_no"], "left").withColumn("is_new", is_new))
    rows = rows.drop("_before")
    return rows if every else rows.filter("is_new").drop("is_new")


def recommend_actions(warnings):
    """``stop`` a tenant that sends too many bad rows, ``restart`` a slow one."""
    return warnings.withColumn(
        "action",
        F.when(F.col("warning") == "maxDiscardedRowsRelation", "stop").when(F.col("warning").isNotNull(), "restart"),
    )


def critical_windows(alerts, limit, size="1 hour"):
    """Periods with more alerts than the limit: the trigger of an extra batch run."""
    return (
        alerts.groupBy(
            F.window("window_start", f"{interval_seconds(size)} seconds").alias("period")
        )
        .agg(F.count(F.lit(1)).alias("alerts"))
        .filter(F.col("alerts") > limit)
        .select(
            F.col("period.start").alias("period_start"),
            F.col("period.end").alias("period_end"),
            "alerts",
        )
    )


def tenant_feed(silver, late, alerts):
    """One feed of the texts of silver rows, late rows and alerts (``value``)."""
    return silver.unionByName(late).unionByName(alerts)
