"""Session settings and the shared working folder."""

import uuid

from pyspark.sql import SparkSession

ROCKS_DB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def build_session(app="tripflow", master=None, **conf):
    """A session with the settings the operators rely on; ``conf`` wins over the defaults."""
    settings = {
        # Trip times are UTC instants on every path.
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        # Window and session state lives off heap on the executors' disks and is
        # committed to the checkpoint folder.
        "spark.sql.streaming.stateStore.providerClass": ROCKS_DB,
        **conf,
    }
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_root(spark):
    """The folder all executors can reach: ``spark.checkpoint.dir``, else the warehouse folder."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
    return root.rstrip("/")


def fresh_dir(spark, label):
    """A path below the shared folder that no other run uses.

    All paths of an application have one parent, so they can be deleted together after it.
    """
    application = spark.sparkContext.applicationId
    return f"{shared_root(spark)}/tripflow/{application}/{label}-{uuid.uuid4().hex}"


def settle(df, label):
    """Compute a small result once: write it to the shared folder and read it back.

    Its true size is then known when it is joined, so Spark broadcasts it only below
    ``spark.sql.autoBroadcastJoinThreshold`` and shuffles both sides above that, and the
    large side is not shuffled just to find out. The file survives lost executors.
    """
    path = fresh_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def interval_seconds(interval):
    """Seconds of an interval given as a number or as text such as ``'60 seconds'``."""
    if isinstance(interval, (int, float)):
        return int(interval)
    units = {"second": 1, "minute": 60, "hour": 3600, "day": 86400}
    amount, unit = interval.split()
    return int(amount) * units[unit.rstrip("s")]
