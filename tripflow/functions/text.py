"""Texts of messages, log lines, file names and topics."""

from pyspark.sql import functions as F

from tripflow.functions.times import epoch_ms


def silver_line():
    """CSV line of a silver row: area, trips, total, window start and end in ms."""
    return F.concat_ws(
        ",", "area", "trips", "total_fares", epoch_ms("window_start"), epoch_ms("window_end")
    )


def silver_message():
    return F.concat(F.lit("Silver data: "), silver_line())


def late_message():
    return F.concat(F.lit("Record ignored from analytics due lateness: "), F.col("value"))


def alert_message():
    """Quality alert text of a window-quality row."""
    return F.concat(
        F.lit("data quality alert"),
        F.to_json(
            F.struct(
                epoch_ms("window_start").alias("window"),
                "rows",
                "discarded",
                "data_quality",
                "pickup_errors",
                "timestamp_errors",
            ),
            {"ignoreNullFields": "false"},
        ),
    )


def _number_text(c):
    """Text of a number; 0.0005 stays that, where a plain cast gives 5.0E-4."""
    short = F.regexp_replace(c.cast("string"), r"^(-?)(\d)\.0E-4$", "$10.000$2")
    return F.regexp_replace(short, r"^(-?)(\d)\.(\d+)E-4$", "$10.000$2$3")


def metric_log_block():
    """Seven log lines of a window-quality row."""
    lines = [
        ("window: ", epoch_ms("window_start")),
        ("records per window: ", F.col("rows")),
        ("records processed per second: ", F.col("records_per_second")),
        ("rows discarded: ", F.col("discarded")),
        ("data quality: ", F.col("data_quality")),
        ("pickup area errors: ", F.col("pickup_errors")),
        ("timestamp errors: ", F.col("timestamp_errors")),
    ]
    return F.concat_ws(
        "\n",
        *[F.concat(F.lit(name), F.coalesce(_number_text(c), F.lit("None"))) for name, c in lines],
    )


def to_status_json():
    return F.to_json(
        F.struct("tenant_id", "timestamp", "rows_processed", "rows_per_second", "discarded_rows")
    )


def to_report_json():
    return F.to_json(
        F.struct("start_time", "end_time", "total_time", "rows", "total_size", "speed"),
        {"ignoreNullFields": "false"},
    )


def to_warning_json():
    return F.to_json(F.struct("tenant", "warning"))


def to_action_json():
    return F.to_json(F.struct("action"))


def report_log_block():
    """Log lines of a finished ingest run."""
    seconds = F.format_string("%.2f s", F.col("total_time"))
    speed = F.format_string("%.2f kB/s", F.coalesce("speed", F.lit(0.0)))
    lines = [
        F.concat(F.col("tenant"), F.lit(" - Stream ingestion statistics:")),
        F.concat(F.lit("Ingestion started at: "), F.from_unixtime(F.floor("start_time"))),
        F.concat(F.lit("Ingestion ended at: "), F.from_unixtime(F.floor("end_time"))),
        F.concat(F.lit("Total ingestion time: "), seconds),
        F.concat(F.lit("Total number of rows inserted: "), F.col("rows")),
        F.concat(F.lit("Total ingestion size: "), F.col("total_size"), F.lit(" kB")),
        F.concat(F.lit("Ingestion speed: "), speed),
        F.concat(
            F.lit("Number of rows not inserted due to format not matching schema: "),
            F.col("discarded"),
        ),
    ]
    return F.concat_ws("\n", *lines)


def gold_path(c):
    """Gold directory of a silver file: same base and hour directory below ``goldData``."""
    return F.regexp_replace(c, r"^(.*)silverData/([^/]+)(/.*)?$", "$1goldData/$2/")


def processed_name(c):
    """``x.csv`` to ``x_processed.csv``."""
    return F.regexp_replace(c, r"\.([^./]+)$", "_processed.$1")


def file_ext(c):
    """Text after the last dot of a file name."""
    return F.substring_index(c, ".", -1)


def tenant_of(topic):
    """Tenant id of a topic: the part before the first underscore."""
    return F.substring_index(topic, "_", 1)


def message_kind(topic):
    """Message kind of a topic: everything after the first underscore."""
    return F.coalesce(F.get(F.split(topic, "_", 2), F.lit(1)), F.lit(""))
