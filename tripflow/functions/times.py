"""Parsing and rendering of times."""

from pyspark.sql import functions as F

ISO_Z = "yyyy-MM-dd'T'HH:mm:ss'Z'"
US_12H = "MM/dd/yyyy hh:mm:ss a"


def _column(c):
    return F.col(c) if isinstance(c, str) else c


def parse_iso_z(c):
    """``2024-01-19T17:00:00Z`` to TIMESTAMP, NULL for any other form."""
    return F.try_to_timestamp(_column(c), F.lit(ISO_Z))


def parse_us_12h(c):
    """``01/19/2024 05:00:00 PM`` to TIMESTAMP, NULL for any other form."""
    return F.try_to_timestamp(_column(c), F.lit(US_12H))


def iso_event_time(c):
    """ISO date or time with ``Z``, an offset or no zone (UTC); NULL if it is none."""
    text = _column(c)
    return F.when(text.rlike(r"^\d{4}-\d{2}-\d{2}"), F.try_to_timestamp(text))


def event_time(c, ingest_ts):
    """Event time of a payload text; the arrival time where the text gives none."""
    return F.coalesce(iso_event_time(c), _column(ingest_ts))


def iso_z(c):
    """TIMESTAMP to ``2024-01-19T17:00:00Z``."""
    return F.date_format(_column(c), ISO_Z)


def epoch_ms(c):
    return F.unix_millis(_column(c))


def epoch_text(c):
    """Epoch seconds to ``yyyy-MM-dd HH:mm:ss`` in the session zone."""
    return F.from_unixtime(_column(c).cast("bigint"), "yyyy-MM-dd HH:mm:ss")


def hour_dir(c, zone="Europe/Helsinki"):
    """Name of the hourly silver directory, ``yyyy-MM-dd--HH`` in a local zone."""
    return F.date_format(F.from_utc_timestamp(_column(c), zone), "yyyy-MM-dd--HH")
