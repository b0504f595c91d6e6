"""Sizes and speeds."""

from pyspark.sql import functions as F

from tripflow.schemas import ROW_BYTES


def to_mb(size):
    """Bytes to MB of 10^6 bytes."""
    return size / F.lit(1_000_000.0)


def row_kb(rows):
    """kB that a number of stored rows counts as."""
    return rows * F.lit(float(ROW_BYTES)) / F.lit(1000.0)


def per_second(amount, seconds):
    """Amount per second, NULL where no time has passed."""
    return F.when(seconds > 0, amount / seconds)
