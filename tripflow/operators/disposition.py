"""Which rows go on, which are kept out, and why."""

from pyspark.sql import functions as F

from tripflow.functions.times import event_time, iso_event_time, parse_iso_z
from tripflow.operators.cleanse import fill_total, parse_trips
from tripflow.schemas import (
    CHICAGO_ANALYTICS,
    CHICAGO_MESSAGE_KEY,
    CHICAGO_RAW,
    NY_MESSAGE_KEY,
    NY_RAW,
)

# How ``from_json`` hands a bare NaN to a text field.
NAN_TEXT = '"NaN"'


def _is_nan(df, name):
    if dict(df.dtypes)[name] in ("double", "float"):
        return F.isnan(F.col(f"`{name}`"))
    if dict(df.dtypes)[name] == "string":
        return F.col(f"`{name}`") == NAN_TEXT
    return F.lit(False)


def valid_key(df, keys):
    """Add ``valid_key``: every key field is present and is not NaN."""
    missing = F.lit(False)
    for name in keys:
        missing = missing | F.col(f"`{name}`").isNull() | F.coalesce(_is_nan(df, name), F.lit(False))
    return df.withColumn("valid_key", ~missing)


def ingest_disposition(df, keys=CHICAGO_MESSAGE_KEY, schema=CHICAGO_RAW):
    """Parse trip messages and add ``disposition`` and ``reason``.

    ``discarded``: no JSON, or a key is NaN. ``errored``: a key is absent or unusable, or
    a trip time does not parse; such rows are neither stored nor counted as discarded.
    ``ok``: the row is stored. Keys are tested in order, as the first fault decides.
    """
    rows = parse_trips(df, schema)
    times = ["Trip Start Timestamp", "Trip End Timestamp"]
    reason = F.when(F.col("malformed"), "discarded:malformed")
    for name in keys:
        reason = reason.when(_is_nan(rows, name), f"discarded:NaN {name}")
        reason = reason.when(F.col(f"`{name}`").isNull(), f"errored:missing {name}")
    for name in times:
        reason = reason.when(parse_iso_z(F.col(f"`{name}`")).isNull(), f"errored:{name}")
    verdict = F.split(F.coalesce(reason, F.lit("ok:")), ":", 2)
    return (
        rows.withColumn("_verdict", verdict)
        .withColumn("disposition", F.col("_verdict")[0])
        .withColumn("reason", F.col("_verdict")[1])
        .drop("_verdict")
    )


def quarantine(df, keys=NY_MESSAGE_KEY, schema=NY_RAW):
    """Parse messages and mark those whose key is missing or NaN as ``quarantine``."""
    rows = valid_key(parse_trips(df, schema), keys)
    accepted = F.col("valid_key") & ~F.col("malformed")
    return rows.withColumn("disposition", F.when(accepted, "ok").otherwise("quarantine"))


def split_by_tag(df, tag="disposition", data="ok"):
    """Two branches of one tagged stream: data rows and all others."""
    is_data = F.col(tag) == data
    return df.filter(is_data), df.filter(~is_data)


def analytics_rows(messages):
    """Messages with the fields of the area analytics.

    Adds ``area`` (INT, NULL if not a JSON integer), ``start_text``, ``total`` (money),
    ``event_time`` and ``time_fallback`` (the arrival time had to stand in).
    """
    rows = parse_trips(messages, CHICAGO_ANALYTICS)
    kept = [c for c in messages.columns]
    start = F.col("`Trip Start Timestamp`")
    return rows.select(
        *kept,
        "malformed",
        F.col("`Pickup Community Area`").alias("area"),
        start.alias("start_text"),
        fill_total("`Trip Total`").alias("total"),
        event_time(start, "ingest_ts").alias("event_time"),
        iso_event_time(start).isNull().alias("time_fallback"),
    )


def analytics_reason(df):
    """Add ``reason``: the first fault of a row, ``good`` if it has none.

    The area must be a JSON integer; the start time must be there, though it need not
    parse (the arrival time takes its place).
    """
    no_start = F.col("start_text").isNull() | F.col("start_text").isin(NAN_TEXT, "NaN", "nan")
    return df.withColumn(
        "reason",
        F.when(F.col("malformed"), "malformed")
        .when(F.col("area").isNull(), "pickup_area")
        .when(no_start, "timestamp")
        .otherwise("good"),
    )


def raw_area_key(value="value"):
    """The area as sent, for rows already known to have no integer area."""
    text = F.from_json(value, "`Pickup Community Area` STRING")["Pickup Community Area"]
    return F.when(
        F.col("area").isNull(), F.coalesce(F.concat(F.lit("!"), text), F.lit("missing"))
    ).otherwise(F.col("area").cast("string"))
