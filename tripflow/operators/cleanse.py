"""Parsing, renaming, casting and cleaning of trip rows."""

import re

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripflow.functions.times import parse_us_12h
from tripflow.schemas import CHICAGO_UNUSED, MONEY

# Message keys that become columns of a dynamic table, at most; the others stay in this map column.
MOST_COLUMNS = 500
OVERFLOW = "more_fields"


def drop_unused(df, columns=CHICAGO_UNUSED):
    """Drop the columns no table keeps; absent ones are ignored."""
    return df.drop(*columns)


def snake_name(name):
    return re.sub(r" +", "_", name.lower())


def snake_columns(df):
    """Lower-case column names with each run of spaces turned into one underscore."""
    return df.toDF(*[snake_name(name) for name in df.columns])


def parse_trips(df, schema, value="value"):
    """Add the fields of a JSON message, typed by ``schema``, and a ``malformed`` flag.

    A field of the wrong type becomes NULL and the row stays. ``malformed`` is set where the
    text is not exactly one JSON object: text after it, a second object, and single quotes
    count. That second look, on the text as the only element of an array, is taken for rows in
    which something did not fit and for texts with more braces than a flat object has.
    """
    strict = {"allowSingleQuotes": "false"}
    parsed = F.from_json(
        value, f"{schema}, _misfit STRING", {"columnNameOfCorruptRecord": "_misfit", **strict}
    )
    alone = F.from_json(
        F.concat(F.lit("["), value, F.lit("]")), "ARRAY<MAP<STRING, STRING>>", strict
    )
    is_object = F.coalesce((F.size(alone) == 1) & F.get(alone, 0).isNotNull(), F.lit(False))
    is_flat = F.rlike(value, F.lit(r"\A\s*\{[^{}]*\}\s*\z"))
    return (
        # The generator keeps filters on the fields above it. Pushed below, they would
        # parse each message again for every field they test.
        df.select("*", F.inline(F.array(parsed)))
        .withColumn(
            "malformed",
            F.when(F.col(value).isNull(), True)
            .when(F.col("_misfit").isNull() & is_flat, False)
            .otherwise(~is_object),
        )
        .drop("_misfit")
    )


def nan_to_null(df):
    """NaN becomes NULL in every floating-point column."""
    floating = {
        f.name
        for f in df.schema.fields
        if isinstance(f.dataType, (T.DoubleType, T.FloatType))
    }
    return df.select(
        *[
            F.when(~F.isnan(F.col(f"`{c}`")), F.col(f"`{c}`")).alias(c)
            if c in floating
            else F.col(f"`{c}`")
            for c in df.columns
        ]
    )


def fill_area(df, value=-1.0, column="pickup_community_area"):
    """Trips without a pickup area get a fixed area, so the key is never NULL."""
    return df.fillna({column: value})


def cast_trips(df, spec):
    """Cast columns by name: a type name, or a function of the column for texts of times."""
    return df.withColumns(
        {
            name: kind(F.col(name)) if callable(kind) else F.col(name).try_cast(kind)
            for name, kind in spec.items()
            if name in df.columns
        }
    )


def whole_number(c):
    """An INT from a number that may be written as ``1749.0``; NULL if it is not whole or too large."""
    number = F.col(c) if isinstance(c, str) else c
    return F.when(number == F.floor(number), number.try_cast("int"))


# Column types of the staged Chicago files; their times are US 12-hour texts.
CHICAGO_CASTS = {
    "trip_seconds": whole_number,
    "trip_start_timestamp": parse_us_12h,
    "trip_end_timestamp": parse_us_12h,
    "pickup_community_area": "double",
    "dropoff_community_area": "double",
}


def fill_total(c):
    """Money of a trip total: missing, NaN or out of range counts as 0."""
    total = F.col(c) if isinstance(c, str) else c
    return F.coalesce(
        F.when(~F.isnan(total), total.try_cast(MONEY)), F.lit(0).cast(MONEY)
    )


def message_columns(messages, value="value", unused=CHICAGO_UNUSED, known=(), most=MOST_COLUMNS):
    """``(columns, beyond)``: column name -> message keys, and whether there are keys besides.

    A key of one of the ``known`` columns has that column. Of the others the most frequent have
    columns, so that no more than ``most`` keys reach the driver and the schema; all further ones
    stay in the map column ``OVERFLOW``.
    """
    fields = F.from_json(value, "MAP<STRING, STRING>")
    name = F.lower(F.regexp_replace("key", " +", "_"))
    keys = (
        messages.select(F.explode(F.map_keys(fields)).alias("key"))
        .filter(~F.col("key").isin(unused) & (name != OVERFLOW))
        .groupBy("key").agg(F.count(F.lit(1)).alias("n"))
        .orderBy(F.desc(name.isin(list(known))), F.desc("n"), "key")
        .limit(most + 1)
        .collect()
    )
    columns: dict[str, list[str]] = {}
    for key in sorted(row.key for row in keys[:most]):
        columns.setdefault(snake_name(key), []).append(key)
    return columns, len(keys) > most or OVERFLOW in known


def with_message_fields(messages, value="value"):
    """Add ``_fields``, the message as a map of texts; NULL if it is no JSON object."""
    fields = F.from_json(value, "MAP<STRING, STRING>")
    return messages.select("*", F.explode(F.array(fields)).alias("_fields"))


def message_texts(columns, beyond=False, unused=CHICAGO_UNUSED):
    """The columns found by ``message_columns``, taken from ``_fields``; with ``beyond`` all other keys
    in one map column."""
    named = [key for keys in columns.values() for key in keys]
    rest = F.map_filter("_fields", lambda key, _: ~key.isin([*named, *unused]))
    return [F.when(F.size(rest) > 0, rest).alias(OVERFLOW)] * beyond + [
        # JSON NaN comes out of the map as the quoted text.
        F.nullif(F.coalesce(*[F.col("_fields")[key] for key in keys]), F.lit('"NaN"')).alias(name)
        for name, keys in columns.items()
    ]


def evolve_columns(df, messages, value="value"):
    """Append messages to a table; message keys the table lacks become new text columns, the
    most frequent ones, and the others stay in a map (``message_columns``).

    ``df`` may be None for a table that does not exist yet. Batch only.
    """
    known = {f.name: f.dataType for f in df.schema.fields} if df is not None else {}
    columns, beyond = message_columns(messages, value, known=known)
    rows = (
        with_message_fields(messages, value)
        .filter("_fields IS NOT NULL")
        .select(*message_texts(columns, beyond))
    )
    if df is None:
        return rows
    rows = rows.select(
        *[F.col(c).try_cast(known[c]).alias(c) if c in known else F.col(c) for c in rows.columns]
    )
    return df.unionByName(rows, allowMissingColumns=True)
