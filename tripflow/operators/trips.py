"""Further operators on stored trips."""

from pyspark.sql import functions as F

from tripflow.session import settle


def vehicle_stats(trips):
    """Trips and revenue per vehicle and hour."""
    hour = F.date_trunc("hour", "trip_start_timestamp").alias("hour")
    return trips.groupBy("taxi_id", hour).agg(
        F.count(F.lit(1)).alias("trips"), F.sum("trip_total").alias("revenue")
    )


def mean_trips_per_vehicle(trips):
    """Number of vehicles and mean trips per vehicle, one row."""
    return (
        trips.groupBy("taxi_id")
        .agg(F.count(F.lit(1)).alias("trips"))
        .agg(F.count(F.lit(1)).alias("vehicles"), F.avg("trips").alias("mean_trips"))
    )


def split_hot_cold(trips, now, age="24 hours", column="trip_start_timestamp"):
    """Trips started within ``age`` before ``now``, and the older ones."""
    limit = F.lit(now).cast("timestamp") - F.expr(f"INTERVAL {age}")
    return trips.filter(F.col(column) >= limit), trips.filter(
        (F.col(column) < limit) | F.col(column).isNull()
    )


def dq_rules(df, required=(), ranges=None, unique=None, order_col=None):
    """Add ``reject_reasons``: missing required fields, values out of range, repeats.

    ``unique`` names a key; of the rows with the same key all but the one smallest by
    ``order_col`` (which must be unique) are repeats. Only keys that do repeat are joined
    back, and their smallest order comes from a partial aggregation.
    """
    reasons = [
        F.when(F.col(c).isNull(), F.lit(f"missing {c}")) for c in required
    ] + [
        F.when((F.col(c) < low) | (F.col(c) > high), F.lit(f"range {c}"))
        for c, (low, high) in (ranges or {}).items()
    ]
    rows = df
    if unique:
        repeated = settle(
            df.groupBy(*unique)
            .agg(F.count(F.lit(1)).alias("_n"), F.min(order_col).alias("_first"))
            .filter("_n > 1")
            .drop("_n"),
            "repeated",
        )
        rows = df.join(repeated, unique, "left")
        reasons.append(F.when(F.col(order_col) > F.col("_first"), F.lit("duplicate")))
    return rows.withColumn("reject_reasons", F.array_compact(F.array(*reasons))).select(
        *df.columns, "reject_reasons"
    )


def drop_repeats(df, unique, time_col, within):
    """Streaming form of the repeat rule: keep one row per key within the watermark."""
    return df.withWatermark(time_col, within).dropDuplicatesWithinWatermark(unique)


# The types of a parsed JSON value that each registered type takes. Any scalar can be read as a text,
# so ``string`` takes them all.
_JSON_TYPES = {
    "integer": "^BIGINT$", "number": "^(BIGINT|DOUBLE|DECIMAL.*)$", "boolean": "^BOOLEAN$", "string": "^(?!OBJECT|ARRAY)",
}


def newest_schemas(registry):
    """``tenant, schema_version, fields`` of each tenant's newest version; a field is its name, the
    pattern of its values, and whether it is required. A row per tenant, made by one aggregation."""
    pattern = F.element_at(F.create_map(*[F.lit(x) for pair in _JSON_TYPES.items() for x in pair]), F.col("type"))
    field = F.struct(
        F.col("field").alias("name"), pattern.alias("pattern"), F.coalesce("required", F.lit(False)).alias("required")
    )
    newest = registry.groupBy("tenant").agg(F.max("version").alias("version"))
    return (
        registry.join(newest, ["tenant", "version"]).groupBy("tenant", F.col("version").alias("schema_version"))
        .agg(F.array_sort(F.collect_list(field)).alias("_schema"))
    )


def validate_schema(messages, registry, value="value"):
    """Check messages against the newest registered schema of their tenant.

    ``registry``: tenant, version, field, type, required. Schemas are data: each message is parsed once
    into its fields and joined with its tenant's schema, so the plan is the same for any number of
    tenants and fields, and nothing goes to the driver. Adds ``schema_version`` and ``mismatches``, one
    text per missing or wrongly typed field (a message that is no object has the one text ``not an
    object``). Messages of tenants without a schema are left out.
    """
    schemas = settle(newest_schemas(registry), "schemas")
    # Through a generator: the parse is bound once, however often its fields are looked at.
    types = F.transform_values(
        F.from_json(value, "MAP<STRING, VARIANT>"), lambda _, v: F.nullif(F.schema_of_variant(v), F.lit("VOID"))
    )
    parsed = messages.select("*", F.explode(F.array(types)).alias("_types"))

    def fault(field):
        kind = F.col("_types")[field["name"]]
        return F.when(kind.isNull(), F.when(field["required"], F.concat(F.lit("missing "), field["name"]))).when(
            ~F.rlike(kind, field["pattern"]), F.concat(F.lit("type "), field["name"])
        )

    mismatches = F.when(F.col("_types").isNull(), F.array(F.lit("not an object"))).otherwise(
        F.array_compact(F.transform("_schema", fault))
    )
    return (
        parsed.join(schemas, "tenant").withColumn("mismatches", mismatches)
        .select(*messages.columns, "schema_version", "mismatches")
    )


def encrypt_cols(df, cols, key):
    """Encrypt columns to base64 text (AES-GCM); NULL stays NULL.

    ``key`` is a DataFrame of one row and column, such as the text file of a secret. It is read
    as a scalar subquery when the query runs, so no plan, explain or event log shows it.
    """
    secret = key.scalar()
    return df.withColumns(
        {c: F.base64(F.aes_encrypt(F.col(c).cast("string"), secret)) for c in cols}
    )


def decrypt_cols(df, types, key):
    """Decrypt columns; ``types`` gives each its type, ``key`` as for ``encrypt_cols``."""
    secret = key.scalar()
    return df.withColumns(
        {
            c: F.aes_decrypt(F.unbase64(F.col(c)), secret).cast("string").cast(kind)
            for c, kind in types.items()
        }
    )
