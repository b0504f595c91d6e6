"""Running aggregates over a key's rows without a task that holds them all."""

from pyspark.sql import Window
from pyspark.sql import functions as F

# Stretches of 65,536 numbers on three levels span 2^48 numbers.
BITS = 16
LEVELS = 3


def running(df, keys, at, value, aggregate, falling=False, bits=BITS, levels=LEVELS):
    """``keys, at`` and ``value``: the aggregate of a key's values up to and with each row.

    Rows are ordered by the whole number ``at``, from above with ``falling``; one row per key and
    ``at``. A tree of ``levels``: windows hold stretches of ``2 ** bits`` numbers, then as many
    stretches, and so on, so no window holds a key's history, at any spread of the numbers from
    ``-2 ** (bits * levels - 1)`` to the same above. ``aggregate`` must be associative and skip
    nulls (min, max, sum, bit_xor); it also joins the parts. ``df`` is read once a level: hand in
    a written table.
    """
    order = (F.desc if falling else F.asc)("_at")
    rows = df.select(*keys, F.col(at).alias("_at"), F.col(value).alias("_value"))
    return _level(rows, keys, aggregate, order, bits, levels, True).select(
        *keys, F.col("_at").alias(at), F.col("_run").alias(value)
    )


def _level(rows, keys, aggregate, order, bits, levels, inclusive):
    # On top, numbers on both sides of 0 are one stretch.
    shift = 1 << bits - 1 if levels == 1 else 0
    rows = rows.withColumn("_stretch", F.shiftright(F.col("_at") + shift, bits))
    frame = Window.partitionBy(*keys, "_stretch").orderBy(order).rowsBetween(
        Window.unboundedPreceding, Window.currentRow if inclusive else -1
    )
    within = rows.withColumn("_run", aggregate("_value").over(frame))
    if levels == 1:
        return within.drop("_stretch")
    above = rows.groupBy(*keys, F.col("_stretch").alias("_at")).agg(aggregate("_value").alias("_value"))
    carried = _level(above, keys, aggregate, order, bits, levels - 1, False).select(
        *keys, F.col("_at").alias("_stretch"), F.col("_run").alias("_carried")
    )
    return within.join(carried, [*keys, "_stretch"]).withColumn("_run", _both(aggregate)).drop("_stretch", "_carried")


def _both(aggregate):
    """The aggregate of the two parts; null is none."""
    joins = {
        "min": F.least, "max": F.greatest, "sum": lambda a, b: F.coalesce(a + b, a, b),
        "bit_xor": lambda a, b: F.coalesce(a.bitwiseXOR(b), a, b),
    }
    return joins[aggregate.__name__](F.col("_run"), F.col("_carried"))
