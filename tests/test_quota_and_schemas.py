"""Quota intervals and schema checks against brute force; plans that do not grow with tenants."""

import json
import random

import pytest
from pyspark.sql import functions as F

from tripflow.operators.sla import quota_batches
from tripflow.operators.trips import validate_schema
from tripflow.schemas import AGREEMENT


def agreement(tenant, quota):
    return (tenant, "p", f"/{tenant}", "k", "t", {"csv": True}, 1e9, 1000, 10, quota, 10)


@pytest.mark.parametrize("seed", [1, 2])
def test_quota_intervals(spark, seed):
    rng, quotas = random.Random(seed), {"a": 5.0, "b": 1.5, "c": 0.000001, "d": 1000.0, "e": None, "f": 2.0}
    sizes = {t: [rng.choice([0, 1, 400_000, 1_500_000, 2_070_000, 7_000_000]) for _ in range(rng.randrange(1, 60))] for t in quotas}
    sizes["f"] = [0] * 7 + [2_000_000] + [0] * 3 + [1]
    files = [(t, f"f{i:03}.csv", n, "csv") for t, v in sizes.items() for i, n in enumerate(v)]
    want = set()
    for tenant, quota in quotas.items():
        used, number = 0, 0
        for i, n in enumerate(sizes[tenant]):
            if quota is not None and used >= quota * 1e6:
                used, number = 0, number + 1
            used += n
            want.add((tenant, f"f{i:03}.csv", n, number))
    random.Random(seed).shuffle(files)
    found = quota_batches(
        spark.createDataFrame(files, "tenant STRING, file STRING, bytes LONG, ext STRING"),
        spark.createDataFrame([agreement(t, q) for t, q in quotas.items()], AGREEMENT),
    )
    assert {tuple(r) for r in found.collect()} == want
    assert "collect_list" not in found._jdf.queryExecution().optimizedPlan().toString()


REGISTRY = "tenant STRING, version INT, field STRING, type STRING, required BOOLEAN"


def fits(kind, value):
    if isinstance(value, (dict, list)):
        return False
    number = isinstance(value, (int, float)) and not isinstance(value, bool)
    return {"string": True, "boolean": isinstance(value, bool), "number": number,
            "integer": number and isinstance(value, int)}[kind]


def test_schemas_are_data(spark):
    """500 tenants with schemas of their own: one parse in the plan, the same plan as for two."""
    rng = random.Random(3)
    values = [1, -7, 2.5, 8.0, float("nan"), "8", "x", True, None, {"x": 1}, [1], 10**25 + 0.5]
    registry, schemas, messages, want = [], {}, [], {}
    for t in range(500):
        for version in range(1, 1 + rng.randrange(1, 4)):
            schemas[t] = version, {f"f {k}": (rng.choice(["string", "boolean", "number", "integer"]), rng.choice([True, False, None]))
                                   for k in rng.sample(range(6), rng.randrange(1, 6))}
            registry += [(f"t{t}", version, f, *kind) for f, kind in schemas[t][1].items()]
    for i in range(1500):
        t = rng.randrange(510)
        body = {f"f {k}": rng.choice(values) for k in rng.sample(range(7), rng.randrange(7))}
        text = rng.choice([json.dumps(body)] * 9 + ["no json", "[1]"])
        messages.append((i, f"t{t}", text))
        if t < 500:
            version, fields = schemas[t]
            faults = [] if text.startswith("{") else ["not an object"]
            for f, (kind, required) in sorted(fields.items()) if text.startswith("{") else ():
                if body.get(f) is None:
                    faults += [f"missing {f}"] if required else []
                elif not fits(kind, body[f]):
                    faults.append(f"type {f}")
            want[i] = version, faults
    table = spark.createDataFrame(messages, "seq LONG, tenant STRING, value STRING")
    found = validate_schema(table, spark.createDataFrame(registry, REGISTRY))
    assert {r.seq: (r.schema_version, r.mismatches) for r in found.collect()} == want
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    few = validate_schema(table, spark.createDataFrame([r for r in registry if r[0] in ("t1", "t2")], REGISTRY))
    assert plan.count("from_json") == 1
    assert len(few._jdf.queryExecution().optimizedPlan().toString().splitlines()) == len(plan.splitlines())
    assert validate_schema(table.withColumn("fields", F.lit(1)), spark.createDataFrame([], REGISTRY)).count() == 0
