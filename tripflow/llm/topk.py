"""Exact top-k inner products over whole-number vectors, pruned by norms and rotated partial sums.

Vectors are sorted by descending length and cut into blocks. Queries are scored against the first
block; the k-th score is a bound that any other vector must reach. By Cauchy-Schwarz, blocks whose
longest vector cannot reach it for any query of a block of queries are not visited. In a visited
block, vectors are rotated by the singular vectors of all data, which puts most of a product into
the first coordinates; after some of them, the product of the residual lengths bounds the rest, and
pairs below the bound are dropped. What is left is scored in whole numbers.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import Window
from pyspark.sql import functions as F

from tripflow.session import settle
from tripflow.sources.files import number_rows

SCALE = 64
TOP = 20
QUERY_STRIDE = 20
BLOCK = 1024
QUERY_BLOCK = 256
_LEVELS = 256
_EXACT = float(1 << 53)


def whole_vectors(rows, vec_id="vec_id", vector="embedding", scale=SCALE):
    """``vec_id, vector`` with each component x as ``floor(scale * x)``, x as double.

    Null vectors, vectors with a null or non-finite component, and null ids take no part; repeated
    rows count once. Shorter vectors count as padded with zeros; an empty one has only zeros.
    """
    fine = F.forall(vector, lambda x: x.isNotNull() & (F.abs(x.cast("double")) < float("inf")))
    return (
        rows.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(vector).alias("vector"))
        .filter(F.col("vec_id").isNotNull() & F.col("vector").isNotNull())
        .withColumnRenamed("vector", vector).filter(fine)
        .select("vec_id", F.transform(vector, lambda x: F.floor(x.cast("double") * scale)).alias("vector"))
        .dropDuplicates()
    )


def _matrix(vectors, width):
    """Rows of lists as a matrix of doubles, zeros at the end of short ones."""
    out = np.zeros((len(vectors), width))
    for i, v in enumerate(vectors):
        out[i, :len(v)] = v
    return out


def _gram(width):
    def run(batches):
        total = np.zeros((width, width))
        for batch in batches:
            m = _matrix(batch.column(0).to_pylist(), width)
            total += m.T @ m
        i, j = np.nonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(i), pa.array(j), pa.array(total[i, j])], names=["i", "j", "v"])

    return run


def rotation(vectors, width):
    """Right singular vectors of all vectors, the strongest first: width x width numbers pass the driver."""
    gram = np.zeros((width, width))
    sums = vectors.select("vector").mapInArrow(_gram(width), "i long, j long, v double")
    for row in sums.groupBy("i", "j").agg(F.sum("v").alias("v")).collect():
        gram[row["i"], row["j"]] = row["v"]
    return np.linalg.eigh(gram)[1][:, ::-1].copy()


def _exact_scores(queries, vectors):
    """Whole-number products; beyond what doubles hold exactly, by Python's numbers."""
    limit = np.abs(queries).max(initial=0) * np.abs(vectors).max(initial=0) * queries.shape[1]
    if limit < _EXACT:
        return (queries @ vectors.T).astype(np.int64)
    return (queries.astype(object) @ vectors.T.astype(object)).astype(np.int64)


def _candidates(queries, vectors, turned_q, turned_v, least):
    """Which pairs may reach ``least``: partial sums plus the product of the residual lengths."""
    width = queries.shape[1]
    alive = np.ones((len(queries), len(vectors)), bool)
    q_len, v_len = np.linalg.norm(queries, axis=1), np.linalg.norm(vectors, axis=1)
    slack = 1e-9 * np.outer(q_len, v_len) + 1e-6
    done, partial = 0, np.zeros(alive.shape)
    for stop in (width // 4, width // 2):
        if stop <= done:
            continue
        partial += turned_q[:, done:stop] @ turned_v[:, done:stop].T
        done = stop
        rest = np.outer(
            np.linalg.norm(turned_q[:, done:], axis=1), np.linalg.norm(turned_v[:, done:], axis=1)
        )
        alive &= partial + rest + slack >= least[:, None]
        if not alive.any():
            break
    return alive


def _score(turn, top):
    """The best of each query in a block, from rows of a block of vectors and a block of queries."""
    width = len(turn)

    def run(batches):
        held = None
        for batch in batches:
            out = [[], [], []]
            for i in range(batch.num_rows):
                row = {c: batch.column(c)[i] for c in batch.schema.names}
                if held is None or held[0] != row["block"].as_py():
                    vectors = _matrix(row["vectors"].as_py(), width)
                    held = row["block"].as_py(), np.array(row["vec_ids"].as_py(), np.int64), vectors, vectors @ turn
                _, vec_ids, vectors, turned = held
                query_ids = np.array(row["query_ids"].as_py(), np.int64)
                queries = _matrix(row["queries"].as_py(), width)
                least = np.array(row["least"].as_py(), np.float64)
                alive = _candidates(queries, vectors, queries @ turn, turned, least)
                some = np.flatnonzero(alive.any(axis=0))
                scores = _exact_scores(queries, vectors[some])
                for q in range(len(query_ids)):
                    fits = alive[q, some] & (vec_ids[some] != query_ids[q]) & (scores[q] >= least[q])
                    ids, own = vec_ids[some][fits], scores[q][fits]
                    best = np.lexsort((ids, -own))[:top]
                    out[0].append(np.full(len(best), query_ids[q]))
                    out[1].append(ids[best])
                    out[2].append(own[best])
            if out[0]:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(c).astype(np.int64)) for c in out],
                    names=["query_id", "vec_id", "score"],
                )

    return run


def _best(found, top):
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)


def top_products(rows, queries, top=TOP, vec_id="vec_id", vector="embedding", scale=SCALE, block=BLOCK):
    """``query_id, rank, vec_id, score``: each query's ``top`` largest products with all other ids.

    ``queries``: a condition on ``vec_id``. Ties go to the smaller id. See ``whole_vectors`` for what
    takes part. Queries go in blocks to the blocks of vectors they may need; per block at most
    ``top`` rows of a query come back. To the driver go the rotation and at most 256 lengths.
    """
    spark = rows.sparkSession
    vectors = whole_vectors(rows, vec_id, vector, scale).withColumn(
        "down", -F.sqrt(F.aggregate("vector", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double")))
    )
    vectors = settle(number_rows(vectors, ["down", "vec_id", "vector"]), "sorted-vectors")
    width, n = vectors.agg(F.coalesce(F.max(F.size("vector")), F.lit(0)), F.count(F.lit(1))).first()
    turn = rotation(vectors, width) if width else np.zeros((0, 0))
    n_blocks = max(1, -(-n // block))
    packed = settle(
        vectors.withColumn("block", F.expr(f"row_no div {block}")).groupBy("block").agg(
            F.min("down").alias("down"), F.sort_array(F.collect_list(F.struct("vec_id", "vector"))).alias("v")
        ).select(
            "block", (-F.col("down")).alias("longest"), F.col("v.vec_id").alias("vec_ids"), F.col("v.vector").alias("vectors")
        ),
        "vector-blocks",
    )
    asked = vectors.filter(queries).withColumnRenamed("vec_id", "query_id")
    score = _score(turn, top)
    found_type = "query_id long, vec_id long, score long"

    def against(query_blocks):
        return query_blocks.join(packed, "block").select(
            "block", "vec_ids", "vectors", "query_ids", "queries", "least"
        ).sortWithinPartitions("block").mapInArrow(score, found_type)

    def blocks_of(asked, key):
        return asked.groupBy(key.alias("query_block")).agg(
            F.collect_list(F.struct("query_id", "vector", "least", "needed")).alias("q")
        ).select(
            F.col("q.query_id").alias("query_ids"), F.col("q.vector").alias("queries"),
            F.col("q.least").alias("least"), F.array_min("q.needed").alias("needed"),
        )

    key = F.expr(f"row_no div {block * QUERY_BLOCK // 64}")
    first = blocks_of(
        asked.withColumns({"least": F.lit(float("-inf")), "needed": F.lit(0.0)}), key
    ).withColumn("block", F.lit(0).cast("long"))
    head = settle(_best(against(first), top).drop("rank"), "head-scores")
    bounds = head.groupBy("query_id").agg(F.count(F.lit(1)).alias("n"), F.min("score").alias("kth"))
    least = F.when(F.col("n") >= top, F.col("kth").cast("double")).otherwise(F.lit(float("-inf")))
    # A vector shorter than this cannot reach the bound.
    needed = F.when((least > 0) & (F.col("down") < 0), least / -F.col("down")).otherwise(F.lit(0.0))
    bounded = asked.join(settle(bounds, "query-bounds"), "query_id", "left").withColumn("least", least).withColumn(
        "needed", needed * (1 - 1e-9)
    )
    step = -(-n_blocks // _LEVELS)
    lengths = [
        r["longest"] for r in packed.filter(F.col("block") % step == 0).orderBy("block").select("longest").collect()
    ]
    level = F.array(*[F.lit(float(x)) for x in lengths]) if lengths else F.array(F.lit(0.0))
    reach = F.size(F.filter(level, lambda x: x >= F.col("needed"))) * step - 1
    rest = blocks_of(bounded, key).withColumn("last", F.least(reach, F.lit(n_blocks - 1))).filter("last >= 1")
    rest = rest.withColumn("block", F.explode(F.sequence(F.lit(1).cast("long"), F.col("last").cast("long"))))
    found = _best(head.union(against(rest)), top)
    return found.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def top_report(embeddings):
    return top_products(embeddings, F.col("vec_id") % QUERY_STRIDE == 0)
