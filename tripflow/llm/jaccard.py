"""Exact Jaccard self-join of word-shingle sets, with count-vector R-trees.

1. Texts become sets of hashed shingles (numpy, whole texts). Each set's shingles go, as packed
   bytes, to the partition of their hash, where the documents per shingle are counted; the shingles
   that several documents hold come back. All documents are counted.
2. A document can link only if that share of its shingles is held elsewhere as the threshold asks;
   the others are done. Equal sets are one node from here on.
3. Two linked sets share a shingle among the first `n - ceil(t * n) + 1` of each, in any order that
   is the same for all; rare ones first, here. So nodes meet in the buckets of those shingles.
4. Each bucket's node with the fewest shingles of its own is its pivot. Every node is compared with
   the pivots of its buckets: a hub and its copies are joined without comparing all pairs.
5. Buckets that still hold nodes of several components get an R-tree: shingles are hashed into
   groups, a node's group counts are a point, a box keeps the largest count per group. The overlap
   of two sets is at most the sum of the coordinates' minima, so boxes and points below the needed
   overlap are cut off; what is left is verified on the sets. Nodes of one component are not compared.
   A bucket over the block size is dealt out as pairs of blocks.
6. Links make components by minimum labels.
"""

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripflow.llm.words import text_slices
from tripflow.session import fresh_dir, settle

SHINGLE = 5
PERCENT = 75
GROUPS = 64
BLOCK = 1024
_FANOUT = 16
_LOW_BYTES = 6
_MULTIPLIER = 0x9E3779B97F4A7C15
_WHITE = r"[ \t\n\x0b\x0c\r]+"
_FAR = np.iinfo(np.int64).max


def _mix(x):
    """A bijection of 64-bit numbers that spreads their bits."""
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
    return x ^ (x >> np.uint64(31))


def shingle_sets(texts, k=SHINGLE):
    """Yield ``(start, stop, sets)`` for runs of an Arrow array of texts: sorted 64-bit hashes of the
    distinct shingles of each. A-Z are lower-cased; with fewer than ``k`` words the whole sequence is
    one shingle; no words or a null: no shingle."""
    import xxhash

    for start, stop in text_slices(texts):
        run = pc.ascii_lower(pa.array(texts.slice(start, stop - start).fill_null("")))
        if pc.any(pc.match_substring_regex(run, r"[\t\x0b\x0c\r]")).as_py():
            run = pc.replace_substring_regex(run, _WHITE, " ")
        words = pc.split_pattern(pc.replace_substring(run, "\n", " "), " ")
        coded = words.flatten().dictionary_encode()
        names = coded.dictionary.to_pylist()
        hashes = np.fromiter((xxhash.xxh3_64_intdigest(w) for w in names), np.uint64, len(names))
        index = coded.indices.to_numpy()
        at = words.offsets.to_numpy().astype(np.int64)
        if "" in names:  # blanks in a row
            real = index != names.index("")
            at = np.concatenate([[0], np.cumsum(real)])[at]
            index = index[real]
        h = hashes[index]
        rolled = np.zeros(max(0, len(h) - k + 1), np.uint64)
        for j in range(k if len(rolled) else 0):
            rolled = rolled * np.uint64(_MULTIPLIER) + h[j:len(h) - k + 1 + j]
        rolled = _mix(rolled)
        sets = []
        for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True):
            if b - a >= k:
                sets.append(np.unique(rolled[a:b - k + 1]))
            elif b > a:
                whole = xxhash.xxh3_64_intdigest(h[a:b].tobytes(), seed=b - a)
                sets.append(np.array([whole], np.uint64))
            else:
                sets.append(np.zeros(0, np.uint64))
        yield start, stop, sets


def least_overlap(n, percent=PERCENT):
    """The fewest shingles that a set of ``n`` shares with any set it links with."""
    return -(-n * percent // 100)


def _low_bytes(values):
    return np.ascontiguousarray(values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :_LOW_BYTES]).tobytes()


def _from_low_bytes(data):
    raw = np.zeros((len(data) // _LOW_BYTES, 8), np.uint8)
    raw[:, :_LOW_BYTES] = np.frombuffer(data, np.uint8).reshape(-1, _LOW_BYTES)
    return raw.view("<u8").reshape(-1)


def _record(schema, **columns):
    arrays = [pa.array(columns[f.name], f.type) for f in schema]
    return pa.RecordBatch.from_arrays(arrays, schema=schema)


def _schemas(id_type):
    """Of what is routed by part, and of the documents."""
    routed = T.StructType([
        T.StructField("part", T.IntegerType()), T.StructField("slice", T.LongType()),
        T.StructField("docs", T.ArrayType(id_type)), T.StructField("sizes", T.ArrayType(T.LongType())),
        T.StructField("nodes", T.ArrayType(T.LongType())), T.StructField("counts", T.BinaryType()),
        T.StructField("tokens", T.BinaryType()), T.StructField("df", T.BinaryType()),
    ])
    documents = T.StructType([
        T.StructField("doc_id", id_type), T.StructField("n", T.LongType()), T.StructField("node", T.LongType()),
        T.StructField("tokens", T.BinaryType()), T.StructField("df", T.BinaryType()),
    ])
    return routed, documents


def _route(parts, k, schema):
    """Shingles of a run of documents, by the upper 16 bits of their hash; and a row on the run."""

    def run(batches):
        import xxhash
        from pyspark import TaskContext

        number = TaskContext.get().partitionId() << 32
        for batch in batches:
            for start, stop, sets in shingle_sets(batch.column(1), k):
                number += 1
                sizes = np.array([len(s) for s in sets], np.int64)
                nodes = [xxhash.xxh3_64_intdigest(s.tobytes()) - (1 << 63) for s in sets]
                yield _record(
                    schema, part=[int(number % parts)], slice=[number],
                    docs=[batch.column(0).slice(start, stop - start).to_pylist()], sizes=[sizes],
                    nodes=[nodes], counts=[None], tokens=[None], df=[None],
                )
                flat = np.concatenate(sets)
                owner = np.repeat(np.arange(len(sets)), sizes)
                part = ((flat >> np.uint64(48)) * np.uint64(parts) >> np.uint64(16)).astype(np.int64)
                order = np.argsort(part, kind="stable")
                flat, owner = flat[order], owner[order]
                cuts = np.searchsorted(part[order], np.arange(parts + 1))
                full = [p for p in range(parts) if cuts[p] < cuts[p + 1]]
                if full:
                    rows = [(slice(cuts[p], cuts[p + 1])) for p in full]
                    yield _record(
                        schema, part=full, slice=[number] * len(full), docs=[None] * len(full),
                        sizes=[None] * len(full), nodes=[None] * len(full),
                        counts=[np.bincount(owner[r], minlength=len(sets)).astype("<u4").tobytes() for r in rows],
                        tokens=[_low_bytes(flat[r]) for r in rows], df=[None] * len(full),
                    )

    return run


def _count(schema):
    """Of each part: the shingles that two or more documents hold, with their number (to 255)."""

    def flush(part, held):
        tokens = [_from_low_bytes(t) for _, _, t in held]
        _, back, counts = np.unique(np.concatenate(tokens), return_inverse=True, return_counts=True)
        df = counts[back]
        at = 0
        for (number, per_doc, _), values in zip(held, tokens, strict=True):
            own = df[at:at + len(values)]
            at += len(values)
            shared = own > 1
            per_doc = np.frombuffer(per_doc, "<u4")
            owner = np.repeat(np.arange(len(per_doc)), per_doc)[shared]
            yield _record(
                schema, part=[part], slice=[number], docs=[None], sizes=[None], nodes=[None],
                counts=[np.bincount(owner, minlength=len(per_doc)).astype("<u4").tobytes()],
                tokens=[_low_bytes(values[shared])],
                df=[np.minimum(own[shared], 255).astype(np.uint8).tobytes()],
            )

    def run(batches):
        part, held = None, []
        for batch in batches:
            for i, row in enumerate(batch.to_pylist()):
                if row["docs"] is not None:
                    yield batch.slice(i, 1)
                    continue
                if row["part"] != part and held:
                    yield from flush(part, held)
                    held = []
                part = row["part"]
                held.append((row["slice"], row["counts"], row["tokens"]))
        if held:
            yield from flush(part, held)

    return run


def _gather(percent, schema):
    """Documents of each slice; with their shared shingles, rare ones first, if they can link."""

    def flush(head, held):
        docs, sizes, nodes = head
        owners, tokens, dfs = [np.zeros(0, np.int64)], [np.zeros(0, np.uint64)], [np.zeros(0, np.uint8)]
        for part, counts, low, df in held:
            counts = np.frombuffer(counts, "<u4")
            owners.append(np.repeat(np.arange(len(counts)), counts))
            tokens.append(_from_low_bytes(low) | np.uint64(part << 48))
            dfs.append(np.frombuffer(df, np.uint8))
        owner, token, df = np.concatenate(owners), np.concatenate(tokens), np.concatenate(dfs)
        order = np.lexsort((token, df, owner))
        owner, token, df = owner[order], token[order].astype("<u8"), df[order]
        cuts = np.searchsorted(owner, np.arange(len(docs) + 1))
        rows = []
        for i, n in enumerate(sizes):
            a, b = cuts[i], cuts[i + 1]
            able = n > 0 and b - a >= least_overlap(n, percent)
            rows.append((token[a:b].tobytes(), df[a:b].tobytes()) if able else (None, None))
        return _record(
            schema, doc_id=docs, n=sizes, node=nodes, tokens=[r[0] for r in rows], df=[r[1] for r in rows]
        )

    def run(batches):
        number, head, held = None, None, []
        for batch in batches:
            for row in batch.to_pylist():
                if row["slice"] != number:
                    if head:
                        yield flush(head, held)
                    number, head, held = row["slice"], None, []
                if row["docs"] is not None:
                    head = row["docs"], row["sizes"], row["nodes"]
                else:
                    held.append((row["part"], row["counts"], row["tokens"], row["df"]))
        if head:
            yield flush(head, held)

    return run


def _prefixes(percent):
    """A row for each prefix shingle that others hold, with the shingles that only the node has."""

    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                n, tokens = row["n"], np.frombuffer(row["tokens"], "<u8")
                alone = n - len(tokens)
                first = n - least_overlap(n, percent) + 1 - alone
                if first > 0:
                    tokens = tokens[:first].view(np.int64)
                    size = len(tokens)
                    yield pa.RecordBatch.from_arrays([
                        pa.array(tokens), pa.array(np.full(size, row["node"])), pa.array(np.full(size, alone)),
                    ], names=["token", "node", "alone"])

    return run


def _verify(percent):
    def run(batches):
        for batch in batches:
            keep = []
            for row in batch.to_pylist():
                a, b = (np.frombuffer(row[c], "<u8") for c in ("a_tokens", "b_tokens"))
                both = len(np.intersect1d(a, b, assume_unique=True))
                keep.append(100 * both >= percent * (row["a_n"] + row["b_n"] - both))
            yield batch.filter(pa.array(keep, pa.bool_())).select(["a", "b"])

    return run


class CountTree:
    """R-tree of points with counts per group: boxes of up to 16 entries, packed by size."""

    def __init__(self, points, sizes, labels, percent):
        self.order = np.lexsort((points.argmax(axis=1), sizes))
        self.percent = percent
        points, sizes, labels = points[self.order], sizes[self.order], labels[self.order]
        # Each level: largest counts, smallest and largest size, the component if it is one.
        self.levels = [(points, sizes, sizes, labels)]
        while len(self.levels[-1][1]) > _FANOUT:
            high, least, most, label = self.levels[-1]
            at = np.arange(0, len(least), _FANOUT)
            same = np.minimum.reduceat(label, at) == np.maximum.reduceat(label, at)
            self.levels.append((
                np.maximum.reduceat(high, at), np.minimum.reduceat(least, at),
                np.maximum.reduceat(most, at), np.where(same, label[at], _FAR),
            ))

    def search(self, point, size, label):
        """Positions of points of other components whose bound reaches the needed overlap."""
        found = np.arange(len(self.levels[-1][1]))
        for depth in range(len(self.levels) - 1, -1, -1):
            high, least, most, own = (x[found] for x in self.levels[depth])
            smallest = np.maximum(least, -(-size * self.percent // 100))
            bound = np.minimum(high, point).sum(axis=1)
            fits = (
                (own != label) & (smallest <= most) & (100 * least <= 10000 * size // self.percent)
                & ((100 + self.percent) * bound >= self.percent * (size + smallest))
            )
            found = found[fits]
            if depth:
                found = (found[:, None] * _FANOUT + np.arange(_FANOUT)).ravel()
                found = found[found < len(self.levels[depth - 1][1])]
        return self.order[found]


def _search(percent):
    """Candidate pairs of a bucket, or of two of its blocks."""

    def flush(rows):
        left, right = [[r for r in rows if r["side"] in s] for s in ((0, 2), (1, 2))]
        if not left or not right:
            return []
        points = np.array([r["groups"] for r in right], np.int64)
        sizes = np.array([r["n"] for r in right], np.int64)
        tree = CountTree(points, sizes, np.array([r["label"] for r in right], np.int64), percent)
        out = []
        for row in left:
            for i in tree.search(np.array(row["groups"], np.int64), row["n"], row["label"]).tolist():
                a, b = row["node"], right[i]["node"]
                if a != b:
                    out.append((min(a, b), max(a, b)))
        return sorted(set(out))

    def run(batches):
        key, held = None, []
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                own = row["token"], row["i"], row["j"]
                if own != key:
                    out += flush(held)
                    key, held = own, []
                held.append(row)
            yield pa.RecordBatch.from_arrays(
                [pa.array([p[0] for p in out], pa.int64()), pa.array([p[1] for p in out], pa.int64())],
                names=["a", "b"],
            )
        out = flush(held)
        if out:
            yield pa.RecordBatch.from_arrays(
                [pa.array([p[0] for p in out]), pa.array([p[1] for p in out])], names=["a", "b"]
            )

    return run


def components(edges, label="components"):
    """``node, label`` of all nodes of the edges ``a, b``: the smallest node that can be reached.

    Each round takes the smallest label of the neighbours, then the label's own label; it is
    written, and one number goes to the driver. A hub's edges are summed before the shuffle.
    """
    both = settle(
        edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(),
        f"{label}-edges",
    )
    labels = settle(
        both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.first("a")).alias("label")), label
    )
    while True:
        near = both.join(labels, both["b"] == labels["node"]).select(F.col("a").alias("node"), "label")
        least = labels.select("node", F.col("label").alias("was"), "label").union(
            near.select("node", F.lit(None).cast("long").alias("was"), "label")
        ).groupBy("node").agg(F.max("was").alias("was"), F.min("label").alias("label"))
        least = settle(least, label)
        jump = least.select(F.col("node").alias("label"), F.col("label").alias("next"))
        labels = settle(least.join(jump, "label").select("node", "was", F.col("next").alias("label")), label)
        if labels.filter(F.col("label") != F.col("was")).isEmpty():
            return labels.select("node", "label")
        labels = labels.select("node", "label")


def _linked(pairs, sets, percent):
    """The pairs that link, of node pairs ``a, b``."""
    one = sets.select(F.col("node").alias("a"), F.col("n").alias("a_n"), F.col("tokens").alias("a_tokens"))
    two = sets.select(F.col("node").alias("b"), F.col("n").alias("b_n"), F.col("tokens").alias("b_tokens"))
    return pairs.join(two, "b").join(one, "a").mapInArrow(_verify(percent), "a long, b long")


def document_sets(docs, k=SHINGLE, percent=PERCENT, doc_id="doc_id", text="text"):
    """``doc_id, n, node`` of all documents: set size and class of equal sets; ``tokens, df`` of those
    that can link. Steps 1 and 2."""
    spark = docs.sparkSession
    parts = min(1 << 16, int(spark.conf.get("spark.sql.shuffle.partitions")))
    routed, documents = _schemas(docs.schema[doc_id].dataType)
    from pyspark.sql.pandas.types import to_arrow_schema

    arrow = to_arrow_schema(routed)
    found = (
        docs.select(doc_id, text).mapInArrow(_route(parts, k, arrow), routed)
        .repartition(parts, "part").sortWithinPartitions("part").mapInArrow(_count(arrow), routed)
        .repartition(parts, "slice").sortWithinPartitions("slice")
        .mapInArrow(_gather(percent, to_arrow_schema(documents)), documents)
    )
    path = fresh_dir(spark, "shingle-sets")
    found.write.parquet(path)
    return spark.read.schema(documents).parquet(path)


def set_links(sets, percent=PERCENT, groups=GROUPS, block=BLOCK):
    """Links ``a, b`` between different nodes, enough to connect all that links connect.
    Steps 3 to 5. ``sets``: from ``document_sets``."""
    sets = settle(
        sets.filter(F.col("tokens").isNotNull()).select("node", "n", "tokens").dropDuplicates(["node"]),
        "candidate-sets",
    )
    entries = settle(
        sets.mapInArrow(_prefixes(percent), "token long, node long, alone long"), "prefix-entries"
    )
    pivots = (
        entries.groupBy("token")
        .agg(F.min(F.struct("alone", "node"))["node"].alias("pivot"), F.count(F.lit(1)).alias("size"))
        .filter("size > 1")
    )
    buckets = settle(entries.join(pivots, "token").select("token", "node", "pivot", "size"), "buckets")
    stars = buckets.filter("node != pivot").select(F.col("node").alias("a"), F.col("pivot").alias("b")).distinct()
    links = settle(_linked(stars, sets, percent), "pivot-links")
    labels = components(links, "pivot-components")
    members = buckets.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    mixed = (
        members.groupBy("token").agg(F.min("label").alias("least"), F.max("label").alias("most"))
        .filter("least < most").select("token")
    )
    points = settle(
        sets.join(members.select("node").distinct(), "node", "left_semi").mapInArrow(
            _points(groups), "node long, n long, groups array<int>"
        ),
        "count-points",
    )
    open_members = settle(
        members.join(mixed, "token").join(points, "node").select("token", "node", "n", "label", "groups", "size"),
        "open-buckets",
    )
    blocks = F.ceil(F.col("size") / block).cast("int")
    own = F.pmod(F.xxhash64("node"), blocks).cast("int")
    dealt = open_members.withColumn("own", own).withColumn(
        "other", F.explode(F.sequence(F.lit(0), blocks - 1))
    ).select(
        "token", "node", "n", "label", "groups", F.least("own", "other").alias("i"),
        F.greatest("own", "other").alias("j"),
        F.when(F.col("own") == F.col("other"), 2).otherwise((F.col("own") > F.col("other")).cast("int")).alias("side"),
    )
    pairs = (
        dealt.repartition("token", "i", "j").sortWithinPartitions("token", "i", "j")
        .mapInArrow(_search(percent), "a long, b long").distinct()
    )
    return links.union(settle(_linked(pairs, sets, percent), "tree-links"))


def _points(groups):
    def run(batches):
        for batch in batches:
            vectors = [
                np.bincount((np.frombuffer(t.as_py(), "<u8") % np.uint64(groups)).astype(np.int64), minlength=groups)
                for t in batch.column(2)
            ]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(vectors, pa.list_(pa.int32()))],
                names=["node", "n", "groups"],
            )

    return run


def join_components(docs, k=SHINGLE, percent=PERCENT, doc_id="doc_id", text="text"):
    """``doc_id, n_shingles, component_id`` of every document: set size, and the smallest id that can
    be reached over links, its own included.

    Two documents link if ``100 * intersection >= percent * union`` of their sets. Null, empty and
    blank texts have no shingles and link with nothing. Repeated rows and equal ids are kept, one
    row out for each row in; null ids count only if a component has no other. Sets are told apart
    by 64-bit hashes.
    """
    found = document_sets(docs, k, percent, doc_id, text)
    labels = components(set_links(found, percent))
    nodes = found.filter("n > 0").groupBy("node").agg(F.min("doc_id").alias("least"))
    least = (
        nodes.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    )
    of_label = least.groupBy("label").agg(F.min("least").alias("component_id"))
    known = settle(least.join(of_label, "label").select("node", "component_id"), "node-components")
    return found.select("doc_id", "n", "node").join(known, "node", "left").select(
        F.col("doc_id").alias(doc_id), F.col("n").alias("n_shingles"),
        F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"),
    )


def keep_one(docs, doc_id="doc_id", text="text"):
    """The documents with one row of each component left: one with its smallest id, and of several such
    rows one of the smallest text. A row with a null id is kept if its component has no id. Rows without
    shingles are all kept. Rows are told apart by a 64-bit hash of id and text."""
    names = docs.columns
    keyed = docs.withColumn(
        "_row", F.xxhash64(F.col(doc_id).isNull(), F.col(doc_id), F.col(text).isNull(), F.col(text))
    )
    found = document_sets(keyed, doc_id="_row", text=text)
    labels = components(set_links(found))
    rows = settle(
        found.filter("n > 0").join(labels, "node", "left").groupBy(F.col("doc_id").alias("_row"))
        .agg(F.min(F.coalesce("label", "node")).alias("_label"), F.count(F.lit(1)).alias("_times")),
        "row-components",
    )
    ids = settle(keyed.select("_row", F.col(doc_id).alias("_id")).distinct().join(rows, "_row"), "row-ids")
    least = ids.groupBy("_label").agg(F.min("_id").alias("_least"))
    firsts = settle(
        ids.join(least, "_label").filter(F.col("_id").eqNullSafe(F.col("_least"))).select("_label", "_row", "_times"),
        "rows-of-least-id",
    )
    first = firsts.groupBy("_label").agg(
        F.count(F.lit(1)).alias("_n"), F.min("_row").alias("_row"), F.min("_times").alias("_times")
    )
    first = settle(first, "first-rows")
    tied = (
        firsts.join(first.filter("_n > 1").select("_label"), "_label")
        .join(keyed.select("_row", F.col(text).alias("_text")), "_row")
        .groupBy("_label").agg(F.min(F.struct("_text", "_row", "_times")).alias("_first"))
        .select("_first._row", "_first._times")
    )
    chosen = settle(first.filter("_n = 1").select("_row", "_times").union(tied), "kept-rows")
    blank = found.filter("n = 0").select(F.col("doc_id").alias("_row")).distinct()
    once = chosen.filter("_times = 1").select("_row").union(blank)
    again = chosen.filter("_times > 1").select("_row")
    kept = keyed.join(settle(once, "single-rows"), "_row", "left_semi").select(*names)
    return kept.union(
        keyed.join(settle(again, "repeated-rows"), "_row", "left_semi").dropDuplicates(["_row"]).select(*names)
    )
