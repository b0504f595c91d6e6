"""A trie of conversations by their turns.

Turns are digested once (two 64-bit hashes each); from then on all rows are narrow. The digest of a
prefix is the combination of its turns' digests, each taken with its position, so prefixes can be
summed up in pieces: a conversation of any length is never one task's work.

Conversations are grouped by whole blocks of ``BLOCK`` turns first: those with the same digest up to
a block's start are siblings there. Where all siblings have the same block, its turns are nodes
with the same members, and one conversation stands for all. Only where siblings diverge are the
turns inside the block told apart for each of them.

A node belongs to its smallest member, and with it all nodes below that this member passes
through. So the nodes of a conversation are a chain down to its end, chains hang from chains, and
what lies below a node is the rest of its chain and the chains that hang there. Sums over chains
below chains are made by doubling.
"""

import hashlib

import pyarrow as pa
from pyspark.sql import Window
from pyspark.sql import functions as F

from tripflow.session import settle
from tripflow.sources.files import number_rows

BLOCK = 4
FAMILY = 5
HEAD_TURNS = 9
_CHUNK = 1024
_IDS = 4096


def _running(df, key, at, values, combine, aggregate, falling=False):
    """Adds ``{name}_run``: the values of a key's rows up to and with this one, in the order of ``at``.

    In two steps, over chunks of rows and over chunks, so a key with a third of all rows is shared out.
    """
    order = F.desc if falling else F.asc
    df = df.withColumn("_chunk", F.expr(f"{at} div {_CHUNK}"))
    within = Window.partitionBy(key, "_chunk").orderBy(order(at)).rowsBetween(Window.unboundedPreceding, 0)
    before = Window.partitionBy(key).orderBy(order("_chunk")).rowsBetween(Window.unboundedPreceding, -1)
    carried = settle(
        df.groupBy(key, "_chunk").agg(*(aggregate(v).alias(v) for v in values))
        .select(key, "_chunk", *(aggregate(v).over(before).alias(f"_before_{v}") for v in values))
        .filter(F.col(f"_before_{values[0]}").isNotNull()),
        "carried",
    )
    out = df.select("*", *(aggregate(v).over(within).alias(f"_within_{v}") for v in values)).join(
        carried, [key, "_chunk"], "left"
    )
    runs = {
        f"{v}_run": combine(F.col(f"_within_{v}"), F.coalesce(f"_before_{v}", F.lit(0).cast("long"))) for v in values
    }
    return out.withColumns(runs).drop("_chunk", *(f"_{w}_{v}" for w in ("within", "before") for v in values))


def rebuilt_turns(conversations):
    """``(turns, conversations)``: ``conv_id, depth`` (from 1), ``x, y`` (the turn's digests with its
    depth) and ``bytes``; and ``conv_id, length`` of every rebuilt conversation, also without turns.

    Turns stand in the order of ``turn``, null first; turns of the same number in the order of their
    digests. A null role or text is empty. Rows without ``conv_id`` belong to no conversation.
    Conversation c has the first h turns of c - c % 5 (h = crc32 of c in decimals, modulo 9; c % 5 has
    the sign of c), then its own turns after its first h.
    """
    role, text = (F.coalesce(c, F.lit("")) for c in ("role", "text"))
    digested = conversations.filter("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long"), "turn", F.xxhash64(F.lit(1), role, text).alias("a"),
        F.xxhash64(F.lit(2), text, role).alias("b"), F.octet_length(text).cast("long").alias("bytes"),
    )
    numbered = number_rows(digested, ["conv_id", "turn", "a", "b"])
    whole = numbered.groupBy("conv_id").agg(F.min("row_no").alias("first"), F.count(F.lit(1)).alias("n"))
    head = F.crc32(F.col("conv_id").cast("string").cast("binary")) % HEAD_TURNS
    whole = settle(
        whole.withColumns({"head": head, "base": F.col("conv_id") - F.col("conv_id") % FAMILY}), "conversations"
    )
    bases = whole.filter("conv_id = base").select("base", F.col("n").alias("base_n"))
    own_base = F.col("conv_id") == F.col("base")
    taken = F.least("head", F.coalesce("base_n", F.lit(0)))
    facts = settle(
        whole.join(bases, "base", "left").select(
            "conv_id", "first", "base", "head", F.when(own_base, F.col("head")).otherwise(taken).alias("taken"),
            F.when(own_base, F.col("n")).otherwise(taken + F.greatest(F.col("n") - F.col("head"), F.lit(0)))
            .alias("length"),
        ),
        "conversation-facts",
    )
    placed = numbered.join(facts.select("conv_id", "first", "base", "head", "taken"), "conv_id").withColumn(
        "pos", F.col("row_no") - F.col("first")
    )
    own = placed.filter((F.col("conv_id") == F.col("base")) | (F.col("pos") >= F.col("head"))).select(
        "conv_id",
        F.when(F.col("conv_id") == F.col("base"), F.col("pos"))
        .otherwise(F.col("taken") + F.col("pos") - F.col("head")).alias("pos"),
        "a", "b", "bytes",
    )
    # At most eight turns of a base go to its four followers.
    followers = facts.filter("conv_id <> base").select(F.col("conv_id").alias("follower"), "base", "taken")
    lent = (
        placed.filter((F.col("conv_id") == F.col("base")) & (F.col("pos") < HEAD_TURNS - 1))
        .select("base", "pos", "a", "b", "bytes").join(followers, "base").filter("pos < taken")
        .select(F.col("follower").alias("conv_id"), "pos", "a", "b", "bytes")
    )
    depth = F.col("pos") + 1
    turns = own.unionByName(lent).select(
        "conv_id", depth.alias("depth"), F.xxhash64(depth, "a", "b").alias("x"),
        F.xxhash64("b", depth, "a").alias("y"), "bytes",
    )
    return settle(turns, "turns"), facts.select("conv_id", "length")


def _prefix_blocks(turns):
    """``conv_id, block`` with the digests of the prefixes before it (``sx, sy``) and with it (``ex, ey``)."""
    blocks = turns.groupBy("conv_id", F.expr(f"(depth - 1) div {BLOCK}").alias("block")).agg(
        F.bit_xor("x").alias("bx"), F.bit_xor("y").alias("by")
    )
    run = _running(blocks, "conv_id", "block", ["bx", "by"], lambda p, q: p.bitwiseXOR(q), F.bit_xor)
    return settle(
        run.select(
            "conv_id", "block", F.col("bx_run").alias("ex"), F.col("by_run").alias("ey"),
            F.col("bx_run").bitwiseXOR(F.col("bx")).alias("sx"), F.col("by_run").bitwiseXOR(F.col("by")).alias("sy"),
        ),
        "prefix-blocks",
    )


def _nodes(turns, blocks, conversations):
    """Nodes: owner (``conv_id``), ``depth``, ``n_convs``, ``bytes``, the digests of the node (``dx, dy``)
    and of its parent (``px, py``)."""
    at = ["block", "sx", "sy"]
    same = (F.min("ex") == F.max("ex")) & (F.min("ey") == F.max("ey"))
    siblings = blocks.groupBy(*at).agg(
        F.count(F.lit(1)).alias("n"), F.min("conv_id").alias("owner"), same.alias("same")
    )
    # One conversation stands for siblings that agree on the whole block; it counts for all.
    stand_in = settle(
        siblings.filter("same").select(F.col("owner").alias("conv_id"), "block", "sx", "sy", "n"), "stand-ins"
    )
    diverging = settle(siblings.filter("NOT same").select(*at), "diverging")
    told = stand_in.unionByName(
        blocks.join(diverging, at, "left_semi").select("conv_id", "block", "sx", "sy", F.lit(1).cast("long").alias("n"))
    )
    inside = Window.partitionBy("conv_id", "block").orderBy("depth").rowsBetween(Window.unboundedPreceding, 0)
    rows = (
        turns.withColumn("block", F.expr(f"(depth - 1) div {BLOCK}")).join(told, ["conv_id", "block"])
        .withColumns({
            "dx": F.col("sx").bitwiseXOR(F.bit_xor("x").over(inside)),
            "dy": F.col("sy").bitwiseXOR(F.bit_xor("y").over(inside)),
        })
    )
    below = rows.groupBy("depth", "dx", "dy").agg(
        F.min("conv_id").alias("conv_id"), F.sum("n").alias("n_convs"), F.max("bytes").alias("bytes"),
        F.min(F.col("dx").bitwiseXOR(F.col("x"))).alias("px"), F.min(F.col("dy").bitwiseXOR(F.col("y"))).alias("py"),
    )
    zero = F.lit(0).cast("long")
    root = conversations.agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs")).filter(
        "n_convs > 0"
    ).select("conv_id", zero.alias("depth"), "n_convs", *(zero.alias(c) for c in ("bytes", "dx", "dy", "px", "py")))
    return settle(root.unionByName(below), "nodes")


def _hash_ids(batches):
    """The digest of the parts of each node, in their order; constant memory at any number of parts."""
    schema = pa.schema([("depth", pa.int64()), ("dx", pa.int64()), ("dy", pa.int64()), ("ends_sha256", pa.string())])
    key, sha = None, None
    for batch in batches:
        done = []
        for *new, part in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if new == key:
                sha.update(b",")
            else:
                if key:
                    done.append((*key, sha.hexdigest()))
                key, sha = new, hashlib.sha256()
            sha.update(part.encode())
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*done, strict=True)], schema=schema)
    if key:
        yield pa.RecordBatch.from_arrays([pa.array([v]) for v in (*key, sha.hexdigest())], schema=schema)


def _ends(blocks, conversations):
    """``depth, dx, dy, ends_sha256`` of nodes where conversations end: their ids, ascending, comma-joined.

    Ids are joined in parts of a few thousand, wherever they lie; SHA-256 reads the parts of a node
    one after the other.
    """
    last = blocks.groupBy("conv_id").agg(F.max(F.struct("block", "ex", "ey")).alias("last"))
    zero = F.lit(0).cast("long")
    ends = conversations.join(last, "conv_id", "left").select(
        F.col("length").alias("depth"), F.coalesce("last.ex", zero).alias("dx"), F.coalesce("last.ey", zero).alias("dy"),
        "conv_id",
    )
    node = ["depth", "dx", "dy"]
    parts = number_rows(ends, [*node, "conv_id"]).groupBy(*node, F.expr(f"row_no div {_IDS}").alias("part")).agg(
        F.array_join(F.transform(F.array_sort(F.collect_list("conv_id")), lambda c: c.cast("string")), ",").alias("ids")
    )
    return (
        parts.repartition(*node).sortWithinPartitions(*node, "part").select(*node, "ids")
        .mapInArrow(_hash_ids, "depth long, dx long, dy long, ends_sha256 string")
    )


def _below(chains):
    """``conv_id, saved, leaves`` over each chain and all chains that hang from it, at any distance.

    ``chains``: ``conv_id, up`` (the chain it hangs from; null: none), ``saved, leaves`` of its own. A round
    doubles the distance covered, so rounds are the logarithm of the chains passed on the way down.
    """
    while True:
        hanging = chains.filter("up IS NOT NULL")
        if hanging.isEmpty():
            return chains.drop("up")
        gain = hanging.groupBy(F.col("up").alias("conv_id")).agg(
            F.sum("saved").alias("_saved"), F.sum("leaves").alias("_leaves")
        )
        # Chains below one that hangs from nothing are through; that leaves out the most frequent name.
        further = hanging.select(F.col("conv_id").alias("up"), F.col("up").alias("_next"))
        chains = settle(
            chains.join(gain, "conv_id", "left").join(further, "up", "left").select(
                "conv_id", F.col("_next").alias("up"),
                *((F.col(c) + F.coalesce(f"_{c}", F.lit(0))).alias(c) for c in ("saved", "leaves")),
            ),
            "chains",
        )


def trie_nodes(turns, conversations):
    """All nodes of the trie of ``rebuilt_turns``; no conversations give no nodes."""
    blocks = _prefix_blocks(turns)
    nodes = _nodes(turns, blocks, conversations)
    # Where each chain begins, and the node it hangs from.
    tops = nodes.groupBy("conv_id").agg(
        F.min(F.struct("depth", "px", "py")).alias("top"), F.max("depth").alias("end"),
        F.sum((F.col("n_convs") - 1) * F.col("bytes")).alias("saved"),
    )
    parents = nodes.select(
        (F.col("depth") + 1).alias("top_depth"), F.col("dx").alias("px"), F.col("dy").alias("py"),
        F.col("conv_id").alias("up"),
    )
    tops = settle(
        tops.select("conv_id", "end", "saved", F.col("top.depth").alias("top_depth"), "top.px", "top.py")
        .join(parents, ["top_depth", "px", "py"], "left")
        .select("conv_id", "end", "saved", "top_depth", F.when(F.col("top_depth") > 0, F.col("up")).alias("up")),
        "chain-tops",
    )
    joints = settle(
        tops.filter("top_depth > 0").groupBy(F.col("up").alias("conv_id"), (F.col("top_depth") - 1).alias("depth"))
        .agg(F.count(F.lit(1)).alias("hung")),
        "joints",
    )
    leaf = tops.select("conv_id", F.col("end").alias("depth")).join(joints, ["conv_id", "depth"], "left_anti")
    chains = tops.join(leaf.select("conv_id", F.lit(1).cast("long").alias("leaf")), "conv_id", "left").select(
        "conv_id", "up", "saved", F.coalesce("leaf", F.lit(0)).cast("long").alias("leaves")
    )
    chains = settle(chains, "chains")
    totals = _below(chains)
    hung = tops.filter("top_depth > 0").select("conv_id", "up", "top_depth").join(totals, "conv_id").groupBy(
        F.col("up").alias("conv_id"), (F.col("top_depth") - 1).alias("depth")
    ).agg(F.count(F.lit(1)).alias("hung"), F.sum("saved").alias("hung_saved"), F.sum("leaves").alias("hung_leaves"))
    rows = (
        nodes.join(hung, ["conv_id", "depth"], "left").fillna(0, ["hung", "hung_saved", "hung_leaves"])
        .join(tops.select("conv_id", "end", "top_depth", "up"), "conv_id")
        .withColumn("n_children", F.col("hung") + (F.col("depth") < F.col("end")).cast("long"))
        .withColumns({
            "saved": (F.col("n_convs") - 1) * F.col("bytes") + F.col("hung_saved"),
            "leaves": F.col("hung_leaves") + (F.col("n_children") == 0).cast("long"),
        })
    )
    summed = _running(rows, "conv_id", "depth", ["saved", "leaves"], lambda p, q: p + q, F.sum, falling=True)
    ends = _ends(blocks, conversations)
    parent = F.when(F.col("depth") > F.col("top_depth"), F.col("conv_id")).otherwise(F.col("up"))
    return summed.join(ends, ["depth", "dx", "dy"], "left").select(
        "conv_id", "depth", parent.alias("parent_conv_id"), "n_convs", "n_children",
        F.col("leaves_run").alias("n_leaves"), F.col("saved_run").alias("saved_tokens"),
        F.coalesce("ends_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("ends_sha256"),
    )


def trie_report(conversations):
    """The trie of the rebuilt conversations: a row for each node."""
    return trie_nodes(*rebuilt_turns(conversations))
