"""Pack tokenised documents into windows by minimum bin slack.

A document longer than a window is cut: full windows, then a rest. Only the lengths of the rests
matter for a plan, and there are fewer lengths than the window has tokens. The plan is made from
the count of each length: a bitset subset-sum program finds the multiset of lengths that fills a
window closest to its capacity, backtracking tells how many of each it takes, and that window is
repeated as often as the counts allow. So a plan is small at any number of documents, and pieces
find their place in it by their number among the pieces of the same length.
"""

import functools
from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripflow.llm.words import TokenizerFile, WordEncoder
from tripflow.session import settle
from tripflow.sources.files import number_rows

WINDOW = 2048
# Packing is the last of a pipeline's stages, in workers that earlier ones have filled.
_KEPT_BYTES = 16_000_000
_RUN_BYTES = 2_500_000


def fullest(counts, capacity):
    """The multiset of lengths, at most ``counts`` of each, whose sum comes closest to ``capacity``.

    Bit s of ``reach`` says that a sum s can be made with the lengths seen so far. Lengths are
    added from long to short; the search ends early when the capacity itself is reached.
    """
    mask = (1 << capacity + 1) - 1
    reach, steps = 1, []
    for length in sorted(counts, reverse=True):
        left = min(counts[length], capacity // length)
        take = 1
        while left > 0:  # 1, 2, 4, ... copies make any number up to the count
            use = min(take, left)
            steps.append((length * use, length, use, reach))
            reach |= reach << length * use & mask
            left -= use
            take *= 2
        if reach >> capacity & 1:
            break
    total = reach.bit_length() - 1
    taken: Counter[int] = Counter()
    for size, length, use, before in reversed(steps):
        if not before >> total & 1:
            taken[length] += use
            total -= size
    return taken


def plan_windows(counts, capacity):
    """Windows for pieces of the given ``{length: count}``: a list of ``(pattern, repeats)`` where a
    pattern is ``{length: count}``. Each takes the longest piece left and fills up the rest.

    Lengths from 1 to ``capacity``. Every piece is used once. The list has at most a few
    entries for each length, as a pattern is repeated until a length runs out.
    """
    left = Counter({k: v for k, v in counts.items() if v > 0})
    plan = []
    while left:
        longest = max(left)
        rest = left.copy()
        rest[longest] -= 1
        room = capacity - longest
        pattern = fullest({k: v for k, v in rest.items() if 0 < v and k <= room}, room) if room else Counter()
        pattern[longest] += 1
        repeats = min(left[k] // n for k, n in pattern.items())
        plan.append((dict(pattern), repeats))
        for k, n in pattern.items():
            left[k] -= n * repeats
            if not left[k]:
                del left[k]
    return plan


def _plan_rows(counts, capacity):
    """``length, from_no, to_no, per_window, first_window, first_offset`` for runs of pieces."""
    used: Counter[int] = Counter()
    window, rows = 0, []
    for pattern, repeats in plan_windows(counts, capacity):
        offset = 0
        for length in sorted(pattern, reverse=True):
            n = pattern[length]
            rows.append((length, used[length], used[length] + n * repeats, n, window, offset))
            used[length] += n * repeats
            offset += n * length
        window += repeats
    return rows


def lower_ascii(words):
    """Words of ASCII in lower case, so that both cases are encoded once."""
    return pc.if_else(pc.string_is_ascii(words), pc.ascii_lower(words), words)


@functools.lru_cache(maxsize=2)
def _encoder(tokenizer):
    return WordEncoder(
        TokenizerFile(tokenizer), spaced=False,
        fold=lower_ascii, limit=_KEPT_BYTES, run_bytes=_RUN_BYTES,
    )


def cut_documents(docs, tokenizer, end_id=1, window=WINDOW, doc_id="doc_id", text="text"):
    """Pieces of all documents: id, ``start`` (ids of its document before it), ``length``, ``ids``
    (little-endian unsigned 32-bit integers) and ``doc_tokens``.

    Whole texts, each followed by ``end_id``; a null text is empty and gives a piece of one id.
    ``tokenizer``: file of a vocabulary with word ends, of the tokenizers library.
    """
    schema = T.StructType([
        T.StructField(doc_id, docs.schema[doc_id].dataType), T.StructField("start", T.LongType()),
        T.StructField("length", T.LongType()), T.StructField("ids", T.BinaryType()),
        T.StructField("doc_tokens", T.LongType()),
    ])
    end = np.array([end_id], "<u4").tobytes()

    def run(batches):
        encoder = _encoder(tokenizer)
        for batch in batches:
            for first, stop, ids, counts in encoder.texts(batch.column(1)):
                raw, ends = ids.astype("<u4").tobytes(), np.cumsum(counts)
                tokens = counts + 1
                pieces = -(-tokens // window)
                owner = np.repeat(np.arange(stop - first), pieces)
                start = (np.arange(len(owner)) - np.repeat(np.cumsum(pieces) - pieces, pieces)) * window
                length = np.minimum(window, tokens[owner] - start)
                base = (ends - counts)[owner] + start
                last = start + length == tokens[owner]
                cuts = zip(base.tolist(), (base + length - last).tolist(), last.tolist(), strict=True)
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(first, stop - first).take(pa.array(owner)),
                    pa.array(start), pa.array(length),
                    pa.array([raw[4 * a:4 * b] + (end if z else b"") for a, b, z in cuts], pa.binary()),
                    pa.array(tokens[owner]),
                ], names=schema.names)

    return docs.select(doc_id, text).mapInArrow(run, schema)


def place_pieces(pieces, order, window=WINDOW):
    """Adds ``sequence_id`` and ``offset`` to rows with a ``length`` from 1 to ``window``.

    ``order``: columns that tell pieces of the same length apart (equal rows may swap). Pass
    narrow rows: they are range-partitioned and written once. A length with a third of all
    pieces is spread over tasks, as pieces are numbered over all lengths. To the driver goes
    the count of each length, at most ``window`` rows.
    """
    spark = pieces.sparkSession
    numbered = number_rows(pieces, ["length", *order])
    lengths = settle(
        numbered.groupBy("length").agg(F.min("row_no").alias("_first"), F.count(F.lit(1)).alias("_n")),
        "piece-lengths",
    )
    counts = {r["length"]: r["_n"] for r in lengths.collect()}
    rows = spark.createDataFrame(
        _plan_rows(counts, window),
        "length long, _from long, _to long, _per long, _window long, _offset long",
    )
    # Runs of one length in a row of their own, so that a piece looks only at its length.
    plan = settle(
        rows.groupBy("length").agg(
            F.sort_array(F.collect_list(F.struct("_from", "_to", "_per", "_window", "_offset"))).alias("_runs")
        ).join(lengths.select("length", "_first"), "length"),
        "packing-plan",
    )
    number = F.col("row_no") - F.col("_first")
    placed = numbered.join(plan, "length").withColumn("_no", number).withColumn(
        "_run", F.filter("_runs", lambda r: (r["_from"] <= F.col("_no")) & (F.col("_no") < r["_to"]))[0]
    )
    within = F.col("_no") - F.col("_run._from")
    return placed.select(
        *pieces.columns,
        (F.col("_run._window") + F.floor(within / F.col("_run._per"))).alias("sequence_id"),
        (F.col("_run._offset") + within % F.col("_run._per") * F.col("length")).alias("offset"),
    )


def packed_pieces(docs, tokenizer, end_id=1, window=WINDOW):
    """Cut, digest and place all documents.

    The narrow rows are written first: range partitioning reads its input twice, and the
    second reading would tokenise again.
    """
    pieces = settle(
        cut_documents(docs, tokenizer, end_id, window).select(
            "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens"
        ),
        "pieces",
    )
    return place_pieces(pieces, ["doc_id", "start", "ids_crc32", "doc_tokens"], window)
