"""Token-ID files of patched frame-of-reference blocks.

A file is a table of segments. A segment holds whole documents and is self-contained:

    "PFR1", block size, ids, blocks (u32 each) | byte offset of each block (u32) | blocks

and a block: minimum u32, width u8, exceptions u16 | the ids minus the minimum, `width` bits each |
positions (u16) and full differences (u32) of the ids that need more bits. The width is that of
the block's 90th percentile. So any block can be read on its own.
"""

import functools
import struct

import numpy as np
import pyarrow as pa
from pyspark.sql import Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripflow.llm.words import TokenizerFile, WordEncoder
from tripflow.session import fresh_dir, settle

MAGIC = b"PFR1"
BLOCK = 512
PERCENTILE = 90
SEGMENT_IDS = 65_536
_HEAD = struct.Struct("<4sIII")
_BLOCK_HEAD = struct.Struct("<IBH")


def _bits(values):
    """Bits that each value needs."""
    return np.where(values > 0, np.frexp(values.astype(np.float64))[1], 0)


def pack_ids(ids, block=BLOCK, percentile=PERCENTILE):
    """A segment's bytes."""
    n = len(ids)
    blocks = -(-n // block)
    lengths = np.full(blocks, block)
    if n % block:
        lengths[-1] = n % block
    values = np.zeros(blocks * block, np.int64)
    values[:n] = ids
    values[n:] = values[n - 1] if n else 0
    values = values.reshape(blocks, block)
    least = values.min(axis=1)
    values -= least[:, None]
    widths = np.zeros(blocks, np.int64)
    if blocks:
        at = -(-block * percentile // 100) - 1
        widths = _bits(np.partition(values, at, axis=1)[:, at])
    odd = values >= (1 << widths)[:, None]
    odd[np.arange(block)[None, :] >= lengths[:, None]] = False
    low = np.where(odd, 0, values).astype("<u4")
    packed = [b""] * blocks
    for width in np.unique(widths).tolist():
        rows = np.flatnonzero(widths == width)
        if width:
            raw = low[rows].view(np.uint8).reshape(-1, 4)[:, :-(-width // 8)]
            bits = np.unpackbits(raw, axis=1, count=width, bitorder="little")
            data = np.packbits(bits.reshape(len(rows), -1), axis=1, bitorder="little")
            for row, line in zip(rows.tolist(), data, strict=True):
                packed[row] = line[: -(-int(lengths[row]) * width // 8)].tobytes()
    odd_row, odd_at = np.nonzero(odd)
    cut = np.searchsorted(odd_row, np.arange(blocks + 1))
    odd_value = values[odd_row, odd_at].astype("<u4")
    odd_at = odd_at.astype("<u2")
    parts, starts, size = [], [], 0
    for k in range(blocks):
        a, b = cut[k], cut[k + 1]
        part = b"".join((
            _BLOCK_HEAD.pack(int(least[k]), int(widths[k]), int(b - a)), packed[k],
            odd_at[a:b].tobytes(), odd_value[a:b].tobytes(),
        ))
        starts.append(size)
        parts.append(part)
        size += len(part)
    return b"".join([_HEAD.pack(MAGIC, block, n, blocks), np.array(starts, "<u4").tobytes(), *parts])


def unpack_ids(segment, first=0, last=None):
    """The ids of blocks ``first`` to ``last`` (exclusive) of a segment."""
    magic, block, n, blocks = _HEAD.unpack_from(segment)
    if magic != MAGIC:
        raise ValueError("not a token segment")
    last = blocks if last is None else min(last, blocks)
    data = _HEAD.size + 4 * blocks
    starts = np.frombuffer(segment, "<u4", blocks, _HEAD.size) if blocks else []
    out = np.zeros((max(0, last - first), block), np.int64)
    by_width: dict[int, list] = {}
    patches = []
    for k in range(first, last):
        at = data + int(starts[k])
        least, width, odd = _BLOCK_HEAD.unpack_from(segment, at)
        length = min(block, n - k * block)
        at += _BLOCK_HEAD.size
        size = -(-length * width // 8)
        if width:
            by_width.setdefault(width, []).append((k - first, at, size))
        if odd:
            patches.append((k - first, at + size, odd))
        out[k - first] = least
    buffer = np.frombuffer(segment, np.uint8)
    for width, rows in by_width.items():
        raw = np.zeros((len(rows), -(-block * width // 8)), np.uint8)
        for i, (_, at, size) in enumerate(rows):
            raw[i, :size] = buffer[at:at + size]
        bits = np.unpackbits(raw, axis=1, bitorder="little")[:, : block * width]
        values = bits.reshape(len(rows), block, width) @ (1 << np.arange(width, dtype=np.int64))
        out[[r[0] for r in rows]] += values
    for row, at, odd in patches:
        where = np.frombuffer(segment, "<u2", odd, at)
        base = out[row, where]  # the packed slot of an exception holds 0
        out[row, where] = base + np.frombuffer(segment, "<u4", odd, at + 2 * odd)
    return out.reshape(-1)[: max(0, min(n, last * block) - first * block)].astype(np.uint32)


@functools.lru_cache(maxsize=2)
def _encoder(tokenizer):
    return WordEncoder(TokenizerFile(tokenizer), spaced=True)


def _write(tokenizer, end_id, id_type):
    schema = pa.schema([
        ("part", pa.int32()), ("seq", pa.int32()), ("first", pa.int64()), ("n_ids", pa.int64()),
        ("docs", pa.list_(id_type)), ("counts", pa.list_(pa.int64())), ("segment", pa.binary()),
    ])

    def run(batches):
        encoder = _encoder(tokenizer)
        docs, counts, held, size, seq, first, part = [], [], [], 0, 0, 0, 0

        def segment():
            ids = np.concatenate(held)
            row = [part], [seq], [first], [len(ids)], [docs], [counts], [pack_ids(ids)]
            return pa.RecordBatch.from_arrays(
                [pa.array(v, f.type) for v, f in zip(row, schema, strict=True)], schema=schema
            )

        for batch in batches:
            if not batch.num_rows:
                continue
            part = batch.column(2)[0].as_py()
            keys = batch.column(0).to_pylist()
            for start, _, ids, lengths in encoder.texts(batch.column(1)):
                ends = np.cumsum(lengths)
                for i, (end, n) in enumerate(zip(ends.tolist(), lengths.tolist(), strict=True)):
                    docs.append(keys[start + i])
                    counts.append(n + 1)
                    held += [ids[end - n:end], np.array([end_id], np.uint32)]
                    size += n + 1
                    if size >= SEGMENT_IDS:
                        yield segment()
                        docs, counts, held, seq, first, size = [], [], [], seq + 1, first + size, 0
        if docs:
            yield segment()

    return run


def write_token_file(docs, path, tokenizer, end_id=0, doc_id="doc_id", text="text"):
    """Write the ids of all documents in ascending ``doc_id`` order, each with ``end_id`` after it.

    Whole texts; a null text is empty, null ids come first, rows with equal ids in order of
    their text. ``tokenizer``: file of the tokenizers library. Texts are range-partitioned once.
    """
    id_type = docs.schema[doc_id].dataType
    schema = T.StructType([
        T.StructField("part", T.IntegerType()), T.StructField("seq", T.IntegerType()),
        T.StructField("first", T.LongType()), T.StructField("n_ids", T.LongType()),
        T.StructField("docs", T.ArrayType(id_type)),
        T.StructField("counts", T.ArrayType(T.LongType())),
        T.StructField("segment", T.BinaryType()),
    ])
    from pyspark.sql.pandas.types import to_arrow_type

    (
        docs.select(F.col(doc_id).alias("id"), F.col(text).alias("text"))
        .repartitionByRange("id")
        .sortWithinPartitions("id", "text")
        .withColumn("part", F.spark_partition_id())
        .mapInArrow(_write(tokenizer, end_id, to_arrow_type(id_type)), schema)
        .write.parquet(path)
    )


def _read(schema):
    def run(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                row = {k: batch.column(k)[i] for k in batch.schema.names}
                ids = unpack_ids(row["segment"].as_py())
                counts = np.array(row["counts"].as_py(), np.int64)
                ends = np.cumsum(counts)
                starts = ends - counts
                raw = ids.astype("<u4").tobytes()
                cuts = zip(starts.tolist(), ends.tolist(), strict=True)
                yield pa.RecordBatch.from_arrays([
                    row["docs"].values, pa.array(starts + row["first"].as_py() + row["offset"].as_py()),
                    pa.array(counts), pa.array([raw[4 * a:4 * b] for a, b in cuts], pa.binary()),
                ], schema=schema)

    return run


def read_token_file(spark, path, doc_id="doc_id"):
    """Documents of a token file: id, ``start`` (ids of all documents before it), ``n_tokens`` and
    ``ids`` (little-endian unsigned 32-bit integers). An empty file gives no rows."""
    from pyspark.sql.pandas.types import to_arrow_schema

    segments = spark.read.parquet(path)
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    # A row per partition that wrote.
    offsets = settle(
        segments.groupBy("part").agg(F.sum("n_ids").alias("n"))
        .select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset")),
        "token-offsets",
    )
    schema = T.StructType([
        T.StructField(doc_id, segments.schema["docs"].dataType.elementType),
        T.StructField("start", T.LongType()), T.StructField("n_tokens", T.LongType()),
        T.StructField("ids", T.BinaryType()),
    ])
    return segments.join(offsets, "part").select("first", "offset", "docs", "counts", "segment").mapInArrow(
        _read(to_arrow_schema(schema)), schema
    )


def token_digests(docs, tokenizer):
    """Write, read back, and digest each document's ids."""
    spark = docs.sparkSession
    path = fresh_dir(spark, "token-file")
    write_token_file(docs, path, tokenizer)
    return read_token_file(spark, path).select(
        "doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32")
    )
