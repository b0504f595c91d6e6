"""Byte-level BPE through sentencepiece, from a file of ranks.

The sentencepiece model is written here, straight from the vocabulary: each byte string becomes a
piece of printable characters (one per byte), scored by its negative rank, in a BPE model without
normalisation. Merging the best-scored pair first is then merging the lowest rank first, and a
piece's id is its rank.
"""

import base64
import functools
import struct

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripflow.llm.words import WordEncoder, take_runs

# Fixed value: the split before the merges (contractions, letters, digits, others, white space).
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
# Any 256 characters that no normalisation touches would do; white space is avoided.
_BYTE_BASE = 0x4E00
_BYTES = {b: chr(_BYTE_BASE + b) for b in range(256)}
_UNKNOWN = "⁇"


def read_ranks(path):
    """Byte string to rank, of a file with a base64 string and a rank in each line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}


def to_piece(data):
    return data.decode("latin-1").translate(_BYTES)


def _varint(n):
    out = bytearray()
    while n > 127:
        out.append(n & 127 | 128)
        n >>= 7
    return bytes(out + bytes([n]))


def _field(number, value):
    """A protocol-buffer field: int, float, bytes or text."""
    if isinstance(value, int):
        return _varint(number << 3) + _varint(value)
    if isinstance(value, float):
        return _varint(number << 3 | 5) + struct.pack("<f", value)
    data = value.encode() if isinstance(value, str) else value
    return _varint(number << 3 | 2) + _varint(len(data)) + data


def build_model(ranks):
    """Bytes of a sentencepiece BPE model whose ids are the ranks."""
    by_rank = {rank: token for token, rank in ranks.items()}
    if sorted(by_rank) != list(range(len(ranks))):
        raise ValueError("ranks must count from 0 without gaps")
    # Field numbers and enum values of sentencepiece's model format.
    pieces = [
        _field(1, _field(1, to_piece(by_rank[r])) + _field(2, float(-r))) for r in range(len(ranks))
    ]
    unknown = _field(1, _field(1, _UNKNOWN) + _field(2, 0.0) + _field(3, 2))
    no_id = (1 << 64) - 1
    trainer = (
        _field(3, 2) + _field(4, len(ranks) + 1) + _field(40, len(ranks))
        + _field(41, no_id) + _field(42, no_id) + _field(43, no_id) + _field(45, _UNKNOWN)
    )
    normalizer = _field(1, "identity") + _field(3, 0) + _field(4, 0) + _field(5, 0)
    return b"".join(pieces) + unknown + _field(2, trainer) + _field(3, normalizer)


class _Coder:
    """Pre-tokens of the pattern through sentencepiece. There are no special strings."""

    specials = ()

    def __init__(self, ranks_path, pattern):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_proto=build_model(read_ranks(ranks_path)))
        self.split = regex.compile(pattern)

    def texts(self, texts):
        groups = [self.split.findall(t) for t in texts]
        pieces = [to_piece(p.encode()) for g in groups for p in g]
        lists = self.model.encode(pieces, out_type=int, num_threads=1)
        sizes = np.fromiter(map(len, lists), np.int64, len(lists))
        ends = np.concatenate([[0], np.cumsum(sizes)])
        at = np.concatenate([[0], np.cumsum([len(g) for g in groups])]).astype(np.int64)
        return np.fromiter((i for ids in lists for i in ids), np.uint32, int(ends[-1])), np.diff(ends[at])

    def parts(self, parts):
        return self.texts(parts.to_pylist())


@functools.lru_cache(maxsize=2)
def _encoder(ranks_path, pattern):
    return WordEncoder(_Coder(ranks_path, pattern), spaced=True)


@functools.lru_cache(maxsize=2)
def _byte_table(ranks_path):
    """The bytes of all tokens, and where each begins and how long it is."""
    ranks = read_ranks(ranks_path)
    tokens = sorted(ranks, key=ranks.get)
    lengths = np.array([len(t) for t in tokens], np.int64)
    return np.frombuffer(b"".join(tokens), np.uint8), np.cumsum(lengths) - lengths, lengths


def _decode(ids, table):
    flat, starts, lengths = table
    return take_runs(flat, starts[ids], lengths[ids]).tobytes()


def encode_documents(docs, ranks_path, doc_id="doc_id", text="text", pattern=PATTERN, decoded=False):
    """Each document's id, ``n_tokens`` and ``ids`` (little-endian unsigned 32-bit integers); with
    ``decoded`` also the bytes that the ids stand for, by the inverse mapping, in the same pass.

    Whole texts; a null or empty text has no ids; one row out for each row in.
    """
    fields = [
        T.StructField(doc_id, docs.schema[doc_id].dataType), T.StructField("n_tokens", T.LongType()),
        T.StructField("ids", T.BinaryType()),
    ]
    schema = T.StructType(fields + [T.StructField("decoded", T.BinaryType())] * decoded)

    def run(batches):
        encoder = _encoder(ranks_path, pattern)
        for batch in batches:
            for start, stop, ids, counts in encoder.texts(batch.column(1)):
                ends = np.cumsum(counts)
                cuts = list(zip((ends - counts).tolist(), ends.tolist(), strict=True))
                raw = ids.astype("<u4").tobytes()
                columns = [
                    batch.column(0).slice(start, stop - start), pa.array(counts),
                    pa.array([raw[4 * a:4 * b] for a, b in cuts], pa.binary()),
                ]
                if decoded:
                    table = _byte_table(ranks_path)
                    text_bytes = _decode(ids, table)
                    at = np.concatenate([[0], np.cumsum(table[2][ids])])
                    columns.append(pa.array([text_bytes[at[a]:at[b]] for a, b in cuts], pa.binary()))
                yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return docs.select(doc_id, text).mapInArrow(run, schema)


def decode_documents(encoded, ranks_path):
    """Adds ``decoded``: the bytes that a document's ``ids`` stand for. Needs no model."""
    schema = T.StructType([*encoded.schema.fields, T.StructField("decoded", T.BinaryType())])
    column = encoded.columns.index("ids")

    def run(batches):
        table = _byte_table(ranks_path)
        for batch in batches:
            out = [_decode(np.frombuffer(raw.as_py(), "<u4"), table) for raw in batch.column(column)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(out, pa.binary())], names=schema.names
            )

    return encoded.mapInArrow(run, schema)


def round_trip_digests(docs, ranks_path):
    """Encode, decode, and digest both."""
    return encode_documents(docs, ranks_path, decoded=True).select(
        "doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
