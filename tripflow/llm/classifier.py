"""Quality classifier: supervised subword embeddings.

A document is the average of its words, a word the average of the learned vectors of its hashed
character n-grams and of itself; a softmax over two classes is on top. Training is stochastic
gradient descent in numpy on a bounded sample of labelled documents. As nothing stands between the
average and the softmax, the trained model folds to one number per hash bucket, which is what goes to
the executors (its size is a parameter).
"""

import dataclasses

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripflow.llm.words import text_slices

#: At most so many labelled documents are fitted on; they are chosen by a hash of the id.
SAMPLE_ROWS = 4_000
SAMPLE_BYTES = 64_000_000
SAMPLE_TEXT_BYTES = 1_000_000
CUT = 0.3
GRAMS = (2, 3)
# Bytes of text worked on at a time; a word has several features of eight bytes each.
_SLICE_BYTES = 1_000_000
_PRIME = np.uint64(0x100000001B3)
_SEED = np.uint64(0xCBF29CE484222325)


@dataclasses.dataclass(frozen=True)
class Settings:
    buckets: int = 1 << 17
    dim: int = 12
    epochs: int = 6
    rate: float = 2.0
    batch: int = 16
    seed: int = 7


def _hash_runs(codes, starts, lengths, salt):
    """A hash of each run of code points."""
    out = np.full(len(starts), _SEED ^ np.uint64(salt), np.uint64)
    order = np.argsort(-lengths, kind="stable")
    starts, lengths = starts[order], lengths[order]
    alive = len(starts)
    for step in range(int(lengths[0]) if alive else 0):
        alive = int(np.searchsorted(-lengths, -step, "left"))
        picked = order[:alive]
        out[picked] = (out[picked] ^ codes[starts[:alive] + step]) * _PRIME
    return out ^ (out >> np.uint64(29))


def word_features(words, buckets):
    """``(features, counts)``: hash buckets of each word's n-grams and of the word, word after word.

    Words are taken with marks at both ends, and by code points.
    """
    codes = np.frombuffer("".join(f"<{w}>" for w in words).encode("utf-32-le", "surrogatepass"), np.uint32)
    codes = codes.astype(np.uint64)
    lengths = np.fromiter((len(w) + 2 for w in words), np.int64, len(words))
    starts = np.cumsum(lengths) - lengths
    owner = np.repeat(np.arange(len(words)), lengths)
    left = np.repeat(starts + lengths, lengths) - np.arange(len(codes))  # code points up to the word's end
    found, owners = [_hash_runs(codes, starts, lengths, 0)], [np.arange(len(words))]
    for n in GRAMS:
        at = np.flatnonzero(left >= n)
        gram = np.full(len(at), _SEED ^ np.uint64(n), np.uint64)
        for k in range(n):
            gram = (gram ^ codes[at + k]) * _PRIME
        found.append(gram ^ (gram >> np.uint64(29)))
        owners.append(owner[at])
    features, owners = np.concatenate(found) % np.uint64(buckets), np.concatenate(owners)
    order = np.argsort(owners, kind="stable")
    return features[order].astype(np.int64), np.bincount(owners, minlength=len(words))


def _coded(texts):
    """Words of texts (blanks and line ends part them): index of each, the words, bounds per text."""
    plain = pc.replace_substring_regex(texts, r"[ \t\n\x0b\x0c\r]+", " ")
    words = pc.split_pattern(plain, " ")
    coded = words.flatten().dictionary_encode()
    return coded.indices.to_numpy().astype(np.int64), coded.dictionary.to_pylist(), words.offsets.to_numpy()


def _run_sums(values, at):
    """Sums of the runs between the bounds."""
    return np.diff(np.concatenate([[0.0], np.cumsum(values)])[at])


def _sample_matrix(texts, buckets):
    """Sparse rows of the documents: features, weights (that sum to 1), bounds.

    Made from runs of texts, so that only the rows themselves are held for all.
    """
    columns, weights, bounds = [], [], [0]
    for start, stop in text_slices(texts, _SLICE_BYTES):
        index, words, at = _coded(pa.array(texts.slice(start, stop - start)))
        features, counts = word_features(words, buckets)
        ends = np.cumsum(counts)
        for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True):
            own, times = np.unique(index[a:b], return_counts=True)
            sizes = counts[own]
            run = np.repeat(ends[own] - np.cumsum(sizes), sizes) + np.arange(sizes.sum())
            weight = np.repeat(times / (sizes * (b - a)), sizes)
            column, back = np.unique(features[run], return_inverse=True)
            columns.append(column.astype(np.int32))
            weights.append(np.bincount(back, weights=weight).astype(np.float32))
            bounds.append(bounds[-1] + len(column))
    return np.concatenate(columns), np.concatenate(weights), np.array(bounds)


def train(texts, labels, settings=Settings()):
    """``(bucket weights, bias)``: the log odds of label 1 are the bias plus the average weight.

    Both classes get the same total weight. One class only, or no rows: no weights, and the share
    of label 1 as score, kept off 0 and 1.
    """
    labels = np.asarray(labels, np.int64)
    good = int(labels.sum())
    if good in (0, len(labels)):
        return np.zeros(settings.buckets, np.float32), float(np.log((good + 1) / (len(labels) - good + 1)))
    columns, weights, bounds = _sample_matrix(texts, settings.buckets)
    rng = np.random.default_rng(settings.seed)
    vectors = rng.uniform(-1, 1, (settings.buckets, settings.dim)).astype(np.float32) / settings.dim
    out, bias = np.zeros((settings.dim, 2), np.float32), np.zeros(2, np.float32)
    balance = np.array([len(labels) / (2 * (len(labels) - good)), len(labels) / (2 * good)], np.float32)
    steps = settings.epochs * -(-len(labels) // settings.batch)
    step = 0
    for _ in range(settings.epochs):
        for rows in np.array_split(rng.permutation(len(labels)), -(-len(labels) // settings.batch)):
            rate = settings.rate * (1 - step / steps)
            step += 1
            sizes = bounds[rows + 1] - bounds[rows]
            run = np.repeat(bounds[rows + 1] - np.cumsum(sizes), sizes) + np.arange(sizes.sum())
            column, weight = columns[run], weights[run, None]
            cuts = np.cumsum(sizes) - sizes
            hidden = np.add.reduceat(vectors[column] * weight, cuts, axis=0)
            logits = hidden @ out + bias
            odds = np.exp(logits - logits.max(axis=1, keepdims=True))
            error = odds / odds.sum(axis=1, keepdims=True)
            error[np.arange(len(rows)), labels[rows]] -= 1
            error *= balance[labels[rows], None] / len(rows)
            back = (error @ out.T).astype(np.float32)
            out -= rate * (hidden.T @ error).astype(np.float32)
            bias -= rate * error.sum(axis=0)
            np.add.at(vectors, column, -rate * np.repeat(back, sizes, axis=0) * weight * len(rows))
    return vectors @ (out[:, 1] - out[:, 0]), float(bias[1] - bias[0])


def labelled_sample(docs, labels, rows=SAMPLE_ROWS, doc_id="doc_id", text="text", label="quality"):
    """``text, label`` of at most ``rows`` labelled documents outside the held-out fold, the same for
    the same tables. Null labels and texts take no part, nor do texts beyond ``SAMPLE_TEXT_BYTES``; the
    sample ends before ``SAMPLE_BYTES``. The bounds hold for documents, however often an id occurs.
    """
    mark = labels.filter(F.col(label).isin(0, 1) & ~held_out(doc_id)).select(
        F.col(doc_id).alias("_id"), F.col(label).cast("int").alias("label")
    )
    order = ["_hash", "_id", "label", "_text"]
    found = docs.filter(F.octet_length(text) <= SAMPLE_TEXT_BYTES).select(
        F.xxhash64(F.lit("sample"), doc_id).alias("_hash"), F.col(doc_id).alias("_id"), F.xxhash64(text).alias("_text"),
        F.octet_length(text).alias("bytes"), F.col(text).alias("text"),
    )
    # Narrow rows first, at most ``rows`` of them; then the texts up to the last that fits.
    mark = mark.distinct()
    first = found.drop("text").join(mark, "_id").select(*order, "bytes").orderBy(*order).limit(rows).collect()
    n = int(np.searchsorted(np.cumsum([r["bytes"] for r in first]), SAMPLE_BYTES, "right"))
    chosen = found.filter(F.col("_hash") <= first[n - 1]["_hash"] if n else F.lit(False)).join(mark, "_id")
    chosen = chosen.orderBy(*order).limit(n)
    sample = chosen.select("_id", "label", "text").toArrow()
    return sample.sort_by([("_id", "ascending"), ("label", "ascending"), ("text", "ascending")])


def held_out(doc_id="doc_id"):
    """Whether the crc32 of the id as text leaves 0 by 5. A null id is never held out."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def score_texts(texts, weights, bias):
    """Yield ``(start, stop, scores)`` for runs of an Arrow array of whole texts; null and empty
    texts get the bias's score."""
    for start, stop in text_slices(texts, _SLICE_BYTES):
        index, words, at = _coded(pa.array(texts.slice(start, stop - start).fill_null("")))
        features, counts = word_features(words, len(weights))
        means = _run_sums(weights[features].astype(np.float64), np.concatenate([[0], np.cumsum(counts)])) / counts
        means[[i for i, w in enumerate(words) if not w]] = 0
        sizes = np.diff(at)
        odds = _run_sums(means[index], at) / np.maximum(sizes, 1) + bias
        yield start, stop, 1 / (1 + np.exp(-np.clip(odds, -60, 60)))


def with_score(docs, labels, text="text", score="score", doc_id="doc_id", settings=Settings(), rows=SAMPLE_ROWS):
    """Adds ``score``, from 0 to 1; higher: label 1 is likelier. Only the text is used.

    The model is trained on the driver from the bounded sample and is broadcast: ``settings.buckets``
    numbers. A column of that name is replaced; one row out for each row in.
    """
    sample = labelled_sample(docs, labels, rows, doc_id, text)
    weights, bias = train(sample["text"].combine_chunks(), sample["label"].to_numpy(), settings)
    model = docs.sparkSession.sparkContext.broadcast((weights.astype(np.float32), bias))
    docs = docs.select(*[c for c in docs.columns if c != score])
    at = docs.columns.index(text)
    schema = T.StructType([*docs.schema.fields, T.StructField(score, T.DoubleType())])

    def run(batches):
        weights, bias = model.value
        for batch in batches:
            for start, stop, scores in score_texts(batch.column(at), weights, bias):
                columns = batch.slice(start, stop - start).columns
                yield pa.RecordBatch.from_arrays([*columns, pa.array(scores)], names=schema.names)

    return docs.mapInArrow(run, schema)


def quality_scores(docs, labels, cut=CUT):
    scored = with_score(docs.select("doc_id", "text"), labels)
    return scored.select(
        "doc_id", held_out().alias("held_out"), "score", (F.col("score") >= cut).cast("int").alias("predicted")
    )


def keep_quality(docs, labels, cut=CUT):
    """The documents whose score reaches ``cut``; the columns of ``docs``."""
    scored = with_score(docs, labels, score="_quality_score")
    return scored.filter(F.col("_quality_score") >= cut).drop("_quality_score")
