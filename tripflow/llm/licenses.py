"""License scans: an exact set-similarity join of text blocks with license templates.

A token is a pair of neighbouring words. A text block is a window of ``BLOCK`` words; windows
start every half window, so whatever fits in half a window lies whole in one of them. A template is
found in a block that holds at least ``CONTAINS`` percent of its tokens. Tokens that no template has
cannot count, so a block keeps those of the templates only.

The join: tokens are ordered by the number of blocks that hold them, rare ones first. A template
of n tokens that needs o of them in common meets a block in one of its first n - o + 1 tokens (prefix
filter); the block must have o tokens (length filter); and the tokens from the first common one on
must be enough on both sides (position filter). Who is left is compared in whole.
"""

import functools

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripflow.session import settle

BLOCK = 128
CONTAINS = 80

# The phrases of the base scan and their labels, in the order of the contract.
PHRASES = (
    ("gnu general public license", "gpl"), ("apache license", "apache"), ("cc by", "cc-by"), ("mit license", "mit"),
)

# Sentences by which licenses are granted, at most half a window long.
TEMPLATES = (
    ("mit", "released under the mit license"),
    ("mit", "licensed under the mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and "
            "associated documentation files to deal in the software without restriction"),
    ("apache-2.0", "licensed under the apache license version 2 0"),
    ("apache-2.0", "you may not use this file except in compliance with the license you may obtain a copy of the "
                   "license at http www apache org licenses license 2 0"),
    ("gpl-3.0", "this work is licensed under the gnu general public license version 3"),
    ("gpl-2.0", "this work is licensed under the gnu general public license version 2"),
    ("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu "
            "general public license as published by the free software foundation"),
    ("lgpl", "this library is free software you can redistribute it and or modify it under the terms of the gnu "
             "lesser general public license as published by the free software foundation"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided "
            "that the following conditions are met"),
    ("mpl-2.0", "this source code form is subject to the terms of the mozilla public license v 2 0"),
    ("cc-by-4.0", "licensed under cc by 4 0"),
    ("cc-by-nc-4.0", "licensed under cc by nc 4 0"),
    ("cc-by-sa-4.0", "licensed under cc by sa 4 0"),
    ("cc-by-4.0", "licensed under a creative commons attribution 4 0 international license"),
    ("cc0", "to the extent possible under law the author has waived all copyright and related or neighboring rights"),
)

# Words: runs of digits, letters and all beyond ASCII. In UTF-8 the latter are the bytes from 80 on.
_SPACES = bytes(
    c if c >= 0x80 or chr(c).isalnum() else 0x20 for c in bytes(range(256)).lower()
)
_PIECE = 1 << 20


def _word_runs(data):
    """The words of a text's bytes, a list for each megabyte."""
    data = data.translate(_SPACES)
    start = 0
    while start < len(data):
        stop = data.find(b" ", start + _PIECE)
        stop = len(data) if stop < 0 else stop
        yield data[start:stop].split()
        start = stop


class _Vocabulary:
    """Numbers of the words of phrases and templates, and of the templates' pairs of words."""

    def __init__(self, phrases, templates):
        split = [text.lower().split() for _, text in templates]
        # A phrase is a few words; they are numbered with the others.
        sides = [text.lower().split() for text, _ in phrases]
        self.words = {w.encode(): i for i, w in enumerate(sorted({w for ws in [*split, *sides] for w in ws}))}
        self.pairs = sorted({p for ws in split for p in zip(ws, ws[1:], strict=False)})
        size = len(self.words)
        number = lambda p: self.words[p[0].encode()] * size + self.words[p[1].encode()]
        codes = np.array([number(p) for p in self.pairs], np.int64)
        order = np.argsort(codes)
        self.codes, self.tokens = codes[order], order
        self.phrases = [[self.words[w.encode()] for w in ws] for ws in sides]

    def ids(self, text):
        """The number of each word of a text; -1 for words of no template."""
        find = self.words.get
        runs = [np.array([find(w, -1) for w in run], np.int32) for run in _word_runs(text)]
        return np.concatenate(runs) if runs else np.zeros(0, np.int32)

    def places(self, ids):
        """Where each phrase starts."""
        out = []
        for phrase in self.phrases:
            hit = ids[:max(0, len(ids) - len(phrase) + 1)] == phrase[0]
            for k, word in enumerate(phrase[1:], 1):
                hit = hit & (ids[k:k + len(hit)] == word)
            out.append(np.flatnonzero(hit))
        return out

    def blocks(self, ids, block):
        """``(block number, distinct tokens)`` of the blocks that hold a template's token."""
        left, right = ids[:-1].astype(np.int64), ids[1:]
        at = np.flatnonzero((left >= 0) & (right >= 0))
        if not len(at):
            return []
        code = left[at] * len(self.words) + right[at]
        place = np.minimum(np.searchsorted(self.codes, code), len(self.codes) - 1)
        known = self.codes[place] == code
        at, token = at[known], self.tokens[place[known]]
        if not len(at):
            return []
        half = block // 2
        number = at // half
        # Both words of a pair lie in the block; the one before reaches half a window on.
        earlier = (number > 0) & (at % half < half - 1)
        rows = np.unique(np.stack([
            np.concatenate([number, number[earlier] - 1]), np.concatenate([token, token[earlier]]),
        ]), axis=1)
        numbers, starts = np.unique(rows[0], return_index=True)
        return list(zip(numbers.tolist(), (t.tolist() for t in np.split(rows[1], starts[1:])), strict=True))


@functools.lru_cache(maxsize=2)
def _vocabulary(phrases, templates):
    return _Vocabulary(phrases, templates)


def scan_blocks(docs, phrases=PHRASES, templates=TEMPLATES, block=BLOCK, doc_id="doc_id", text="text"):
    """``doc_id, n_words, places`` (starts of each phrase) and ``blocks`` (number and tokens) of each row.

    A text is read in pieces of a megabyte, whatever its length.
    """
    id_type = docs.schema[doc_id].dataType
    schema = T.StructType([
        T.StructField("doc_id", id_type), T.StructField("n_words", T.LongType()),
        T.StructField("places", T.ArrayType(T.ArrayType(T.LongType()))),
        T.StructField("blocks", T.ArrayType(T.StructType([
            T.StructField("block", T.LongType()), T.StructField("tokens", T.ArrayType(T.IntegerType())),
        ]))),
    ])
    from pyspark.sql.pandas.types import to_arrow_schema

    arrow = to_arrow_schema(schema)

    def run(batches):
        vocabulary = _vocabulary(phrases, templates)
        for batch in batches:
            words, places, blocks = [], [], []
            for value in batch.column(1):
                data = value.as_buffer() if value.is_valid else None
                ids = vocabulary.ids(data.to_pybytes() if data else b"")
                words.append(len(ids))
                places.append([p.tolist() for p in vocabulary.places(ids)])
                blocks.append(vocabulary.blocks(ids, block))
            yield pa.RecordBatch.from_arrays([
                batch.column(0), pa.array(words, pa.int64()), pa.array(places, arrow.field("places").type),
                pa.array([[{"block": b, "tokens": t} for b, t in row] for row in blocks], arrow.field("blocks").type),
            ], schema=arrow)

    return docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string")).mapInArrow(run, schema)


def find_templates(scanned, phrases=PHRASES, templates=TEMPLATES, contains=CONTAINS):
    """``_row, template, contained``: the greatest share of each template found in a block of a row.

    ``scanned``: ``_row`` and ``blocks``. Every block with at least ``contains`` percent of a
    template's tokens is found. The tables of tokens and templates are as large as the templates.
    """
    spark = scanned.sparkSession
    vocabulary = _vocabulary(phrases, templates)
    number = {pair: i for i, pair in enumerate(vocabulary.pairs)}
    token_sets = [
        {number[p] for p in zip(ws, ws[1:], strict=False)} for ws in (text.lower().split() for _, text in templates)
    ]
    rows = [(i, sorted(s), -(-contains * len(s) // 100)) for i, s in enumerate(token_sets) if s]
    least = min(need for *_, need in rows)
    blocks = scanned.select("_row", F.explode("blocks").alias("b")).select("_row", "b.block", "b.tokens")
    # The global order: a row for each token of the templates.
    counts = blocks.select(F.explode("tokens").alias("token")).groupBy("token").count()
    order = [r["token"] for r in counts.orderBy("count", "token").collect()]
    order = [t for t in range(len(vocabulary.pairs)) if t not in set(order)] + order
    place = {token: i for i, token in enumerate(order)}
    sets = [(i, sorted(place[t] for t in tokens), need) for i, tokens, need in rows]
    index = spark.createDataFrame(
        [(s[at], at, i, s, need) for i, s, need in sets for at in range(len(s) - need + 1)],
        "token int, at int, template int, wanted array<int>, need int",
    )
    ranks = F.array(*(F.lit(place[t]) for t in range(len(vocabulary.pairs))))
    sorted_blocks = blocks.filter(F.size("tokens") >= least).select(
        "_row", "block", F.sort_array(F.transform("tokens", lambda t: F.get(ranks, t))).alias("held")
    )
    size = F.size("held")
    prefix = F.slice("held", 1, size - F.lit(least - 1))
    probes = sorted_blocks.select("_row", "block", "held", F.posexplode(prefix).alias("pos", "token"))
    common = F.array_intersect("wanted", "held")
    return (
        probes.join(index, "token")
        .filter(size >= F.col("need"))
        .filter(F.least(F.size("wanted") - F.col("at"), size - F.col("pos")) >= F.col("need"))
        .withColumn("_common", common)
        # A pair that meets in several tokens counts at the first.
        .filter((F.get("_common", F.lit(0)) == F.col("token")) & (F.size("_common") >= F.col("need")))
        .groupBy("_row", "template")
        .agg(F.max(F.size("_common") / F.size("wanted")).alias("contained"))
    )


def license_report(docs, phrases=PHRASES, templates=TEMPLATES, block=BLOCK, contains=CONTAINS, doc_id="doc_id",
                   text="text"):
    """Each row's words, base places and labels, and the labels of templates found in it.

    ``score``: the greatest share of a template found in a block; at least 0.5 where a phrase
    stands; else 0. A null or empty text has no words and no labels; one row out for each row in,
    also for repeated rows and null ids; other columns do not matter.
    """
    scanned = settle(
        scan_blocks(docs, phrases, templates, block, doc_id, text).withColumn(
            "_row", F.monotonically_increasing_id()
        ),
        "license-blocks",
    )
    found = find_templates(scanned, phrases, templates, contains)
    names = F.array(*(F.lit(label) for label, _ in templates))
    labels = found.groupBy("_row").agg(
        F.collect_set(F.get(names, F.col("template"))).alias("_found"), F.max("contained").alias("_share")
    )
    every = F.array_sort(F.flatten("places"))
    base = F.array_compact(F.array(*(
        F.when(F.size(F.coalesce(F.get("places", F.lit(k)), F.array().cast("array<bigint>"))) > 0, F.lit(label))
        for k, (_, label) in enumerate(phrases)
    )))
    n_base = F.size("_every")
    return (
        scanned.drop("blocks").join(labels, "_row", "left")
        .withColumns({"_every": every, "_base": base})
        .select(
            "doc_id", "n_words", n_base.cast("long").alias("n_base"),
            F.when(n_base > 0, F.element_at("_every", 1)).alias("first_word"),
            F.when(n_base > 0, F.element_at("_every", -1)).alias("last_word"),
            F.array_join(F.array_sort(F.array_distinct("_base")), ",").alias("base_labels"),
            F.array_join(
                F.array_sort(F.array_union("_base", F.coalesce("_found", F.array().cast("array<string>")))), ","
            ).alias("labels"),
            F.greatest(F.coalesce("_share", F.lit(0.0)), F.when(n_base > 0, 0.5).otherwise(0.0)).alias("score"),
        )
    )
