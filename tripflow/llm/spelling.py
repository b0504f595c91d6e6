"""Group spelling variants: words that differ by exactly one code point.

Words are grouped so that two near words meet in one small group. The first place where they
differ lies in a part of the word; all before and after that part is equal, and is their key. A
group is a sorted list of what stands in the part. Each word of it is held against the list by
dynamic programming: the banded rows of the edit matrix belong to the list word's prefix, so the
next list word goes on from the prefix it shares with the one before, and when all of a row is
over one edit, the scan jumps past every word with that prefix.

Parts are halves of a word first. The words of a group above ``GROUP`` go on with halves of that
part, and so on to single places, where a group has one word for each letter. So the largest
group is bounded, whatever the words, and no pair is left out.
"""

import pyarrow as pa
from pyspark.sql import functions as F

from tripflow.session import settle

LETTERS = r"[A-Za-zÀ-ÿ]"
SHORTEST = 7
LEAST_COUNT = 2
TIMES = 10
DROP_EVERY = 31
GROUP = 256
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_OVER = 2  # more than one edit


def count_words(docs, doc_id="doc_id", text="text", shortest=SHORTEST, least=LEAST_COUNT):
    """``word, n`` of all words of whole texts, A-Z lower-cased, every 31st run with one letter deleted.

    A null text has no words; a null id counts as an empty one; repeated rows count each.
    """
    runs = F.regexp_extract_all(
        F.translate(F.col(text), _UPPER, _LOWER), F.lit(f"{LETTERS}{{{shortest},}}"), F.lit(0)
    )
    name = F.coalesce(F.col(doc_id).cast("string"), F.lit(""))
    seen = docs.select(name.alias("_doc"), F.explode(runs).alias("_run"))
    h = F.crc32(F.concat_ws(":", "_doc", "_run").cast("binary"))
    seen = seen.select("_run", h.alias("_h"))
    at = (F.col("_h") % F.char_length("_run")).cast("int")
    cut = F.concat(F.col("_run").substr(F.lit(1), at), F.col("_run").substr(at + 2, F.char_length("_run")))
    word = F.when(F.col("_h") % DROP_EVERY == 0, cut).otherwise(F.col("_run"))
    return (
        seen.select(word.alias("word")).filter(F.char_length("word") >= shortest)
        .groupBy("word").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= least)
    )


def _keyed(words):
    """Rows with ``_a`` and ``_b``: the part from a to b of the shorter word's length ``_len`` is
    open. What stands before and after it is the key, together with a, b and the length."""
    size = F.char_length("word")
    before = F.col("word").substr(F.lit(1), F.col("_a"))
    after = F.col("word").substr(size - (F.col("_len") - F.col("_b")) + 1, F.col("_len") - F.col("_b"))
    middle = F.col("word").substr(F.col("_a") + 1, size - F.col("_a") - (F.col("_len") - F.col("_b")))
    return words.withColumns({"_before": before, "_after": after, "_middle": middle})


_KEY = ["_len", "_a", "_b", "_before", "_after"]


def _halves(words):
    """Each word with its own length and, as the longer of two, with one less; both halves."""
    size = F.char_length("word")
    return _keyed(
        words.withColumn("_len", F.explode(F.array(size, size - 1))).filter("_len > 0")
        .withColumn("_cut", F.expr("_len div 2"))
        .withColumn("_ab", F.explode(F.array(
            F.struct(F.lit(0).alias("a"), F.col("_cut").alias("b")),
            F.struct(F.col("_cut").alias("a"), F.col("_len").alias("b")),
        )))
        .select("word", "n", "_len", F.col("_ab.a").alias("_a"), F.col("_ab.b").alias("_b"))
    )


def _finer(rows):
    """The rows of groups that are too large, with halves of their parts."""
    cut = F.expr("(_a + _b) div 2")
    return _keyed(
        rows.select(
            "word", "n", "_len",
            F.explode(F.array(
                F.struct(F.col("_a").alias("a"), cut.alias("b")), F.struct(cut.alias("a"), F.col("_b").alias("b"))
            )).alias("_ab"),
        ).select("word", "n", "_len", F.col("_ab.a").alias("_a"), F.col("_ab.b").alias("_b"))
    )


def scan_sorted(query, words, lcp):
    """Places in the sorted list of the words exactly one edit from ``query`` and of its length or one more.

    Row k is the band of the edit matrix at a list word's first k letters: the distances to the
    query's first k - 1, k and k + 1 letters. What lies outside the band is over one edit.
    """
    n, size = len(words), len(query)
    padded = f"\0{query}\0\0\0"
    rows, found, i = [(_OVER, 0, 1)], [], 0
    while i < n:
        word = words[i]
        k = lcp[i]
        del rows[k + 1:]
        k = len(rows) - 1
        low, mid, high = rows[k]
        for letter in word[k:]:
            if padded[k] != letter:
                low += 1
            if low > mid:
                low = mid + 1
            if padded[k + 1] != letter:
                mid += 1
            if mid > high:
                mid = high + 1
            if mid > low:
                mid = low + 1
            if padded[k + 2] != letter:
                high += 1
            if high > mid:
                high = mid + 1
            k += 1
            if low > 1 and mid > 1 and high > 1:
                # No word with these k letters is near: on to the first that shares fewer.
                i += 1
                while i < n and lcp[i] >= k:
                    i += 1
                break
            rows.append((low, mid, high))
        else:
            if (mid if k == size else low) == 1:
                found.append(i)
            i += 1
    return found


def _shared(a, b):
    """Letters that two words share at their start."""
    n = 0
    for x, y in zip(a, b, strict=False):
        if x != y:
            break
        n += 1
    return n


def near_in_group(group, size, a, b):
    """``{word: [near words, largest n, that word]}`` of ``(middle, word, n)`` sorted by middle.

    ``size``: length of the shorter word of the pairs looked for. A pair counts in the part where
    its words first differ, so it counts once.
    """
    out = {}

    def add(word, other, n):
        got = out.setdefault(word, [0, 0, ""])
        got[0] += 1
        if n > got[1] or n == got[1] and other < got[2]:
            got[1:] = n, other

    middles = [g[0] for g in group]
    lcp = [0, *(_shared(*pair) for pair in zip(middles, middles[1:], strict=False))]
    for middle, word, n in group:
        if len(word) != size:
            continue
        for j in scan_sorted(middle, middles, lcp):
            _, other, times = group[j]
            first = a + _shared(middle, middles[j])
            if not (first < b or first == b == size):
                continue
            add(word, other, times)
            if len(other) > size:
                add(other, word, n)
    return out


def _near(batches):
    schema = pa.schema([("word", pa.string()), ("n_near", pa.int64()), ("best", pa.int64()), ("form", pa.string())])
    key, group = None, []

    def rows():
        found = near_in_group(group, key[0], key[1], key[2]) if len(group) > 1 else {}
        return [(word, *value) for word, value in found.items()]

    def table(found):
        return pa.RecordBatch.from_arrays(
            [pa.array(c, f.type) for c, f in zip(zip(*found, strict=True), schema, strict=True)], schema=schema
        )

    held = []
    for batch in batches:
        columns = [batch.column(k).to_pylist() for k in range(batch.num_columns)]
        for *new, middle, word, n in zip(*columns, strict=True):
            if new != key:
                held += rows()
                key, group = new, []
            group.append((middle, word, n))
        if held:
            yield table(held)
            held = []
    held = rows() if group else []
    if held:
        yield table(held)


def near_words(words):
    """``word, n_near, best, form``: near words, the largest count among them, and the first word of
    that count in code-point order. ``words``: distinct ``word`` with its ``n``. Words without a
    near word have no row."""
    rows, found = _halves(words), None
    while True:
        # A word alone in its group meets nobody; a part of one place is bounded by the letters.
        sizes = settle(
            rows.groupBy(*_KEY).agg(F.count(F.lit(1)).alias("_rows")).filter("_rows > 1"), "word-groups"
        )
        fit = (F.col("_rows") <= GROUP) | (F.col("_b") - F.col("_a") <= 1)
        part = settle(
            rows.join(sizes.filter(fit).select(*_KEY), _KEY, "left_semi")
            .select(*_KEY, "_middle", "word", "n")
            .repartition(*_KEY)
            .sortWithinPartitions(*_KEY, "_middle")
            .mapInArrow(_near, "word string, n_near long, best long, form string"),
            "near-words",
        )
        found = part if found is None else found.unionByName(part)
        large = sizes.filter(~fit).select(*_KEY)
        if large.isEmpty():
            break
        rows = settle(_finer(rows.join(large, _KEY, "left_semi")), "finer-groups")
    best = F.min(F.struct((-F.col("best")).alias("least"), "form"))
    return found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("_best")).select(
        "word", "n_near", (-F.col("_best.least")).alias("best"), F.col("_best.form").alias("form")
    )


def _roots(forms):
    """``word, root`` of all words that have a form.

    A form is ten times as frequent as its word, so a chain has at most 18 steps, and five rounds
    of doubling reach its end.
    """
    ends = forms.select("word", F.col("form").alias("root"))
    while True:
        onward = ends.select(F.col("word").alias("root"), F.col("root").alias("_next"))
        if ends.join(onward, "root", "left_semi").isEmpty():
            return ends
        ends = settle(
            ends.join(onward, "root", "left").select("word", F.coalesce("_next", "root").alias("root")), "roots"
        )


def spelling_groups(words, times=TIMES):
    """Each word with ``n``, ``form`` (its most frequent near word, if ``times`` as frequent; ties:
    the first in code-point order), ``root`` (where the forms end; itself without a form),
    ``n_near`` and ``form_n``. An empty table gives no rows."""
    words = settle(words.select("word", "n"), "words")
    near = settle(near_words(words), "near-words")
    fits = F.col("best") >= times * F.col("n")
    judged = settle(
        words.join(near, "word", "left").select(
            "word", "n", F.when(fits, F.col("form")).alias("form"), F.when(fits, F.col("best")).alias("form_n"),
            F.coalesce("n_near", F.lit(0)).alias("n_near"),
        ),
        "word-forms",
    )
    roots = _roots(judged.filter("form IS NOT NULL"))
    return judged.join(roots, "word", "left").select(
        "word", "n", "form", F.coalesce("root", "word").alias("root"), "n_near", "form_n"
    )


def variant_report(docs):
    """Words of all documents with their forms and roots."""
    return spelling_groups(count_words(docs))
