"""Quality rules of documents, and lines that many documents of a host share.

Lines are normalised and hashed. Per host, distinct documents that hold a line are counted; lines
above the limit are boilerplate and are removed; a document that loses most of its words is
rejected. Column expressions only.

Copies must not make each other's lines boilerplate. Equal texts of a host count once, and so do near
copies: two texts of which most words are in lines of both. A line is above the limit if enough
texts hold it of which no two are near copies.
"""

from functools import reduce

from pyspark.sql import functions as F

from tripflow.session import settle

_BLANK = "\\x20\\x09-\\x0D"
# The limit, in documents of a host: it does not grow with the host.
MIN_DOCS = 10
# Not used here; the SQL twin still names them.
MIN_SHARE = 0.002
MIN_VARIETY = 0.5
# Near copies: this share of the words of both texts' lines, each line once, is in common lines.
NEAR_PERCENT = 75
# A line's texts that are looked at in one round.
_PICKS = 16
_SIZE_BITS = 0xFFFF
# A document is depleted if less than this share of its words is left.
LEAST_LEFT = 0.3
MIN_WORDS = 50
REPEAT_PERCENT = 50


def words_of(text):
    return F.array_remove(F.split(text, f"[{_BLANK}]+"), "")


def lines_of(text):
    """Lines that hold a word."""
    return F.filter(F.split(text, "\n"), lambda line: F.rlike(line, F.lit(f"[^{_BLANK}]")))


def _plain(line):
    return F.lower(F.trim(F.regexp_replace(line, f"[{_BLANK}0-9]+", " ")))


def line_hash(line):
    """Case, digits, and blanks at the ends or in a row make no difference."""
    return F.xxhash64(_plain(line))


def with_repeats(docs, words="_words", out="n_repeat_words"):
    """Adds the number of words in 3-word windows that occur twice or more in the text.

    Windows are numbers: the upper bits of the window's hash, the lower bits its position.
    Sorting puts equal windows side by side; their words are compared before they count.
    """
    n = F.size(words)
    mask = F.coalesce(F.call_function("shiftleft", F.lit(1).cast("long"), F.length(F.bin(n))) - 1, F.lit(0).cast("long"))
    word = lambda i: F.get(F.col(words), i)
    codes = F.transform(
        F.sequence(F.lit(0), F.greatest(n - 3, F.lit(0))),
        lambda i: F.xxhash64(word(i), word(i + 1), word(i + 2)).bitwiseAND(F.bitwise_not(F.col("_mask")))
        .bitwiseOR(i.cast("long")),
    )
    place = lambda code: code.bitwiseAND(F.col("_mask")).cast("int")

    def same(a, b):
        p, q = place(a), place(b)
        equal = a.bitwiseOR(F.col("_mask")) == b.bitwiseOR(F.col("_mask"))
        for k in range(3):
            equal = equal & (word(p + k) == word(q + k))
        return F.coalesce(equal, F.lit(False))

    at = lambda k: F.get(F.col("_codes"), k)
    twice = F.filter("_codes", lambda c, k: same(c, at(k - 1)) | same(c, at(k + 1)))
    m = F.size("_twice")
    steps = F.aggregate(
        F.sequence(F.lit(0), F.greatest(m - 2, F.lit(0))), F.lit(0),
        lambda acc, k: acc + F.coalesce(
            F.least(F.lit(3), F.get(F.col("_twice"), k + 1) - F.get(F.col("_twice"), k)), F.lit(0)
        ),
    )
    return (
        docs.withColumn("_mask", mask)
        .withColumn("_codes", F.when(n >= 3, F.sort_array(codes)))
        .withColumn("_twice", F.sort_array(F.transform(twice, place)))
        .withColumn(out, F.when(m > 0, 3 + steps).otherwise(0).cast("long"))
        .drop("_mask", "_codes", "_twice")
    )


def with_rules(docs, text="text"):
    """Adds ``n_words word_chars n_symbols n_dup_lines n_repeat_words base_failed`` of whole texts.

    A null text has no words. Rows are judged one by one, so repeated rows get equal results.
    """
    whole = F.coalesce(F.col(text), F.lit(""))
    found = docs.withColumn("_words", words_of(whole)).withColumn("_lines", lines_of(whole))
    rules = F.struct(
        F.size("_words").cast("long").alias("n_words"),
        F.char_length(F.array_join("_words", "")).cast("long").alias("word_chars"),
        (F.char_length(whole) - F.char_length(F.regexp_replace(whole, "[#*$%&|<>]", ""))).cast("long").alias("n_symbols"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        F.col("n_repeat_words"),
    )
    # Through a generator: a filter on a rule is not pushed below it, where it would compute all again.
    found = with_repeats(found).select(*docs.columns, F.inline(F.array(rules)))
    return found.withColumn(
        "base_failed",
        (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > REPEAT_PERCENT * F.col("n_words")),
    )


def _host(host):
    """A null host is the empty one."""
    return F.coalesce(F.col(host).cast("string"), F.lit(""))


def _near(one, two, percent=NEAR_PERCENT):
    """Of arrays of line codes: the upper bits of the line's hash, the lower bits its words."""
    words = lambda codes: F.aggregate(
        codes, F.lit(0).cast("long"), lambda acc, c: acc + c.bitwiseAND(F.lit(_SIZE_BITS).cast("long"))
    )
    both = words(F.array_intersect(one, two))
    return 100 * both >= percent * (words(one) + words(two) - both)


def _near_pairs(pairs, codes, label):
    """Those of ``host, a, b`` that are near copies. Many pairs have one ``b``; its lines are sent along."""
    known = settle(
        codes.join(pairs.select("host", F.col("b").alias("fingerprint")).distinct(), ["host", "fingerprint"]), label
    )
    one = codes.withColumnsRenamed({"fingerprint": "a", "codes": "a_codes"})
    two = known.withColumnsRenamed({"fingerprint": "b", "codes": "b_codes"})
    return pairs.join(one, ["host", "a"]).join(two, ["host", "b"]).filter(_near(F.col("a_codes"), F.col("b_codes"))).select("host", "a", "b")


def distinct_holders(held, codes, least):
    """``host, hash`` of lines that ``least`` texts hold of which no two are near copies.

    ``held``: host, hash, fingerprint; ``codes``: host, fingerprint, codes. In each round some of
    a line's texts are picked, the nearest to each of several numbers; those that are no near copy of a smaller
    pick stand for themselves and their near copies, and all of these leave. A round ends at least
    one group of each line, so there are at most ``least`` rounds; most lines need one or two.
    All texts of a line are looked at before it is taken for one of few groups.
    """
    line, found = ["host", "hash"], []
    orders = [(k << 60) - (1 << 64 if k > 7 else 0) for k in range(_PICKS)]
    mark = lambda c: F.col("fingerprint").bitwiseXOR(F.lit(c).cast("long"))
    live = settle(held.withColumn("known", F.lit(0).cast("long")), "held-lines")
    while True:
        picks = settle(
            live.groupBy(*line).agg(
                F.max("known").alias("known"), F.count(F.lit(1)).alias("n"),
                *[F.min(mark(c)).alias(f"m{k}") for k, c in enumerate(orders)],
            )
            .filter(F.col("known") + F.col("n") >= least)
            .select(*line, "known", F.explode(F.array_distinct(F.array(*[
                F.col(f"m{k}").bitwiseXOR(F.lit(c).cast("long")) for k, c in enumerate(orders)
            ]))).alias("fingerprint")),
            "picked-texts",
        )
        if picks.isEmpty():
            return reduce(lambda x, y: x.union(y), found) if found else held.select(*line).limit(0)
        two = picks.select(*line, F.col("fingerprint").alias("b"))
        sides = picks.select(*line, F.col("fingerprint").alias("a")).join(two, line).filter("b < a")
        near = settle(_near_pairs(sides.select("host", "a", "b").distinct(), codes, "picked-lines"), "near-picks")
        copies = sides.join(near, ["host", "a", "b"]).select(*line, F.col("a").alias("fingerprint")).distinct()
        heads = settle(picks.join(copies, [*line, "fingerprint"], "left_anti"), "group-heads")
        counts = settle(
            heads.groupBy(*line).agg((F.max("known") + F.count(F.lit(1))).alias("known")), "group-counts"
        )
        found.append(counts.filter(F.col("known") >= least).select(*line))
        rest = settle(
            live.drop("known").join(counts.filter(F.col("known") < least), line), "undecided-lines"
        )
        if rest.isEmpty():
            return reduce(lambda x, y: x.union(y), found)
        against = rest.select(*line, F.col("fingerprint").alias("a")).join(
            heads.select(*line, F.col("fingerprint").alias("b")), line
        )
        near = settle(_near_pairs(against.select("host", "a", "b").distinct(), codes, "head-lines"), "near-heads")
        gone = against.join(near, ["host", "a", "b"]).select(*line, F.col("a").alias("fingerprint")).distinct()
        live = settle(rest.join(gone, [*line, "fingerprint"], "left_anti"), "held-lines")


def boilerplate(docs, host="source", text="text", min_docs=MIN_DOCS):
    """``host, fingerprint, removed_words, removed`` of each host's texts that hold lines above the
    limit; ``removed`` are those lines' hashes. Texts are told apart by a 64-bit hash.

    A host or a line with a third of all rows is summed before it is shuffled.
    """
    lines = F.transform(
        F.transform(
            lines_of(F.col(text)),
            lambda line: F.struct(_plain(line).alias("plain"), F.size(words_of(line)).alias("words")),
        ),
        lambda x: F.struct(
            F.xxhash64(x["plain"]).alias("hash"), x["words"].alias("words"), F.size(F.split(x["plain"], " ")).alias("size")
        ),
    )
    texts = settle(
        docs.filter(F.col(text).isNotNull())
        .groupBy(_host(host).alias("host"), F.xxhash64(text).alias("fingerprint"))
        .agg(F.first(lines).alias("lines")),
        "line-hashes",
    )
    held = texts.select("host", "fingerprint", F.explode(F.array_distinct("lines.hash")).alias("hash"))
    frequent = settle(
        held.groupBy("host", "hash").agg(F.count(F.lit(1)).alias("n_docs"))
        .filter(F.col("n_docs") >= min_docs).select("host", "hash"),
        "frequent-lines",
    )
    code = lambda x: x["hash"].bitwiseAND(F.lit(~_SIZE_BITS).cast("long")).bitwiseOR(
        F.least(x["size"], F.lit(_SIZE_BITS)).cast("long")
    )
    codes = texts.select("host", "fingerprint", F.array_distinct(F.transform("lines", code)).alias("codes"))
    often = settle(distinct_holders(held.join(frequent, ["host", "hash"]), codes, min_docs), "boilerplate-lines")
    return settle(
        texts.select("host", "fingerprint", F.inline("lines"))
        .join(often, ["host", "hash"])
        .groupBy("host", "fingerprint")
        .agg(F.sum("words").alias("removed_words"), F.collect_set("hash").alias("removed")),
        "boilerplate-texts",
    )


def judge(docs, host="source", text="text", least_left=LEAST_LEFT):
    """Adds the rules' columns, ``removed`` (hashes of lines to remove, or null) and ``kept``.

    ``kept`` is false for ``base_failed`` and for documents of which less than ``least_left`` of
    the words is left. A null text has no lines. Columns of ``docs`` must not have these names.
    """
    texts = boilerplate(docs, host, text)
    keyed = with_rules(docs, text).withColumns(
        {"_host": _host(host), "_fingerprint": F.xxhash64(text)}
    )
    joined = keyed.join(
        texts.withColumnsRenamed({"host": "_host", "fingerprint": "_fingerprint"}),
        ["_host", "_fingerprint"], "left",
    )
    left = F.col("n_words") - F.coalesce("removed_words", F.lit(0))
    return joined.withColumn(
        "kept", ~F.col("base_failed") & (left >= least_left * F.col("n_words"))
    ).drop("_host", "_fingerprint", "removed_words")


def quality_report(docs):
    """A row for each document with the rules' counts and both verdicts."""
    return judge(docs.select("doc_id", "text", "source")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


def clean(docs, host="source", text="text"):
    """The documents that are kept, without their boilerplate lines; the columns of ``docs``, whatever
    their names: a row goes along as one column."""
    left = F.filter(
        F.split(F.col("text"), "\n"), lambda line: ~F.array_contains("removed", line_hash(line))
    )
    packed = docs.select(F.struct("*").alias("row"), F.col(host).alias("source"), F.col(text).alias("text"))
    clean_text = F.when(F.col("removed").isNull(), F.col("text")).otherwise(F.array_join(left, "\n"))
    return judge(packed).filter("kept").select("row", clean_text.alias("text")).select(
        *(F.col("text").alias(c) if c == text else F.col("row").getField(c).alias(c) for c in docs.columns)
    )
