"""Secrets in texts: fixed patterns, and windows of high entropy. Column expressions only.

Spans are ``{start, kind_no, end}`` in code points, ``end`` exclusive. Fixed patterns come first;
the entropy scan adds spans that reach beyond each of theirs; spans may overlap.

Entropy scan: runs of a class's characters, at least a window long. Allowed pieces end a run, so
only windows that overlap one are suppressed; a run that an allow pattern covers has no windows.
A window slides over each run; entering and leaving characters change the counts by one, and with
them the sum of ``c * log2(c)``, which is all that a window's Shannon entropy depends on. It is kept in
whole numbers, so the result does not depend on the order of steps. Windows at or above the class's
limit are marked, and marked windows that touch are one span.
"""

import math

from pyspark.sql import functions as F

# The kinds in order, their patterns, and what a match needs to count.
KINDS = ("assign", "access", "hex", "entropy_hex", "entropy_base64")
_ASSIGN = (
    "(?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]"
    "|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])[\"']?\\x20*[:=]\\x20*[\"']?"
)
_VALUE = "([A-Za-z0-9+/_.=-]+)"
_ACCESS = "AKIA[A-Z0-9]{14,}"
_HEX = "[0-9a-f]{16,}"
VALUE_CHARS = 12
# Character classes of the entropy scan: alphabet, window, entropy in bits from which it counts.
HEX_ALPHABET = "0123456789ABCDEFabcdef"
BASE64_ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_-"
CLASSES = ((3, HEX_ALPHABET, 20, 3.0), (4, BASE64_ALPHABET, 24, 3.9))
# Whole runs that are no secrets: one kind of character only, UUIDs.
ALLOWED = (
    "^[A-Za-z]+$", "^[0-9]+$", "^[+/_-]+$",
    "^[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}$",
)
# Pieces of a run, in either case, that belong to no secret: spelt-out alphabets, stated examples.
ALLOWED_PIECES = ("0123456789", "abcdefghij", "example", "placeholder", "changeme")
_UNIT = 1 << 20
MASK = "[SECRET]"

_SPANS = "array<struct<start:int,kind_no:int,end:int>>"
_ACC = f"struct<at:int,spans:{_SPANS}>"


def weights(window):
    """``c * log2(c)`` of each count up to ``window``, in units of 2**-20."""
    return [0, *(round(c * math.log2(c) * _UNIT) for c in range(1, window + 1))]


def weight_limit(window, bits):
    """The largest sum of weights of a window whose entropy is at least ``bits``."""
    return math.floor((math.log2(window) - bits) * window * _UNIT)


def _span(start, kind_no, end):
    return F.struct(
        start.cast("int").alias("start"), F.lit(kind_no).alias("kind_no"), end.cast("int").alias("end")
    )


def _matches(text, pattern, each):
    """Spans of the non-overlapping matches: ``each(match, start)`` gives an array of spans.

    Positions are running lengths of the pieces between the matches and of the matches.
    """
    gaps, hits = F.split(text, pattern, -1), F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    both = F.arrays_zip(gaps.alias("gap"), hits.alias("hit"))

    def step(acc, pair):
        start = acc["at"] + F.char_length(pair["gap"])
        hit = pair["hit"]  # null after the last gap
        return F.struct(
            (start + F.coalesce(F.char_length(hit), F.lit(0))).cast("int").alias("at"),
            F.when(hit.isNull(), acc["spans"]).otherwise(F.concat(acc["spans"], each(hit, start))).alias("spans"),
        )

    none = F.array().cast(_SPANS)
    start = F.struct(F.lit(0).alias("at"), none.alias("spans")).cast(_ACC)
    found = F.aggregate(both, start, step, lambda acc: acc["spans"])
    return F.when(F.rlike(text, F.lit(pattern)), found).otherwise(none)


def _whole(kind_no):
    return lambda hit, start: F.array(_span(start, kind_no, start + F.char_length(hit)))


def _assignments(hit, start):
    """Values are tested after matching: a short one still uses up its text."""
    value = F.regexp_extract(hit, f"^{_ASSIGN}{_VALUE}$", 1)
    span = F.array(_span(start, 0, start + F.char_length(hit)))
    return F.when(F.char_length(value) >= VALUE_CHARS, span).otherwise(F.array().cast(_SPANS))


def base_spans(text):
    """Spans of the fixed patterns, by start, then kind."""
    return F.sort_array(
        F.concat(
            _matches(text, _ASSIGN + _VALUE, _assignments), _matches(text, _ACCESS, _whole(1)),
            _matches(text, _HEX, _whole(2)),
        )
    )


def _entropy_of_run(kind_no, alphabet, window, bits):
    table = F.array(*[F.lit(w).cast("long") for w in weights(window)])
    limit = weight_limit(window, bits)
    at = lambda ch: F.instr(F.lit(alphabet), ch)
    acc_type = f"struct<counts:array<int>,sum:bigint,open:int,end:int,spans:{_SPANS}>"

    def spans(run, first):
        length = F.char_length(run)

        def move(places, acc, i):
            come = F.element_at(places, i)
            gone = F.when(i > window, F.element_at(places, i - window)).otherwise(0)
            more = F.element_at(acc["counts"], come)
            less = F.when(gone > 0, F.element_at(acc["counts"], F.greatest(gone, F.lit(1))))
            weight = lambda c: F.element_at(table, c + 1)
            change = F.when(come == gone, F.lit(0).cast("long")).otherwise(
                weight(more + 1) - weight(more)
                + F.when(gone > 0, weight(less - 1) - weight(less)).otherwise(F.lit(0).cast("long"))
            )
            counts = F.transform(
                acc["counts"],
                lambda c, k: c + (k + 1 == come).cast("int") - (k + 1 == gone).cast("int"),
            )
            total = acc["sum"] + change
            marked = (i >= window) & (total <= limit)
            joined = (acc["open"] >= 0) & (i - window <= acc["end"])
            shut = marked & ~joined & (acc["open"] >= 0)
            return F.struct(
                counts.alias("counts"), total.alias("sum"),
                F.when(marked & ~joined, i - window).otherwise(acc["open"]).cast("int").alias("open"),
                F.when(marked, i).otherwise(acc["end"]).cast("int").alias("end"),
                F.when(
                    shut,
                    F.concat(acc["spans"], F.array(_span(first + acc["open"], kind_no, first + acc["end"]))),
                ).otherwise(acc["spans"]).alias("spans"),
            )

        start = F.struct(
            F.array_repeat(F.lit(0), len(alphabet)).alias("counts"), F.lit(0).cast("long").alias("sum"),
            F.lit(-1).alias("open"), F.lit(-1).alias("end"), F.array().cast(_SPANS).alias("spans"),
        ).cast(acc_type)
        allowed = F.lit(False)
        for pattern in ALLOWED:
            allowed = allowed | F.rlike(run, F.lit(pattern))

        def slide(places):
            return F.aggregate(
                F.sequence(F.lit(1), F.greatest(length, F.lit(1))), start, lambda acc, i: move(places, acc, i),
                lambda acc: F.when(
                    acc["open"] >= 0,
                    F.concat(acc["spans"], F.array(_span(first + acc["open"], kind_no, first + acc["end"]))),
                ).otherwise(acc["spans"]),
            )

        # The places of the run's characters in the alphabet, bound once for all steps.
        found = F.get(F.transform(F.array(F.transform(F.split(run, ""), at)), slide), 0)
        return F.when(allowed, F.array().cast(_SPANS)).otherwise(found)

    return spans


def without_allowed(text):
    """The text with blanks, as many, in the place of each allowed piece."""
    bare = text
    for piece in ALLOWED_PIECES:
        bare = F.regexp_replace(bare, f"(?i){piece}", " " * len(piece))
    return F.when(F.rlike(text, F.lit("(?i)" + "|".join(ALLOWED_PIECES))), bare).otherwise(text)


def entropy_spans(text):
    """Spans of the entropy scan, of all classes."""
    parts, text = [], without_allowed(text)
    for kind_no, alphabet, window, bits in CLASSES:
        symbols = f"[{alphabet.replace('-', '')}{'-' if '-' in alphabet else ''}]"
        pattern = f"(?<!{symbols}){symbols}{{{window},}}"
        parts.append(_matches(text, pattern, _entropy_of_run(kind_no, alphabet, window, bits)))
    return F.concat(*parts)


def scan(docs, text="text", base="_base", spans="_spans"):
    """Adds two arrays of spans: the fixed patterns', and all, each by start, then kind.

    Whole texts; a null text is empty. An entropy span goes only if one fixed pattern's or one of an
    earlier class holds all of it, so a hexadecimal run that both classes mark is reported once.
    """
    whole = F.coalesce(F.col(text), F.lit(""))
    within = lambda a, b: (b["start"] <= a["start"]) & (a["end"] <= b["end"])
    found = docs.withColumn(base, base_spans(whole)).withColumn("_entropy", entropy_spans(whole))
    fresh = F.filter(
        "_entropy",
        lambda s: ~F.exists(base, lambda b: within(s, b))
        & ~F.exists("_entropy", lambda o: (o["kind_no"] < s["kind_no"]) & within(s, o)),
    )
    both = F.struct(F.col(base), F.sort_array(F.concat(F.col(base), fresh)).alias(spans))
    # Through a generator: a filter on spans is not pushed below it, where it would scan again.
    return found.select(*docs.columns, F.inline(F.array(both)))


def spans_text(spans):
    """``kind:start:end`` of each span, comma-joined."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(
        F.transform(
            spans,
            lambda s: F.concat_ws(
                ":", F.element_at(names, s["kind_no"] + 1), s["start"].cast("string"), s["end"].cast("string")
            ),
        ),
        ",",
    )


def secret_report(docs):
    """A row for each document: counts of the fixed kinds, digest of their spans, and all spans."""
    count = lambda k: F.size(F.filter("_base", lambda s: s["kind_no"] == k)).cast("long")
    return scan(docs.select("doc_id", "text")).select(
        "doc_id", count(0).alias("n_assign"), count(1).alias("n_access"), count(2).alias("n_hex"),
        F.sha2(spans_text(F.col("_base")), 256).alias("base_sha256"),
        spans_text(F.col("_spans")).alias("spans"),
    )


def redact(docs, text="text"):
    """The documents with each secret replaced by ``[SECRET]``; all other columns as they are.

    Spans that touch are replaced by one mask. A null text stays null.
    """
    def join(acc, s):
        last = F.element_at(acc, -1)
        whole = F.struct(last["start"].alias("start"), F.greatest(last["end"], s["end"]).alias("end"))
        return F.when(
            (F.size(acc) > 0) & (s["start"] <= F.try_element_at(acc, F.lit(-1))["end"]),
            F.concat(F.slice(acc, 1, F.size(acc) - 1), F.array(whole)),
        ).otherwise(F.concat(acc, F.array(F.struct(s["start"].alias("start"), s["end"].alias("end")))))

    cuts = F.aggregate("_spans", F.array().cast("array<struct<start:int,end:int>>"), join)
    # The row goes along as one column, so no name of its own is in the way.
    packed = docs.select(F.struct("*").alias("row"), F.col(text).alias("text"))
    marked = scan(packed).withColumn("_cuts", cuts)
    before = lambda i: F.when(i > 0, F.get(F.col("_cuts"), i - 1)["end"]).otherwise(0)
    pieces = F.transform(
        "_cuts",
        lambda c, i: F.concat(F.substring(F.col("text"), before(i) + 1, c["start"] - before(i)), F.lit(MASK)),
    )
    rest = F.substring(F.col("text"), F.element_at("_cuts", -1)["end"] + 1, F.char_length("text"))
    clean = F.when(F.size("_cuts") > 0, F.concat(F.array_join(pieces, ""), rest)).otherwise(F.col("text"))
    return marked.select("row", clean.alias("text")).select(
        *(F.col("text").alias(c) if c == text else F.col("row").getField(c).alias(c) for c in docs.columns)
    )
