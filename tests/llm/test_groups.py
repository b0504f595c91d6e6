"""License, spelling and conversation operators against brute force and edge cases."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from tripflow.llm import licenses, prefix_trie, spelling

FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def license_brute(text):
    w = re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", (text or "").translate(FOLD))
    places, base, found, best = set(), set(), set(), 0.0
    for phrase, label in licenses.PHRASES:
        p = phrase.split()
        for i in range(len(w) - len(p) + 1):
            if w[i:i + len(p)] == p:
                places.add((i, label))
                base.add(label)
    half = licenses.BLOCK // 2
    for start in range(0, max(len(w), 1), half):
        block = w[start:start + licenses.BLOCK]
        held = set(zip(block, block[1:], strict=False))
        for label, template in licenses.TEMPLATES:
            t = template.split()
            wanted = set(zip(t, t[1:], strict=False))
            if 100 * len(wanted & held) >= licenses.CONTAINS * len(wanted):
                found.add(label)
                best = max(best, len(wanted & held) / len(wanted))
    starts = sorted(i for i, _ in places)
    return (
        len(w), len(starts), starts[0] if starts else None, starts[-1] if starts else None, ",".join(sorted(base)),
        ",".join(sorted(base | found)), max(best, 0.5 if places else 0.0),
    )


LICENSE_TEXTS = [
    None, "", "mit", "MIT License", "apache\nlicense, CC-BY! cc by", "é the MIT-Licensé",
    " ".join(licenses.TEMPLATES[2][1].upper().split()), "word " * 60 + licenses.TEMPLATES[7][1] + " word" * 300,
    ("x " * 63 + licenses.TEMPLATES[9][1]).replace(" and binary", " or binary"),
    "Licensed under the Apache License, Version 3.0", "gnu general public " * 40 + "license",
    "released under the old mit license", "the of " * 20_000 + licenses.TEMPLATES[10][1],
    "y" * 2_500_000 + " mit license", "z " * 700_000 + licenses.TEMPLATES[4][1], "MIT License", "MIT License",
]


def test_licenses(spark):
    rows = [(None if i == 3 else i // 2, t, "clash", i) for i, t in enumerate(LICENSE_TEXTS)]
    docs = spark.createDataFrame(rows, "doc_id LONG, text STRING, labels STRING, _row LONG")
    got = Counter(tuple(r) for r in licenses.license_report(docs.repartition(3)).collect())
    assert got == Counter((r[0], *license_brute(r[1])) for r in rows)
    assert licenses.license_report(docs.limit(0)).count() == 0


def test_license_join_finds_every_block(spark):
    """Edited templates around the threshold, in every place of a window."""
    texts = []
    for n, (_, template) in enumerate(licenses.TEMPLATES):
        w = template.split()
        for drop in range(0, len(w), 3):
            for lead in (0, 61, 63, 64, 100):
                texts.append(" ".join(["lead"] * (lead + n) + w[:drop] + ["edit"] + w[drop + 1 + n % 2:]))
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id LONG, text STRING")
    got = {r[0]: tuple(r)[1:] for r in licenses.license_report(docs).collect()}
    assert got == {i: license_brute(t) for i, t in enumerate(texts)}


def near_brute(words):
    cuts, near = defaultdict(set), defaultdict(set)
    for w in words:
        for i in range(len(w)):
            rest = w[:i] + w[i + 1:]
            cuts[i, rest].add(w)
            if rest in words:
                near[w].add(rest)
                near[rest].add(w)
    for group in cuts.values():
        for w in group:
            near[w] |= group - {w}
    return near


def spelling_brute(counts):
    near, form = near_brute(counts), {}
    for w, n in counts.items():
        if near[w]:
            best = min(near[w], key=lambda x: (-counts[x], x))
            if counts[best] >= 10 * n:
                form[w] = best
    out = set()
    for w, n in counts.items():
        root = w
        while root in form:
            root = form[root]
        out.add((w, n, form.get(w), root, len(near[w]), counts[form[w]] if w in form else None))
    return out


def words_brute(rows):
    counts = Counter()
    for doc, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(FOLD)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if h % 31 == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1:]
            if len(run) >= 7:
                counts[run] += 1
    return {w: n for w, n in counts.items() if n >= 2}


@pytest.mark.parametrize("group", [2, 5, 1000])
def test_near_words(spark, monkeypatch, group):
    """Dense words, long chains of forms, one hot prefix, short words; parts are halved down to single places."""
    monkeypatch.setattr(spelling, "GROUP", group)
    words = {f"{a}{b}{c}{d}": 1 + len(a + b) for a in ("", "a", "b") for b in ("ab", "ba", "é") for c in ("", "a", "aa")
             for d in ("b", "ab", "")}
    words |= {"hotprefix" + x + y: 3 for x in "abcdeABCDÿ" for y in "abcdeé×"}
    words |= {"chain" + "x" * i: 2 * 10 ** i for i in range(15)}
    table = spark.createDataFrame(list(words.items()), "word STRING, n LONG")
    got = spelling.spelling_groups(table).select("word", "n", "form", "root", "n_near", "form_n").collect()
    assert {tuple(r) for r in got} == spelling_brute(words) and len(got) == len(words)


def test_word_counts(spark, edge_docs, no_docs):
    rows = [(i % 7 if i % 11 else None, "Äpfelchen AEPFELCHEN äpfelchen1aepfelchen " * (i % 5) + f"word{'x' * i}")
            for i in range(400)] + [(5, None), (None, ""), (1, "q" * 200_000), (1, "q" * 200_000)]
    docs = spark.createDataFrame(rows, "doc_id LONG, text STRING").withColumn("word", F.lit("clash"))
    assert {r.word: r.n for r in spelling.count_words(docs).collect()} == words_brute(rows)
    assert spelling.variant_report(no_docs).count() == 0 and spelling.variant_report(edge_docs).count() >= 0


def trie_brute(rows):
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            own[conv].append((turn is not None, turn or 0, role or "", text or ""))
    turns = {c: [t[2:] for t in sorted(v)] for c, v in own.items()}
    rebuilt = {}
    for c in turns:
        h = zlib.crc32(str(c).encode()) % 9
        rebuilt[c] = tuple(turns.get(c - c % 5, [])[:h] + turns[c][h:])
    members, below = defaultdict(list), defaultdict(set)
    for c, t in rebuilt.items():
        for d in range(len(t) + 1):
            members[t[:d]].append(c)
    for path in members:
        if path:
            below[path[:-1]].add(path)
    sums = {}
    for path in sorted(members, key=len, reverse=True):
        leaves = sum(sums[k][0] for k in below[path]) or 1
        saved = sum(sums[k][1] for k in below[path])
        sums[path] = leaves, saved + ((len(members[path]) - 1) * len(path[-1][1].encode()) if path else 0)
    out = []
    for path, convs in members.items():
        ends = ",".join(map(str, sorted(c for c in convs if len(rebuilt[c]) == len(path))))
        out.append((
            min(convs), len(path), min(members[path[:-1]]) if path else None, len(convs), len(below[path]),
            *sums[path], hashlib.sha256(ends.encode()).hexdigest(),
        ))
    return Counter(out)


def conversations():
    rows = []
    for c in range(240):
        if c % 5 == 0 and c % 3 == 0:
            continue  # a base that is absent
        for t in range(c % 14):
            text = f"t{t}" if t < 3 or c % 4 == 0 else f"{c % (t + 1)} é" * (t % 3)
            rows.append((c, None if t == 0 and c % 7 == 0 else t, None if c % 6 == 0 else f"r{t % 2}", text or None))
    rows += [(1000, t, "u", f"deep {t}") for t in range(61)] + [(1001, t, "u", f"deep {t}") for t in range(59)]
    rows += [(1003, t, "u", f"deep {t}" if t < 40 else "off") for t in range(50)] + [(None, 1, "u", "nobody")]
    return rows


def test_trie(spark, monkeypatch):
    rows = conversations()
    table = spark.createDataFrame(rows, "conv_id LONG, turn LONG, role STRING, text STRING").withColumns(
        {c: F.lit("clash") for c in ("depth", "x", "n", "block")}
    )
    want = trie_brute(rows)
    assert Counter(tuple(r) for r in prefix_trie.trie_report(table).collect()) == want
    # Pieces of a few rows, as for conversations and groups of ends that hold a third of all rows.
    monkeypatch.setattr(prefix_trie, "_CHUNK", 3)
    monkeypatch.setattr(prefix_trie, "_IDS", 2)
    assert Counter(tuple(r) for r in prefix_trie.trie_report(table.repartition(5)).collect()) == want
    assert prefix_trie.trie_report(table.limit(0)).count() == 0
    one = spark.createDataFrame([(7, None, None, None)], table.select("conv_id", "turn", "role", "text").schema)
    assert [tuple(r) for r in prefix_trie.trie_report(one).collect()] == list(trie_brute([(7, None, None, None)]))


def test_repeated_turns(spark):
    """Rows of the same conversation and turn: their order is by digest, and no row is lost."""
    rows = [(5, 0, "u", "a"), (5, 0, "u", "b"), (5, 0, "u", "b"), (5, None, None, "c")]
    table = spark.createDataFrame(rows, "conv_id LONG, turn LONG, role STRING, text STRING")
    got = prefix_trie.trie_report(table).collect()
    assert sorted(r.depth for r in got) == [0, 1, 2, 3, 4] and {r.n_convs for r in got} == {1}
