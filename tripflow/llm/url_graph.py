"""URL filters: host and path rules, and trust that spreads over the link graph of hosts.

A rule is a host, a slash and the start of a path. It fits its host and all subdomains; of several that
fit, the longest wins. Pages that no rule fits get their host's verdict by the link graph:

* edges lead from a page's host to the other hosts that its links name, weighted by the pages;
* trust is a PageRank that restarts at hosts with allowed pages, along the edges;
* distrust is one that restarts at hosts with blocked pages, against the edges;
* a host whose distrust is at least `limit` of both together is blocked.

A host's share of the restarts is the share of its pages that rules allow or block. Rank that reaches a
host without edges leaves. Rounds go on until no host gets its first rank and none changes by more
than a small part of itself, so a verdict reaches the end of a chain of any length.
"""

from pyspark.sql import functions as F

from tripflow.session import settle

# The rules, longest first where they overlap.
RULES = (
    ("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"),
    ("allow", "com/fr/"), ("block", "com/de/"),
)
DAMPING = 0.8
# The change of a rank, of itself, that ends the rounds.
TOLERANCE = 1e-6
LIMIT = 0.75
_ROUNDS_A_PLAN = 4
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_LINK = r"""(?i)<a\s[^>]*?href\s*=\s*["']?\s*((?:[a-z][a-z0-9+.-]*:)?//[^"'\s>]*)"""


def host_and_path(url):
    """Text after the first ``://`` up to ``/ ? #``, A-Z lower-cased; then up to ``?`` or ``#``.

    A null url or one without ``://`` has neither: two empty texts.
    """
    mark = F.coalesce(F.instr(url, "://"), F.lit(0))
    rest = F.when(mark > 0, F.substring(url, mark + 3, F.char_length(url))).otherwise(F.lit(""))
    host = F.translate(F.regexp_extract(rest, "^([^/?#]*)", 1), _UPPER, _LOWER)
    return host, F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)


def matching_rule(host, path, rules=RULES):
    """The longest rule that fits, or null; of two as long, the one with the longer host, then block."""
    order = sorted(rules, key=lambda r: (-len(r[1]), -r[1].index("/"), r[0] != "block", r[1]))
    found = F.lit(None).cast("string")
    for _, rule in reversed(order):
        name, start = rule.split("/", 1)
        fits = ((host == name) | host.endswith(f".{name}")) & path.startswith(f"/{start}")
        found = F.when(fits, rule).otherwise(found)
    return found


def judged_pages(pages, rules=RULES, page_id="page_id", url="url"):
    """``page_id, host, path, rule, ruled``: the rule that fits and its verdict, or nulls."""
    host, path = host_and_path(F.col(url))
    verdicts = F.create_map(*[F.lit(x) for verdict, rule in rules for x in (rule, verdict)])
    return (
        pages.select(F.col(page_id).alias("page_id"), host.alias("host"), path.alias("path"))
        .withColumn("rule", matching_rule(F.col("host"), F.col("path"), rules))
        .withColumn("ruled", F.element_at(verdicts, F.col("rule")))
    )


def host_edges(pages, url="url", html="html"):
    """``src, dst, pages``: pages of ``src`` with a link to ``dst``, another host. Absolute links and
    those that begin with ``//`` name a host; a page counts once for each."""
    named = F.transform(
        F.regexp_extract_all(F.col(html), F.lit(_LINK), F.lit(1)),
        lambda link: F.translate(F.regexp_extract(link, "^[^/]*//([^/?#]*)", 1), _UPPER, _LOWER),
    )
    return (
        pages.filter(F.rlike(html, F.lit(_LINK)))
        .select(host_and_path(F.col(url))[0].alias("src"), F.explode(F.array_distinct(named)).alias("dst"))
        .filter("src != '' and dst != '' and src != dst")
        .groupBy("src", "dst").agg(F.count(F.lit(1)).alias("pages"))
    )


def spread_ranks(edges, restarts, damping=DAMPING, tolerance=TOLERANCE):
    """``kind, host, rank`` at convergence. ``edges``: kind, src, dst, share (of what src passes on);
    ``restarts``: kind, host, share. Only hosts with a rank are kept.

    A round is one shuffle of a row for each task and host. Every few rounds ranks are written and
    compared with those before, so a lost executor costs those rounds at most.
    """
    ranks, before = restarts.withColumnRenamed("share", "rank"), None
    again = restarts.select("kind", "host", ((1 - damping) * F.col("share")).alias("rank"))
    while True:
        for _ in range(_ROUNDS_A_PLAN):
            passed = edges.join(ranks.withColumnRenamed("host", "src"), ["kind", "src"]).select(
                "kind", F.col("dst").alias("host"), (damping * F.col("rank") * F.col("share")).alias("rank")
            )
            ranks = passed.union(again).groupBy("kind", "host").agg(F.sum("rank").alias("rank"))
        ranks = settle(ranks, "host-ranks")
        if before is not None:
            moved = ranks.join(before, ["kind", "host"], "left").filter(
                F.col("before").isNull() | (F.abs(F.col("rank") - F.col("before")) > tolerance * F.col("rank"))
            )
            if moved.isEmpty():
                return ranks
        before = ranks.withColumnRenamed("rank", "before")


def host_verdicts(pages, judged, damping=DAMPING, tolerance=TOLERANCE, limit=LIMIT):
    """``host, trust, distrust, verdict`` of hosts that a rank reaches; all others are allowed."""
    count = lambda verdict: F.count(F.when(F.col("ruled") == verdict, 1))
    hosts = settle(
        judged.filter("host != ''").groupBy("host").agg(
            F.count(F.lit(1)).alias("n"), count("allow").alias("allow"), count("block").alias("block")
        ),
        "host-pages",
    )
    shares = hosts.select(
        F.explode(F.create_map(F.lit("trust"), F.col("allow") / F.col("n"), F.lit("distrust"), F.col("block") / F.col("n")))
        .alias("kind", "share"), "host",
    ).filter("share > 0")
    totals = shares.groupBy("kind").agg(F.sum("share").alias("total"))
    restarts = settle(
        shares.join(totals, "kind").select("kind", "host", (F.col("share") / F.col("total")).alias("share")), "restarts"
    )
    links = settle(host_edges(pages), "host-edges")
    ways = links.select(F.lit("trust").alias("kind"), "src", "dst", "pages").union(
        links.select(F.lit("distrust"), F.col("dst"), F.col("src"), "pages")
    )
    out = ways.groupBy("kind", "src").agg(F.sum("pages").alias("out"))
    edges = settle(
        ways.join(out, ["kind", "src"]).select("kind", "src", "dst", (F.col("pages") / F.col("out")).alias("share")),
        "weighted-edges",
    )
    ranks = spread_ranks(edges, restarts, damping, tolerance)
    of = lambda kind: F.sum(F.when(F.col("kind") == kind, F.col("rank")).otherwise(0.0))
    both = ranks.groupBy("host").agg(of("trust").alias("trust"), of("distrust").alias("distrust"))
    blocked = F.col("distrust") >= limit * (F.col("trust") + F.col("distrust"))
    return both.withColumn("verdict", F.when(blocked, "block").otherwise("allow"))


def judge_urls(pages, rules=RULES, damping=DAMPING, tolerance=TOLERANCE, limit=LIMIT):
    """``page_id, host, path, rule, verdict`` for each page, repeated rows and null ids included.

    Pages without a host, and hosts that no rank reaches, are allowed. A null html has no links.
    """
    judged = judged_pages(pages, rules)
    hosts = settle(host_verdicts(pages, judged, damping, tolerance, limit).select("host", "verdict"), "host-verdicts")
    return judged.join(hosts, "host", "left").select(
        "page_id", "host", "path", "rule", F.coalesce("ruled", "verdict", F.lit("allow")).alias("verdict")
    )
