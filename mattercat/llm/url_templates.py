"""URL filtering by per-host trees of path templates with smoothed labelled purity.

Rules label part of the urls. Every path becomes a template: segments that vary
(numbers, hashes, ids, or a position with many different values) are wildcards.
Branches of a node whose labels do not differ beyond chance are merged, and a template is
judged by the share of blocked urls among its labelled ones, smoothed towards the share
of its host and, above that, of all urls.

Everything here is DataFrame operations on counts: urls are first reduced to one row
for each template and verdict, so a host with a third of all urls is a few rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import staged

DEPTH = 4  # levels of a tree; deeper segments share one wildcard
VARIED = 12  # different values from which a position is variable
REPEATS = 4  # urls each value of a position has on average where it is not

Rule = tuple[str, str]  # ("example.net/en/", "allow")


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host and path. Without ``://``, or for null, both are empty.

    The host ends at the first ``/``, ``?`` or ``#`` and has A-Z in lower case; the path
    goes on up to ``?`` or ``#``.
    """
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url)))
    host = F.translate(F.regexp_extract(rest, r"(?s)^([^/?#]*)", 1), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    path = F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)
    return F.coalesce(host, F.lit("")), F.coalesce(path, F.lit(""))


def matched_rule(host: Column, path: Column, rules: Sequence[Rule]) -> Column:
    """The longest rule that fits, as text; null without one.

    A rule fits its host and all subdomains, if the path starts with the rule's.
    """
    found = F.lit(None).cast("string")
    for rule, _ in sorted(rules, key=lambda r: (len(r[0]), r[0])):
        domain, slash, start = rule.partition("/")
        fits = ((host == domain) | F.endswith(host, F.lit("." + domain))) & F.startswith(path, F.lit(slash + start))
        found = F.when(fits, F.lit(rule)).otherwise(found)
    return found


def segments(path: Column) -> Column:
    """Segments of a path with variable shapes already generalised; always ``DEPTH`` of them.

    Whole numbers are ``{n}``, hexadecimal names of 8 and more ``{x}``, names with digits
    ``{i}``; an ending such as ``.html`` stays. Missing segments are empty, and what lies
    deeper than the tree is one ``{**}``.
    """
    parts = F.filter(F.split(path, "/"), lambda s: s != "")

    def shape(s: Column) -> Column:
        s = F.regexp_replace(s, r"^[0-9]+(?=\.[a-z]{2,5}$|$)", "{n}")
        s = F.when(s.rlike(r"[0-9]"), F.regexp_replace(s, r"^[0-9a-fA-F-]{8,}(?=\.[a-z]{2,5}$|$)", "{x}")).otherwise(s)
        return F.when(s.rlike(r"[0-9]") & ~F.contains(s, F.lit("{")), F.lit("{i}")).otherwise(s)

    short = F.transform(F.slice(parts, 1, DEPTH), shape)
    filled = F.concat(short, F.array_repeat(F.lit(""), F.greatest(F.lit(0), F.lit(DEPTH) - F.size(short))))
    deep = F.when(F.size(parts) > DEPTH, F.lit("{**}")).otherwise(F.lit(""))
    return F.concat(filled, F.array(deep))


def prefix(level: int) -> Column:
    """The template's first ``level`` segments as one text."""
    return F.concat_ws("/", F.slice("template", 1, level)) if level else F.lit("")


def template_tree(counts: DataFrame, z: float) -> DataFrame:
    """``counts`` with ``template``: the tree node each shape of path ends in.

    ``counts`` has ``host``, ``raw`` (array of segments), ``n``, ``blocked`` and ``labelled``. Level by
    level: a position becomes ``{*}`` where it takes ``VARIED`` values or more with fewer than
    ``REPEATS`` urls each; and labelled branches are merged into ``{=}`` where their share
    of blocked urls lies within ``z`` standard errors of their node's.
    """
    rows = counts.withColumn("template", F.col("raw"))
    for level in range(DEPTH):
        node = rows.withColumn("node", prefix(level)).withColumn("value", F.element_at("template", level + 1))
        branch = staged(node.groupBy("host", "node", "value").agg(
            F.sum("n").alias("n"), F.sum("labelled").alias("labelled"), F.sum("blocked").alias("blocked")), "branches")
        # Written first: a node with very many branches is then split by the join.
        own = staged(branch.groupBy("host", "node").agg(
            F.count("*").alias("values"), F.sum("n").alias("total"), F.sum("labelled").alias("seen"), F.sum("blocked").alias("bad")), "nodes")
        mean = (F.col("bad") + 1) / (F.col("seen") + 2)
        error = F.sqrt(mean * (1 - mean) / F.col("labelled"))
        similar = (F.col("labelled") > 0) & (F.abs(F.col("blocked") / F.col("labelled") - mean) <= z * error)
        variable = (F.col("values") >= VARIED) & (F.col("total") < REPEATS * F.col("values"))
        open_ = ~F.col("value").isin("", "{n}", "{x}", "{i}", "{**}")
        to = F.when(open_ & variable, F.lit("{*}")).when(open_ & similar & (F.col("labelled") < F.col("seen")), F.lit("{=}")).otherwise(F.col("value"))
        renamed = branch.join(own, ["host", "node"]).select("host", "node", "value", to.alias("to"))
        moved = node.join(staged(renamed, "renamed"), ["host", "node", "value"])
        rows = staged(moved.withColumn("template", F.concat(
            F.slice("template", 1, level), F.array("to"), F.slice("template", level + 2, DEPTH + 1))).drop("node", "value", "to"), "templates")
    return rows


def judged(tree: DataFrame, strength: float) -> DataFrame:
    """``(host, raw, template, labelled, purity)`` with the smoothed share of blocked urls of each template.

    A template counts ``strength`` urls at its host's share, and a host as many at the
    share of all urls: ``(blocked + strength * above) / (labelled + strength)``.
    """
    whole = tree.agg(F.sum("blocked").alias("b"), F.sum("labelled").alias("l")).first()
    share = F.lit((whole["b"] or 0) / max(1, whole["l"] or 0))
    rows = tree.withColumn("leaf", prefix(DEPTH + 1)).select("host", "raw", "template", "leaf", "blocked", "labelled")
    hosts = staged(rows.groupBy("host").agg(F.sum("blocked").alias("b"), F.sum("labelled").alias("l")), "hosts")
    leaves = staged(rows.groupBy("host", "leaf").agg(F.sum("blocked").alias("bad"), F.sum("labelled").alias("seen")), "leaves")
    above = (F.col("b") + strength * share) / (F.col("l") + strength)
    purity = (F.col("bad") + strength * above) / (F.col("seen") + strength)
    rated = staged(leaves.join(hosts, "host").select("host", "leaf", "seen", purity.alias("purity")), "rated")
    return rows.join(rated, ["host", "leaf"]).select("host", "raw", "template", F.col("seen").alias("labelled"), "purity")


def filter_urls(pages: DataFrame, rules: Sequence[Rule], page_id: str = "page_id", url: str = "url", strength: float = 4.0,
                limit: float = 0.5, z: float = 1.96) -> DataFrame:
    """``(page_id, host, path, rule, verdict, template, purity)`` for every page.

    ``verdict`` is the rule's where one fits. Elsewhere the template decides: ``block`` if
    it holds labelled urls and their smoothed share of blocked ones is over ``limit``, else
    ``allow``: a template without a label of its own is not rejected for its host's others.

    Null urls and such without ``://`` have an empty host and path and are judged like a host of their
    own. Repeated rows and null ids stay; other columns are not read; an empty table
    gives no rows. ``rules`` is a short list written by hand: it becomes part of the plan.
    """
    host, path = url_parts(pages[url])
    base = pages.select(pages[page_id].alias("page_id"), host.alias("host"), path.alias("path"))
    base = base.withColumn("rule", matched_rule(F.col("host"), F.col("path"), rules)).withColumn("raw", segments(F.col("path")))
    verdicts = F.create_map(*[F.lit(x) for rule in rules for x in rule])
    base = base.withColumn("ruled", F.element_at(verdicts, F.col("rule")))
    counts = staged(base.groupBy("host", "raw").agg(
        F.count("*").alias("n"), F.count("rule").alias("labelled"), F.count_if(F.col("ruled") == "block").alias("blocked")), "paths")
    found = staged(judged(template_tree(counts, z), strength), "judged")
    by = F.when((F.col("labelled") > 0) & (F.col("purity") > limit), "block").otherwise("allow")
    return base.join(found, ["host", "raw"]).select(
        "page_id", "host", "path", "rule", F.coalesce("ruled", by).alias("verdict"),
        F.concat_ws("/", F.filter("template", lambda s: s != "")).alias("template"), "purity")
