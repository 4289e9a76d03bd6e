"""URL filter by a path-template tree.

Per host, path segments that vary are generalised into wildcards, first by
their form and then by how many different ones a node has; sibling branches with
statistically equal label rates are merged; templates whose smoothed share of
blocked labelled urls is high are rejected. Labels come from explicit rules.
Smoothing runs down the tree: each node's share leans on its parent's (all, site,
host, then segment by segment), so where a template has few labels or none, those
of its nearest ancestors decide.
DataFrame functions only; every step works on counted templates, not on urls.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .frames import Scratch

#: (verdict, rule) as host and path prefix.
RULES = (
    ("allow", "com/"),
    ("block", "example.com/en/"),
    ("allow", "www.example.com/en/"),
    ("block", "net/es/"),
    ("block", "net/fr/"),
)
LETTERS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


@dataclass(frozen=True)
class Settings:
    depth: int = 3  # segments with a column of their own; the rest is one last segment
    min_kinds: int = 10  # a node with at least so many children ...
    kinds_pct: int = 50  # ... per this share of its urls holds a variable
    min_labelled: int = 5  # branches with fewer labels are never merged
    z: float = 1.96  # standard errors within which label rates count as equal
    prior: float = 10.0  # labels that a node's parent weighs as much as
    purity: float = 0.8  # templates from here on are rejected


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host in lower case and path; both empty for a null url or one without ``://``."""
    at = F.locate("://", url)
    rest = F.substr(url, at + 3)
    has = url.isNotNull() & (at > 0)
    host = F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), LETTERS, LETTERS.lower())
    path = F.regexp_extract(F.substr(rest, F.length(F.regexp_extract(rest, r"^([^/?#]*)", 1)) + 1), r"^([^?#]*)", 1)
    return F.when(has, host).otherwise(F.lit("")), F.when(has, path).otherwise(F.lit(""))


def matching_rule(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits, or nulls."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for kind, text in sorted(rules, key=lambda r: (len(r[1]), r[1])):
        name, _, prefix = text.partition("/")
        fits = ((host == name) | host.endswith("." + name)) & path.startswith("/" + prefix)
        rule, verdict = F.when(fits, F.lit(text)).otherwise(rule), F.when(fits, F.lit(kind)).otherwise(verdict)
    return rule, verdict


def segment_form(s: Column) -> Column:
    """A path segment with the parts that vary by form replaced: identifiers in hex, then numbers."""
    s = F.regexp_replace(s, r"[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}|[0-9a-f]{16,}", "{h}")
    return F.regexp_replace(s, r"[0-9]+", "{n}")


def _segments(path: Column, depth: int) -> list[Column]:
    parts = F.split(path, "/")  # the first is what stands before the leading slash
    one = [F.coalesce(segment_form(F.get(parts, F.lit(i))), F.lit("")) for i in range(1, depth + 1)]
    rest = F.array_join(F.slice(parts, depth + 2, 1 << 20), "/")
    return [*one, F.coalesce(F.when(F.size(parts) > depth + 1, segment_form(rest)), F.lit(""))]


def path_templates(pages: DataFrame, s: Settings, scratch: Scratch) -> DataFrame:
    """(host, g1.., t1.., labelled, blocked) for each generalised path: its template after both steps.

    ``pages`` has host, g1.. and verdict.
    """
    g = [f"g{i}" for i in range(1, s.depth + 2)]
    t = [f"t{i}" for i in range(1, s.depth + 2)]
    counts = pages.groupBy("host", *g).agg(
        F.count("*").alias("n"), F.count("verdict").alias("labelled"), F.count(F.when(F.col("verdict") == "block", 1)).alias("blocked")
    )
    table = scratch.store(counts.select("*", *[F.col(a).alias(b) for a, b in zip(g, t)]))

    for i in range(len(t)):  # wildcards, from the root down
        node = ["host", *t[:i]]
        children = table.groupBy(*node, t[i]).agg(F.sum("n").alias("n"))
        wide = (
            children.groupBy(*node)
            .agg(F.count("*").alias("kinds"), F.sum("n").alias("urls"))
            .where((F.col("kinds") >= s.min_kinds) & (100 * F.col("kinds") >= s.kinds_pct * F.col("urls")))
            .select(*node, F.lit(True).alias("wide"))
        )
        step = F.when(F.col("wide") & (F.col(t[i]) != ""), F.lit("*")).otherwise(F.col(t[i]))
        table = scratch.store(table.join(wide, node, "left").withColumn(t[i], step).drop("wide"))

    for i in range(len(t)):  # merging of siblings that differ in segment i alone
        family = ["host", *t[:i], *t[i + 1 :]]
        branch = table.groupBy(*family, t[i]).agg(F.sum("labelled").alias("bl"), F.sum("blocked").alias("bb"))
        sure = branch.where((F.col("bl") >= s.min_labelled) & ~F.col(t[i]).isin("", "*"))
        sure = sure.withColumn("side", F.when(2 * F.col("bb") >= F.col("bl"), F.lit("(+)")).otherwise(F.lit("(-)")))  # mostly blocked, or not
        pool = (
            sure.groupBy(*family, "side").agg(F.sum("bl").alias("pl"), F.sum("bb").alias("pb"), F.count("*").alias("branches")).where("branches > 1")
        )
        rate, share = F.col("pb") / F.col("pl"), F.col("bb") / F.col("bl")
        alike = (
            sure.join(pool, [*family, "side"])
            .where(F.abs(share - rate) <= F.lit(s.z) * F.sqrt(rate * (F.lit(1.0) - rate) / F.col("bl")))
            .select(*family, t[i], F.col("side").alias("alike"))
        )
        step = F.coalesce("alike", t[i])
        table = scratch.store(table.join(alike, [*family, t[i]], "left").withColumn(t[i], step).drop("alike"))
    return table


def filter_urls(pages: DataFrame, page: str = "page_id", url: str = "url", rules=RULES, settings: Settings = Settings()) -> DataFrame:
    """(page, host, path, rule, verdict, template, purity) of each row.

    The verdict is the longest fitting rule's, else the template's: ``block``
    from the limit of its smoothed purity on, which is (blocked + prior * purity
    of the parent) / (labelled + prior) over the urls that rules label. The
    parent of a template is the template without its last segment, then its
    host, its site (the host's last two labels) and all urls. A url that is
    null or has no ``://`` has empty host and path and is judged like any other
    template. Without any label the purity is 0. Repeated rows get equal
    results; other columns are ignored; an empty table gives an empty result.
    """
    s = settings
    g = [f"g{i}" for i in range(1, s.depth + 2)]
    t = [f"t{i}" for i in range(1, s.depth + 2)]
    host, path = host_and_path(F.col("url"))
    rows = pages.select(F.col(f"`{page}`").alias("page"), F.col(f"`{url}`").alias("url")).select("page", host.alias("host"), path.alias("path"))
    rule, verdict = matching_rule(F.col("host"), F.col("path"), rules)
    rows = rows.select("*", rule.alias("rule"), verdict.alias("verdict"), *[c.alias(a) for c, a in zip(_segments(F.col("path"), s.depth), g)])
    table = path_templates(rows, s, Scratch(pages.sparkSession))
    totals = table.groupBy("host", *t).agg(F.sum("labelled").alias("tl"), F.sum("blocked").alias("tb"))
    overall = rows.agg(F.coalesce(F.count(F.when(F.col("verdict") == "block", 1)) / F.nullif(F.count("verdict"), F.lit(0)), F.lit(0.0)).alias("rate"))
    site = F.regexp_extract("host", r"([^.]+\.)?[^.]*$", 0)
    level, below = totals.withColumn("site", site), [["site"], ["site", "host"], *[["host", *t[:i]] for i in range(1, len(t) + 1)]]
    judged = overall.select(F.col("rate").alias("purity"))
    for node in below:  # from the root down; a few rows for each host
        own = level.groupBy(*node).agg(F.sum("tl").alias("tl"), F.sum("tb").alias("tb"))
        above = [c for c in node if c in judged.columns]
        parents = own.join(judged, above) if above else own.join(F.broadcast(judged))  # one row
        judged = parents.select(*node, ((F.col("tb") + F.lit(s.prior) * F.col("purity")) / (F.col("tl") + F.lit(s.prior))).alias("purity"))
    template = F.rtrim(F.concat(*[F.concat(F.lit("/"), F.col(x)) for x in t]), F.lit("/"))
    of_path = table.join(judged, ["host", *t]).select("host", *g, template.alias("template"), "purity")
    return rows.join(of_path, ["host", *g]).select(
        F.col("page").alias(page), "host", "path", "rule",
        F.coalesce("verdict", F.when(F.col("purity") >= s.purity, F.lit("block")).otherwise(F.lit("allow"))).alias("verdict"),
        "template", F.round("purity", 6).alias("purity"),
    )
