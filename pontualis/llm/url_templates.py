"""URL filters: path templates per host, judged by the purity of their labelled members.

Built-in column functions only.  Rules judge the URLs they fit; those verdicts
are also the labels.  The paths of a host form a tree of segments.  Segments that
look variable (numbers, hashes, dates) become wildcards at once, which reduces
the URLs to few shapes before anything is shuffled.  Then the tree is walked from
the host down, and siblings are merged where their labels say they are alike: a labelled
child joins the branch ``*#`` when a two-proportion test does not tell its share of
blocked labels from that of its labelled siblings, and both sides have ``LEAST`` labels.
Children without any label join the branch ``*?`` of their own kind and never take a
labelled sibling's verdict.  No path holds ``#`` or ``?``, so these names are no segments.
A leaf template is rejected when its smoothed share of blocked labels reaches ``REJECT``;
one with labels on less than ``COVERED`` of its pages has the share of all labels.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pontualis.llm.tables import Workspace, join_unique

# Verdict, host and path of each rule.
RULES = (("allow", "org", "/"), ("block", "example.org", "/es/"),
         ("block", "example.org", "/en/1"), ("allow", "com", "/fr/"), ("block", "com", "/de/"))

# Standard errors within which the block rates of a child and of its siblings are the same,
# and labels that both sides need to be compared at all.
DEVIATIONS = 1.96
LEAST = 3
# Share of the pages of a template that must have labels for these to speak for the others.
COVERED = 0.5
# Pseudo-labels of a template, at the block rate of all labels.
SMOOTHING = 4.0
REJECT = 0.8

_NUMBER = r"^[0-9][0-9_.:-]*(\.[A-Za-z0-9]{1,5})?$"
_OPAQUE = r"^[0-9a-fA-F-]{8,}$|[0-9].*[0-9].*[0-9].*[0-9]|^.{41,}$"


def _keyed(urls: DataFrame, url: str) -> DataFrame:
    """Add host, path and shape; a URL without ``://`` has an empty host and path."""
    rest = F.regexp_extract(F.coalesce(F.col(url), F.lit("")), r"(?s)^.*?://(.*)$", 1)
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    out = urls.withColumn("rest", rest)
    out = out.withColumn("host", F.translate(
        F.regexp_extract("rest", r"(?s)^([^/?#]*)", 1), upper, lower))
    out = out.withColumn("path", F.regexp_extract("rest", r"(?s)^[^/?#]*([^?#]*)", 1))

    def general(segment: Column) -> Column:
        ending = F.regexp_extract(segment, r"\.[A-Za-z]{1,5}$", 0)
        return (F.when(segment.rlike(_NUMBER), F.concat(F.lit("*"), ending))
                .when(segment.rlike(_OPAQUE), F.lit("*")).otherwise(segment))

    segments = F.split("path", "/")
    return (out.withColumn("shape", F.transform(segments, general)).drop("rest"))


def _rule(rules: Sequence[tuple[str, str, str]], value: int | None) -> Column:
    """The longest rule that fits, as text, or its verdict; NULL without one."""
    host, path = F.col("host"), F.col("path")
    cases = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((host == rule[1]) | host.endswith("." + rule[1])) & path.startswith(rule[2])
        cases = F.when(fits, rule[1] + rule[2] if value is None else rule[value]).otherwise(cases)
    return cases


def template_tree(shapes: DataFrame, workspace: Workspace) -> DataFrame:
    """``host``, ``shape`` and ``template`` of counted shapes (pages, labelled, blocked).

    Paths are followed to their end.  A shape that is alone at its node equals what the
    node pools, so all its further segments are wildcards and it is done.
    """
    rows = shapes.count()
    table, level, done = shapes.withColumn("prefix", F.lit("")), 0, []
    while level == 0 or table.limit(1).count():
        level += 1
        table = table.withColumn("segment", F.get("shape", F.lit(level)))
        children = table.where("segment IS NOT NULL").groupBy("host", "prefix", "segment").agg(
            F.count(F.lit(1)).alias("rows"), F.sum("labelled").alias("labelled"),
            F.sum("blocked").alias("blocked"))
        children = workspace.save(children, f"children-{level}")
        nodes = children.groupBy("host", "prefix").agg(
            F.count(F.lit(1)).alias("children"), F.sum("rows").alias("all_rows"),
            F.sum("labelled").alias("all_labelled"), F.sum("blocked").alias("all_blocked"))
        n, k = F.col("labelled"), F.col("blocked")
        others, hit = F.col("all_labelled") - n, F.col("all_blocked") - k
        rate = (F.col("all_blocked") + 1) / (F.col("all_labelled") + 2)
        error = F.sqrt(rate * (1 - rate) * (1 / F.greatest(n, F.lit(1)) + 1 / F.greatest(others, F.lit(1))))
        apart = F.abs(k / F.greatest(n, F.lit(1)) - hit / F.greatest(others, F.lit(1)))
        similar = (n >= LEAST) & (others >= LEAST) & (apart <= DEVIATIONS * error)
        branch = (F.when(n == 0, F.lit("*?")).when(similar, F.lit("*#"))
                  .otherwise(F.col("segment")))
        merged = join_unique(children, nodes, ["host", "prefix"], "children", rows).select(
            "host", "prefix", "segment", "rows", (F.col("all_rows") == 1).alias("alone"),
            branch.alias("branch"))
        deeper = join_unique(table.where("segment IS NOT NULL"), merged,
                             ["host", "prefix", "segment"], "rows", rows)
        ended = table.where("segment IS NULL").withColumns(
            {"branch": F.lit(None).cast("string"), "alone": F.lit(True)})
        columns = ["host", "shape", "pages", "labelled", "blocked"]
        further = F.repeat(F.lit("/*"), F.size("shape") - level)
        prefix = F.when(F.col("branch").isNotNull() & F.col("alone"), F.concat("prefix", further)
                        ).otherwise(F.concat_ws("/", "prefix", "branch"))
        table = workspace.save(
            deeper.select(*columns, "prefix", "branch", "alone")
            .unionByName(ended.select(*columns, "prefix", "branch", "alone"))
            .select(*columns, prefix.alias("prefix"), "alone"), f"level-{level}")
        done.append(table.where("alone").drop("alone"))
        table = table.where("NOT alone").drop("alone")
    return reduce(DataFrame.unionByName, done).withColumnRenamed("prefix", "template")


def judge_urls(pages: DataFrame, rules: Sequence[tuple[str, str, str]] = RULES,
               page_id: str = "page_id", url: str = "url") -> DataFrame:
    """``page_id``, ``host``, ``path``, ``rule``, ``verdict`` and ``template`` of every row.

    NULL URLs and those without ``://`` have an empty host and path, fit no rule and share
    the template of the empty host.  Repeated rows are all returned and all counted; other
    columns may have any name.  Without labels every template has the rate of none and
    is allowed.  A host with labels on one branch only keeps that branch apart.
    """
    workspace = Workspace(pages.sparkSession, "url-templates")
    source = _keyed(pages.select(F.col(f"`{page_id}`").alias("id"),
                                 F.col(f"`{url}`").cast("string").alias("url")), "url")
    source = source.select("id", "host", "path", "shape", _rule(rules, None).alias("rule"),
                           _rule(rules, 0).alias("ruled"))
    label = F.col("ruled")
    shapes = workspace.save(source.groupBy("host", "shape").agg(
        F.count(F.lit(1)).alias("pages"), F.count(label).alias("labelled"),
        F.count(F.when(label == "block", 1)).alias("blocked")), "shapes")
    total = shapes.agg(F.sum("pages").alias("pages"), F.sum("labelled").alias("labelled"),
                       F.sum("blocked").alias("blocked")).first()
    prior = (total.blocked or 0) / max(total.labelled or 0, 1)
    tree = workspace.save(template_tree(shapes, workspace), "tree")
    share = (F.sum("blocked") + SMOOTHING * prior) / (F.sum("labelled") + SMOOTHING)
    purity = F.when(F.sum("labelled") >= COVERED * F.sum("pages"), share).otherwise(F.lit(float(prior)))
    leaves = tree.groupBy("host", "template").agg(
        F.count(F.lit(1)).alias("shapes"), F.round(purity, 6).alias("purity"))
    judged = join_unique(tree, leaves, ["host", "template"], "shapes", tree.count()).select(
        "host", "shape", "pages", "template", "purity")
    placed = join_unique(source, workspace.save(judged, "judged"), ["host", "shape"], "pages",
                         total.pages or 0)
    method = F.when(F.col("purity") >= REJECT, F.lit("block")).otherwise(F.lit("allow"))
    return placed.select(F.col("id").alias(page_id), "host", "path", "rule",
                         F.coalesce("ruled", method).alias("verdict"), "template", "purity")
