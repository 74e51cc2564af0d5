"""Verdicts on urls: rules for hosts and paths, and a path-template tree. DataFrame functions only.

Rules decide what they fit; the urls they decide are the labelled ones. The tree learns from all
urls and decides the others. Below each host, paths are followed segment by segment. Numbers in a
segment become ``{n}`` first, which folds most urls of a host into few shapes with counts; the tree
works on these. Then, level by level:

* a segment is variable below a node with many different ones; those of a small share become ``*``;
* branches of one node that look alike are merged: the same shapes follow in them, and their shares
  of blocked urls do not differ significantly. Branches without a labelled url are merged with each
  other only: nothing is known that would make them like the others.

What a path is led to is its template. The purity of a template is the share of blocked urls among
its labelled ones, smoothed towards one half; a template of high purity is rejected. It decides
urls without a rule that share a template with labelled ones, so below variable segments.

Counts are combined before each shuffle, so a host with a third of all urls is a few rows per task.
The last join leads urls to their shape's verdict; both its sides are shuffled for it, so that
adaptive execution can split a frequent shape.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from eventpulse.llm._common import LOWER, UPPER, col, saved

ALLOW, BLOCK = "allow", "block"

# Segments followed one by one; what comes after them is one last segment.
LEVELS = 8
# A node with more different segments than this is variable; segments of at least this share stay.
MAX_LITERALS = 12
LITERAL_SHARE = 0.05
# A shape belongs to a branch's looks when it has at least this share of it.
SHAPE_SHARE = 0.1
# Branches are merged below this many standard errors; labels count as if so many more had been seen.
SAME_BELOW = 1.96
SMOOTHING = 4.0
REJECT_FROM = 0.9


@dataclass(frozen=True)
class Rule:
    """A host with all its subdomains, and how paths begin, as in ``example.com/en/``."""

    pattern: str
    verdict: str

    def fits(self, host: str, path: str) -> Column:
        name, slash, rest = self.pattern.partition("/")
        h = F.col(host)
        inside = (h == name) | F.endswith(h, F.lit("." + name))
        return inside & F.startswith(F.col(path), F.lit(slash + rest))


def url_host(url: Column) -> Column:
    """What stands between the first ``://`` and ``/``, ``?``, ``#`` or the end, A-Z in lower case."""
    return F.translate(F.regexp_extract(_after_scheme(url), r"^[^/?#]*", 0), UPPER, LOWER)


def url_path(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end."""
    return F.regexp_extract(_after_scheme(url), r"^[^/?#]*([^?#]*)", 1)


def _after_scheme(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))


def with_rule(urls: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Add ``rule`` and ``ruled``, pattern and verdict of the longest rule that fits, else null.

    Of rules of one length, the longer host goes first, then the alphabet.
    """
    order = sorted(rules, key=lambda r: (-len(r.pattern), -r.pattern.find("/"), r.pattern))
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for r in reversed(order):
        fits = r.fits("host", "path")
        rule = F.when(fits, F.lit(r.pattern)).otherwise(rule)
        verdict = F.when(fits, F.lit(r.verdict)).otherwise(verdict)
    return urls.withColumns({"rule": rule, "ruled": verdict})


def shape(path: str) -> Column:
    """The path's segments, numbers folded, the ones beyond :data:`LEVELS` joined to one."""
    folded = F.regexp_replace(F.ltrim(F.col(path), F.lit("/")), "[0-9]+", "{n}")
    return F.when(F.col(path) == "", F.array().cast("array<string>")).otherwise(
        F.split(folded, "/", LEVELS + 1)
    )


def _named(units: DataFrame) -> DataFrame:
    """``host, tree, seg, name``: what each segment at a node is called; ``*`` where variable."""
    node = ["host", "tree"]
    children = saved(units.groupBy(*node, "seg").agg(F.sum("n").alias("n")), "children")
    nodes = saved(
        children.groupBy(*node).agg(F.sum("n").alias("all"), F.count("*").alias("kinds")), "nodes"
    )
    fold = (F.col("kinds") > MAX_LITERALS) & (F.col("n") < LITERAL_SHARE * F.col("all"))
    name = F.when(fold, F.lit("*")).otherwise(F.col("seg"))
    return children.join(nodes, node).select(*node, "seg", name.alias("name"))


def _merged(units: DataFrame, level: int) -> DataFrame:
    """``host, tree, name, branch``: branches that look alike get one name.

    Branches of the same looks are put in order of their purity; one that does not differ
    significantly from the one before belongs to it.
    """
    own = ["host", "tree", "name"]
    following = F.coalesce(F.get("segs", F.lit(level + 1)), F.lit(""))
    shapes = units.groupBy(*own, following.alias("next")).agg(
        *[F.sum(c).alias(c) for c in ("n", "blocked", "allowed")]
    )
    sums = shapes.groupBy(*own).agg(
        *[F.sum(c).alias("all_" + c) for c in ("n", "blocked", "allowed")]
    )
    often = shapes.join(sums, own).where(F.col("n") >= SHAPE_SHARE * F.col("all_n"))
    looks = often.groupBy(*own).agg(
        F.array_join(F.sort_array(F.collect_list("next")), "/").alias("looks")
    )
    labelled = F.col("all_blocked") + F.col("all_allowed") + SMOOTHING
    branches = sums.join(looks, own, "left").withColumn(
        "p", (F.col("all_blocked") + SMOOTHING / 2) / labelled
    ).withColumn("v", F.col("p") * (1 - F.col("p")) / (labelled + 1))
    branches = branches.withColumn("known", F.col("all_blocked") + F.col("all_allowed") > 0)
    order = Window.partitionBy("host", "tree", "looks", "known").orderBy("p", "name")
    gap = F.col("p") - F.lag("p").over(order)
    error = F.sqrt(F.col("v") + F.lag("v").over(order))
    breaks = F.coalesce((gap > SAME_BELOW * error).cast("int"), F.lit(0))
    grouped = branches.withColumn("breaks", breaks).withColumn(
        "part", F.sum("breaks").over(order.rowsBetween(Window.unboundedPreceding, 0))
    )
    together = Window.partitionBy("host", "tree", "looks", "known", "part")
    names = F.sort_array(F.collect_list("name").over(together))
    branch = F.when(F.size(names) == 1, F.element_at(names, 1)).otherwise(
        F.concat(F.lit("("), F.array_join(names, "|"), F.lit(")"))
    )
    return grouped.select(*own, branch.alias("branch"))


def template_tree(labelled: DataFrame) -> DataFrame:
    """``host, segs, template, purity`` per shape, from ``host, segs, ruled`` per url."""
    units = saved(
        labelled.groupBy("host", "segs").agg(
            F.count("*").alias("n"), F.count_if(F.col("ruled") == BLOCK).alias("blocked"),
            F.count_if(F.col("ruled") == ALLOW).alias("allowed"),
        ).withColumn("tree", F.lit("")),
        "units",
    )
    deepest = units.agg(F.max(F.size("segs"))).first()[0] or 0
    kept = units.columns
    for level in range(min(deepest, LEVELS + 1)):
        here = units.where(F.size("segs") > level).withColumn("seg", F.get("segs", F.lit(level)))
        names = saved(_named(here), "names")
        here = saved(here.join(names, ["host", "tree", "seg"]), "named")
        merged = saved(_merged(here, level), "branches")
        grown = here.join(merged, ["host", "tree", "name"]).withColumn(
            "tree", F.concat_ws("/", "tree", "branch")
        )
        ended = units.where(F.size("segs") <= level)
        units = saved(ended.select(kept).unionByName(grown.select(kept)), "units")
    purity = (F.sum("blocked") + SMOOTHING / 2) / (
        F.sum("blocked") + F.sum("allowed") + SMOOTHING
    )
    templates = saved(units.groupBy("host", "tree").agg(purity.alias("purity")), "templates")
    return units.join(templates, ["host", "tree"]).select(
        "host", "segs", F.col("tree").alias("template"), "purity"
    )


def judge_urls(
    table: DataFrame, rules: Sequence[Rule], *, id_column: str = "page_id", url: str = "url",
    reject_from: float = REJECT_FROM,
) -> DataFrame:
    """One row per row of ``table``: ``page_id, host, path, rule, verdict, template, purity``.

    A url that is null or without ``://`` has an empty host and path; it is judged like others.
    Ids may be null or repeated; other columns are not looked at; an empty table gives no rows.
    """
    urls = table.select(
        col(id_column).alias("page_id"), url_host(col(url)).alias("host"),
        url_path(col(url)).alias("path"),
    )
    ruled = with_rule(urls, rules).withColumn("segs", shape("path"))
    tree = saved(template_tree(ruled.select("host", "segs", "ruled")), "tree")
    learnt = F.when(F.col("purity") >= reject_from, F.lit(BLOCK)).otherwise(F.lit(ALLOW))
    return ruled.join(tree, ["host", "segs"]).select(
        "page_id", "host", "path", "rule", F.coalesce("ruled", learnt).alias("verdict"),
        "template", "purity",
    )
