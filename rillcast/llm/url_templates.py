"""URL verdicts by rules and by a tree of path templates (operator 8)."""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rillcast.sources.staged import stage

WILDCARD, MERGED = "*", "+"


class Rule(NamedTuple):
    verdict: str
    name: str

    @property
    def host(self) -> str:
        return self.name.partition("/")[0]

    @property
    def path(self) -> str:
        slash = self.name.find("/")
        return self.name[slash:] if slash >= 0 else ""


class TreeSettings(NamedTuple):
    """levels: segments that the tree tells apart, the rest of a path is one segment more.

    A segment stays a constant if it holds ``least_rows`` rows, whatever the
    size of its node; all others of the node become one wildcard. All of them
    do at a node of ``least_children`` such segments or more that are followed
    by the same segments (on average a following one by ``shared`` of them)
    and whose shares of bad labels scatter no more than chance has it
    (``similar_z`` deviations of the chi-square sum): those are names or numbers
    of the same kind of thing, however many rows each has. A branch whose labelled share is within ``similar_z`` standard
    errors of its siblings' is merged with them. A template is rejected when
    its share of bad labels, smoothed by ``weight`` labels at its host's share
    (and the host's by as many at the overall one), reaches ``reject``.
    """

    levels: int = 4
    least_rows: int = 5
    least_children: int = 20
    shared: float = 0.5
    similar_z: float = 2.0
    weight: float = 10.0
    reject: float = 0.5


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a url; both empty without ``://``."""
    rest = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://(.*)$", 1)
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    capitals = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return F.translate(host, capitals, capitals.lower()), path


def matching_rule(rules: Sequence[Rule], host: Column, path: Column, what: str) -> Column:
    """``name`` or ``verdict`` of the longest rule that fits; null where none does."""
    best = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: len(r.name)):
        fits = ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)
        best = F.when(fits, F.lit(getattr(rule, what))).otherwise(best)
    return best


def templates(paths: DataFrame, settings: TreeSettings) -> DataFrame:
    """Add ``template`` (array of constants and wildcards) to rows with host and path.

    The tree grows a level at a time. A level counts rows by node and segment
    (partial sums first, so a hot host is no hot task) and keeps the frequent
    segments. This table is written, so its checked size decides how it is
    joined back.
    """
    segments = F.split(F.regexp_replace("path", "^/", ""), "/", settings.levels + 1)
    rows = paths.withColumns({"_segments": segments, "template": F.array().cast("array<string>")})
    for level in range(settings.levels + 1):
        rows = rows.withColumn("_segment", F.get("_segments", F.lit(level)))
        children = rows.where(F.col("_segment").isNotNull()).groupBy("host", "template", "_segment").agg(F.count("*").alias("_n"))
        constant = stage(children.where(F.col("_n") >= settings.least_rows))
        if level < settings.levels:
            variable = variable_nodes(rows.withColumn("_next", F.get("_segments", F.lit(level + 1))), constant, settings)
            constant = constant.join(variable, ["host", "template"], "left_anti")
        kept = stage(constant.select("host", "template", "_segment", F.lit(True).alias("_constant")))
        rows = rows.join(kept, ["host", "template", "_segment"], "left").withColumn(
            "template",
            F.when(F.col("_segment").isNull(), F.col("template")).otherwise(
                F.concat("template", F.array(F.when(F.col("_constant"), F.col("_segment")).otherwise(F.lit(WILDCARD))))
            ),
        ).drop("_constant", "_segment")
        rows = stage(rows)
    return rows.drop("_segments")


def variable_nodes(rows: DataFrame, constant: DataFrame, settings: TreeSettings) -> DataFrame:
    """Nodes (host, template) whose segments all stand for the same kind of thing."""
    node = ["host", "template"]
    many = stage(constant.groupBy(*node).agg(F.count("*").alias("_children")).where(F.col("_children") >= settings.least_children))
    cells = rows.join(constant.select(*node, "_segment"), [*node, "_segment"]).join(many, node).groupBy(*node, "_children", "_segment", "_next").agg(
        F.count("*").alias("_n"), F.count("bad").alias("_labelled"), F.coalesce(F.sum("bad"), F.lit(0)).alias("_bad")
    )
    cells = stage(cells)
    followed = cells.groupBy(*node, "_children", "_next").agg(F.count("*").alias("_k"), F.sum("_n").alias("_w"))
    # A path that ends here says nothing about what follows.
    known = F.when(F.col("_next").isNotNull(), F.col("_w") * F.col("_k") / F.col("_children")).otherwise(F.lit(0.0))
    alike = followed.groupBy(*node).agg((F.sum(known) / F.sum("_w")).alias("_shared")).where(F.col("_shared") >= settings.shared)
    branches = cells.groupBy(*node, "_segment").agg(F.sum("_labelled").alias("_n"), F.sum("_bad").alias("_b")).where("_n > 0")
    # The chi-square sum of all branches from their squares, so that one aggregate gives share and scatter.
    sums = branches.groupBy(*node).agg(
        F.count("*").alias("_c"), F.sum("_n").alias("_all"), F.sum("_b").alias("_all_bad"), F.sum(F.col("_b") * F.col("_b") / F.col("_n")).alias("_squares")
    )
    share = F.col("_all_bad") / F.col("_all")
    scatter = F.try_divide(F.col("_squares") - F.col("_all_bad") * share, share * (1 - share))
    free = F.col("_c") - 1
    apart = sums.where(scatter > free + settings.similar_z * F.sqrt(2 * free)).select(*node)
    return alike.select(*node).join(apart, node, "left_anti")


def merged(leaves: DataFrame, settings: TreeSettings) -> DataFrame:
    """Add ``branch`` to templates with host, template, labelled and bad: similar siblings share one.

    From the deepest level up, a branch is compared with its siblings by the
    two-proportion test; branches without enough labels to tell are similar.
    """
    rows = leaves.withColumn("branch", F.col("template"))
    for depth in range(settings.levels + 1, 0, -1):
        prefix, parent = F.slice("branch", 1, depth), F.slice("branch", 1, depth - 1)
        rows = rows.withColumns({"_prefix": F.when(F.size("branch") >= depth, prefix), "_parent": parent})
        branches = rows.where("_prefix IS NOT NULL").groupBy("host", "_parent", "_prefix").agg(
            F.sum("labelled").alias("_n"), F.sum("bad").alias("_b")
        )
        siblings = branches.groupBy("host", "_parent").agg(F.sum("_n").alias("_all"), F.sum("_b").alias("_all_bad"))
        others, other_bad = F.col("_all") - F.col("_n"), F.col("_all_bad") - F.col("_b")
        # Without labels on either side the divisions give null: nothing tells the branch apart.
        share = F.try_divide("_all_bad", "_all")
        error = F.sqrt(share * (1 - share) * (F.try_divide(F.lit(1), "_n") + F.try_divide(F.lit(1), others)))
        apart = F.abs(F.try_divide("_b", "_n") - F.try_divide(other_bad, others)) > settings.similar_z * error
        alike = branches.join(siblings, ["host", "_parent"]).where(~F.coalesce(apart, F.lit(False)))
        names = alike.select("host", "_prefix", F.lit(True).alias("_alike"))
        renamed = F.concat("_parent", F.array(F.lit(MERGED)), F.slice("branch", depth + 1, settings.levels + 2))
        rows = rows.join(names, ["host", "_prefix"], "left").withColumn(
            "branch", F.when(F.col("_alike"), renamed).otherwise(F.col("branch"))
        ).drop("_alike", "_prefix", "_parent")
        rows = stage(rows)
    return rows


def rejected_templates(rows: DataFrame, settings: TreeSettings) -> DataFrame:
    """Host, template and purity of templates whose branch is rejected; rows carry host, template and bad (0, 1 or null)."""
    leaves = stage(
        rows.groupBy("host", "template").agg(F.count("bad").alias("labelled"), F.coalesce(F.sum("bad"), F.lit(0)).cast("long").alias("bad"))
    )
    branches = merged(leaves, settings)
    counts = [F.sum("labelled").alias("n"), F.sum("bad").alias("b")]
    overall = leaves.agg(F.try_divide(F.sum("bad"), F.sum("labelled")).alias("base"))
    base = F.coalesce(overall.scalar(), F.lit(0.0))
    hosts = leaves.groupBy("host").agg(*counts).select("host", ((F.col("b") + settings.weight * base) / (F.col("n") + settings.weight)).alias("host_share"))
    by_branch = branches.groupBy("host", "branch").agg(*counts).join(hosts, "host").select(
        "host", "branch", ((F.col("b") + settings.weight * F.col("host_share")) / (F.col("n") + settings.weight)).alias("purity")
    )
    return branches.join(by_branch.where(F.col("purity") >= settings.reject), ["host", "branch"]).select("host", "template", "purity")


def judge_urls(pages: DataFrame, labels: DataFrame, rules: Sequence[Rule] = (), settings: TreeSettings = TreeSettings()) -> DataFrame:
    """Verdict on every page's url: page_id, host, path, rule, verdict, template and purity (null unless rejected).

    ``labels`` holds page_id and bad (0 or 1); several labels of a page are
    averaged to the larger class, null ones don't count. The longest rule that
    fits decides; all other urls go by their template. Null urls and urls
    without ``://`` have empty host and path and are judged as one template.
    Null and repeated page_ids are kept, each row gives a row. Other columns
    are ignored.
    """
    host, path = host_and_path(F.col("url").cast("string"))
    parsed = pages.select(F.col("page_id").cast("long").alias("page_id"), host.alias("host"), path.alias("path"))
    by_page = labels.where("bad IS NOT NULL AND page_id IS NOT NULL").groupBy(F.col("page_id").cast("long").alias("page_id")).agg(
        F.round(F.avg("bad")).cast("long").alias("bad")
    )
    rows = templates(parsed.join(by_page, "page_id", "left"), settings)
    rejected = stage(rejected_templates(rows, settings))
    name = matching_rule(rules, F.col("host"), F.col("path"), "name")
    verdict = matching_rule(rules, F.col("host"), F.col("path"), "verdict")
    by_template = F.when(F.col("purity").isNotNull(), F.lit("block")).otherwise(F.lit("allow"))
    return rows.join(rejected, ["host", "template"], "left").select(
        "page_id", "host", "path", name.alias("rule"), F.coalesce(verdict, by_template).alias("verdict"),
        F.concat(F.lit("/"), F.array_join("template", "/")).alias("template"), "purity",
    )
