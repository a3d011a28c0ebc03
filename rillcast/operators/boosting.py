"""Boosted trees for every group and horizon, grown level by level in shared jobs.

Features are binned once. A level of a tree is one aggregate of gradient sums
by (group, horizon, node, feature, bin), for all groups and horizons together;
running sums over the bins give every split, and the best one of a node is an
aggregate again. Trees are tables; a sample finds its node by walking them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rillcast.config import Clip
from rillcast.functions.vectors import let
from rillcast.operators.models import with_forecasts
from rillcast.sources.staged import per_key, stage

# Gains that agree to so many digits are ties; the first feature and bin win.
GAIN_DIGITS = 6


def bin_edges(train: DataFrame, keys: Sequence[str], features: str, bins: int, by: str = "width") -> DataFrame:
    """keys and edges: per feature the bounds between its bins.

    ``by`` is "width" (equal steps between the least and largest value) or
    "count" (approximate quantiles, the values themselves being bounds).
    """
    cells = train.select(*keys, F.posexplode(features).alias("place", "x")).groupBy(*keys, "place")
    if by == "width":
        ends = cells.agg(F.min("x").alias("lo"), F.max("x").alias("hi"))
        found = F.transform(F.sequence(F.lit(1), F.lit(bins - 1)), lambda k: F.col("lo") + k * (F.col("hi") - F.col("lo")) / bins)
    elif by == "count":
        ends = cells.agg(F.percentile_approx("x", [k / bins for k in range(1, bins)]).alias("q"))
        found = F.array_sort(F.array_distinct("q"))
    else:
        raise ValueError("by must be 'width' or 'count'")
    # One row per feature of a group.
    rows = ends.select(*keys, F.struct("place", found.alias("edges")).alias("e")).groupBy(*keys).agg(F.sort_array(F.collect_list("e")).alias("e"))
    return rows.select(*keys, F.col("e.edges").alias("edges"))


def with_bins(df: DataFrame, edges: DataFrame, keys: Sequence[str], features: str) -> DataFrame:
    """Samples with the bin of every feature: how many bounds it reaches."""
    bins = F.zip_with(F.col(features), F.col("edges"), lambda x, e: F.size(F.filter(e, lambda v: v <= x)))
    return df.join(per_key(edges), list(keys)).withColumn("bins", bins).drop("edges")


def packed_tree(nodes: DataFrame, keys: Sequence[str], horizons: int, depth: int) -> DataFrame:
    """keys and tree: per horizon an array of nodes; node ``k`` has the children ``2k`` and ``2k + 1``."""
    size = 2 ** (depth + 1)
    place = (F.col("horizon") - 1) * size + F.col("node")
    cell = F.struct(place.cast("int").alias("at"), "feature", "bin", "value")
    found = nodes.groupBy(*keys).agg(F.sort_array(F.collect_list(cell)).alias("cells"))
    by_place = F.map_from_entries(F.transform("cells", lambda c: F.struct(c["at"], F.struct(c["feature"], c["bin"], c["value"]))))
    dense = F.transform(
        F.sequence(F.lit(0), F.lit(horizons - 1)),
        lambda h: F.transform(F.sequence(F.lit(0), F.lit(size - 1)), lambda k: F.try_element_at("by_place", (h * size + k).cast("int"))),
    )
    return found.withColumn("by_place", by_place).select(*keys, dense.alias("tree"))


def node_of(nodes: Column, bins: Column, levels: int) -> Column:
    """Number of the node a sample has reached after so many levels; where a node has no split it stays."""
    at = F.lit(1)
    for _ in range(levels):
        at = let(at, lambda k: let(F.get(nodes, k), lambda n: F.when(n["feature"].isNull(), k).otherwise(
            2 * k + (F.get(bins, n["feature"]) > n["bin"]).cast("int"))))
    return at


def reached(tree: Column, bins: Column, levels: int) -> Column:
    """Per horizon the node a sample has reached after so many levels."""
    return F.transform(tree, lambda nodes: node_of(nodes, bins, levels))


def leaf_values(tree: Column, bins: Column, depth: int) -> Column:
    """Per horizon the value of a sample's leaf."""
    return F.transform(tree, lambda nodes: let(node_of(nodes, bins, depth), lambda k: F.get(nodes, k)["value"]))


def level_nodes(samples: DataFrame, keys: Sequence[str], level: int, last: int, shrink: float, least_rows: int) -> DataFrame:
    """Nodes of one level: keys, horizon, node, n, value and the best split (feature, bin; null without one).

    ``samples`` has bins, residuals and node (per horizon). A split must leave
    ``least_rows`` samples on either side and gain something; nodes of the
    ``last`` level have none.
    """
    long = samples.select(*keys, "bins", F.posexplode(F.arrays_zip("node", "residuals")).alias("h", "r"))
    long = long.where(F.col("r.node") >= 2**level)
    rows = long.select(*keys, (F.col("h") + 1).alias("horizon"), "r.node", F.col("r.residuals").alias("g"), "bins")
    own = [*keys, "horizon", "node"]
    if level == last:
        leaves = rows.groupBy(*own).agg(F.count("*").alias("n"), (F.sum("g") / (F.count("*") + shrink)).alias("value"))
        return leaves.withColumns({"feature": F.lit(None).cast("int"), "bin": F.lit(None).cast("int")})
    cells = rows.select(*own, "g", F.posexplode("bins").alias("feature", "bin"))
    sums = cells.groupBy(*own, "feature", "bin").agg(F.count("*").alias("n"), F.sum("g").alias("g"))
    feature = Window.partitionBy(*own, "feature")
    before = feature.orderBy("bin").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    split = sums.select(
        *own, "feature", "bin", F.sum("n").over(before).alias("nl"), F.sum("g").over(before).alias("gl"),
        F.sum("n").over(feature).alias("n"), F.sum("g").over(feature).alias("g"),
    )
    score = lambda g, n: g * g / (n + shrink)
    left, right = (F.col("gl"), F.col("nl")), (F.col("g") - F.col("gl"), F.col("n") - F.col("nl"))
    gain = F.round(score(*left) + score(*right) - score(F.col("g"), F.col("n")), GAIN_DIGITS)
    allowed = (F.col("nl") >= least_rows) & (F.col("n") - F.col("nl") >= least_rows) & (gain > 0)
    # Sums of a node differ between features in their last digits; the first feature's are taken.
    best = split.groupBy(*own).agg(
        F.min(F.when(allowed, F.struct((-gain).alias("loss"), "feature", "bin"))).alias("best"),
        F.min(F.struct("feature", "bin", "n", (F.col("g") / (F.col("n") + shrink)).alias("value"))).alias("whole"),
    )
    return best.select(*own, F.col("whole.n").alias("n"), F.col("whole.value").alias("value"), F.col("best.feature").alias("feature"), F.col("best.bin").alias("bin"))


def fit_boosted_groups(
    train: DataFrame, edges: DataFrame, horizons: int, trees: int = 100, depth: int = 5, rate: float = 0.1, subsample: float = 0.8,
    shrink: float = 1.0, least_rows: int = 1, keys: Sequence[str] = ("site_id",), sample: Sequence[str] = ("forecast_start_time",),
    features: str = "features", label: str = "scaled_deltas",
) -> DataFrame:
    """Nodes of all trees: keys, horizon, tree, node, n, value, feature, bin (null for leaves).

    One tree a group and horizon in every turn, all grown together: depth + 2
    written tables a tree, however many groups and horizons there are. The
    forecast is ``rate`` times the sum of the leaves, from zero. A tree takes
    the share ``subsample`` of the samples, drawn by a digest of ``sample`` and the
    tree's number. Samples with a missing target or feature are left out.
    """
    whole = lambda c: F.col(c).isNotNull() & ~F.exists(c, lambda x: x.isNull() | F.isnan(x))
    rows = with_bins(train.where(whole(features) & whole(label)), edges, keys, features)
    drawn = F.xxhash64(*[F.col(c).cast("string") for c in (*keys, *sample)])
    state = stage(rows.select(*keys, drawn.alias("drawn"), "bins", F.col(label).cast("array<double>").alias("residuals")))
    grown = None
    for tree in range(trees):
        some = state
        if subsample < 1:
            some = state.where(F.pmod(F.xxhash64("drawn", F.lit(tree)), F.lit(1_000_000)) < round(subsample * 1_000_000))
        nodes = None
        for level in range(depth + 1):
            if nodes is None:
                at = some.withColumn("node", F.array_repeat(F.lit(1), horizons))
            else:
                packed = per_key(packed_tree(nodes, keys, horizons, depth))
                at = some.join(packed, list(keys)).withColumn("node", reached(F.col("tree"), F.col("bins"), level))
            new = stage(level_nodes(at, keys, level, depth, shrink, least_rows))
            nodes = new if nodes is None else nodes.unionByName(new)
        told = nodes.withColumn("tree", F.lit(tree))
        grown = told if grown is None else grown.unionByName(told)
        if tree + 1 < trees:
            packed = per_key(packed_tree(nodes, keys, horizons, depth))
            moved = F.zip_with("residuals", leaf_values(F.col("tree"), F.col("bins"), depth), lambda r, v: r - rate * F.coalesce(v, F.lit(0.0)))
            state = stage(state.join(packed, list(keys)).withColumn("residuals", moved).drop("tree"))
    return grown


def score_boosted_groups(
    df: DataFrame, edges: DataFrame, grown: DataFrame, horizons: int, depth: int, rate: float = 0.1, clip: Clip = Clip(),
    keys: Sequence[str] = ("site_id",), features: str = "features", scaled: bool = True,
) -> DataFrame:
    """Forecasts of every sample of a group that has trees; ``scaled`` trees predict scaled deltas."""
    one = packed_tree(grown.withColumnRenamed("tree", "turn"), [*keys, "turn"], horizons, depth)
    # In their order, so that sums are added alike every time.
    every = one.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct("turn", "tree"))).alias("t")).select(*keys, F.col("t.tree").alias("trees"))
    rows = with_bins(df, edges, keys, features).join(per_key(every), list(keys))
    start = F.array_repeat(F.lit(0.0), horizons)
    found = F.aggregate("trees", start, lambda s, t: F.zip_with(s, leaf_values(t, F.col("bins"), depth), lambda a, v: a + rate * F.coalesce(v, F.lit(0.0))))
    if scaled:
        found = F.transform(found, lambda d: d * F.col("delta_scale") + F.col("delta_mean"))
    return with_forecasts(rows, found, clip, horizons).drop("trees", "bins")
