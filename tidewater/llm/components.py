"""Links inside groups of candidates, and their connected components.

Groups of up to ``PAGE`` members give all their pairs, a number of pairs in proportion to the members. In larger groups
members are compared with some pivots at a time, until all outside the largest component have been pivots.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewater.llm.common import dropped, saved

PAGE = 24
#: Pivots of a cluster in the third round; how many times those of the round before they are in the next ones, and how many at
#: most: without and with sketches, which leave few of a pivot's pairs.
FEW, GROWTH = 8, ((8, 512), (64, 4096))


def components(links: DataFrame) -> DataFrame:
    """``node, root``: for every node of the links ``(a, b)`` the smallest node it is connected with.

    Each round takes the smallest label of a node and its neighbours, then the label's own label, so a path of n links
    needs about log n rounds. Rounds are written to the shared folder. Minima are combined before the shuffle, and joins
    may be split by adaptive execution, so a node with very many links needs no task of its own.
    """
    both = links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    both = saved(both.where("a <> b").distinct())
    old = labels = saved(both.groupBy("a").agg(F.min("b").alias("b")).select(
        F.col("a").alias("node"), F.least("a", "b").alias("root")))
    while True:
        near = both.join(labels, both["b"] == labels["node"]).groupBy(F.col("a").alias("near")).agg(
            F.min("root").alias("low"))
        lower = labels.join(near, labels["node"] == near["near"]).select("node", F.least("root", "low").alias("up"), "root")
        jump = lower.join(labels.select(F.col("node").alias("at"), F.col("root").alias("next")), F.col("up") == F.col("at"), "left")
        new = saved(jump.select("node", F.least("up", F.coalesce("next", "up")).alias("low"), "root"))
        dropped(old)
        old, labels = new, new.select("node", F.col("low").alias("root"))
        if new.where("low <> root").isEmpty():
            dropped(both)
            return labels


def sized(members: DataFrame) -> DataFrame:
    """``members`` (``group``, ``node``) of groups with two or more, with the group's ``size``."""
    sizes = members.groupBy("group").agg(F.count("*").alias("size")).where("size > 1")
    return saved(members.join(sizes, "group"))


def small_pairs(members: DataFrame) -> DataFrame:
    """All pairs ``(a, b)`` of the groups of at most ``PAGE`` members."""
    groups = members.where(F.col("size") <= PAGE).groupBy("group").agg(F.sort_array(F.collect_set("node")).alias("ids"))
    pair = F.inline(F.flatten(F.transform("ids", lambda x, i: F.transform(
        F.slice("ids", i + 2, PAGE), lambda y: F.struct(x.alias("a"), y.alias("b"))))))
    return groups.select(pair).distinct()


def pivot_links(members: DataFrame, links: DataFrame, verified: Callable[[DataFrame], DataFrame],
                sketches: DataFrame | None = None, may: Callable[[Column, Column], Column] | None = None) -> DataFrame:
    """``links`` and those that connect the groups of more than ``PAGE`` members; ``verified`` keeps the true pairs.

    Groups that have members in common are one cluster, so a pair that is in many groups is looked at once. The first
    pivots are the members with the most links so far: in a cluster of copies with edits of their own that is soon the
    text they were made from. Then members outside the cluster's largest component are pivots, more in each round: a few pivots
    join the large components, whose members need not meet one by one. A pivot meets the members of other components that it
    has a group in common with; no member is a pivot twice. ``verified`` returns saved tables. ``sketches`` may have a
    ``sketch`` for each ``node``: pairs for which ``may`` excludes that they are true do not meet. The components of all
    links are found once; a round takes those of its own links between them.
    """
    large = saved(members.where(F.col("size") > PAGE).select("group", "node"))
    if large.isEmpty():
        return links
    heads = large.groupBy("group").agg(F.min("node").alias("head"))
    clusters = components(large.join(heads, "group").where("node <> head").select(
        F.col("head").alias("a"), F.col("node").alias("b")).distinct())
    nodes = saved(large.groupBy("node").agg(F.collect_set("group").alias("groups")).join(
        clusters.select("node", F.col("root").alias("cluster")), "node").join(
        sketches if sketches else large.select("node", F.lit(0).alias("sketch")).distinct(), "node"))
    labels = components(links)
    labelled = saved(nodes.join(labels, "node", "left").select(
        "cluster", "node", "groups", "sketch", F.coalesce("root", "node").alias("root")))
    dropped(nodes)
    used, turn = None, 0
    more, most = GROWTH[may is not None]
    while True:
        parts = labelled.groupBy("cluster", "root").agg(F.count("*").alias("n")).groupBy("cluster").agg(
            F.max_by("root", "n").alias("main"), F.count("*").alias("parts")).where("parts > 1")
        unsettled = saved(labelled.join(parts.select("cluster", "main"), "cluster"))
        fresh = unsettled if used is None else unsettled.join(used, "node", "left_anti")
        if turn < 2:
            degree = links.select(F.explode(F.array("a", "b")).alias("node")).groupBy("node").agg(
                F.count("*").alias("degree"))
            rank = F.struct(F.coalesce(-F.col("degree"), F.lit(0).cast("long")), F.xxhash64("node"), "node")
            pivots = fresh.join(degree, "node", "left").groupBy("cluster").agg(
                F.min_by(F.struct("node", "root", "groups", "sketch"), rank).alias("p")).select("cluster", "p.*")
        else:
            order = Window.partitionBy("cluster").orderBy(F.xxhash64("node"), "node")
            pivots = fresh.where("root <> main").withColumn("nth", F.row_number().over(order)).where(
                F.col("nth") <= min(most, FEW * more ** (turn - 2)))
        pivots = saved(pivots.select("cluster", F.col("node").alias("pivot"), F.col("root").alias("pivot_root"),
                                     F.col("groups").alias("pivot_groups"), F.col("sketch").alias("pivot_sketch")))
        if pivots.isEmpty():
            return links
        turn += 1
        now = pivots.select(F.col("pivot").alias("node"))
        used = saved(now if used is None else used.union(now))
        pairs = unsettled.join(pivots, "cluster").where(
            (F.col("root") != F.col("pivot_root")) & (may(F.col("sketch"), F.col("pivot_sketch")) if may else F.lit(True)) &
            F.arrays_overlap("groups", "pivot_groups")).select(
            F.least("node", "pivot").alias("a"), F.greatest("node", "pivot").alias("b")).distinct()
        found = verified(pairs)
        links = links.union(found)
        labelled = _relabelled(labelled, found)
        dropped(unsettled, pivots)


def _relabelled(labelled: DataFrame, found: DataFrame) -> DataFrame:
    """``labelled`` with the roots that the links ``found`` give: what was connected before is one node each of their graph."""
    root = labelled.select("node", "root")
    joined = components(found.join(root.toDF("a", "root_a"), "a").join(root.toDF("b", "root_b"), "b").select(
        F.col("root_a").alias("a"), F.col("root_b").alias("b"))).toDF("old", "new")
    out = saved(labelled.join(joined, labelled["root"] == joined["old"], "left").select(
        "cluster", "node", "groups", "sketch", F.coalesce("new", "root").alias("root")))
    dropped(labelled)
    return out
