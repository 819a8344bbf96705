"""Groups of linked nodes, found from shared buckets without listing the pairs of a bucket.

A link can only lie between two nodes that share a bucket. ``grouped`` finds the groups that all such
links would give, testing few of the pairs:

* In each of two rounds a bucket tests its members against one of them; links join groups. First that
  is the member that shares buckets with most others: among copies that were each changed in their own
  way, the one they stem from, which is like most of them where two of them are not like each
  other. Then it is the first in a pseudo-random order that all buckets share. A large bucket of near
  copies shrinks to one group here, at one test a member and round.
* A last pass is exact: wherever a bucket still holds members of more than one group, each member
  outside its largest group is tested against all members of other groups. Pairs inside one group
  need no test, as their group is known. Where many members may be alike and yet not linked, the
  caller brings a pass of its own, which need not list these pairs either.

So no link is lost, and what is tested follows the links and the failed candidates, not the square
of a bucket. Groups are the components of the links, by alternating large-star and small-star
steps; all of it is joins and aggregations of (bucket, node) and (node, node) rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskpipe.llm.shared import checkpointed, release

#: From pairs (a, b) to those of them that are links.
Test = Callable[[DataFrame], DataFrame]
ROUNDS = 2


def components(links: DataFrame) -> DataFrame:
    """``node, root`` for every node of ``links`` (``a, b``) but the roots; a root is the least node."""
    edges = checkpointed(
        links.select(F.greatest("a", "b").alias("high"), F.least("a", "b").alias("low"))
        .filter("high <> low")
        .distinct()
    )
    mark = _mark(edges)
    while True:
        edges = checkpointed(_small_star(_large_star(edges)))
        before, mark = mark, _mark(edges)
        release(edges.sparkSession)  # the step before
        if mark == before:
            return edges.select(F.col("high").alias("node"), F.col("low").alias("root"))


def _mark(edges: DataFrame) -> tuple:
    pair = F.xxhash64("high", "low")
    return tuple(edges.agg(F.count("*"), F.bit_xor(pair), F.sum(F.shiftright(pair, 24))).first())


def _large_star(edges: DataFrame) -> DataFrame:
    """Each node hands its larger neighbours the least node around it."""
    around = edges.select(F.col("low").alias("at"), F.col("low").alias("least")).union(
        edges.select(F.col("high").alias("at"), F.col("low").alias("least"))
    )
    least = around.groupBy("at").agg(F.min("least").alias("least"))
    return edges.join(least, edges["low"] == least["at"]).select(
        "high", F.col("least").alias("low")
    ).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Each node hands its smaller neighbours, and itself, the least of them."""
    least = edges.groupBy("high").agg(F.min("low").alias("least"))
    handed = edges.join(least, "high").filter(F.col("low") != F.col("least"))
    return (
        handed.select(F.col("low").alias("high"), F.col("least").alias("low"))
        .union(least.select("high", F.col("least").alias("low")))
        .distinct()
    )


def shared_members(members: DataFrame) -> DataFrame:
    """The rows of ``members`` (``bucket, node``, without repeats) whose bucket has others."""
    several = members.groupBy("bucket").agg(F.count("*").alias("n")).filter("n > 1")
    return members.join(several.select("bucket"), "bucket")


def grouped(members: DataFrame, test: Test, last: Test | None = None) -> DataFrame:
    """``node, root`` of all nodes that are linked to a smaller one, directly or through others.

    ``members`` is checkpointed and has the rows of ``shared_members``, nodes as longs. ``last``
    makes links (a, b) from the rows (bucket, node, root) of all buckets with several groups: enough
    of them to connect what the links in each bucket connect.
    """
    roots = None
    sizes = members.groupBy("bucket").agg(F.count("*").alias("n"))
    central = members.join(sizes, "bucket").groupBy("node").agg(F.sum("n").alias("weight"))
    for turn in range(ROUNDS):
        labelled = _labelled(members, roots)
        weight = -F.col("weight") if turn == 0 else F.lit(0)
        order = F.struct(weight, F.xxhash64("node", F.lit(turn)), "node")
        first = (
            (labelled.join(central, "node") if turn == 0 else labelled)
            .groupBy("bucket")
            .agg(F.min_by(F.struct("node", "root"), order).alias("hub"))
        )
        pairs = (
            labelled.join(first, "bucket")
            .filter(F.col("root") != F.col("hub.root"))
            .select(*_ordered("node", "hub.node"))
        )
        roots = _joined(roots, test(pairs.distinct()))
    labelled = _labelled(members, roots)
    sizes = labelled.groupBy("bucket", "root").agg(F.count("*").alias("n"))
    main = (
        sizes.groupBy("bucket")
        .agg(F.max_by("root", F.struct("n", "root")).alias("main"), F.count("*").alias("groups"))
        .filter("groups > 1")
        .select("bucket", "main")
    )
    mixed = labelled.join(main, "bucket")
    if last:
        return _joined(roots, last(mixed.select("bucket", "node", "root")))
    outside = mixed.filter("root <> main").select(
        "bucket", F.col("node").alias("one"), F.col("root").alias("one_root")
    )
    pairs = (
        outside.join(mixed, "bucket")
        .filter("one_root <> root and (root = main or one < node)")
        .select(*_ordered("one", "node"))
    )
    return _joined(roots, test(pairs.distinct()))


def _ordered(one: str, other: str) -> list:
    return [F.least(one, other).alias("a"), F.greatest(one, other).alias("b")]


def _labelled(members: DataFrame, roots: DataFrame | None) -> DataFrame:
    if roots is None:
        return members.withColumn("root", F.col("node"))
    return members.join(roots, "node", "left").select(
        "bucket", "node", F.coalesce("root", "node").alias("root")
    )


def _joined(roots: DataFrame | None, links: DataFrame) -> DataFrame:
    links = links.select("a", "b")
    return components(
        links if roots is None else links.union(roots.select(F.col("root"), F.col("node")))
    )
