"""Classes of an equivalence given by links, and everything that a directed relation reaches."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def classes(links: DataFrame, keep: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """(node, label) of every linked node; the label is the smallest node of its class.

    ``links`` has columns a and b, which may be chains and cycles, in any direction, repeated or from
    a node to itself.  ``keep`` fixes a frame, by a checkpoint or a written table, and cuts its
    lineage.  Labels start as the smallest neighbour.  In each round

    * a node takes the smallest label among its own and its neighbours',
    * so does the node that is its label (whole trees are hooked at once, however far their members
      are from the link), and
    * the label of its label replaces its label, which halves the depth of trees.

    Rounds, a logarithm of the longest chain in practice, end when both ends of every link have one label,
    which is seen before trees are hooked: classes whose smallest node is linked to all others take no
    round at all.  All minima are combined before they are shuffled, so a node with a third of all links
    and a label of a third of all nodes are reduced where they are.  One bit a round comes to the driver.
    """
    both = links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    both = keep(both.where("a is not null and b is not null").distinct())
    labels = keep(both.groupBy(F.col("a").alias("node")).agg(F.least("node", F.min("b")).alias("label")))
    while True:
        near = both.join(labels.withColumnsRenamed({"node": "b"}), "b").groupBy(F.col("a").alias("node")).agg(
            F.min("label").alias("near"), F.max("label").alias("far")
        )
        seen = keep(labels.join(near, "node"))
        if seen.where("near <> label or far <> label").isEmpty():
            return labels
        hooked = seen.groupBy(F.col("label").alias("node")).agg(F.min("near").alias("hooked"))
        lower = seen.join(hooked, "node", "left").select("node", F.least("label", "near", "hooked").alias("low"))
        above = lower.select(F.col("node").alias("low"), F.col("low").alias("lowest"))
        labels = keep(lower.join(above, "low").select("node", F.least("low", "lowest").alias("label")))


def reached(start: DataFrame, steps: DataFrame, keep: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """(a, b): ``start``, and whatever follows from it along ``steps`` (a, b), each pair once.

    Semi-naive: a round joins only the pairs that the round before found, and ends when it finds none.
    Cycles end too.  Each round's pairs are fixed by ``keep``.
    """
    pair, onward = ["a", "b"], steps.select(F.col("a").alias("b"), F.col("b").alias("next")).distinct()
    known = new = keep(start.select(*pair).distinct())
    while True:
        found = new.join(onward, "b").select("a", F.col("next").alias("b")).distinct()
        new = keep(found.join(known, pair, "left_anti"))
        if new.isEmpty():
            return known
        known = known.unionByName(new)
