"""Connected components of a graph that is held as a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame

from altimart.operators.closure import classes
from altimart.sources.sinks import materialised


def components(links: DataFrame) -> DataFrame:
    """(node, label) of every linked node; the label is the smallest node of its component.

    The frames of each round are small and many.  Each is written once, by one job, and read by few
    tasks; a checkpoint takes two jobs, and a task for each of its partitions whenever it is read.
    """
    return classes(links, lambda frame: materialised(frame, "classes"))
