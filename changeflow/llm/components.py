"""Connected components of links by contraction; nothing is gathered on the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from changeflow.session import stored


def components(links: DataFrame) -> DataFrame:
    """(node, component) of every node in ``links(a, b)``; the component is one of its nodes.

    Each round every node hooks to the smallest of its neighbours, parents are followed twice,
    and the links are contracted to what still joins two components. Nodes are hashes, that is
    in random order, so the number of rounds grows with the logarithm of the component. Smallest
    neighbours are a minimum that tasks combine before the shuffle: a hub is no burden.
    """
    links = stored(links.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "links")
    labels = links.select(F.col("a").alias("node")).union(links.select("b")).distinct().withColumn("component", F.col("node"))
    labels = stored(labels, "labels")
    while not links.isEmpty():
        # a < b: each b hooks to its smallest a.
        parents = stored(links.groupBy(F.col("b").alias("child")).agg(F.min("a").alias("parent")), "parents")
        for _ in range(2):
            up = parents.select(F.col("child").alias("parent"), F.col("parent").alias("above"))
            parents = parents.join(up, "parent", "left").select("child", F.coalesce("above", "parent").alias("parent"))
        parents = stored(parents, "parents")

        def lifted(df: DataFrame, column: str, parents: DataFrame = parents) -> DataFrame:
            found = parents.select(F.col("child").alias(column), F.col("parent").alias("lifted"))
            return df.join(found, column, "left").withColumn(column, F.coalesce("lifted", column)).drop("lifted")

        labels = stored(lifted(labels, "component"), "labels")
        moved = lifted(lifted(links, "a"), "b").where("a <> b")
        links = stored(moved.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "links")
    return labels
