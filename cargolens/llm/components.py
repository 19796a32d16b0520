"""Connected components of a link table, by alternating large-star and small-star steps.

Each step is an aggregate (the smallest neighbour of each node, combined map-side) and a join with it, so a node
with very many neighbours is split over tasks instead of gathered into one.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cargolens.storage import remove_path, scratch_path


def local_components(n: int, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Smallest index of each of ``n`` nodes' component, for links between nodes of one task."""
    label = np.arange(n)
    while len(left):
        low = np.minimum(label[left], label[right])
        np.minimum.at(label, label[left], low)
        np.minimum.at(label, label[right], low)
        while (label[label] != label).any():
            label = label[label]
        apart = label[left] != label[right]
        left, right = left[apart], right[apart]
    return label


def components(links: DataFrame, name: str = "components") -> DataFrame:
    """``(node, root)`` for every node of ``links(a, b)``, where root is the smallest node reachable.

    ``links`` holds longs without nulls; direction, repetition and self links do not matter. An empty table gives an
    empty table. Rounds are written to the shared folder; the number of rounds grows with the logarithm of the nodes.
    """
    spark = links.sparkSession
    folder = scratch_path(spark, name)

    def keep(edges: DataFrame, number: int) -> tuple[DataFrame, tuple]:
        path = f"{folder}/{number}"
        edges.select("a", "b").where("a != b").distinct().write.parquet(path)
        edges = spark.read.schema("a long, b long").parquet(path)
        sign = F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))
        return edges, tuple(edges.agg(F.count("*"), sign).first())

    edges, before = keep(links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")), 0)
    number = 0
    while True:
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("low")).select("a", F.least("a", "low").alias("low"))
        large = both.where("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("low").alias("b")).distinct()
        low = large.groupBy("a").agg(F.min("b").alias("low"))
        linked = large.join(low, "a")
        small = linked.select(F.col("b").alias("a"), F.col("low").alias("b")).union(low.select("a", F.col("low").alias("b")))
        number += 1
        edges, after = keep(small, number)
        remove_path(spark, f"{folder}/{number - 1}")
        if after == before:
            break
        before = after
    roots = edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots.union(edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
