"""Connected components by large-star and small-star rounds; nothing comes to the driver but two sums a round."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import in_arrow, stage


def smallest_labels(count: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The smallest index reachable from each of ``count`` nodes by edges (a, b)."""
    label = np.arange(count)
    while len(a):
        low = np.minimum(label[a], label[b])
        before = label.copy()
        np.minimum.at(label, label[a], low)
        np.minimum.at(label, label[b], low)
        np.minimum.at(label, a, low)
        np.minimum.at(label, b, low)
        while (jumped := label[label] != label).any():
            label[jumped] = label[label[jumped]]
        if (label == before).all():
            break
    return label


def forest(edges: pa.RecordBatch) -> pa.RecordBatch:
    """Stars that connect the same nodes as a batch of edges."""
    a, b = (np.asarray(edges.column(c)) for c in ("a", "b"))
    nodes, index = np.unique(np.concatenate([a, b]), return_inverse=True)
    label = smallest_labels(len(nodes), index[: len(a)], index[len(a) :])
    other = np.flatnonzero(label != np.arange(len(nodes)))
    return pa.RecordBatch.from_arrays([pa.array(nodes[other]), pa.array(nodes[label[other]])], ["a", "b"])


def connected_components(edges: DataFrame) -> DataFrame:
    """``node, component`` (the smallest node reachable) for every node of ``edges(a, b)``, long and not null."""

    def contract(batches):
        for batch in batches:
            if batch.num_rows:
                yield forest(batch)

    stars = stage(in_arrow(edges.select("a", "b").where("a != b"), contract, "a long, b long").distinct(), "edges")
    before = None
    while True:
        state = tuple(stars.agg(F.count("*"), F.sum(F.xxhash64("a", "b") % 1_000_003)).first())
        if state == before or not state[0]:
            break
        before = state
        both = stars.union(stars.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least("a", F.min("b")).alias("least"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("least").alias("b")).where("a != b").distinct()
        down = large.groupBy("a").agg(F.min("b").alias("least"))
        small = large.join(down, "a").select(F.col("b").alias("a"), F.col("least").alias("b")).where("a != b")
        stars = stage(small.union(down.select("a", F.col("least").alias("b"))).distinct(), "edges")
    centres = stars.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return stars.select(F.col("a").alias("node"), F.col("b").alias("component")).union(centres)
