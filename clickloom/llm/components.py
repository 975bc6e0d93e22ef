"""Connected components of link tables of any size."""

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickloom.llm import workspace


def components(links: DataFrame) -> DataFrame:
    """(node, component) of every node in ``links`` (a long, b long); the component is its smallest node.

    Alternates large stars (greater neighbours of a node move to its smallest one) and small stars (smaller ones
    do) until nothing changes, which takes about as many rounds as the logarithm of the longest chain. A node's
    smallest neighbour is a map-side combined minimum; the join back can be split where a node has many links. Every
    round is written to the shared folder.
    """
    edges = workspace.stage(
        links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .mapInArrow(_contract, "a long, b long").distinct(), "links",
    )
    state = None
    while True:
        edges = workspace.stage(_small_star(_large_star(edges)), "stars")
        found = edges.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first()
        if found == state:
            break
        state = found
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
        edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct(),
    )


def _contract(batches):
    """Links of each batch as stars around the smallest node of each of its own components."""
    for batch in batches:
        a, b = (batch.column(i).to_numpy() for i in (0, 1))
        nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
        label = star_labels(len(nodes), at[:len(a)], at[len(a):])
        far = np.flatnonzero(label != np.arange(len(nodes)))
        yield pa.record_batch([pa.array(nodes[far]), pa.array(nodes[label[far]])], ["a", "b"])


def star_labels(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest index in the component of each of ``n`` nodes."""
    label = np.arange(n)
    while True:
        low = np.minimum(label[a], label[b])
        moved = label.copy()
        np.minimum.at(moved, label[a], low)
        np.minimum.at(moved, label[b], low)
        moved = moved[moved]
        if (moved == label).all():
            return label
        label = moved


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    moved = edges.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionByName(least.select("a", F.col("m").alias("b"))).distinct()
