"""Near-duplicate vectors by lattice hashing.

A table projects unit vectors to eight dimensions, scales and shifts them, and takes the nearest point of the E8
lattice as the cell. Every vector is indexed in its own cell of each table and looked up in that cell and in the
neighbouring cells nearest to it. Candidates that differ in too many signs of random projections are passed over, and
all others are verified by cosine in double precision.
"""

import itertools

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickloom.llm import components, hashing, workspace

#: Cosine from which two vectors are linked.
MIN_COSINE = 0.9
#: Tables, neighbouring cells that are probed, and lattice units per unit of length.
TABLES, PROBES, SCALE = 16, 8, 8.0
#: Signs, of 64, in which candidates may differ; at cosine 0.9 the mean is 9 and the deviation 3.
MAX_SIGNS = 24
SEED = 11


def _minimal_vectors() -> np.ndarray:
    """The 240 shortest vectors of E8: two coordinates of 1 or -1, or all halves with an even number of minus signs."""
    found = []
    for i, j in itertools.combinations(range(8), 2):
        for signs in itertools.product((1.0, -1.0), repeat=2):
            vector = np.zeros(8)
            vector[[i, j]] = signs
            found.append(vector)
    found += [np.array(s) / 2 for s in itertools.product((1.0, -1.0), repeat=8) if s.count(-1.0) % 2 == 0]
    return np.array(found)


MINIMAL = _minimal_vectors()


def _nearest_even(x: np.ndarray) -> np.ndarray:
    """Nearest integer points with an even sum."""
    near = np.rint(x)
    odd = np.flatnonzero(near.sum(1) % 2 != 0)
    error = x[odd] - near[odd]
    worst = np.abs(error).argmax(1)
    near[odd, worst] += np.where(error[np.arange(len(odd)), worst] >= 0, 1.0, -1.0)
    return near


def nearest(x: np.ndarray) -> np.ndarray:
    """Nearest E8 points: of the integer points with an even sum and of those moved by a half."""
    whole, half = _nearest_even(x), _nearest_even(x - 0.5) + 0.5
    closer = ((x - whole) ** 2).sum(1) <= ((x - half) ** 2).sum(1)
    return np.where(closer[:, None], whole, half)


def _keys(points: np.ndarray, table: int, size: int) -> np.ndarray:
    h = np.full(points.shape[:-1], (size * 1000 + table + 1) * hashing.MULTIPLIER & (1 << 64) - 1, np.uint64)
    for axis in range(8):
        h = hashing.mixed(h * np.uint64(31) + (2 * points[..., axis]).astype(np.int64).view(np.uint64))
    return h.view(np.int64)


def cells(vectors: np.ndarray, tables: int = TABLES, probes: int = PROBES, scale: float = SCALE):
    """Keys of the own cell per table, and of the own and the probed cells per table, of unit vectors."""
    size = vectors.shape[1]
    rng = np.random.default_rng([SEED, size])
    own, probed = [], []
    for table in range(tables):
        axes = np.linalg.qr(rng.normal(size=(size, 8)))[0] if size >= 8 else rng.normal(size=(size, 8))
        x = vectors @ (axes * scale) + rng.uniform(0, 1, 8)
        center = nearest(x)
        toward = (x - center) @ MINIMAL.T
        best = np.argpartition(-toward, probes - 1, axis=1)[:, :probes] if probes else np.zeros((len(x), 0), int)
        around = np.concatenate([center[:, None], center[:, None] + MINIMAL[best]], axis=1)
        keys = _keys(around, table, size)
        own.append(keys[:, 0])
        probed.append(keys)
    return np.stack(own, 1), np.concatenate(probed, 1)


def _signs(vectors: np.ndarray) -> np.ndarray:
    planes = np.random.default_rng([SEED, vectors.shape[1], 64]).normal(size=(vectors.shape[1], 64))
    return np.packbits(vectors @ planes > 0, axis=1).view(np.int64)[:, 0]


def near_duplicates(table: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", min_cosine: float = MIN_COSINE,
                    tables: int = TABLES, probes: int = PROBES, scale: float = SCALE) -> DataFrame:
    """(vec_id, n_links, component_id, kept) per row.

    ``n_links`` counts the other rows linked directly, equal vectors included; the component is the smallest vec_id
    reachable. Vectors that are null, empty or zero or hold null or non-finite components link with nothing; nor do
    vectors of different sizes. Equal vectors are one node, however many rows have them. Other columns are ignored.
    """
    rows = workspace.stage(table.select(
        F.col(vec_id).alias("vec_id"), F.transform(F.col(embedding), lambda x: x.cast("double")).alias("v"),
    ).withColumn("norm", F.sqrt(F.aggregate("v", F.lit(0.0), lambda n, x: n + x * x))), "vectors")
    # A null component makes the norm null.
    fit = F.col("norm").isNotNull() & ~F.isnan("norm") & (F.col("norm") > 0) & (F.col("norm") < float("inf"))
    usable = rows.where(fit)
    nodes = workspace.stage(
        usable.groupBy("v").agg(F.min("vec_id").alias("node"), F.count("*").alias("copies"), F.first("norm").alias("norm")), "nodes",
    )
    links = workspace.stage(_links(nodes, min_cosine, tables, probes, scale), "links")
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    copies = nodes.select(F.col("node").alias("b"), "copies")
    degree = both.join(copies, "b").groupBy(F.col("a").alias("node")).agg(F.sum("copies").alias("others"))
    component = components.components(links).select("node", F.col("component").alias("root"))
    named = nodes.join(degree, "node", "left").join(component, "node", "left").select(
        "v", (F.coalesce("others", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("root", "node").alias("component_id"),
    )
    linked = usable.join(named, "v").select("vec_id", "n_links", "component_id")
    alone = rows.where(~fit | F.col("norm").isNull()).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return linked.unionByName(alone).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))


def _links(nodes: DataFrame, min_cosine: float, tables: int, probes: int, scale: float) -> DataFrame:
    """Verified links (a, b), a < b, between different vectors."""
    def hashed(probing: bool):
        names = ["key", "a", "signs_a"] if probing else ["key", "b", "signs_b"]

        def run(batches):
            for batch in batches:
                column = batch.column("v")
                size = np.diff(column.offsets.to_numpy())
                values = column.flatten().to_numpy()
                first = np.cumsum(size) - size
                for width in np.unique(size):
                    some = np.flatnonzero(size == width)
                    v = values[(first[some][:, None] + np.arange(width))]
                    v = v / batch.column("norm").to_numpy()[some][:, None]
                    signs = _signs(v)
                    for low in range(0, len(some), 1024):
                        part = slice(low, low + 1024)
                        keys = cells(v[part], tables, probes, scale)[probing]
                        yield pa.record_batch([
                            pa.array(keys.reshape(-1)), batch.column("node").take(pa.array(np.repeat(some[part], keys.shape[1]))),
                            pa.array(np.repeat(signs[part], keys.shape[1])),
                        ], names)
        return run

    listed = nodes.select("node", "v", "norm")
    index = listed.mapInArrow(hashed(False), "key long, b long, signs_b long")
    asked = listed.mapInArrow(hashed(True), "key long, a long, signs_a long")
    near = F.bit_count(F.col("signs_a").bitwiseXOR(F.col("signs_b"))) <= MAX_SIGNS
    pairs = asked.join(index, "key").where(near & (F.col("a") != F.col("b"))).select(
        F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"),
    ).distinct()
    left = nodes.select(F.col("node").alias("a"), F.col("v").alias("v_a"), F.col("norm").alias("norm_a"))
    right = nodes.select(F.col("node").alias("b"), F.col("v").alias("v_b"), F.col("norm").alias("norm_b"))
    dot = F.aggregate(F.zip_with("v_a", "v_b", lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)
    cosine = dot / F.col("norm_a") / F.col("norm_b")
    return pairs.join(left, "a").join(right, "b").where((F.size("v_a") == F.size("v_b")) & (cosine >= min_cosine)).select("a", "b")
