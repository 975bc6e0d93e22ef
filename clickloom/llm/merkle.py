"""Merkle manifest of a dataset, its trees stored in van Emde Boas layout.

Digests of the rows are the leaves of one tree per group, the roots of the groups are the leaves of the tree above.
``ARITY`` consecutive nodes become one, the last run of a level may have fewer, down to one; a level with a single node is
the root. A tree is cut into aligned blocks of ``HEIGHT`` levels above their leaves. A block is one row: its digests, laid
out by splitting it at half its height, the top part first and then the parts below it, each of which is laid out alike. So a
path from a leaf to the block's root lies in a few runs of bytes whatever the size of a page. The roots of the
blocks are the leaves of the next layer of blocks, until a group has one.

A group of any size is spread over its blocks; no task sees more than a block, and a tree of a hundred billion
leaves has four layers.
"""

import functools
import hashlib
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickloom.llm import blocks, workspace

#: Consecutive nodes that become one.
ARITY = 3
#: Levels of a block above its leaves: 2,187 leaves and 105 KB of digests at most.
HEIGHT = 7
#: Leaves that one task puts in order, on average.
RANGE_ROWS = 50_000
#: Bytes of a digest.
BYTES = 32

EMPTY = hashlib.sha256(b"").hexdigest()


def digest(fields: Sequence[Column]) -> Column:
    """Lowercase hex SHA-256 of fields, each ``-`` if null, else its UTF-8 byte count, ``:`` and itself."""
    def part(field: Column) -> Column:
        text = field.cast("string")
        return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))

    return F.sha2(F.concat(*map(part, fields)).cast("binary"), 256)


# Layout


@functools.cache
def tree_size(levels: int, arity: int = ARITY) -> int:
    """Nodes of a full tree."""
    return sum(arity**d for d in range(levels))


def address(levels: int, depth: int, index: np.ndarray, arity: int = ARITY) -> np.ndarray:
    """Place of the nodes ``index`` of one depth in a full tree of so many levels, by arithmetic alone.

    A node of the top half is placed as in a tree of its own; one below it comes after the top half and the bottom
    trees to its left, and is placed as in its bottom tree.
    """
    index = np.asarray(index, np.int64)
    place = np.zeros_like(index)
    while levels > 1:
        top = levels // 2
        if depth < top:
            levels = top
            continue
        below = arity ** (depth - top)
        place += tree_size(top, arity) + index // below * tree_size(levels - top, arity)
        index = index % below
        depth, levels = depth - top, levels - top
    return place


def height_of(leaves: int, most: int, arity: int = ARITY) -> int:
    """Levels above the leaves until one node is left, ``most`` at the most."""
    height = 0
    while height < most and leaves > 1:
        leaves = -(-leaves // arity)
        height += 1
    return height


def build(leaves: Sequence[bytes], height: int, arity: int = ARITY) -> bytes:
    """A block over consecutive leaves; nodes without a leaf below them are zeros."""
    store = np.zeros((tree_size(height + 1, arity), BYTES), np.uint8)
    level = list(leaves)
    for depth in range(height, -1, -1):
        store[address(height + 1, depth, np.arange(len(level)), arity)] = np.frombuffer(b"".join(level), np.uint8).reshape(-1, BYTES)
        if depth:
            names = [d.hex().encode() for d in level]
            level = [hashlib.sha256(b"".join(names[i:i + arity])).digest() for i in range(0, len(names), arity)]
    return store.tobytes()


def siblings(block: bytes, leaves: int, height: int, at: np.ndarray, arity: int = ARITY):
    """Of the leaves ``at`` and their ancestors below the root: digests and mask of the run's other nodes, and their places.

    Shapes (at, levels, arity - 1, bytes), the same without bytes, and (at, levels).
    """
    store = np.frombuffer(block, np.uint8).reshape(-1, BYTES)
    found = np.zeros((len(at), height, arity - 1, BYTES), np.uint8)
    there = np.zeros((len(at), height, arity - 1), bool)
    places = np.zeros((len(at), height), np.int32)
    node, count = np.asarray(at, np.int64), leaves
    for level in range(height):
        first, place = node // arity * arity, node % arity
        places[:, level] = place
        for other in range(arity - 1):
            sibling = first + other + (place <= other)  # the run without the node itself
            there[:, level, other] = sibling < count
            inside = np.minimum(sibling, count - 1)
            found[:, level, other] = store[address(height + 1, height - level, inside, arity)]
        node, count = node // arity, -(-count // arity)
    return found, there, places


# Trees of one or more groups


@dataclass(frozen=True)
class Trees:
    """Leaves in their places, block tables from the bottom to the top, and the root of each group."""

    leaves: DataFrame
    layers: list[DataFrame]
    roots: DataFrame
    arity: int
    height: int


def _blocks(nodes: DataFrame, arity: int, height: int) -> DataFrame:
    """(grp, block, n, leaves, nodes, root): blocks over (grp, position, n, digest binary), where n counts the group's nodes."""
    width = arity**height

    def built(table: pa.Table) -> pa.Table:
        table = table.sort_by("position")
        digests, n = table.column("digest").to_pylist(), table.column("n")[0].as_py()
        # A block among others goes up to its full height, however few leaves it has.
        own = height if n > width else height_of(n, height, arity)
        stored = build(digests, own, arity)
        return pa.table({
            "grp": table.column("grp").slice(0, 1), "block": table.column("block").slice(0, 1), "n": pa.array([n], pa.int64()),
            "leaves": pa.array([len(digests)], pa.int32()), "height": pa.array([own], pa.int32()),
            "nodes": pa.array([stored], pa.binary()), "root": pa.array([stored[:BYTES]], pa.binary()),
        })

    dealt = nodes.select("grp", F.expr(f"position div {width}").alias("block"), "position", "n", "digest")
    return dealt.groupBy("grp", "block").applyInArrow(
        built, "grp string, block long, n long, leaves int, height int, nodes binary, root binary",
    )


def _trees(leaves: DataFrame, arity: int, height: int) -> Trees:
    """Trees over staged ``leaves`` with (grp, position, n, digest)."""
    width = arity**height
    layers, nodes = [], leaves.select("grp", "position", "n", "digest")
    while True:
        layer = workspace.stage(_blocks(nodes, arity, height), "blocks")
        layers.append(layer)
        if not layer.where(F.col("n") > width).limit(1).count():
            break
        nodes = layer.where(F.col("n") > width).select(
            "grp", F.col("block").alias("position"), F.ceil(F.col("n") / width).alias("n"), F.col("root").alias("digest"),
        )
    roots = [layer.where(F.col("n") <= width).select("grp", "root") for layer in layers]
    return Trees(leaves, layers, functools.reduce(DataFrame.unionByName, roots), arity, height)


def _placed(rows: DataFrame, order: list[str], range_rows: int) -> DataFrame:
    """Rows with their ``position`` in their group's order and the size ``n`` of the group.

    Ranges of the global order are numbered each on their own and begin where the rows before them end. A number that
    is drawn for each row splits any run of equal rows over ranges. The window over the ranges of a group sees a row per
    range and group; one that runs inside a range sees no more than its rows.
    """
    drawn = workspace.stage(rows.withColumn("drawn", F.xxhash64(F.monotonically_increasing_id())), "leaves")
    ranges = drawn.count() // range_rows + 1
    ordered = ["grp", *order, "drawn"]
    ranged = workspace.stage(drawn.repartitionByRange(ranges, *ordered).withColumn("range", F.spark_partition_id()), "ranges")
    inside = F.row_number().over(Window.partitionBy("grp", "range").orderBy(*order, "drawn"))
    here = ranged.groupBy("grp", "range").agg(F.count("*").alias("here"))
    group = Window.partitionBy("grp")
    before = F.sum("here").over(group.orderBy("range").rowsBetween(Window.unboundedPreceding, -1))
    starts = here.select("grp", "range", F.coalesce(before, F.lit(0)).alias("before"), F.sum("here").over(group).alias("n"))
    numbered = ranged.withColumn("inside", inside).join(starts, ["grp", "range"])
    return numbered.withColumn("position", F.col("before") + F.col("inside") - 1).drop("range", "drawn", "before", "inside")


_PATH = "array<struct<place:int,siblings:array<string>>>"


def _paths(trees: Trees, above: DataFrame | None) -> DataFrame:
    """The leaves with ``path``: per level from the leaf up, its place in the run and the digests of the others.

    ``above`` has (grp, path) from the group's root on. Goes down layer by layer: each block has the path of its own
    root and adds the levels inside it.
    """
    kept = [c for c in trees.leaves.columns if c not in ("n", "digest")]
    top = len(trees.layers) - 1
    found = None
    for number in range(top, -1, -1):
        stored = trees.layers[number]
        width = trees.arity**trees.height
        ends = stored.where(F.col("n") <= width)
        none = F.array().cast(_PATH)
        if above is None:
            ends = ends.withColumn("path", none)
        else:
            ends = ends.join(above, "grp")
        if found is not None:
            inner = stored.where(F.col("n") > width).join(found.select("grp", F.col("position").alias("block"), "path"), ["grp", "block"])
            ends = ends.unionByName(inner)
        if number:
            below = trees.layers[number - 1].where(F.col("n") > width).select("grp", F.col("block").alias("position"))
        else:
            below = trees.leaves.select(*kept)
        dealt = below.withColumn("block", F.expr(f"position div {width}"))
        kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in below.schema)
        found = dealt.groupBy("grp", "block").cogroup(ends.groupBy("grp", "block")).applyInArrow(
            _retrieving(below.columns, trees.arity, width), f"{kinds}, path {_PATH}",
        )
        if number:
            found = workspace.stage(found, "paths")
    return found


def _retrieving(names: list[str], arity: int, width: int):
    """Leaves of one block with their siblings in it, and the path of the block's root behind them."""
    def retrieved(leaves: pa.Table, stored: pa.Table) -> pa.Table:
        leaves, block = leaves.combine_chunks(), stored.to_pylist()[0]
        rows, upper = leaves.num_rows, block["path"]
        found, there, places = siblings(
            block["nodes"], block["leaves"], block["height"], leaves.column("position").to_numpy() % width, arity,
        )
        # Levels inside the block, then those above it, which are the same for all its leaves.
        above = [bytes.fromhex(s) for step in upper for s in step["siblings"]]
        spots = np.concatenate([places, np.tile(np.array([step["place"] for step in upper], np.int32), (rows, 1))], axis=1)
        counts = np.concatenate([there.sum(2), np.tile(np.array([len(step["siblings"]) for step in upper], int), (rows, 1))], axis=1)
        tail = np.tile(np.frombuffer(b"".join(above), np.uint8).reshape(1, len(above), BYTES), (rows, 1, 1))
        chosen = np.concatenate([found.reshape(rows, -1, BYTES) if found.size else tail[:, :0], tail], axis=1)
        mask = np.concatenate([there.reshape(rows, -1) if there.size else np.zeros((rows, 0), bool), np.ones((rows, len(above)), bool)], axis=1)
        text = _hex(chosen[mask])
        ends = np.arange(0, len(text) + 1, 2 * BYTES, dtype=np.int32)
        values = pa.StringArray.from_buffers(len(ends) - 1, pa.py_buffer(ends.tobytes()), pa.py_buffer(text.tobytes()))
        others = blocks.lists(values, counts.reshape(-1))
        steps = pa.StructArray.from_arrays([pa.array(spots.reshape(-1)), others], ["place", "siblings"])
        path = blocks.lists(steps, np.full(rows, spots.shape[1]))
        return pa.table([*[leaves.column(c) for c in names], path], [*names, "path"])

    return retrieved


_DIGITS = np.frombuffer(b"0123456789abcdef", np.uint8)


def _hex(data: np.ndarray) -> np.ndarray:
    """Lowercase hex digits of bytes."""
    return np.stack([_DIGITS[data >> 4], _DIGITS[data & 15]], axis=-1).reshape(-1)


def fold(leaf: Column, path: Column) -> Column:
    """Root that a leaf and its path lead to."""
    return F.aggregate(path, leaf, lambda node, step: F.sha2(
        F.array_join(F.array_insert(step["siblings"], step["place"] + 1, node), "").cast("binary"), 256))


def path_digest(path: Column) -> Column:
    """Digest of all siblings of a path, in its order."""
    return F.sha2(F.array_join(F.flatten(F.transform(path, lambda step: step["siblings"])), "").cast("binary"), 256)


@dataclass(frozen=True)
class Manifest:
    """Stored trees of all groups and of their roots, and the root over everything, None without rows."""

    groups: Trees
    whole: Trees
    root: str | None

    def proofs(self) -> DataFrame:
        """Each row with the root of its group as ``subroot`` and ``path``, the siblings on its way up to ``root``.

        The row's own columns, ``grp`` and ``position`` are kept.
        """
        top = _paths(self.whole, None).select(F.col("name").alias("grp"), "path")
        top = workspace.stage(top, "top")
        subroots = self.groups.roots.select("grp", F.lower(F.hex("root")).alias("subroot"))
        return _paths(self.groups, top).join(subroots, "grp")


def manifest(rows: DataFrame, group: str, order: str, leaf: str, arity: int = ARITY, height: int = HEIGHT,
             range_rows: int = RANGE_ROWS) -> Manifest:
    """Trees over the hex digests in ``leaf``, one for each value of ``group``, its leaves ascending by ``order``.

    Groups are ordered bytewise by their text and null, a group of its own, comes first. Null comes first in ``order``
    too; ties go by digest, and fully equal rows are interchangeable but have a leaf each. An empty table has no
    trees and the root None. Columns of ``rows`` are kept; ``grp``, ``position``, ``n``, ``digest`` and ``drawn`` must not
    be among them.
    """
    name = F.coalesce(F.concat(F.lit("s"), F.col(group).cast("string")), F.lit(""))
    ready = rows.withColumns({"grp": name, "digest": F.unhex(F.col(leaf))})
    groups = _trees(workspace.stage(_placed(ready, [order, "digest"], range_rows), "placed"), arity, height)
    subroots = groups.roots.select(F.lit("").alias("grp"), F.col("grp").alias("name"), F.col("root").alias("digest"))
    whole = _trees(workspace.stage(_placed(subroots, ["name"], range_rows), "subroots"), arity, height)
    top = whole.roots.select(F.lower(F.hex("root"))).first()
    return Manifest(groups, whole, top[0] if top else None)
