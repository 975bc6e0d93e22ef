"""Approximate nearest neighbours by an inverted multi-index.

Vectors are cut into two halves, and each half is quantised on its own: K centroids a half make K * K cells, and
every vector is listed in the cell of its two centroids. A search takes cells in the order of the summed distances of
their two centroids, which a heap yields without looking at all of them, until the cells hold as many vectors
as the budget says, and ranks the listed vectors by their true distance.

How far a search must go for a given recall depends on the data: a share of a percent where vectors gather, half of
them where they are spread evenly. So the budget is calibrated: a bounded sample of the queries is compared with every
vector, and their true neighbours tell how many vectors lie in the cells before theirs.

Cells are dealt into groups of bounded size in the order of their first centroid, a crowded cell into several. A query
is sent once to each group that it visits, with the cells it visits there. So a task holds a bounded part of the
vectors and of the queries, whatever gathers in a cell. Equal vectors are one entry with the smallest ids that they have.
"""

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clickloom.llm import workspace

#: Nearest vectors that a query gets.
NEIGHBOURS = 10
#: Vectors of the sample to which centroids are fitted, about.
SAMPLE_ROWS = 20_000
#: Centroids of a half: enough for cells of so many vectors, within these bounds.
CELL_ROWS, FEWEST, MOST = 50, 8, 256
#: Rounds of fitting centroids.
ROUNDS = 12
#: Queries that are compared with every vector, about, and the share of their neighbours that a search shall find.
CALIBRATION, RECALL = 200, 0.96
#: Vectors of a group of cells, and queries that a task takes to a group, on average.
GROUP_ROWS, GROUP_QUERIES = 4096, 2048
SEED = 23


@dataclass(frozen=True)
class Quantiser:
    """Centroids of both halves, shape (K, half) each."""

    first: np.ndarray
    second: np.ndarray

    def distances(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Squared distances of both halves to their centroids."""
        half = self.first.shape[1]
        return squared(vectors[:, :half], self.first), squared(vectors[:, half:], self.second)

    def cells(self, vectors: np.ndarray) -> np.ndarray:
        a, b = self.distances(vectors)
        return a.argmin(1) * len(self.second) + b.argmin(1)


def squared(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Squared distances of all rows, by products; rounding may move them a little."""
    return np.maximum((x * x).sum(1)[:, None] + (y * y).sum(1) - 2 * (x @ y.T), 0)


def centroids(points: np.ndarray, k: int, rounds: int = ROUNDS) -> np.ndarray:
    """Up to ``k`` means; starts from different points drawn with a fixed seed, and leaves out what nothing is near to."""
    start = np.unique(points, axis=0)
    found = np.random.default_rng(SEED).permutation(start)[:k]
    for _ in range(rounds):
        nearest = squared(points, found).argmin(1)
        size = np.bincount(nearest, minlength=len(found))
        sums = np.zeros_like(found)
        np.add.at(sums, nearest, points)
        found = sums[size > 0] / size[size > 0][:, None]
    return found


def traverse(first: np.ndarray, second: np.ndarray, counts: np.ndarray, budget: float) -> Iterator[int]:
    """Cells by summed distance until the ones before hold ``budget`` vectors; empty cells are passed over.

    ``first`` and ``second`` are distances of a query's halves to the centroids. A pair of ranks (i, j) enters the heap
    when its neighbour with the smaller rank has been taken, so the heap stays as small as the front.
    """
    rows, columns = np.argsort(first, kind="stable"), np.argsort(second, kind="stable")
    a, b = first[rows], second[columns]
    heap, front, seen = [(a[0] + b[0], 0, 0)], np.zeros(len(a), np.int64), 0
    while heap and seen < budget:
        _, i, j = heapq.heappop(heap)
        cell = int(rows[i]) * len(columns) + int(columns[j])
        if counts[cell]:
            yield cell
            seen += int(counts[cell])
        front[i] = j + 1
        # The next of this row, once the row above has gone that far; and the row below, if it waited for this.
        if j + 1 < len(columns) and (i == 0 or front[i - 1] > j + 1):
            heapq.heappush(heap, (a[i] + b[j + 1], i, j + 1))
        if i + 1 < len(rows) and front[i + 1] == j:
            heapq.heappush(heap, (a[i + 1] + b[j], i + 1, j))


def groups_of(counts: np.ndarray, width: int, limit: int) -> tuple[np.ndarray, np.ndarray]:
    """First group of each cell and over how many it is dealt: neighbouring cells share a group up to ``limit`` vectors.

    ``width`` cells have the same first centroid; a group doesn't go beyond them.
    """
    first, over = np.zeros(len(counts), np.int64), np.ones(len(counts), np.int64)
    group, held = 0, 0
    for cell, count in enumerate(counts.tolist()):
        if held and (cell % width == 0 or held + count > limit):
            group, held = group + 1, 0
        first[cell] = group
        if count > limit:
            over[cell] = -(-count // limit)
            group, held = group + int(over[cell]), 0
        else:
            held += count
    return first, over


def _matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    """Lists of the same length as rows of a matrix."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy().reshape(len(column), -1)


def nearest(queries: np.ndarray, entries: np.ndarray, order: np.ndarray, visited: np.ndarray | None, k: int):
    """(query, entry, distance) of the ``k`` nearest entries of each query, ties by ``order``.

    Distances by products choose who may be among them, with room for their rounding; these are computed from the
    differences. ``visited`` marks the entries that each query may have.
    """
    rough = squared(queries, entries)
    if not np.isfinite(rough).all():  # of huge components
        rough = np.stack([((entries - q) ** 2).sum(1) for q in queries])
    if visited is not None:
        rough = np.where(visited, rough, np.inf)
    slack = 1e-9 * ((queries**2).sum(1)[:, None] + (entries**2).sum(1).max(initial=0))
    limit = np.partition(rough, k - 1, axis=1)[:, k - 1:k] if k < len(entries) else np.full((len(queries), 1), np.inf)
    close = rough <= limit + np.where(np.isfinite(slack), slack, np.inf)
    if visited is not None:
        close &= visited
    q, e = np.nonzero(close)
    distance = np.sqrt(((queries[q] - entries[e]) ** 2).sum(1))
    ranked = np.lexsort((order[e], distance, q))
    q, e, distance = q[ranked], e[ranked], distance[ranked]
    begin = np.searchsorted(q, np.arange(len(queries)))
    kept = np.arange(len(q)) - begin[q] < k
    return q[kept], e[kept], distance[kept]


def search(table: DataFrame, asked, vec_id: str = "vec_id", embedding: str = "embedding", neighbours: int = NEIGHBOURS,
           recall: float = RECALL, share: float | None = None) -> DataFrame:
    """(query_id, rank, vec_id, score) of the nearest vectors found for each row of ``table`` for which ``asked`` holds.

    Searched are all rows but those with the query's id, by Euclidean distance in double precision; ties go to the smaller id.
    ``share`` sets the part of the vectors that a search looks at, 1 for all; else it is calibrated to ``recall``.
    Vectors that are null, empty or zero or hold null or non-finite components take no part, nor do rows without
    an id; vectors of other sizes are no candidates. Rows may repeat: an id counts once for each of its different vectors,
    and a query repeated has its rows as often. Other columns are ignored. Vectors of each size have an index of their own.
    """
    rows = workspace.stage(table.select(
        F.col(vec_id).alias("vec_id"), F.transform(F.col(embedding), lambda x: x.cast("double") + F.lit(0.0)).alias("v"), asked.alias("asked"),
    ).where(
        F.col("vec_id").isNotNull() & F.coalesce(F.forall("v", lambda x: x.isNotNull() & (F.abs(x) < float("inf"))), F.lit(False))
        & F.exists("v", lambda x: x != 0)
    ), "vectors")
    # The nearest other rows are among the smallest ids of each different vector: one more than asked for, as the query's own goes.
    smallest = F.row_number().over(Window.partitionBy("v").orderBy("vec_id"))
    ids = rows.select("v", "vec_id").distinct().withColumn("at", smallest).where(F.col("at") <= neighbours + 1)
    listed = ids.groupBy("v").agg(F.array_sort(F.collect_list("vec_id")).alias("ids"))
    wanted = rows.where("asked").groupBy("v").agg(F.lit(True).alias("asked"))
    entries = workspace.stage(
        listed.join(wanted, "v", "left").select(
            F.monotonically_increasing_id().alias("entry"), "v", "ids", F.coalesce("asked", F.lit(False)).alias("asked"),
            F.size("v").alias("width"),
        ), "entries",
    )
    found = None
    for width, n in entries.groupBy("width").agg(F.count("*")).orderBy("width").collect():
        some = _search(entries.where(F.col("width") == width), int(width), int(n), neighbours, recall, share)
        found = some if found is None else found.unionByName(some)
    kind = rows.schema["vec_id"].dataType.simpleString()
    if found is None:
        return table.sparkSession.createDataFrame([], f"query_id {kind}, rank int, vec_id {kind}, score double")
    # The nearest ids of each different query vector, from which each query drops its own.
    best = Window.partitionBy("query").orderBy("score", "vec_id")
    ids = found.select("query", "score", F.explode("ids").alias("vec_id")).withColumn("at", F.row_number().over(best))
    ids = ids.where(F.col("at") <= neighbours + 1).groupBy("query").agg(F.array_sort(F.collect_list(F.struct("score", "vec_id"))).alias("found"))
    answers = entries.select(F.col("entry").alias("query"), "v").join(ids, "query").drop("query")
    others = F.filter("found", lambda x: x["vec_id"] != F.col("query_id"))
    return rows.where("asked").select(F.col("vec_id").alias("query_id"), "v").join(answers, "v").select(
        "query_id", F.posexplode(F.slice(others, 1, neighbours)).alias("rank", "hit"),
    ).select("query_id", (F.col("rank") + 1).cast("int").alias("rank"), F.col("hit.vec_id").alias("vec_id"), F.col("hit.score").alias("score"))


def fit(entries: DataFrame, width: int, n: int, sample_rows: int = SAMPLE_ROWS) -> Quantiser:
    """Centroids from a sample of about ``sample_rows`` of ``n`` different vectors of ``width`` components."""
    drawn = F.pmod(F.xxhash64("entry", F.lit(SEED)), F.lit(1 << 20)) < F.lit(min(1 << 20, (sample_rows << 20) // n + 1))
    points = _matrix(entries.where(drawn).select("v").limit(2 * sample_rows).toArrow().column("v"))
    k = int(min(MOST, max(FEWEST, (n / CELL_ROWS) ** 0.5)))
    half = (width + 1) // 2
    return Quantiser(centroids(points[:, :half], k), centroids(points[:, half:], k))


def _search(entries: DataFrame, width: int, n: int, neighbours: int, recall: float, share: float | None) -> DataFrame:
    """(query, ids, score): the nearest entries found for each entry that is asked for, of vectors of one size."""
    model = fit(entries, width, n)
    cells = len(model.first) * len(model.second)

    def placed(batches):
        for batch in batches:
            yield pa.record_batch(
                [*batch.columns, pa.array(model.cells(_matrix(batch.column("v"))).astype(np.int32))], [*batch.schema.names, "cell"],
            )

    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in entries.schema)
    index = workspace.stage(entries.mapInArrow(placed, f"{kinds}, cell int"), "index")
    counts = np.zeros(cells, np.int64)
    for cell, count in index.groupBy("cell").agg(F.count("*")).collect():  # cells at most
        counts[cell] = count
    if share is None:
        share = calibrated(index, model, counts, neighbours, recall)
    budget = max(share * n, neighbours + 1)
    first, over = groups_of(counts, len(model.second), GROUP_ROWS)

    def visiting(batches):
        """Each query once for every group it visits, with the cells it visits there."""
        for batch in batches:
            vectors = _matrix(batch.column("v"))
            near = model.distances(vectors)
            rows, groups, visited = [], [], []
            for i in range(len(vectors)):
                there: dict[int, list[int]] = {}
                for cell in traverse(near[0][i], near[1][i], counts, budget):
                    for group in range(first[cell], first[cell] + over[cell]):
                        there.setdefault(group, []).append(cell)
                rows += [i] * len(there)
                groups += there
                visited += there.values()
                if len(rows) > 4096 or i + 1 == len(vectors):
                    at = pa.array(rows, pa.int64())
                    yield pa.record_batch(
                        [batch.column("entry").take(at), batch.column("v").take(at), pa.array(groups, pa.int64()), pa.array(visited, pa.list_(pa.int32()))],
                        ["query", "v", "grp", "cells"],
                    )
                    rows, groups, visited = [], [], []

    asks = workspace.stage(index.where("asked").select("entry", "v").mapInArrow(
        visiting, "query long, v array<double>, grp long, cells array<int>"), "asks")
    # A group that many queries visit is taken several times, each time for some of them.
    busy = asks.groupBy("grp").agg(F.ceil(F.count("*") / GROUP_QUERIES).cast("int").alias("times"))

    def grouped(batches):
        """The entries of a cell dealt over its groups."""
        for batch in batches:
            cell, entry = batch.column("cell").to_numpy(), batch.column("entry").to_numpy()
            yield pa.record_batch([*batch.columns, pa.array(first[cell] + entry % over[cell])], [*batch.schema.names, "grp"])

    held = index.select("entry", "v", "ids", "cell")
    held = held.mapInArrow(grouped, ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in held.schema) + ", grp long")
    taken = held.join(busy, "grp").select("v", "ids", "cell", "grp", F.explode(F.sequence(F.lit(1), F.col("times"))).alias("time"))
    going = asks.join(busy, "grp").select("query", "v", "cells", "grp", (F.pmod(F.xxhash64("query"), F.col("times")) + 1).cast("int").alias("time"))

    def ranked(queries: pa.Table, stored: pa.Table) -> pa.Table:
        queries, stored = queries.combine_chunks(), stored.combine_chunks()
        ids = stored.column("ids").combine_chunks()
        found = [np.zeros(0, np.int64)] * 2 + [np.zeros(0)]
        if queries.num_rows and stored.num_rows:
            smallest = ids.flatten().take(pa.array(np.cumsum(np.diff(ids.offsets)) - np.diff(ids.offsets))).to_numpy()
            at = stored.column("cell").to_numpy()
            codes, at = np.unique(at, return_inverse=True)
            lists = queries.column("cells").combine_chunks()
            row = np.repeat(np.arange(len(lists)), np.diff(lists.offsets))
            cell = lists.flatten().to_numpy()
            place = np.minimum(np.searchsorted(codes, cell), len(codes) - 1)
            hit = codes[place] == cell
            visits = np.zeros((len(lists), len(codes)), bool)
            visits[row[hit], place[hit]] = True
            asking, listed = _matrix(queries.column("v")), _matrix(stored.column("v"))
            parts = []
            for low in range(0, len(asking), 256):
                q, e, d = nearest(asking[low:low + 256], listed, smallest, visits[low:low + 256][:, at], neighbours + 1)
                parts.append((q + low, e, d))
            found = [np.concatenate(x) for x in zip(*parts)]
        return pa.table({
            "query": queries.column("query").take(pa.array(found[0])), "ids": ids.take(pa.array(found[1])), "score": pa.array(found[2], pa.float64()),
        })

    kind = entries.schema["ids"].dataType.simpleString()
    pairs = going.groupBy("grp", "time").cogroup(taken.groupBy("grp", "time")).applyInArrow(ranked, f"query long, ids {kind}, score double")
    best = Window.partitionBy("query").orderBy("score", F.col("ids")[0])
    return pairs.withColumn("at", F.row_number().over(best)).where(F.col("at") <= neighbours + 1).drop("at")


def calibrated(index: DataFrame, model: Quantiser, counts: np.ndarray, neighbours: int, recall: float,
               queries: int = CALIBRATION) -> float:
    """Share of the vectors that a search must look at so that sampled queries find ``recall`` of their true neighbours.

    About ``queries`` different query vectors are compared with every vector, each batch of which keeps its nearest.
    """
    asked = index.where("asked")
    n = asked.count()
    if not n:
        return 0.0
    drawn = F.pmod(F.xxhash64("entry", F.lit(SEED + 1)), F.lit(1 << 20)) < F.lit(min(1 << 20, (queries << 20) // n + 1))
    sample = asked.where(drawn).select("entry", "v").limit(2 * queries).toArrow()
    vectors, entry = _matrix(sample.column("v")), sample.column("entry").to_numpy()

    def compared(batches):
        for batch in batches:
            others = _matrix(batch.column("v"))
            for low in range(0, len(others), 2048):
                part = others[low:low + 2048]
                own = batch.column("entry").to_numpy()[low:low + 2048]
                q, e, d = nearest(vectors, part, own, entry[:, None] != own, neighbours)
                yield pa.record_batch(
                    [pa.array(q.astype(np.int32)), pa.array(own[e]), pa.array(d), batch.column("cell").take(pa.array(e + low))],
                    ["query", "entry", "score", "cell"],
                )

    best = Window.partitionBy("query").orderBy("score", "entry")
    true = index.select("entry", "v", "cell").mapInArrow(compared, "query int, entry long, score double, cell int")
    true = true.withColumn("at", F.row_number().over(best)).where(F.col("at") <= neighbours).select("query", "cell").toArrow()
    if not true.num_rows:
        return 0.0
    near = model.distances(vectors)
    sums = (near[0][:, :, None] + near[1][:, None, :]).reshape(len(vectors), -1)
    order = np.argsort(sums, axis=1, kind="stable")
    before = np.cumsum(counts[order], axis=1) - counts[order]
    reach = np.empty_like(before)
    np.put_along_axis(reach, order, before, axis=1)
    needed = reach[true.column("query").to_numpy(), true.column("cell").to_numpy()]
    return float((np.quantile(needed, recall, method="higher") + 1) / counts.sum())
