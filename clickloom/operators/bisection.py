"""Bisecting k-means without a random start: the same rows give the same clusters, in Spark as in SQL.

The cluster with the largest cost is split across its leading axis, and the two halves are improved by Lloyd steps. A step is one
aggregate that combines on the map side; the driver sees counts, means and costs of two sides, whatever their size.
The result is a tree of half-spaces, an expression over the feature columns.
"""

from dataclasses import dataclass

from pyspark.ml.feature import PCA, SQLTransformer
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickloom import constants as C

#: Lloyd steps of a split at most, and the move of a centre, in the units of the features, that ends them earlier.
ROUNDS, STILL = 30, 1e-9
#: Smaller clusters aren't split.
SMALLEST = 20


@dataclass(frozen=True)
class Group:
    """Size, mean and summed squared distances to the mean of some rows."""

    n: int
    mean: tuple[float, ...]
    cost: float


@dataclass(frozen=True)
class Split:
    """Rows of ``cluster`` that are nearer to ``far`` than to ``near`` become cluster ``number``."""

    cluster: int
    number: int
    near: tuple[float, ...]
    far: tuple[float, ...]


@dataclass(frozen=True)
class Bisection:
    """Clusters by number, and the splits they come from.

    Centres are in scaled terms; ``columns`` gives the mean and deviation that each column is scaled by.
    """

    columns: dict[str, tuple[float, float]]
    splits: tuple[Split, ...]
    groups: tuple[Group, ...]

    @property
    def cost(self) -> float:
        return sum(g.cost for g in self.groups)

    def expression(self, cluster: int = 0, first: int = 0) -> str:
        """Number of a row's cluster as SQL: only the comparisons on its way down the tree are made.

        It is over the columns as they are. Over scaled columns that a filter for nulls has seen, Spark would derive a
        constraint for every subset of them.
        """
        for at, split in enumerate(self.splits[first:], first):
            if split.cluster == cluster:
                return f"CASE WHEN {_nearer(self.columns, split.far, split.near)} THEN {self.expression(split.number, at + 1)} ELSE {self.expression(cluster, at + 1)} END"
        return str(cluster)

    def stage(self, output: str = "cluster") -> SQLTransformer:
        """Pipeline stage that adds the number; it is saved with its pipeline.

        Without splits it is zero, but taken from a column: joins by a constant would become products.
        """
        number = self.expression() if self.splits else f"CAST(least(0, abs(CAST({next(iter(self.columns))} AS DOUBLE))) AS INT)"
        return SQLTransformer(statement=f"SELECT *, {number} AS {output} FROM __THIS__")


def _beyond(columns: dict[str, tuple[float, float]], direction, bound: float) -> str:
    """Whether the scaled columns along a direction exceed a bound; a column without deviation is zero."""
    weights = [d / deviation if deviation else 0.0 for d, (_, deviation) in zip(direction, columns.values())]
    bound += sum(w * mean for w, (mean, _) in zip(weights, columns.values()))
    return " + ".join(f"CAST({c} AS DOUBLE) * {w!r}D" for c, w in zip(columns, weights)) + f" > {bound!r}D"


def _nearer(columns: dict[str, tuple[float, float]], far, near) -> str:
    """Whether a row is nearer to ``far`` than to ``near``: on its side of the plane halfway between them."""
    return _beyond(columns, [2 * (f - n) for f, n in zip(far, near)], sum(f * f - n * n for f, n in zip(far, near)))


def _sides(rows: DataFrame, vector: str, far: Column) -> dict[bool, Group]:
    """Groups of the rows on both sides; an empty one is missing."""
    measures = Summarizer.metrics("count", "mean", "variance").summary(F.col(vector))
    found = rows.groupBy(far.alias("far")).agg(measures.alias("of")).collect()  # two rows at most
    return {r["far"]: Group(r["of"]["count"], tuple(r["of"]["mean"].toArray().tolist()),
                            (r["of"]["count"] - 1) * float(r["of"]["variance"].toArray().sum())) for r in found}


def _halves(rows: DataFrame, whole: Group, columns: dict[str, tuple[float, float]], vector: str, rounds: int):
    """Centres and groups of both halves, or None if the rows can't be told apart."""
    axis = PCA(k=1, inputCol=vector, outputCol="axis").fit(rows).pc.toArray()[:, 0].tolist()
    # An axis may come out mirrored; its largest loading shall be positive.
    if max(axis, key=abs) < 0:
        axis = [-a for a in axis]
    middle = sum(a * mean for a, mean in zip(axis, whole.mean))
    sides = _sides(rows, vector, F.expr(_beyond(columns, axis, middle)))
    for step in range(rounds + 1):
        if len(sides) < 2:
            return None
        near, far = sides[False].mean, sides[True].mean
        sides = _sides(rows, vector, F.expr(_nearer(columns, far, near)))
        if len(sides) == 2 and max(abs(a - b) for s, old in ((False, near), (True, far)) for a, b in zip(sides[s].mean, old)) <= STILL:
            break
    return (near, far, sides[False], sides[True]) if len(sides) == 2 else None


def fit(rows: DataFrame, columns: dict[str, tuple[float, float]], vector: str, k: int = C.CLUSTERS, smallest: int = SMALLEST,
        rounds: int = ROUNDS) -> Bisection:
    """Up to ``k`` clusters over numeric ``columns`` without nulls, scaled by a mean and deviation each, as ``vector`` holds them.

    Of the clusters with ``smallest`` rows or more the one with the largest cost is split, on a tie the one with the smaller
    number; those nearer to the half behind the mean keep it. Rows that are all equal are never split, so
    there may be fewer clusters. Rows are read once for each step and should be stored. No rows are one cluster of none.
    """
    whole = _sides(rows, vector, F.lit(False)).get(False, Group(0, (0.0,) * len(columns), 0.0))
    groups, splits, whole_ones = [whole], [], set()
    while len(groups) < k:
        able = [i for i, g in enumerate(groups) if g.n >= max(smallest, 2) and i not in whole_ones]
        if not able:
            break
        chosen = max(able, key=lambda i: (groups[i].cost, -i))
        members = rows.where(F.expr(Bisection(columns, tuple(splits), ()).expression()) == chosen)
        halves = _halves(members, groups[chosen], columns, vector, rounds)
        if halves is None:
            whole_ones.add(chosen)
            continue
        near, far, groups[chosen], other = halves
        splits.append(Split(chosen, len(groups), near, far))
        groups.append(other)
    return Bisection(columns, tuple(splits), tuple(groups))
