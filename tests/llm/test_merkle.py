import hashlib
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from clickloom.llm import merkle


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def brute(leaves, arity=3):
    """Root of hex digests and the siblings of each, level by level."""
    level, at = list(leaves), list(range(len(leaves)))
    paths = [[] for _ in leaves]
    while len(level) > 1:
        runs = [level[i:i + arity] for i in range(0, len(level), arity)]
        for n, i in enumerate(at):
            run = runs[i // arity]
            paths[n].append((i % arity, run[:i % arity] + run[i % arity + 1:]))
        level, at = [sha("".join(r)) for r in runs], [i // arity for i in at]
    return (level[0] if level else None), paths


@pytest.mark.parametrize("arity, levels", [(3, 1), (3, 2), (3, 5), (2, 6), (4, 4)])
def test_address_as_layout_by_recursion(arity, levels):
    """The arithmetic gives the places that laying out tree by tree gives."""
    def layout(levels, depth, index):
        if levels == 1:
            return [(depth, index)]
        top = levels // 2
        found = layout(top, depth, index)
        for i in range(arity**top):
            found += layout(levels - top, depth + top, index * arity**top + i)
        return found

    place = {node: i for i, node in enumerate(layout(levels, 0, 0))}
    assert len(place) == merkle.tree_size(levels, arity)
    for depth in range(levels):
        index = np.arange(arity**depth)
        assert merkle.address(levels, depth, index, arity).tolist() == [place[depth, i] for i in index]


@pytest.mark.parametrize("n", [1, 2, 3, 4, 9, 10, 26, 27])
def test_block_as_brute_force(n):
    leaves = [hashlib.sha256(bytes([i])).digest() for i in range(n)]
    root, paths = brute([d.hex() for d in leaves])
    height = merkle.height_of(n, 3)
    block = merkle.build(leaves, height)
    assert block[:32].hex() == root
    found, there, places = merkle.siblings(block, n, height, np.arange(n))
    for i, path in enumerate(paths):
        got = [(places[i, k], [d.tobytes().hex() for d, t in zip(found[i, k], there[i, k]) if t]) for k in range(height)]
        assert got == path


def rows_of(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, source string, text string")
    return docs.withColumn("leaf", merkle.digest([F.col("doc_id"), F.col("source"), F.col("text")]))


def field(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


@pytest.mark.parametrize("arity, height, range_rows", [(3, 7, 50_000), (3, 1, 7), (3, 2, 5), (2, 3, 10)])
def test_manifest_as_brute_force(spark, arity, height, range_rows):
    """Sources of 1 to 40 rows, null and empty ones, ids that are null, repeated or negative, equal rows."""
    rows = [(n * 7 % 41, "big", f"text {n}") for n in range(40)] + [(5, None, "a"), (3, None, "b"), (3, None, "b"), (3, None, None)]
    rows += [(1, "", "x"), (None, "é", "y"), (-4, "é", ""), (10, "é", "z\n" * 40_000), (2, "Z", "alone")]
    rows += [(2, "Z", "alone")] * 20
    made = merkle.manifest(rows_of(spark, rows), "source", "doc_id", "leaf", arity, height, range_rows)
    leaf = {r: sha(field(r[0]) + field(r[1]) + field(r[2])) for r in rows}
    groups = {}
    for r in rows:
        groups.setdefault(b"" if r[1] is None else b"s" + r[1].encode(), []).append(r)
    for g in groups.values():
        g.sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf[r]))
    trees = {g: brute([leaf[r] for r in some], arity) for g, some in groups.items()}
    names = sorted(groups)
    root, tops = brute([trees[g][0] for g in names], arity)
    want = sorted(
        (str(r), leaf[r], trees[g][0], str(trees[g][1][i] + tops[names.index(g)])) for g, some in groups.items() for i, r in enumerate(some)
    )
    assert made.root == root
    found = made.proofs().withColumn("folded", merkle.fold(F.col("leaf"), F.col("path"))).withColumn("digest", merkle.path_digest(F.col("path"))).collect()
    assert sorted((str((r.doc_id, r.source, r.text)), r.leaf, r.subroot, str([(s.place, list(s.siblings)) for s in r.path])) for r in found) == want
    assert {r.folded for r in found} == {root}
    assert all(r.digest == sha("".join(d for s in r.path for d in s.siblings)) for r in found)


def test_tampered_leaf_leads_elsewhere(spark):
    made = merkle.manifest(rows_of(spark, [(n, "s", "t") for n in range(30)]), "source", "doc_id", "leaf", 3, 2)
    other = F.when(F.col("doc_id") % 2 == 0, F.sha2(F.lit("other").cast("binary"), 256)).otherwise(F.col("leaf"))
    for r in made.proofs().withColumn("folded", merkle.fold(other, F.col("path"))).collect():
        assert (r.folded == made.root) == (r.doc_id % 2 == 1)


def test_without_rows(spark):
    made = merkle.manifest(rows_of(spark, []), "source", "doc_id", "leaf")
    assert made.root is None and made.proofs().count() == 0


def test_query_on_odd_rows(spark, edge_docs, tmp_path):
    """Nulls in every column, an empty table, repeated rows and columns of clashing names."""
    from clickloom.llm.queries import QUERIES

    docs = edge_docs.withColumn("lang", F.lit(None).cast("string")).withColumn("n_chars", F.when(F.col("doc_id") > 3, 5).cast("long"))
    docs = docs.withColumn("text", F.concat("text", F.lit("\n"))).withColumns({c: F.lit("x") for c in ("grp", "position", "n", "digest", "drawn", "leaf", "path")})
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    rows = QUERIES["op13_merkle_manifest"](spark, str(tmp_path)).collect()
    texts = dict(edge_docs.select("doc_id", "text").collect())
    assert len(rows) == edge_docs.count()
    for r in rows:
        touched = zlib.crc32(str(r.doc_id).encode()) % 2 == 0 and texts[r.doc_id] is not None
        assert r.verified == (r.folded_root == r.root) == (not touched)
    docs.where("false").write.parquet(f"{tmp_path}/none/documents.parquet")
    assert QUERIES["op13_merkle_manifest"](spark, f"{tmp_path}/none").count() == 0
