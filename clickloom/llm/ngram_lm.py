"""Language-model scores by stupid backoff, with counts over a whole corpus.

S(w | v) = c(v w) / c(v) if the corpus has the pair, else ``BACKOFF`` * c(w) / N; a first word has c(w) / N. The count tables are partitioned by the hash of the n-gram. Documents are dealt into blocks; a block
lists its different n-grams once for each hash range, which is what is shuffled, and gets the totals back that differ
from its own counts. So a frequent n-gram costs a row entry per block, not per occurrence.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickloom.llm import blocks, decontamination, hashing, workspace

#: Factor for each step back to a shorter history.
BACKOFF = 0.4
#: Pairs seen less often count as not seen.
MIN_PAIR = 1
#: Text bytes of a block, on average.
BLOCK_BYTES = 4 << 20
#: Documents of a block that are worked on at a time have so many bytes.
PART_BYTES = 1 << 20
#: N-grams that are gathered before equal ones are counted together.
FOLD = 1 << 20


def score(docs: DataFrame, corpus: DataFrame | None = None, doc_id: str = "doc_id", text: str = "text",
          backoff: float = BACKOFF, min_pair: int = MIN_PAIR, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(doc_id, n_words, log_score) per row of ``docs``: the sum of log10 S over its words.

    Counts come from ``corpus``, by default ``docs`` itself. A word that the corpus lacks counts as a share of
    1 / (N + 1). Null and empty texts have no words and score 0. Repeated rows count and are scored each. Other
    columns are ignored.
    """
    own = corpus is None
    asked, parts = _dealt(docs, doc_id, text, block_bytes)
    kind = docs.schema[doc_id].dataType.simpleString()
    listed = _lists(asked, parts, own, 0)
    if not own:
        counted, more = _dealt(corpus, doc_id, text, block_bytes)
        listed = listed.unionByName(_lists(counted, parts, True, more))
    answers = workspace.stage(listed.groupBy("part").applyInArrow(_totals, _ANSWER), "totals")
    total = answers.where("block = -1").agg(F.sum("words")).first()[0] or 0

    def scored(key, block, answers):
        return _scores(block, answers, parts, own, total, backoff, min_pair)

    return asked.groupBy("block").cogroup(answers.where("block >= 0").groupBy("block")).applyInArrow(
        scored, f"doc_id {kind}, n_words long, log_score double",
    )


_LIST = "part int, block long, asks boolean, counts boolean, grams binary, times binary, words long"
_ANSWER = "block long, part int, at binary, totals binary, words long"


def _dealt(docs: DataFrame, doc_id: str, text: str, block_bytes: int) -> tuple[DataFrame, int]:
    """Rows with the number of their block, and how many blocks there are."""
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text).cast("binary"), F.lit(b"")).alias("text"))
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    count = size // block_bytes + 1
    return rows.withColumn("block", F.pmod(F.xxhash64("doc_id", "text"), F.lit(count))), count


def _grams(table: pa.Table):
    """Word hashes, pair hashes (of each word with the one before), first words and row of each part of a block."""
    column = table.column("text").combine_chunks() if table.num_rows else pa.array([], pa.binary())
    data, offsets = blocks.text_bytes(column)
    for low, high in blocks.blocks(offsets, PART_BYTES):
        words, first = decontamination.terms(data[offsets[low]:offsets[high]], offsets[low:high + 1] - offsets[low])
        words = words.view(np.uint64)
        pairs = np.zeros_like(words)
        pairs[1:] = hashing.mixed(words[:-1] * np.uint64(hashing.MULTIPLIER) + words[1:])
        heads = np.zeros(len(words) + 1, bool)
        heads[first] = True
        yield words, pairs, heads[:-1], first


def _distinct(table: pa.Table) -> tuple[np.ndarray, np.ndarray, int]:
    """Different n-grams of a block, sorted, with their counts, and the number of words."""
    grams, times, words = np.zeros(0, np.uint64), np.zeros(0, np.int64), 0
    found: list[np.ndarray] = []
    size = 0

    def fold():
        nonlocal grams, times, found, size
        values, counts = np.unique(np.concatenate(found), return_counts=True) if found else (grams[:0], times[:0])
        both = np.concatenate([grams, values])
        grams, where = np.unique(both, return_inverse=True)
        times = np.bincount(where, np.concatenate([times, counts]), len(grams)).astype(np.int64)
        found, size = [], 0

    for single, pairs, heads, _ in _grams(table):
        words += len(single)
        found += [single, pairs[~heads]]
        size += 2 * len(single)
        if size > FOLD:
            fold()
    fold()
    return grams, times, words


def _planes(values: np.ndarray) -> bytes:
    """Integers with their first bytes together, then their second ones and so on.

    The high bytes of sorted hashes, of places and of counts are alike and compress well.
    """
    return np.ascontiguousarray(values.view(np.uint8).reshape(-1, values.dtype.itemsize).T).tobytes()


def _from_planes(data, kind: type) -> np.ndarray:
    planes = np.frombuffer(data, np.uint8).reshape(np.dtype(kind).itemsize, -1)
    return np.ascontiguousarray(planes.T).view(kind).reshape(-1)


def _edges(parts: int) -> np.ndarray:
    return np.array([(i << 64) // parts for i in range(1, parts)], np.uint64)


def _lists(dealt: DataFrame, parts: int, counts: bool, offset: int) -> DataFrame:
    """One row per block and hash range. Corpus blocks that aren't scored have negative numbers."""
    asks = offset == 0

    def listed(table: pa.Table) -> pa.Table:
        grams, times, words = _distinct(table)
        block = table.column("block")[0].as_py()
        cut = np.concatenate([[0], np.searchsorted(grams, _edges(parts)), [len(grams)]])
        rows = [(i, a, b) for i, (a, b) in enumerate(zip(cut, cut[1:])) if b > a]
        return pa.table({
            "part": pa.array([i for i, _, _ in rows], pa.int32()),
            "block": pa.array([block if asks else -2 - block] * len(rows), pa.int64()),
            "asks": pa.array([asks] * len(rows), pa.bool_()), "counts": pa.array([counts] * len(rows), pa.bool_()),
            "grams": pa.array([_planes(grams[a:b]) for _, a, b in rows], pa.binary()),
            "times": pa.array([_planes(times[a:b]) for _, a, b in rows], pa.binary()),
            "words": pa.array([words if n == 0 and counts else 0 for n in range(len(rows))], pa.int64()),
        })

    return dealt.groupBy("block").applyInArrow(listed, _LIST)


def _totals(table: pa.Table) -> pa.Table:
    """Count table of one hash range, joined to the lists of the blocks.

    A block gets the places in its list whose total isn't its own count, with the totals; block -1 has the words.
    """
    lists = [_from_planes(g.as_buffer(), np.uint64) for g in table.column("grams")]
    times = [_from_planes(t.as_buffer(), np.int64) for t in table.column("times")]
    counts, asks = table.column("counts").to_pylist(), table.column("asks").to_pylist()
    counted = [g for g, c in zip(lists, counts) if c]
    grams, where = np.unique(np.concatenate([np.zeros(0, np.uint64), *counted]), return_inverse=True)
    total = np.bincount(where, np.concatenate([np.zeros(0, np.int64), *[t for t, c in zip(times, counts) if c]]), len(grams)).astype(np.int64)
    part = table.column("part")[0].as_py()
    at, sums, numbers = [], [], []
    for block, own, n, counts_, asks_ in zip(table.column("block").to_pylist(), lists, times, counts, asks):
        if not asks_:
            continue
        place = np.minimum(np.searchsorted(grams, own), max(len(grams) - 1, 0))
        here = np.where(grams[place] == own, total[place], 0) if len(grams) else np.zeros(len(own), np.int64)
        differs = np.flatnonzero(here != (n if counts_ else 0))
        numbers.append(block)
        at.append(_planes(differs))
        sums.append(_planes(here[differs]))
    words = sum(table.column("words").to_pylist())
    n = len(numbers)
    return pa.table({
        "block": pa.array([*numbers, -1], pa.int64()), "part": pa.array([part] * (n + 1), pa.int32()),
        "at": pa.array([*at, b""], pa.binary()), "totals": pa.array([*sums, b""], pa.binary()),
        "words": pa.array([0] * n + [words], pa.int64()),
    })


def _scores(block: pa.Table, answers: pa.Table, parts: int, own: bool, total: int, backoff: float, min_pair: int) -> pa.Table:
    """Scores of the documents of a block."""
    grams, times, _ = _distinct(block)
    known = times if own else np.zeros(len(grams), np.int64)
    # Lists were cut where the hash ranges begin; a place in a list counts from there.
    begin = np.concatenate([[0], np.searchsorted(grams, _edges(parts))])
    for part, at, totals in zip(*(answers.column(c) for c in ("part", "at", "totals"))):
        known[_from_planes(at.as_buffer(), np.int64) + begin[part.as_py()]] = _from_planes(totals.as_buffer(), np.int64)
    sums, lengths = [], []
    for words, pairs, heads, first in _grams(block):
        n = known[np.searchsorted(grams, words)] if len(words) else np.zeros(0, np.int64)
        alone = np.where(n > 0, n / max(total, 1), 1 / (total + 1))
        value = alone * np.where(heads, 1.0, backoff)
        inner = np.flatnonzero(~heads)
        both = known[np.searchsorted(grams, pairs[inner])]
        seen = both >= min_pair
        value[inner[seen]] = both[seen] / n[inner[seen] - 1]
        document = np.repeat(np.arange(len(first) - 1), np.diff(first))
        sums.append(np.bincount(document, np.log10(value), len(first) - 1))
        lengths.append(np.diff(first))
    none = np.zeros(0)
    return pa.table({
        "doc_id": block.column("doc_id").combine_chunks() if block.num_rows else block.column("doc_id"),
        "n_words": pa.array(np.concatenate([none, *lengths]).astype(np.int64)),
        "log_score": pa.array(np.concatenate([none, *sums])),
    })
