"""Near duplicates by SimHash with deletion-variant signatures.

Two fingerprints that differ in up to ``2 s - 1`` bits differ in at most one bit in one of ``s`` segments. So each
segment is indexed under variants with one bit left out, and equal variants bring such pairs together: with
the default of 3 bits, two segments of 32 bits and 64 variants, where whole-segment equality would need four
segments. Candidates are compared in full.
"""

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickloom.llm import components, workspace

#: Words of a shingle.
SHINGLE_WORDS = 3
#: Bits in which linked fingerprints may differ.
MAX_BITS = 3
#: Seed of the shingle hash.
SEED = 42
#: Fingerprints of one variant that a task compares at once; larger groups are compared in pairs of blocks.
BLOCK = 4096
#: Groups up to this size are compared pair by pair for many groups at once.
SMALL = 32


def fingerprint(text: bytes, shingle_words: int = SHINGLE_WORDS) -> int:
    """Majority of each bit over the hashes of all shingles; zero without words."""
    words = text.lower().split()  # of bytes: ASCII letters and white space only
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    starts = (ends - np.fromiter(map(len, words), np.int64, len(words)) - 1).tolist()
    stops = (ends[min(shingle_words, len(words)) - 1:] - 1).tolist()
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(joined[s:e], SEED) for s, e in zip(starts, stops)], np.uint64)
    bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    ones = bits.sum(axis=0, dtype=np.uint32)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
                 shingle_words: int = SHINGLE_WORDS) -> DataFrame:
    """(doc_id, fingerprint long) per row; null and empty texts have fingerprint zero."""
    def build(batches):
        for batch in batches:
            values = np.fromiter(
                (fingerprint(t.as_buffer().to_pybytes() if t.is_valid else b"", shingle_words) for t in batch.column(1)),
                np.uint64, len(batch),
            )
            yield pa.record_batch([batch.column(0), pa.array(values.view(np.int64))], ["doc_id", "fingerprint"])

    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("binary").alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(build, f"doc_id {kind}, fingerprint long")


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
                    shingle_words: int = SHINGLE_WORDS, max_bits: int = MAX_BITS, block: int = BLOCK) -> DataFrame:
    """(doc_id, fingerprint long, component_id) per row of ``docs``.

    The component is the smallest doc_id reachable over links of up to ``max_bits`` differing bits. Texts without
    words, null included, share fingerprint zero and are linked like any other. Repeated rows stay; other columns
    are ignored. Equal fingerprints are one node, however many documents have them.
    """
    rows = workspace.stage(fingerprints(docs, doc_id, text, shingle_words), "fingerprints")
    nodes = workspace.stage(rows.groupBy("fingerprint").agg(F.min("doc_id").alias("first_id")), "nodes")
    found = components.components(links(nodes, max_bits, block))
    rooted = nodes.join(found, nodes.fingerprint == found.node, "left").select(
        "fingerprint", "first_id", F.coalesce("component", "fingerprint").alias("root"),
    )
    least = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    named = workspace.stage(rooted.join(least, "root").select("fingerprint", "component_id"), "named")
    return rows.join(named, "fingerprint").select("doc_id", "fingerprint", "component_id")


def links(nodes: DataFrame, max_bits: int = MAX_BITS, block: int = BLOCK) -> DataFrame:
    """Links (a, b) between different fingerprints that connect all that are within ``max_bits``.

    A group of equal variants gives a spanning forest of its links, not all its pairs. A group too large for
    one comparison is cut into blocks, and each pair of blocks is compared on its own.
    """
    segments = max_bits // 2 + 1

    def variants(batches):
        for batch in batches:
            values = batch.column(0).to_numpy().view(np.uint64)
            keys = variant_keys(values, segments)
            yield pa.record_batch(
                [pa.array(keys.reshape(-1).view(np.int64)), pa.array(np.repeat(values, keys.shape[1]).view(np.int64))],
                ["key", "fingerprint"],
            )

    def pairs(batches):
        for batch in batches:
            for one, other in zip(batch.column(0), batch.column(1)):
                both = np.union1d(one.values.to_numpy(), other.values.to_numpy())
                yield _link_batch(*forest(both, max_bits))

    keyed = nodes.select("fingerprint").mapInArrow(variants, "key long, fingerprint long")
    found = workspace.stage(
        keyed.repartition("key").sortWithinPartitions("key").mapInArrow(
            lambda batches: _groups(batches, max_bits, block), "a long, b long, key long, block int, members array<long>",
        ), "candidates",
    )
    large = found.where("members is not null").select("key", "block", "members")
    other = large.select("key", F.col("block").alias("block_2"), F.col("members").alias("members_2"))
    between = large.join(other, "key").where("block < block_2").select("members", "members_2")
    return found.where("a is not null").select("a", "b").unionByName(between.mapInArrow(pairs, "a long, b long"))


def variant_keys(values: np.ndarray, segments: int) -> np.ndarray:
    """One key per bit: its segment without that bit, and which bit it is."""
    edges = [64 * i // segments for i in range(segments + 1)]
    keys = np.empty((len(values), 64), np.uint64)
    for low, high in zip(edges, edges[1:]):
        part = (values >> np.uint64(low)) & np.uint64((1 << (high - low)) - 1)
        for bit in range(low, high):
            keys[:, bit] = part & ~np.uint64(1 << (bit - low))
            if high - low <= 56:
                keys[:, bit] |= np.uint64(bit << 56)
            else:  # one segment of 64 bits has no room for the bit's number
                keys[:, bit] ^= np.uint64((bit + 1) * 0x9E3779B97F4A7C15 & (1 << 64) - 1)
    return keys


def _distance(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Differing bits; of unsigned values, as numpy counts those of the magnitude."""
    return np.bitwise_count((a ^ b).view(np.uint64))


def forest(values: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Spanning forest of the links between these fingerprints: each is linked to the one that found it first."""
    left, queue = np.arange(len(values)), []
    from_, to = [], []
    while len(left):
        if not queue:
            queue.append(int(left[0]))
            left = left[1:]
        at = queue.pop()
        near = _distance(values[left], values[at]) <= max_bits
        found = left[near]
        if len(found):
            from_.append(np.full(len(found), at))
            to.append(found)
            queue.extend(found.tolist())
            left = left[~near]
    none = np.zeros(0, np.int64)
    return values[np.concatenate([none, *from_])], values[np.concatenate([none, *to])]


def _link_batch(a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
    return pa.record_batch([pa.array(a), pa.array(b)], ["a", "b"])


def _row_batch(a=(), b=(), key=None, number=None, members=None) -> pa.RecordBatch:
    n = 1 if members is not None else len(a)
    if members is None:
        columns = [pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.nulls(n, pa.int64()), pa.nulls(n, pa.int32()),
                   pa.nulls(n, pa.list_(pa.int64()))]
    else:
        columns = [pa.nulls(1, pa.int64()), pa.nulls(1, pa.int64()), pa.array([key], pa.int64()),
                   pa.array([number], pa.int32()), pa.array([members], pa.list_(pa.int64()))]
    return pa.record_batch(columns, ["a", "b", "key", "block", "members"])


def _groups(batches, max_bits: int, block: int):
    """Links inside groups of equal keys, which come sorted; blocks of groups that are too large."""
    rest_key, rest, number = None, np.zeros(0, np.int64), 0

    def closed():
        if number:
            yield _row_batch(key=rest_key, number=number, members=rest)
            yield _row_batch(*forest(rest, max_bits))
        elif len(rest) > 1:
            yield _row_batch(*forest(rest, max_bits))

    for batch in batches:
        key, value = batch.column(0).to_numpy(), batch.column(1).to_numpy()
        if not len(key):
            continue
        begin = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
        end = np.append(begin[1:], len(key))
        if rest_key is not None and key[0] == rest_key:
            rest = np.concatenate([rest, value[:end[0]]])
            begin, end = begin[1:], end[1:]
        while len(rest) > block:
            members, rest = rest[:block], rest[block:]
            yield _row_batch(key=rest_key, number=number, members=members)
            yield _row_batch(*forest(members, max_bits))
            number += 1
        if not len(begin):
            continue
        yield from closed()
        # The last group may go on in the next batch.
        rest_key, rest, number = int(key[begin[-1]]), value[begin[-1]:], 0
        size = (end - begin)[:-1]
        small = begin[:-1][(size > 1) & (size <= SMALL)]
        yield _row_batch(*_close_pairs(small, size[(size > 1) & (size <= SMALL)], value, max_bits))
        for at in np.flatnonzero(size > SMALL):
            yield _row_batch(*forest(value[begin[at]:end[at]], max_bits))
        while len(rest) > block:
            members, rest = rest[:block], rest[block:]
            yield _row_batch(key=rest_key, number=number, members=members)
            yield _row_batch(*forest(members, max_bits))
            number += 1
    yield from closed()


def _close_pairs(begin: np.ndarray, size: np.ndarray, value: np.ndarray, max_bits: int):
    """All links inside small groups."""
    a, b = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    at = np.repeat(begin, size) + (np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size))
    last = np.repeat(begin + size, size)
    step = 1
    while len(at):
        on = at + step < last
        at, last = at[on], last[on]
        near = _distance(value[at], value[at + step]) <= max_bits
        a.append(value[at[near]])
        b.append(value[at[near] + step])
        step += 1
    return np.concatenate(a), np.concatenate(b)
