"""Removal of byte strings that occur more than once, with suffix arrays over shards.

A string of ``width`` bytes is repeated if it starts at two places of the corpus. All bytes under repeated
strings go, from every place. A suffix array over a corpus needs all suffixes with a common beginning
together, so the corpus is cut into shards that can't separate equal strings:

1. The anchor of a window of ``width`` bytes is its first ``ANCHOR``-byte substring with the least hash. Equal
   windows have equal anchors, so only windows whose anchor repeats can repeat.
2. Neighbouring windows with the same anchor make up its context; every window is in one context only. Equal
   contexts are counted and kept once.
3. Contexts are dealt by anchor. Each task takes whole anchors until a shard is full, builds its suffix array by
   induced sorting and the permuted common prefixes. Places whose common prefixes reach ``width`` hold the same
   window and are repeated, as are all places of a context that occurs twice.
4. The places go back to the documents that hold the contexts; overlapping ones are merged and cut out.

An anchor with more different contexts than a shard may hold is split over tasks by the hashes of its windows,
each counted over all its contexts, which decides the same question exactly.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickloom.llm import blocks, hashing, suffix_array, workspace

#: Bytes of a repeated string.
WIDTH = 200
#: Bytes that an anchor's hash covers.
ANCHOR = 40
#: Bytes of text that are hashed at a time.
ANCHOR_BYTES = 1 << 18
#: Different contexts of one anchor that a shard may hold.
MAX_CONTEXTS = 4096
#: Bytes of contexts in a shard, unless one anchor has more.
SHARD_BYTES = 1 << 19
#: Separates contexts in a shard; never part of UTF-8.
SEPARATOR = 0xFF


def remove_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", width: int = WIDTH,
                   max_contexts: int = MAX_CONTEXTS) -> DataFrame:
    """Per row of ``docs``: doc_id, n_bytes, spans (array of removed [start, end)), kept (binary).

    Null texts count as empty; texts under ``width`` bytes never change. A repeated row is a document of its own,
    so it and its like lose everything that is long enough. Null ids are ids. Other columns are ignored.
    """
    if width < 2 * ANCHOR:
        raise ValueError(f"width must be {2 * ANCHOR} or more")
    rows = _keyed(docs, doc_id, text)
    return _cut(rows, _repeats(rows, width, max_contexts), whole_characters=False)


def without_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", width: int = WIDTH,
                    max_contexts: int = MAX_CONTEXTS) -> DataFrame:
    """``docs`` with the repeated strings cut out of ``text``, and with them all characters that they cut into.

    Rows and other columns stay as they are. A null text becomes empty, as does one that is all repeats.
    """
    others = [c for c in docs.columns if c != text]
    rest = F.struct(F.lit(0).alias("_"), *[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(others)])
    rows = _keyed(docs, doc_id, text, rest)
    cut = _cut(rows, _repeats(rows, width, max_contexts), whole_characters=True)
    back = {c: F.col(f"rest.c{i}").alias(c) for i, c in enumerate(others)}
    return cut.select(*[back.get(c, F.col("kept").cast("string").alias(text)) for c in docs.columns])


def _keyed(docs: DataFrame, doc_id: str, text: str, *rest: Column) -> DataFrame:
    """Documents as bytes; an id with the hash of the text tells rows apart that share an id."""
    return docs.select(
        F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text).cast("binary"), F.lit(b"")).alias("bytes"),
        *[r.alias("rest") for r in rest],
    ).withColumn("text_hash", F.xxhash64("bytes"))


def _repeats(rows: DataFrame, width: int, max_contexts: int) -> DataFrame:
    """Removed ranges of the documents that have any."""
    found = rows.select("doc_id", "bytes", "text_hash")
    hits = _hits(found, width)
    return _spans(hits, _covered(_contexts(hits), width, max_contexts))


def _key(left: DataFrame, right: DataFrame):
    return left.doc_id.eqNullSafe(right.doc_id) & (left.text_hash == right.text_hash)


# Anchors.


def _sliding(extreme, values: np.ndarray, width: int) -> np.ndarray:
    """Minimum or maximum of every ``width`` neighbours, by doubling."""
    have = 1
    while have * 2 <= width:
        values = extreme(values[:-have], values[have:])
        have *= 2
    rest = width - have
    return extreme(values[:-rest], values[rest:]) if rest else values


def anchors(data: np.ndarray, offsets: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Contexts of documents that lie in ``data`` one after the other: first window, number of windows, anchor hash."""
    none = np.zeros(0, np.int64)
    if len(data) < width:
        return none, none, none.view(np.uint64)
    full = hashing.Polynomial(data).rolling(ANCHOR)
    low = np.uint64((1 << 32) - 1)
    ranked = (full & ~low) | np.arange(len(full), dtype=np.uint64)
    at = (_sliding(np.minimum, ranked, width - ANCHOR + 1) & low).astype(np.int64)
    count = np.maximum(np.diff(offsets) - width + 1, 0)
    window = blocks.ranges(offsets[:-1], count)
    at = at[window]
    fresh = np.ones(len(at), bool)
    fresh[1:] = (at[1:] != at[:-1]) | (window[1:] != window[:-1] + 1)
    first = np.flatnonzero(fresh)
    return window[first], np.diff(np.append(first, len(at))), full[at[first]]


def _text_anchors(batch: pa.RecordBatch, width: int) -> Iterator[tuple[np.ndarray, ...]]:
    """Row, first window, number of windows and anchor hash of each context, by block."""
    data, offsets = blocks.text_bytes(batch.column("bytes"))
    for low, high in blocks.blocks(offsets, ANCHOR_BYTES):
        begin = offsets[low]
        start, count, found = anchors(data[begin:offsets[high]], offsets[low:high + 1] - begin, width)
        row = np.searchsorted(offsets, start + begin, side="right") - 1
        yield row, start + begin - offsets[row], count, found


def _hits(rows: DataFrame, width: int) -> DataFrame:
    """Contexts whose anchor occurs twice or more: doc_id, text_hash, start, anchor, context_hash, context.

    ``context`` is given once per batch of documents and context, else null.
    """
    def count(batches):
        for batch in batches:
            for _, _, _, found in _text_anchors(batch, width):
                values, n = np.unique(found, return_counts=True)
                yield pa.record_batch([pa.array(values.view(np.int64)), pa.array(np.minimum(n, 2))], ["anchor", "n"])

    def places(batches):
        for batch in batches:
            for row, start, windows, found in _text_anchors(batch, width):
                taken = batch.select(["doc_id", "text_hash"]).take(pa.array(row))
                yield pa.record_batch(
                    [*taken.columns, pa.array(start.astype(np.int32)), pa.array(windows.astype(np.int32)),
                     pa.array(found.view(np.int64))],
                    ["doc_id", "text_hash", "start", "windows", "anchor"],
                )

    def contexts(batches):
        for batch, data, offsets in blocks.parts(batches, "bytes"):
            wanted = batch.column("wanted")
            row = np.repeat(np.arange(len(batch)), np.diff(wanted.offsets.to_numpy()))
            wanted = wanted.flatten()
            at = wanted.field("start").to_numpy(zero_copy_only=False).astype(np.int64)
            start = offsets[row] + at
            end = start + wanted.field("windows").to_numpy(zero_copy_only=False) + width - 1
            anchor = wanted.field("anchor")
            digest = hashing.Polynomial(data).of(start, end)
            order = np.lexsort((anchor.to_numpy(), digest))
            given = np.ones(len(row), bool)
            given[order[1:]] = (digest[order[1:]] != digest[order[:-1]]) | (
                anchor.to_numpy()[order[1:]] != anchor.to_numpy()[order[:-1]])
            lengths = np.where(given, end - start, 0)
            joined = data[blocks.ranges(start, lengths)]
            ends = np.zeros(len(row) + 1, np.int32)
            np.cumsum(lengths, out=ends[1:])
            text = pa.Array.from_buffers(
                pa.binary(), len(row), [pa.array(given).buffers()[1], pa.py_buffer(ends), pa.py_buffer(joined)],
            )
            taken = batch.select(["doc_id", "text_hash"]).take(pa.array(row))
            yield pa.record_batch(
                [*taken.columns, pa.array(at.astype(np.int32)), anchor, pa.array(digest.view(np.int64)), text],
                ["doc_id", "text_hash", "start", "anchor", "context_hash", "context"],
            )

    kind = rows.schema["doc_id"].dataType.simpleString()
    long = rows.where(F.length("bytes") >= width)
    repeated = workspace.stage(
        long.select("bytes").mapInArrow(count, "anchor long, n long")
        .groupBy("anchor").agg(F.sum("n").alias("n")).where("n > 1").select("anchor"), "repeated_anchors",
    )
    found = long.mapInArrow(places, f"doc_id {kind}, text_hash long, start int, windows int, anchor long")
    wanted = workspace.stage(
        found.join(repeated, "anchor", "left_semi")
        .groupBy("doc_id", "text_hash").agg(F.collect_set(F.struct("start", "windows", "anchor")).alias("wanted")), "wanted_anchors",
    )
    joined = long.join(wanted.hint("shuffle_hash"), _key(long, wanted)).select(
        long.doc_id, long.text_hash, "bytes", "wanted",
    )
    return workspace.stage(joined.mapInArrow(
        contexts, f"doc_id {kind}, text_hash long, start int, anchor long, context_hash long, context binary",
    ), "anchor_contexts")


# Contexts and their repeated places.


def _contexts(hits: DataFrame) -> DataFrame:
    """Different contexts of each anchor and whether they occur twice."""
    return workspace.stage(
        hits.groupBy("anchor", "context_hash").agg(
            (F.count("*") > 1).alias("twice"), F.max("context").alias("context"),
        ), "contexts",
    )


_COVERED = "anchor long, context_hash long, starts array<int>, ends array<int>"


def _covered(contexts: DataFrame, width: int, max_contexts: int) -> DataFrame:
    """Repeated ranges of each context."""
    crowded = workspace.stage(
        contexts.groupBy("anchor").count().where(F.col("count") > max_contexts).select("anchor"), "crowded_anchors",
    )
    few = contexts.join(crowded, "anchor", "left_anti")
    many = contexts.join(crowded, "anchor", "left_semi")
    by_suffix = few.repartition("anchor").sortWithinPartitions("anchor").mapInArrow(
        lambda batches: _by_suffix_array(batches, width), _COVERED,
    )
    return workspace.stage(by_suffix.unionByName(_by_window(many, width)), "covered")


def _by_suffix_array(batches, width: int):
    """Whole anchors, taken together up to a shard's size, through suffix arrays."""
    kept, size = [], 0
    for batch in batches:
        while len(batch):
            anchor = batch.column("anchor").to_numpy()
            _, offsets = blocks.text_bytes(batch.column("context"))
            if size >= SHARD_BYTES:
                # The shard ends with the anchor that filled it.
                last = kept[-1].column("anchor")[-1].as_py()
                cut = int(np.searchsorted(anchor, last, side="right"))
                if cut:
                    kept.append(batch.slice(0, cut))
                batch = batch.slice(cut)
                if len(batch):
                    yield _ranges(pa.Table.from_batches(kept).combine_chunks().to_batches()[0], width)
                    kept, size = [], 0
                continue
            cut = int(np.searchsorted(offsets - offsets[0], SHARD_BYTES - size)) or 1
            kept.append(batch.slice(0, cut))
            size += int(offsets[min(cut, len(batch))] - offsets[0])
            batch = batch.slice(cut)
    if kept:
        yield _ranges(pa.Table.from_batches(kept).combine_chunks().to_batches()[0], width)


def _ranges(shard: pa.RecordBatch, width: int) -> pa.RecordBatch:
    """Repeated ranges of the contexts of one shard, which come by anchor.

    The only context of its anchor has no window in common with another one and needs no place in the array.
    """
    anchor = shard.column("anchor").to_numpy()
    fresh = np.flatnonzero(np.append(True, anchor[1:] != anchor[:-1]))
    size = np.diff(np.append(fresh, len(anchor)))
    shared = np.flatnonzero(np.repeat(size, size) > 1)
    data, offsets = blocks.text_bytes(shard.column("context"))
    lengths = np.diff(offsets)
    repeated = np.repeat(shard.column("twice").to_numpy(zero_copy_only=False), lengths)
    if len(shared):
        own = lengths[shared]
        begin = np.arange(len(shared)) + np.cumsum(own) - own
        inner, source = blocks.ranges(begin, own), blocks.ranges(offsets[shared], own)
        text = np.full(len(inner) + len(shared), SEPARATOR, np.uint8)
        text[inner] = data[source]
        left = np.zeros(len(text), np.int64)
        left[inner] = np.repeat(begin + own, own) - inner
        order = suffix_array.suffix_array(text)
        prefix = suffix_array.common_prefixes(text, order, left)
        again = prefix >= width
        again[order[:-1]] |= prefix[order[1:]] >= width
        repeated[source - offsets[0]] |= again[inner]
    repeated &= np.repeat(offsets[1:], lengths) - np.arange(offsets[0], offsets[-1]) >= width
    at = np.flatnonzero(repeated)
    row = np.repeat(np.arange(len(lengths)), lengths)[at]
    at = at + offsets[0] - offsets[row]
    fresh = np.ones(len(at), bool)
    fresh[1:] = (row[1:] != row[:-1]) | (at[1:] > at[:-1] + width)
    last = np.append(fresh[1:], True) if len(at) else fresh
    count = np.bincount(row[fresh], minlength=len(shard))
    return pa.record_batch([
        shard.column("anchor"), shard.column("context_hash"),
        blocks.lists(pa.array(at[fresh].astype(np.int32)), count),
        blocks.lists(pa.array((at[last] + width).astype(np.int32)), count),
    ], ["anchor", "context_hash", "starts", "ends"])


def _by_window(contexts: DataFrame, width: int) -> DataFrame:
    """Repeated ranges of contexts whose anchor has too many of them for one shard."""
    def windows(batches):
        for batch in batches:
            data, offsets = blocks.text_bytes(batch.column("context"))
            for low, high in blocks.blocks(offsets, 1 << 16):
                sums = hashing.Polynomial(data[offsets[low]:offsets[high]])
                count = np.maximum(np.diff(offsets[low:high + 1]) - width + 1, 0)
                start = blocks.ranges(offsets[low:high] - offsets[low], count)
                row = np.repeat(np.arange(low, high), count)
                taken = batch.select(["anchor", "context_hash", "twice"]).take(pa.array(row))
                place = start - (offsets[row] - offsets[low])
                yield pa.record_batch(
                    [*taken.columns, pa.array(place.astype(np.int32)), pa.array(sums.of(start, start + width).view(np.int64))],
                    ["anchor", "context_hash", "twice", "place", "window"],
                )

    each = contexts.mapInArrow(windows, "anchor long, context_hash long, twice boolean, place int, window long")
    times = each.groupBy("anchor", "window").agg(F.sum(F.when(F.col("twice"), 2).otherwise(1)).alias("times"))
    repeated = each.join(times.where("times > 1"), ["anchor", "window"], "left_semi")
    return repeated.groupBy("anchor", "context_hash").agg(
        F.sort_array(F.collect_set("place")).alias("starts"),
    ).withColumn("ends", F.transform("starts", lambda s: s + width))


# Back to the documents.


def _spans(hits: DataFrame, covered: DataFrame) -> DataFrame:
    """Merged removed ranges of each document that has any."""
    some = covered.where(F.size("starts") > 0)
    ranges = hits.select("doc_id", "text_hash", "start", "anchor", "context_hash").join(
        some, ["anchor", "context_hash"],
    ).select("doc_id", "text_hash", "start", F.explode(F.arrays_zip("starts", "ends")).alias("r")).select(
        "doc_id", "text_hash", (F.col("start") + F.col("r.starts")).alias("start"), (F.col("start") + F.col("r.ends")).alias("end"),
    )
    return workspace.stage(
        ranges.groupBy("doc_id", "text_hash").agg(F.collect_set(F.struct("start", "end")).alias("ranges")), "ranges",
    )


def _cut(rows: DataFrame, spans: DataFrame, whole_characters: bool) -> DataFrame:
    rest = [c for c in rows.columns if c == "rest"]

    def cut(batches):
        for batch, data, offsets in blocks.parts(batches, "bytes"):
            ranges = batch.column("ranges")
            count = np.diff(ranges.offsets.to_numpy())
            if ranges.null_count:
                count = np.where(ranges.is_null().to_numpy(zero_copy_only=False), 0, count)
            row = np.repeat(np.arange(len(batch)), count)
            values = ranges.flatten()
            start = offsets[row] + values.field("start").to_numpy(zero_copy_only=False)
            end = offsets[row] + values.field("end").to_numpy(zero_copy_only=False)
            # Texts lie side by side, so spans may touch but never overlap across rows.
            order = np.lexsort((start, row))
            row, start, end = row[order], start[order], end[order]
            reach = np.maximum.accumulate(end) if len(end) else end
            fresh = np.ones(len(row), bool)
            fresh[1:] = (row[1:] != row[:-1]) | (start[1:] > reach[:-1])
            last = np.append(fresh[1:], True) if len(row) else fresh
            row, start, end = row[fresh], start[fresh], reach[last]
            gone = np.zeros(len(data) + 1, np.int8)
            np.add.at(gone, start, 1)
            np.add.at(gone, end, -1)
            keep = np.cumsum(gone[:-1], dtype=np.int8) == 0
            if whole_characters and len(data):
                character = np.cumsum((data & 0xC0) != 0x80)
                keep &= (np.bincount(character, ~keep) == 0)[character]
            ends = np.concatenate([[0], np.cumsum(keep)])[offsets].astype(np.int32)
            pair = pa.StructArray.from_arrays(
                [pa.array((start - offsets[row]).astype(np.int32)), pa.array((end - offsets[row]).astype(np.int32))],
                ["start", "end"],
            )
            yield pa.record_batch([
                batch.column("doc_id"), pa.array(np.diff(offsets)), blocks.lists(pair, np.bincount(row, minlength=len(batch))),
                pa.Array.from_buffers(pa.binary(), len(batch), [None, pa.py_buffer(ends), pa.py_buffer(data[keep])]),
                *[batch.column(c) for c in rest],
            ], ["doc_id", "n_bytes", "spans", "kept", *rest])

    joined = rows.join(spans.hint("shuffle_hash"), _key(rows, spans), "left").select(rows.doc_id, "bytes", "ranges", *rest)
    span = T.StructType([T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())])
    return joined.mapInArrow(cut, T.StructType([
        rows.schema["doc_id"], T.StructField("n_bytes", T.LongType()), T.StructField("spans", T.ArrayType(span)),
        T.StructField("kept", T.BinaryType()), *[rows.schema[c] for c in rest],
    ]))
