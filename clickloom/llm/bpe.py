"""Byte-level BPE with a published rank file: encoding with a two-tier lookup, and decoding.

A text is cut by the split pattern. A pre-token that is a vocabulary entry is found through a minimal perfect hash
over the vocabulary; any other is merged, lowest rank first, with a heap over its linked bytes.
"""

import base64
import heapq
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickloom.llm import blocks, hashing

#: Words and pre-tokens whose ids a worker remembers before it starts over.
REMEMBERED = 400_000


def read_ranks(path: str) -> list[bytes]:
    """Vocabulary of a rank file, by id. The file has a fixed size and is read on the driver."""
    with open(path, "rb") as lines:
        pairs = [line.split() for line in lines if line.strip()]
    by_id = sorted((int(rank), base64.b64decode(token)) for token, rank in pairs)
    if [rank for rank, _ in by_id] != list(range(len(by_id))):
        raise ValueError("ranks must run from 0 without gaps")
    return [token for _, token in by_id]


class PerfectHash:
    """Minimal perfect hash of fixed keys.

    Each level has a bit table; a key takes the first level at which no other key left falls on its bit. Its slot
    is the number of bits set before its own. Two array reads per level find the slots of many keys at once.
    """

    def __init__(self, keys: np.ndarray, load: float = 1.5):
        self.tables, self.before = [], []
        set_bits = 0
        left = keys
        while len(left):
            at = self._bit(left, len(self.tables), max(1, int(len(left) * load)))
            hits = np.bincount(at, minlength=max(1, int(len(left) * load)))
            table = hits == 1
            self.tables.append(table)
            self.before.append(set_bits + np.cumsum(table) - table)
            set_bits += int(table.sum())
            left = left[~table[at]]
        self.size = set_bits

    @staticmethod
    def _bit(keys: np.ndarray, level: int, bits: int) -> np.ndarray:
        salted = hashing.mixed(keys + np.uint64((level + 1) * hashing.MULTIPLIER & (1 << 64) - 1))
        return (salted % np.uint64(bits)).astype(np.int64)

    def slots(self, keys: np.ndarray) -> np.ndarray:
        """Slot of each key; any slot or -1 for keys outside the set."""
        found = np.full(len(keys), -1, np.int64)
        open_ = np.arange(len(keys))
        for level, (table, before) in enumerate(zip(self.tables, self.before)):
            at = self._bit(keys[open_], level, len(table))
            hit = table[at]
            found[open_[hit]] = before[at[hit]]
            open_ = open_[~hit]
        return found


def _key(token: bytes) -> int:
    return xxhash.xxh64_intdigest(token)


class Codec:
    """Encoder and decoder of one vocabulary; one per worker."""

    def __init__(self, vocabulary: list[bytes], pattern: str):
        self.vocabulary = vocabulary
        self.split = regex.compile(pattern).findall
        self.ranks = {token: rank for rank, token in enumerate(vocabulary)}
        keys = np.fromiter(map(_key, vocabulary), np.uint64, len(vocabulary))
        self.whole = PerfectHash(keys)
        self.id_of_slot = np.empty(len(vocabulary), np.int64)
        self.id_of_slot[self.whole.slots(keys)] = np.arange(len(vocabulary))
        self.lengths = np.fromiter(map(len, vocabulary), np.int64, len(vocabulary))
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.joined = np.frombuffer(b"".join(vocabulary), np.uint8)
        # Ids are remembered as the bytes of 32-bit integers, so those of a text are a join away.
        self.pieces: dict[str, bytes] = {}
        self.words: dict[str, bytes | None] = {}
        self.single = [np.int32(i).tobytes() for i in range(len(vocabulary))]

    def merge(self, piece: bytes) -> bytes:
        """Ids of a pre-token: pairs of neighbours are merged by rank, then from the left."""
        n = len(piece)
        rank = self.ranks.get
        after, before = list(range(1, n + 1)), list(range(-1, n))
        heap = [(r, i, i + 2) for i in range(n - 1) if (r := rank(piece[i:i + 2])) is not None]
        heapq.heapify(heap)
        while heap:
            _, start, stop = heapq.heappop(heap)
            middle = after[start]
            # Out of date if the left part is gone or either part has grown.
            if middle == 0 or middle >= n or after[middle] != stop:
                continue
            after[start], after[middle], before[stop] = stop, 0, start
            if stop < n and (r := rank(piece[start:after[stop]])) is not None:
                heapq.heappush(heap, (r, start, after[stop]))
            if (left := before[start]) >= 0 and (r := rank(piece[left:stop])) is not None:
                heapq.heappush(heap, (r, left, stop))
        parts, at = [], 0
        while at < n:
            parts.append(self.single[self.ranks[piece[at:after[at]]]])
            at = after[at]
        return b"".join(parts)

    def resolve(self, pieces: list[str]) -> None:
        """Remember the ids of these pre-tokens."""
        tokens = [p.encode() for p in pieces]
        slots = self.whole.slots(np.fromiter(map(_key, tokens), np.uint64, len(tokens)))
        ids = np.where(slots >= 0, self.id_of_slot[slots], 0).tolist()
        known, single = self.vocabulary, self.single
        for piece, token, found, slot in zip(pieces, tokens, ids, slots.tolist()):
            self.pieces[piece] = single[found] if slot >= 0 and known[found] == token else self.merge(token)

    def plain(self, texts: list[str]) -> list[bytes]:
        """Ids of texts, each cut by the pattern as a whole."""
        if len(self.pieces) > REMEMBERED:
            self.pieces.clear()
        cut = list(map(self.split, texts))
        self.resolve(list(set(chain.from_iterable(cut)).difference(self.pieces)))
        ids = self.pieces.__getitem__
        return [b"".join(map(ids, c)) for c in cut]

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of texts, as 32-bit integers.

        The pattern never matches across a single space between other characters than white space, except that it
        takes the space along. So words between such spaces are cut and remembered one by one; a text with any
        other space is cut as a whole.
        """
        if len(self.words) > REMEMBERED:
            self.words.clear()
        words = [t.split(" ") for t in texts]
        fresh = list(set(chain.from_iterable(w[1:] for w in words)).difference(self.words))
        regular = [w for w in fresh if w and not w[0].isspace() and not w[-1].isspace()]
        self.words.update(dict.fromkeys(fresh))
        self.words.update(zip(regular, self.plain([" " + w for w in regular])))
        heads = self.plain([w[0] for w in words])
        ids, found = self.words.__getitem__, []
        for text, parts, head in zip(texts, words, heads):
            try:
                if parts[0][-1:].isspace():
                    raise TypeError
                found.append(head + b"".join(map(ids, parts[1:])))
            except TypeError:  # an irregular word has no ids of its own
                found.append(self.plain([text])[0])
        return found

    def forget(self) -> None:
        """Drop what is remembered: a worker lives on after its task, and other stages need the memory."""
        self.pieces.clear()
        self.words.clear()

    def decode(self, ids: np.ndarray) -> np.ndarray:
        """Bytes of ids, one after the other."""
        return self.joined[blocks.ranges(self.starts[ids], self.lengths[ids])]


_codecs: dict[tuple, Codec] = {}


def codec(vocabulary: list[bytes], pattern: str) -> Codec:
    """The worker's codec of this vocabulary."""
    key = (len(vocabulary), hash(tuple(vocabulary)), pattern)
    if key not in _codecs:
        _codecs.clear()
        _codecs[key] = Codec(vocabulary, pattern)
    return _codecs[key]


def encode(docs: DataFrame, ranks_path: str, pattern: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, ids array<int>) per row. Null texts are empty and have no ids; other columns are ignored."""
    shared = docs.sparkSession.sparkContext.broadcast((read_ranks(ranks_path), pattern))

    def run(batches):
        own = codec(*shared.value)
        try:
            for batch in batches:
                texts = batch.column(1)
                _, offsets = blocks.text_bytes(texts)
                for low, high in blocks.blocks(offsets):
                    ids = own.encode([t or "" for t in texts.slice(low, high - low).to_pylist()])
                    lengths = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
                    values = np.frombuffer(b"".join(ids), np.int32)
                    yield pa.record_batch([batch.column(0).slice(low, high - low), blocks.lists(pa.array(values), lengths)], ["doc_id", "ids"])
        finally:
            own.forget()

    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    return rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, ids array<int>")


def decode(encoded: DataFrame, ranks_path: str, pattern: str, doc_id: str = "doc_id", ids: str = "ids") -> DataFrame:
    """(doc_id, ids, decoded binary) per row of ids. Null ids are none; other columns are ignored."""
    shared = encoded.sparkSession.sparkContext.broadcast((read_ranks(ranks_path), pattern))

    def run(batches):
        own = codec(*shared.value)
        for batch in batches:
            column = batch.column(1)
            ends = column.offsets.to_numpy().astype(np.int64)
            for low, high in blocks.blocks(ends, blocks.BLOCK_BYTES >> 2):
                part = column.values.slice(ends[low], ends[high] - ends[low]).to_numpy(zero_copy_only=False)
                size = np.concatenate([[0], np.cumsum(own.lengths[part])])[ends[low:high + 1] - ends[low]]
                data = own.decode(part)
                yield pa.record_batch([
                    batch.column(0).slice(low, high - low), column.slice(low, high - low),
                    pa.Array.from_buffers(pa.binary(), high - low, [None, pa.py_buffer(size.astype(np.int32)), pa.py_buffer(data)]),
                ], ["doc_id", "ids", "decoded"])

    rows = encoded.select(F.col(doc_id).alias("doc_id"), F.coalesce(ids, F.array().cast("array<int>")).alias("ids"))
    return rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, ids array<int>, decoded binary")
