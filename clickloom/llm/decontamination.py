"""Benchmark passages in a corpus, found with a distributed positional inverted index.

The index is split by documents: each row of its table is a segment with the sorted terms of some documents and, per
term, the ascending list of places. A phrase is searched in every segment on its own: the places of its rarest term,
less that term's offset, are candidate starts; the lists of its other terms, from the next rarest on and adjusted in
the same way, are intersected with them. With a ``slop`` above zero each word may stand that many places from
where the phrase has it, counted from the rarest word (a proximity match).
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickloom.llm import blocks, hashing, workspace

#: Words of a window of a benchmark item.
WINDOW = 13
#: Bytes of benchmark text that are searched, and sent to the tasks, at a time.
QUERY_BYTES = 4 << 20

_WORD = np.zeros(256, bool)
_WORD[ord("0"):ord("9") + 1] = True
_WORD[ord("A"):ord("Z") + 1] = True
_WORD[ord("a"):ord("z") + 1] = True
_WORD[128:] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A"):ord("Z") + 1] += 32


def terms(data: np.ndarray, offsets: np.ndarray, places: bool = False) -> tuple[np.ndarray, ...]:
    """Hash of each word of texts that lie side by side, and the first word of each text; with ``places`` also where
    each word begins.

    Words are runs of ASCII letters and digits and of all non-ASCII characters, with A-Z in lower case.
    """
    data = _LOWER[data]
    word = _WORD[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    before = np.append(False, word)[:-1] & ~edge[:-1]
    after = np.append(word, False)[1:] & ~edge[1:]
    starts = np.flatnonzero(word & ~before)
    ends = np.flatnonzero(word & ~after) + 1
    found = hashing.Polynomial(data).of(starts, ends).view(np.int64), np.searchsorted(starts, offsets)
    return (*found, starts) if places else found


def build_index(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", vocabulary: np.ndarray | None = None) -> DataFrame:
    """Segments of the index, written to the shared folder.

    ``vocabulary`` (sorted term hashes of a query set of bounded size) leaves out lists that no query asks for.
    Columns: segment, doc_ids, first_words (of each document and the end), terms, first_places (of each term and
    the end), places (word numbers in the segment).
    """
    def build(batches):
        for batch in batches:
            data, offsets = blocks.text_bytes(batch.column("text"))
            for low, high in blocks.blocks(offsets):
                found, first = terms(data[offsets[low]:offsets[high]], offsets[low:high + 1] - offsets[low])
                places = np.arange(len(found))
                if vocabulary is not None:
                    at = np.minimum(np.searchsorted(vocabulary, found), max(len(vocabulary) - 1, 0))
                    known = vocabulary[at] == found if len(vocabulary) else np.zeros(len(found), bool)
                    found, places = found[known], places[known]
                order = np.argsort(found, kind="stable")
                found, places = found[order], places[order]
                begin = np.flatnonzero(np.append(True, found[1:] != found[:-1])) if len(found) else places
                yield pa.record_batch([
                    blocks.lists(batch.column("doc_id").slice(low, high - low), np.array([high - low])),
                    pa.array([first.astype(np.int32)]), pa.array([found[begin]]),
                    pa.array([np.append(begin, len(found)).astype(np.int32)]), pa.array([places.astype(np.int32)]),
                ], ["doc_ids", "first_words", "terms", "first_places", "places"])

    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("binary").alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    segments = rows.mapInArrow(
        build, f"doc_ids array<{kind}>, first_words array<int>, terms array<long>, first_places array<int>, places array<int>",
    )
    return workspace.stage(segments.withColumn("segment", F.monotonically_increasing_id()), "postings")


class Phrases:
    """Windows of a bounded set of items: terms, rarest first, and the items that have them."""

    def __init__(self, texts: list[str | None], window: int):
        encoded = [(t or "").encode("utf-8", "surrogatepass") for t in texts]
        offsets = np.concatenate([[0], np.cumsum([len(t) for t in encoded])]).astype(np.int64)
        words, first = terms(np.frombuffer(b"".join(encoded), np.uint8), offsets)
        seen: dict[bytes, int] = {}
        self.items: list[list[int]] = []
        phrases = []
        for item, (low, high) in enumerate(zip(first[:-1], first[1:])):
            for at in range(low, max(high - window, low) + 1) if high > low else ():
                phrase = words[at:min(at + window, high)]
                number = seen.setdefault(phrase.tobytes(), len(phrases))
                if number == len(phrases):
                    phrases.append(phrase)
                    self.items.append([])
                if not self.items[number] or self.items[number][-1] != item:
                    self.items[number].append(item)
        self.length = np.array([len(p) for p in phrases], np.int64)
        self.terms = np.zeros((len(phrases), window), np.int64)
        self.offset = np.tile(np.arange(window), (len(phrases), 1))
        for row, phrase in enumerate(phrases):
            self.terms[row, :len(phrase)] = phrase
        self.vocabulary = np.unique(np.concatenate([np.zeros(0, np.int64), *phrases]))

    def arrange(self, frequency: dict[int, int]) -> None:
        """Order the terms of each window by how often the corpus has them; rows keep their windows."""
        known = np.array([frequency.get(int(t), 0) for t in self.vocabulary], np.int64)
        width = self.terms.shape[1]
        inside = np.arange(width) < self.length[:, None]
        at = np.minimum(np.searchsorted(self.vocabulary, self.terms), max(len(self.vocabulary) - 1, 0))
        rarity = np.where(inside, known[at] if len(known) else 0, np.iinfo(np.int64).max)
        order = np.argsort(rarity, axis=1, kind="stable")
        self.terms = np.take_along_axis(self.terms, order, 1)
        self.offset = np.take_along_axis(self.offset, order, 1)

    def search(self, segment: dict, slop: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Window, document number and first word (in the segment) of each match."""
        listed, first, places = segment["terms"], segment["first_places"].astype(np.int64), segment["places"].astype(np.int64)
        none = np.zeros(0, np.int64)
        if not len(listed) or not len(self.length):
            return none, none, none
        total = int(segment["first_words"][-1]) + 1
        keys = np.repeat(np.arange(len(listed)), np.diff(first)) * total + places

        def number(term):
            at = np.minimum(np.searchsorted(listed, term), len(listed) - 1)
            return np.where(listed[at] == term, at, -1)

        rarest = number(self.terms[:, 0])
        window = np.flatnonzero(rarest >= 0)
        count = np.diff(first)[rarest[window]]
        source = blocks.ranges(first[:-1][rarest[window]], count)
        window = np.repeat(window, count)
        document = np.searchsorted(segment["first_words"], places[source], side="right") - 1
        begin, end = segment["first_words"][document].astype(np.int64), segment["first_words"][document + 1].astype(np.int64)
        start = places[source] - self.offset[window, 0]
        alive = np.arange(len(window))
        if slop == 0:
            alive = alive[(start >= begin) & (start + self.length[window] <= end)]
        for nth in range(1, self.terms.shape[1]):
            if not len(alive):
                break
            asked = self.length[window[alive]] > nth
            some = alive[asked]
            term = number(self.terms[window[some], nth])
            place = start[some] + self.offset[window[some], nth]
            low, high = np.maximum(place - slop, begin[some]), np.minimum(place + slop, end[some] - 1)
            at = np.minimum(np.searchsorted(keys, term * total + low), len(keys) - 1)
            good = (term >= 0) & (low <= high) & (keys[at] >= term * total + low) & (keys[at] <= term * total + high)
            alive = np.sort(np.concatenate([alive[~asked], some[good]]))
        return window[alive], document[alive], start[alive]


def matches(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id",
            item_text: str = "text", window: int = WINDOW, slop: int = 0, query_bytes: int = QUERY_BYTES) -> DataFrame:
    """Per row of ``docs``: doc_id, n_words, n_hit (words inside any match), items (ids with a match, as text), spans.

    A window is ``window`` words of an item, or a shorter item as a whole; items without words match nothing. Null
    texts have no words. Repeated documents are judged each on its own; repeated items count once. Items are
    searched in blocks of bounded size, every block against all segments. Other columns are ignored.
    """
    asked = items.select(F.col(item_id).cast("string").alias("item_id"), F.col(item_text).alias("text"))
    size = asked.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = -(-size // query_bytes) or 1
    spark = docs.sparkSession
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    found, index = [], None
    if parts > 1:
        # One stored index for all blocks: its segment numbers name the same documents in each.
        index = build_index(rows, vocabulary=_vocabulary(asked))
    for part in range(parts):
        block = asked.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(parts)) == part).collect()
        phrases = Phrases([r.text for r in block], window)
        if index is None:
            index = build_index(rows, vocabulary=phrases.vocabulary)
        spread = index.select(F.explode(F.arrays_zip("terms", F.slice("first_places", 2, F.size("terms")).alias("to"),
                                                     F.col("first_places").alias("from"))).alias("p"))
        frequency = spread.where("p.terms is not null").groupBy("p.terms").agg(F.sum(F.expr("p.to - p.from")).alias("n"))
        if parts > 1:  # the index has the terms of the other blocks too
            own = spark.createDataFrame(pa.table({"terms": pa.array(phrases.vocabulary, pa.int64())}))
            frequency = frequency.join(own, "terms", "left_semi")
        phrases.arrange({r.terms: r.n for r in frequency.collect()})
        names = np.array([r.item_id for r in block], object)
        found.append(_search(index, phrases, names, slop))
    if parts == 1:
        return found[0].drop("segment", "number")
    return _united([workspace.stage(f, "matches") for f in found])


def _vocabulary(items: DataFrame) -> np.ndarray:
    """Sorted hashes of the different terms of all items."""
    def build(batches):
        for batch in batches:
            yield pa.record_batch([pa.array(np.unique(terms(*_bytes(batch.column(0)))[0]))], ["term"])

    def _bytes(column):
        data, offsets = blocks.text_bytes(column)
        return data[offsets[0]:offsets[-1]], offsets - offsets[0]

    found = items.select(F.col("text").cast("binary").alias("text")).mapInArrow(build, "term long").distinct().toArrow()
    return np.sort(found.column("term").to_numpy())


def _schema(kind: str) -> str:
    return (f"segment long, number int, doc_id {kind}, n_words long, n_hit long, items array<string>, "
            "spans array<struct<start:int,end:int>>")


def _search(index: DataFrame, phrases: Phrases, names: np.ndarray, slop: int) -> DataFrame:
    """Matches of a block of windows in every segment, one row per document."""
    shared = index.sparkSession.sparkContext.broadcast((phrases, names))

    def search(batches):
        phrases, names = shared.value
        for batch in batches:
            for row in range(len(batch)):
                one = {n: batch.column(n)[row].values for n in batch.schema.names if n != "segment"}
                segment = {n: v.to_numpy(zero_copy_only=False) for n, v in one.items() if n != "doc_ids"}
                window, document, start = phrases.search(segment, slop)
                first = segment["first_words"].astype(np.int64)
                start, end = np.maximum(start, first[document]), np.minimum(start + phrases.length[window], first[document + 1])
                yield _found(batch.column("segment")[row].as_py(), one["doc_ids"], first, document, start, end,
                             [[names[i] for i in phrases.items[w]] for w in window])

    kind = index.schema["doc_ids"].dataType.elementType.simpleString()
    return index.select("segment", "doc_ids", "first_words", "terms", "first_places", "places").mapInArrow(search, _schema(kind))


def _found(segment, doc_ids, first, document, start, end, names) -> pa.RecordBatch:
    n = len(doc_ids)
    marks = np.zeros(int(first[-1]) + 1, np.int64)
    np.add.at(marks, start, 1)
    np.add.at(marks, end, -1)
    hit = np.append(np.cumsum(marks[:-1]) > 0, False)
    edge = np.zeros(len(hit), bool)
    edge[first[:-1]] = True
    span_start = np.flatnonzero(hit & (edge | ~np.append(False, hit[:-1])))
    span_end = np.flatnonzero(hit[:-1] & (edge[1:] | ~hit[1:])) + 1
    owner = np.searchsorted(first, span_start, side="right") - 1
    items: list[set] = [set() for _ in range(n)]
    for d, found in zip(document.tolist(), names):
        items[d].update(x for x in found if x is not None)
    n_hit = np.bincount(owner, span_end - span_start, minlength=n).astype(np.int64)
    pairs = pa.StructArray.from_arrays(
        [pa.array((span_start - first[owner]).astype(np.int32)), pa.array((span_end - first[owner]).astype(np.int32))], ["start", "end"],
    )
    return pa.record_batch([
        pa.array([segment] * n, pa.int64()), pa.array(np.arange(n, dtype=np.int32)), doc_ids, pa.array(np.diff(first)),
        pa.array(n_hit), pa.array([sorted(s) for s in items], pa.list_(pa.string())),
        blocks.lists(pairs, np.bincount(owner, minlength=n)),
    ], ["segment", "number", "doc_id", "n_words", "n_hit", "items", "spans"])


def _united(parts: list[DataFrame]) -> DataFrame:
    """Matches of several blocks of items, per document."""
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part)
    # Spans of several blocks may overlap: merge them in order of their starts.
    step = lambda done, s: F.when(
        (F.size(done) > 0) & (F.element_at(done, -1)["end"] >= s["start"]),
        F.concat(F.slice(done, 1, F.size(done) - 1), F.array(F.struct(
            F.element_at(done, -1)["start"].alias("start"), F.greatest(F.element_at(done, -1)["end"], s["end"]).alias("end"),
        ))),
    ).otherwise(F.concat(done, F.array(s)))
    kind = whole.schema["spans"].dataType.simpleString()
    grouped = whole.groupBy("segment", "number").agg(
        F.first("doc_id").alias("doc_id"), F.first("n_words").alias("n_words"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"),
        F.array_sort(F.flatten(F.collect_list("spans"))).alias("all"),
    ).withColumn("spans", F.aggregate("all", F.array().cast(kind), step))
    total = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return grouped.select("doc_id", "n_words", total.alias("n_hit"), "items", "spans")


def contaminated(rows: DataFrame) -> DataFrame:
    """Mark matches of at least a twentieth of a document's words."""
    return rows.withColumn("contaminated", (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words")))
