"""Token ids in Arrow files of equal-length sequences, written in document order and read without copying.

A file holds batches of two columns, ``tokens`` and ``mask``, both fixed-size lists: the ids of its documents, one after
the other, cut into sequences; the last one is filled up and its mask is 0 there. Memory-mapped, any sequence is
an array view. A table lists the documents of each file with place and length.
"""

import re
import uuid
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.fs
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from clickloom.llm import blocks, workspace
from clickloom.sources import storage

#: Ids of a sequence.
SEQUENCE = 2048
#: Sequences of a batch.
BATCH = 128
#: Id that ends a document.
END = 1
#: Words whose ids a worker remembers before it starts over.
REMEMBERED = 800_000
#: Bytes of text that are encoded together.
TOGETHER = 4 << 20

#: Words of visible Latin-1 characters, which normalisation keeps and lower case maps one to one.
_LATIN = re.compile("[!-~¡-ÿ]+").fullmatch
#: A comma or full stop right after another mark.
_RUN_ON = re.compile(r"(?:[^\w\s]|_)[.,] ").search
#: The pieces that the tokenizer's pattern finds.
_PIECES = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+").findall


class WordEncoder:
    """Ids of texts by a tokenizer that drops white space and never joins what white space divides.

    The ids of words are remembered. Texts of Latin-1 characters are put in lower case first, as the tokenizer does, and a
    comma or full stop after a letter or digit becomes a word of its own, as in the tokenizer's pattern, so that
    there are fewer different words. Many new words of letters go through the library together: each ends with a token
    that marks an end, which tells their ids apart. Words of letters and other characters are cut into the pieces of
    the pattern. All others go through the library one by one. A text that may hold an added token, such as the one
    for the end of a text, goes through the library whole.
    """

    def __init__(self, rules: str):
        self.tokenizer = Tokenizer.from_str(rules)
        added = [token.content for token in self.tokenizer.get_added_tokens_decoder().values()]
        self.may_hold_added = re.compile("|".join(map(re.escape, added)) or "(?!)", re.IGNORECASE).search
        vocabulary = self.tokenizer.get_vocab()
        self.dtype = np.dtype("<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4")
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True
        self.known: dict[str, bytes] = {}

    def encode(self, texts: list[str]) -> list[bytes]:
        whole = {i: t for i, t in enumerate(texts) if self.may_hold_added(t)}
        if whole:
            plain = iter(self._words([t for i, t in enumerate(texts) if i not in whole]))
            return [self._ids(whole[i]) if i in whole else next(plain) for i in range(len(texts))]
        return self._words(texts)

    def _ids(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, self.dtype).tobytes()

    def _words(self, texts: list[str]) -> list[bytes]:
        """Ids of texts without added tokens, word by word."""
        if len(self.known) > REMEMBERED:
            self.known.clear()
        # Other white space stays inside words, where the library drops it.
        cut = [_prepared(t).split(" ") for t in texts]
        fresh = set().union(*cut).difference(self.known)
        mixed = {w: _PIECES(w.lower()) for w in fresh if not w.isalpha() and _LATIN(w)}
        pieces = fresh.difference(mixed).union(*mixed.values()).difference(self.known)
        self._resolve(pieces)
        ids = self.known.__getitem__
        self.known.update([(w, b"".join(map(ids, found))) for w, found in mixed.items()])
        return [b"".join(map(ids, words)) for words in cut]

    def _resolve(self, pieces: set[str]) -> None:
        """Remember the ids of these words and pieces."""
        letters = [p for p in pieces if p.isalpha() and _LATIN(p)]
        self._library(list(pieces.difference(letters)))
        for low in range(0, len(letters), 2000):
            part = letters[low:low + 2000]
            ids = np.array(self.tokenizer.encode_batch_fast([" ".join(part)], add_special_tokens=False)[0].ids, self.dtype)
            stops = np.flatnonzero(self.ends[ids]) + 1
            if len(stops) != len(part):
                self._library(part)
                continue
            data, stops = ids.tobytes(), (stops * self.dtype.itemsize).tolist()
            self.known.update(zip(part, [data[a:b] for a, b in zip([0, *stops], stops)]))

    def _library(self, words: list[str]) -> None:
        for low in range(0, len(words), 10_000):
            part = words[low:low + 10_000]
            for word, found in zip(part, self.tokenizer.encode_batch_fast(part, add_special_tokens=False)):
                self.known[word] = np.array(found.ids, self.dtype).tobytes()


def _prepared(text: str) -> str:
    """The text with spaces where words end, as far as that changes nothing."""
    text = text.replace("\n", " ")
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return text
    text = text.lower()
    if _RUN_ON(text):  # the mark belongs to a run of marks
        return text
    return text.replace(", ", " , ").replace(". ", " . ")


_encoders: dict[str, WordEncoder] = {}


def encoder(rules: str) -> WordEncoder:
    """The worker's encoder of these rules."""
    if rules not in _encoders:
        _encoders.clear()
        _encoders[rules] = WordEncoder(rules)
    return _encoders[rules]


def _located(path: str) -> tuple[pa.fs.FileSystem, str]:
    """File system and path of a local path or a URI (file:, hdfs:, s3: and others that Arrow knows)."""
    if path.startswith("file:"):
        return pa.fs.LocalFileSystem(), "/" + path[len("file:"):].lstrip("/")
    return pa.fs.FileSystem.from_uri(path)


class SequenceWriter:
    """Writes ids into sequences of equal length."""

    def __init__(self, path: str, dtype: np.dtype, sequence: int, batch: int):
        self.dtype, self.sequence, self.batch = dtype, sequence, batch
        kind = pa.from_numpy_dtype(dtype)
        self.schema = pa.schema({"tokens": pa.list_(kind, sequence), "mask": pa.list_(pa.bool_(), sequence)})
        fs, local = _located(path)
        fs.create_dir(local.rpartition("/")[0], recursive=True)
        self.sink = fs.open_output_stream(local)
        self.file = pa.ipc.new_file(self.sink, self.schema)
        self.waiting, self.size, self.written = [], 0, 0

    def add(self, ids: bytes) -> int:
        """Append the ids of a document; its place among the ids of the file."""
        place = self.written * self.sequence + self.size // self.dtype.itemsize
        self.waiting.append(ids)
        self.size += len(ids)
        full = self.sequence * self.batch * self.dtype.itemsize
        if self.size >= full:
            data = b"".join(self.waiting)
            used = len(data) // full * full
            for low in range(0, used, full):
                self._put(np.frombuffer(data, self.dtype, full // self.dtype.itemsize, low))
            self.waiting, self.size = [data[used:]], len(data) - used
        return place

    def _put(self, ids: np.ndarray) -> None:
        rows = -(-len(ids) // self.sequence)
        filled = np.zeros(rows * self.sequence, self.dtype)
        filled[:len(ids)] = ids
        mask = np.arange(rows * self.sequence) < len(ids)
        self.file.write_batch(pa.record_batch(
            [pa.FixedSizeListArray.from_arrays(pa.array(c), self.sequence) for c in (filled, mask)], schema=self.schema,
        ))
        self.written += rows

    def close(self) -> None:
        rest = np.frombuffer(b"".join(self.waiting), self.dtype)
        if len(rest):
            self._put(rest)
        self.file.close()
        self.sink.close()


class SequenceFile:
    """Sequences of a file by number, as views of its mapped memory where the file is local."""

    def __init__(self, path: str):
        fs, local = _located(path)
        self.source = pa.memory_map(local) if isinstance(fs, pa.fs.LocalFileSystem) else fs.open_input_file(local)
        self.reader = pa.ipc.open_file(self.source)
        self.sequence = self.reader.schema.field("tokens").type.list_size
        self.batches: dict[int, pa.RecordBatch] = {}
        self.per_batch = len(self._batch(0)) if self.reader.num_record_batches else 1

    def _batch(self, number: int) -> pa.RecordBatch:
        if number not in self.batches:
            self.batches = {number: self.reader.get_batch(number)}
        return self.batches[number]

    def __len__(self) -> int:
        last = self.reader.num_record_batches - 1
        return 0 if last < 0 else last * self.per_batch + len(self._batch(last))

    def __getitem__(self, number: int) -> tuple[np.ndarray, pa.BooleanArray]:
        """Ids and mask of a sequence; the mask has one bit for each id."""
        batch, row = self._batch(number // self.per_batch), number % self.per_batch
        low = row * self.sequence
        tokens = batch.column("tokens").values.to_numpy()[low:low + self.sequence]
        return tokens, batch.column("mask").values.slice(low, self.sequence)

    def ids(self, start: int, count: int):
        """Views of the ids from a place on, batch by batch."""
        width = self.per_batch * self.sequence
        while count > 0:
            number, low = divmod(start, width)
            part = self._batch(number).column("tokens").values.to_numpy()[low:low + count]
            yield part
            start, count = start + len(part), count - len(part)


def write(docs: DataFrame, rules_path: str, doc_id: str = "doc_id", text: str = "text", end: int = END,
          sequence: int = SEQUENCE, batch: int = BATCH) -> DataFrame:
    """Encode and write all rows in ascending order of their ids; (file, doc_id, place, n_tokens) per row.

    ``place`` counts ids from the begin of the file, ``n_tokens`` includes the end id. Files lie in the shared folder and
    their names ascend with the ids in them. Null texts are empty and get the end id alone; rows with equal ids follow
    each other by the hash of their text. A task that is run again writes a new file, and only files of
    successful tasks are listed. Other columns are ignored.
    """
    with open(rules_path, encoding="utf-8") as lines:  # of fixed size
        rules = lines.read()
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(rules)
    folder = storage.scratch_dir(spark, "token_files")

    def run(batches):
        own, writer = encoder(shared.value), None
        last = np.array([end], own.dtype).tobytes()
        for rows in batches:
            texts = rows.column("text")
            _, offsets = blocks.text_bytes(texts)
            for low, high in blocks.blocks(offsets, TOGETHER):
                if writer is None:
                    path = f"{folder}/tokens-{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex}.arrow"
                    writer = SequenceWriter(path, own.dtype, sequence, batch)
                ids = [i + last for i in own.encode([t or "" for t in texts.slice(low, high - low).to_pylist()])]
                places = [writer.add(i) for i in ids]
                yield pa.record_batch([
                    pa.array([path] * len(ids)), rows.column("doc_id").slice(low, high - low), pa.array(places, pa.int64()),
                    pa.array([len(i) // own.dtype.itemsize for i in ids], pa.int64()),
                ], ["file", "doc_id", "place", "n_tokens"])
        if writer is not None:
            writer.close()

    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    ordered = rows.repartitionByRange("doc_id").sortWithinPartitions("doc_id", F.xxhash64("text"))
    return workspace.stage(
        ordered.mapInArrow(run, f"file string, doc_id {kind}, place long, n_tokens long"), "token_index",
    )


def starts(index: DataFrame) -> DataFrame:
    """The index with ``start``, the ids of all documents before each."""
    files = index.groupBy("file").agg(F.sum("n_tokens").alias("here"))
    before = Window.orderBy("name").rowsBetween(Window.unboundedPreceding, -1)
    name = F.substring_index("file", "/", -1).alias("name")
    first = files.select("file", "here", name).select("file", F.coalesce(F.sum("here").over(before), F.lit(0)).alias("before"))
    return index.join(first, "file").withColumn("start", F.col("before") + F.col("place")).drop("before")


def checksums(index: DataFrame) -> DataFrame:
    """The index with ``ids_crc32`` of each document's ids as 32-bit integers, read from the files."""
    def run(batches):
        path, file = None, None
        for rows in batches:
            sums = []
            for name, place, count in zip(*(rows.column(c).to_pylist() for c in ("file", "place", "n_tokens"))):
                if name != path:
                    path, file = name, SequenceFile(name)
                total = 0
                for part in file.ids(place, count):
                    total = zlib.crc32(part.astype("<u4"), total)
                sums.append(total)
            yield pa.RecordBatch.from_arrays([*rows.columns, pa.array(sums, pa.int64())], [*rows.schema.names, "ids_crc32"])

    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in index.schema.fields)
    return index.mapInArrow(run, f"{kinds}, ids_crc32 long")


def read_sequences(spark: SparkSession, index: DataFrame) -> DataFrame:
    """(file, sequence, tokens array<int>, mask array<int>) of all files of an index."""
    def run(batches):
        for rows in batches:
            for path in rows.column("file").to_pylist():
                file = SequenceFile(path)
                for number in range(len(file)):
                    tokens, mask = file[number]
                    one = np.array([file.sequence])
                    yield pa.record_batch([
                        pa.array([path]), pa.array([number]), blocks.lists(pa.array(tokens.astype(np.int32)), one),
                        blocks.lists(mask.cast(pa.int32()), one),
                    ], ["file", "sequence", "tokens", "mask"])

    return index.select("file").distinct().mapInArrow(run, "file string, sequence long, tokens array<int>, mask array<int>")
