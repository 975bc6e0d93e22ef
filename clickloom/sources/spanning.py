"""Objects that span lines of a log: pretty-printed records, arrays of records, several records on a line.

Where an object ends follows from the depth of its braces, which is a running sum over the file. Files are read in
blocks, as ever, and a task goes through the lines of its blocks in order and packs them into segments with the depth so far;
each block sums up its own depth, and the blocks of a file pass on what is open at their end. Objects are then cut out of each
segment for itself. Only what crosses the edge of a segment is shuffled, and no task needs to see more than a segment
at a time. A line that starts with a brace in its first column starts anew, so an object that is never closed costs no more
than what stands before the next such line.
"""

import re
from collections.abc import Iterator
from itertools import chain, groupby
from operator import itemgetter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from clickloom.sources import storage

#: Pieces of lines that one object may have; a longer one is cut there, and its parts are corrupt.
MAX_PIECES = 10_000
#: A segment ends with the line that brings it to so many pieces or characters.
SEGMENT_PIECES, SEGMENT_CHARS = 10_000, 1 << 20

_STRING = r'"(?:[^"\\]++|\\.)*+"'
# What opens and then what closes: in such a piece no object ends before another begins. Braces in strings don't count.
_PIECES = re.compile(rf'(?s)(?:[^}}"]++|{_STRING}|")*+(?:[^{{"]++|{_STRING}|")*+')
_STRINGS = re.compile(_STRING.replace(r"\\.", r"\\[^\n\r\u0085\u2028\u2029]"))
_LOOSE = re.compile(r"(?a)[\s,]*[\[\],][\s\[\],]*[\u0085\u2028\u2029]?\Z")
_IN_FILE = ["file", "block"]

_SEGMENT = "file string, block long, at long, depth long, known boolean, end_at long, end_depth long, end_known boolean, text string"
_CUT = "file string, at long, start long, pieces array<string>, line string"
_CUT_TYPES = {"file": pa.string(), "at": pa.int64(), "start": pa.int64(), "pieces": pa.list_(pa.string()), "line": pa.string()}


def _pieces(line: str) -> list[str]:
    if "{" not in line or "}" not in line:
        return [line]
    return [piece for piece in _PIECES.findall(line) if piece]


def _adds(piece: str) -> int:
    """What a piece adds to the depth."""
    if "{" not in piece and "}" not in piece:
        return 0
    bare = _STRINGS.sub("", piece)
    return bare.count("{") - bare.count("}")


def _runs(batches) -> Iterator[tuple[tuple[str, int], list[str]]]:
    """File and block with lines of it that follow each other."""
    for batch in batches:
        if not len(batch):
            continue
        lines, *place = (batch.column(c) for c in ("value", *_IN_FILE))
        changes = [pc.not_equal(c[1:], c[:-1]).to_numpy(zero_copy_only=False) for c in place]
        ends = [0, *(np.flatnonzero(changes[0] | changes[1]) + 1).tolist(), len(batch)]
        for low, high in zip(ends, ends[1:]):
            text = b"\n".join(lines[low:high].to_pylist()).decode("utf-8", "replace")
            yield tuple(c[low].as_py() for c in place), text.split("\n")


def _segments(batches) -> Iterator[pa.RecordBatch]:
    """Lines of a block in segments, with pieces and depth before and after: from zero or, until a line starts anew, from the block's."""
    def packed(place, before, after, taken):
        row = [*place, *before, *after, "\n".join(taken)]
        return pa.record_batch([pa.array([value]) for value in row], [c.split()[0] for c in _SEGMENT.split(", ")])

    for place, runs in groupby(_runs(batches), itemgetter(0)):
        at, depth, known = before = 0, 0, False
        taken, chars = [], 0
        for line in chain.from_iterable(lines for _, lines in runs):
            if line.startswith("{"):
                depth, known = 0, True
            pieces = _pieces(line)
            at += len(pieces)
            depth += sum(map(_adds, pieces))
            taken.append(line)
            chars += len(line)
            if at - before[0] >= SEGMENT_PIECES or chars >= SEGMENT_CHARS:
                yield packed(place, before, (at, depth, known), taken)
                before, taken, chars = (at, depth, known), [], 0
        if taken:
            yield packed(place, before, (at, depth, known), taken)


def _objects(text: str, at: int, depth: int) -> Iterator[tuple[int, int | None, list[str], bool]]:
    """Place of the first piece, place where the object starts if it does here, pieces, and whether that is all of it."""
    first, start, run = at + 1, None, []
    for line in text.split("\n"):
        if line.startswith("{"):
            depth = 0
        for piece in _pieces(line):
            at += 1
            if depth <= 0:
                if run:
                    yield first, start, run, start is not None
                first, start, run = at, at, []
            run.append(piece)
            depth += _adds(piece)
    yield first, start, run, start is not None and depth <= 0


def _rows(batches) -> Iterator[tuple]:
    for batch in batches:
        # One text at a time, as a batch may hold many.
        for row in range(len(batch)):
            yield tuple(batch.column(c)[row].as_py() for c in ("file", "text", "at", "depth"))


def _cut(max_pieces: int):
    """Whole objects as lines, and pieces of those that begin or end outside of the segment."""
    def cut(batches):
        for file, *segment in _rows(batches):
            rows = []
            for first, start, run, whole in _objects(*segment):
                if not whole:
                    rows.append((file, first, start, run, None))
                elif len(run) > 1 or not _LOOSE.match(run[0]):
                    parts = [run[low:low + max_pieces] for low in range(0, len(run), max_pieces)]
                    rows += [(None, None, None, None, "\n".join(part)) for part in parts]
            columns = zip(*rows) if rows else [[]] * len(_CUT_TYPES)
            yield pa.record_batch([pa.array(c, t) for c, t in zip(columns, _CUT_TYPES.values())], list(_CUT_TYPES))

    return cut


def _placed(segments: DataFrame) -> DataFrame:
    """Segments with the number of pieces before them in the file and the depth at their start."""
    # Without a new start in the block, what was open before it stays open beneath.
    blocks = segments.groupBy(*_IN_FILE).agg(
        F.max("end_at").alias("pieces"), F.max_by("end_depth", "end_at").alias("rest"), F.max("end_known").alias("starts"),
    )
    in_file = Window.partitionBy("file").orderBy("block")
    run = F.sum(F.col("starts").cast("int")).over(in_file)
    open_after = F.sum("rest").over(Window.partitionBy("file", "run").orderBy("block"))
    passed = blocks.withColumn("run", run).withColumn("after", open_after).select(
        *_IN_FILE, F.coalesce(F.lag("after").over(in_file), F.lit(0)).alias("open"),
        (F.sum("pieces").over(in_file) - F.col("pieces")).alias("offset"),
    )
    depth = F.when(F.col("known"), F.col("depth")).otherwise(F.col("open") + F.col("depth"))
    # A row per block, so that no text moves.
    return segments.join(F.broadcast(passed), _IN_FILE).select(
        "file", "text", (F.col("offset") + F.col("at")).alias("at"), depth.alias("depth"),
    )


def _joined(edges: DataFrame, max_pieces: int) -> DataFrame:
    """Objects whose parts lie in several segments, or that are still open at the end of one."""
    in_file = Window.partitionBy("file").orderBy("at")
    starts = edges.select("file", "at", F.coalesce(F.last("start", ignorenulls=True).over(in_file), F.lit(0)).alias("start"))
    pieces = edges.drop("start").join(starts, ["file", "at"]).select(
        "file", "start", F.col("at").alias("first"), F.posexplode("pieces").alias("n", "piece"),
    ).withColumn("at", F.col("first") + F.col("n"))
    part = F.expr(f"(at - start) div {max_pieces}")
    texts = F.transform(F.array_sort(F.collect_list(F.struct("at", "piece"))), lambda p: p["piece"])
    return pieces.groupBy("file", "start", part.alias("part")).agg(F.array_join(texts, "\n").alias("line")).select("line")


def read_lines(spark: SparkSession, path: str | list[str], max_pieces: int = MAX_PIECES) -> DataFrame:
    """Column ``line`` with the whole text of each object; text between objects is a line of its own.

    Brackets and commas between objects are left out. A file is its own: nothing that is open at its end goes on in
    another. Within a string of a line braces don't count; strings don't span lines in JSON.
    """
    lines = spark.read.options(recursiveFileLookup=True).text(path).select(
        F.col("value").cast("binary").alias("value"), F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
    )
    # Stored, since how a file is cut into blocks may change from one reading to the next.
    placed = _placed(storage.stage(lines.mapInArrow(_segments, _SEGMENT), "segments"))
    cut = storage.stage(placed.mapInArrow(_cut(max_pieces), _CUT), "cut")
    whole, edges = cut.where("line IS NOT NULL").select("line"), cut.where("line IS NULL").drop("line")
    return whole.unionByName(_joined(edges, max_pieces)).select(F.regexp_replace("line", r"^[\s,\[]+(?=\{)", "").alias("line"))
