"""Document quality by attention-based multiple-instance learning.

A document is a bag of passages; only the document has a label. Each passage is described by the shares of its byte
classes and of pairs of classes and by how its words repeat, and is encoded by a learned layer. Gated attention
weights the encoded passages; the weighted sum is classified. The few thousand weights are learned from a bounded
sample of labelled documents; every passage of every document is encoded and scored.
"""

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickloom.llm import blocks, decontamination

#: Bytes of a passage.
PASSAGE_BYTES = 512
#: Labelled documents of each class that the model is fitted on at most.
SAMPLE_PER_CLASS = 3000
#: Sizes of the encoded passage and of the attention layer.
ENCODED, ATTENTION = 16, 8
EPOCHS, STEP, BAG = 40, 0.01, 128

_GROUPS = ["abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789", " ", "\n\r", "\t", ".", ",", "!", "?",
           "'\"`", "#$%&*@^~+=", "|<>{}[]\\/_", ":;-()"]
#: The last two classes are non-ASCII and all other bytes.
CLASSES = len(_GROUPS) + 2
_CLASS = np.full(256, CLASSES - 1, np.int64)
_CLASS[128:] = CLASSES - 2
for _number, _letters in enumerate(_GROUPS):
    _CLASS[list(_letters.encode())] = _number
#: Shares of classes, of pairs of classes, and four of words: how many, their length, repeats, different ones.
FEATURES = CLASSES + CLASSES * CLASSES + 4


def passages(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Features of the passages of texts that lie side by side, and the number of passages of each text.

    An empty text has one passage of zeros.
    """
    lengths = np.diff(offsets)
    count = np.maximum(-(-lengths // PASSAGE_BYTES), 1)
    first = np.cumsum(count) - count
    total = int(count.sum())
    where = np.arange(len(data)) - np.repeat(offsets[:-1] - offsets[0], lengths)
    passage = np.repeat(first, lengths) + where // PASSAGE_BYTES
    size = np.maximum(np.bincount(passage, minlength=total), 1)[:, None]
    kind = _CLASS[data]
    found = np.zeros((total, FEATURES), np.float32)
    found[:, :CLASSES] = np.bincount(passage * CLASSES + kind, minlength=total * CLASSES).reshape(total, -1) / size
    inside = passage[1:] == passage[:-1]
    pair = (passage[1:] * CLASSES + kind[:-1]) * CLASSES + kind[1:]
    found[:, CLASSES:-4] = np.bincount(pair[inside], minlength=total * CLASSES ** 2).reshape(total, -1) / size
    words, _, starts = decontamination.terms(data, offsets - offsets[0], places=True)
    at = passage[starts]
    n = np.maximum(np.bincount(at, minlength=total), 1)
    again = (words[1:] == words[:-1]) & (at[1:] == at[:-1])
    order = np.lexsort((words, at))
    new = np.ones(len(words), bool)
    new[1:] = (words[order][1:] != words[order][:-1]) | (at[order][1:] != at[order][:-1])
    found[:, -4] = n / size[:, 0]
    found[:, -3] = np.minimum(size[:, 0] / n / 16, 4)
    found[:, -2] = np.bincount(at[1:][again], minlength=total) / n
    found[:, -1] = np.bincount(at[order][new], minlength=total) / n
    return found, count


@dataclass
class Model:
    """Weights of the encoder, the attention and the classifier; a model without them gives the prior."""

    prior: float
    weights: dict[str, np.ndarray] | None = None

    def bags(self, x: np.ndarray, count: np.ndarray):
        """Scores of documents, with what learning needs."""
        w = self.weights
        x = (x - w["mean"]) / w["scale"]
        h = np.tanh(x @ w["encode"] + w["encode_0"])
        t, g = np.tanh(h @ w["view"]), 1 / (1 + np.exp(-(h @ w["gate"])))
        e = (t * g) @ w["attend"]
        first = np.cumsum(count) - count
        bag = np.repeat(np.arange(len(count)), count)
        a = np.exp(e - np.maximum.reduceat(e, first)[bag])
        a /= np.add.reduceat(a, first)[bag]
        z = np.add.reduceat(a[:, None] * h, first, axis=0)
        score = 1 / (1 + np.exp(-np.clip(z @ w["weigh"] + w["weigh_0"], -30, 30)))
        return score, (x, h, t, g, a, z, first, bag)

    def scores(self, x: np.ndarray, count: np.ndarray) -> np.ndarray:
        if self.weights is None:
            return np.full(len(count), self.prior)
        return self.bags(x, count)[0].astype(np.float64)


def learn(x: np.ndarray, count: np.ndarray, label: np.ndarray, weight: np.ndarray, seed: int = 0) -> dict[str, np.ndarray]:
    """Weights that fit the labels of bags of passages, by Adam on the weighted logarithmic loss."""
    rng = np.random.default_rng(seed)
    scaled = lambda *shape: rng.normal(size=shape) / np.sqrt(shape[0])
    w = {
        "encode": scaled(x.shape[1], ENCODED), "encode_0": np.zeros(ENCODED), "view": scaled(ENCODED, ATTENTION),
        "gate": scaled(ENCODED, ATTENTION), "attend": scaled(ATTENTION), "weigh": scaled(ENCODED), "weigh_0": np.zeros(1),
    }
    fixed = {"mean": x.mean(0), "scale": x.std(0) + 1e-3}
    model = Model(0.5, w | fixed)
    moments = {k: [np.zeros_like(v), np.zeros_like(v)] for k, v in w.items()}
    first, step = np.cumsum(count) - count, 0
    for _ in range(EPOCHS):
        mixed = rng.permutation(len(count))
        for low in range(0, len(mixed), BAG):
            some = mixed[low:low + BAG]
            rows = blocks.ranges(first[some], count[some])
            score, (v, h, t, g, a, z, begin, bag) = model.bags(x[rows], count[some])
            d = (score - label[some]) * weight[some] / weight[some].sum()
            # Back through the classifier, the attention with its softmax, the gate and the encoder.
            dz = d[:, None] * w["weigh"]
            da = (dz[bag] * h).sum(1)
            de = a * (da - np.add.reduceat(a * da, begin)[bag])
            dt, dg = de[:, None] * w["attend"] * g * (1 - t * t), de[:, None] * w["attend"] * t * g * (1 - g)
            dh = (a[:, None] * dz[bag] + dt @ w["view"].T + dg @ w["gate"].T) * (1 - h * h)
            slopes = {
                "weigh": z.T @ d, "weigh_0": d.sum(keepdims=True), "attend": (t * g).T @ de, "view": h.T @ dt, "gate": h.T @ dg,
                "encode": v.T @ dh, "encode_0": dh.sum(0),
            }
            step += 1
            for k, slope in slopes.items():
                slope = slope + 1e-4 * w[k]
                m = moments[k]
                m[0] = 0.9 * m[0] + 0.1 * slope
                m[1] = 0.999 * m[1] + 0.001 * slope * slope
                w[k] -= STEP * (m[0] / (1 - 0.9 ** step)) / (np.sqrt(m[1] / (1 - 0.999 ** step)) + 1e-8)
            model.weights = w | fixed
    return {k: v.astype(np.float32) for k, v in model.weights.items()}


def fit(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "quality",
        sample_per_class: int = SAMPLE_PER_CLASS) -> Model:
    """Model of labelled documents (label 0 or 1; null labels and labels without a document are ignored).

    The sample takes up to ``sample_per_class`` documents of each class, least hash of the id first; classes are
    weighted by their shares among all labels. Without both classes the model gives the share of label 1, or 0.5.
    """
    known = labels.select(F.col(doc_id).alias("doc_id"), F.col(label).cast("int").alias("label")).where(
        "label in (0, 1) and doc_id is not null",
    ).dropDuplicates(["doc_id"])
    classes = {r["label"]: r["count"] for r in known.groupBy("label").count().collect()}
    if not classes:
        return Model(0.5)
    if len(classes) < 2:
        return Model(float(next(iter(classes))))
    parts = [known.where(F.col("label") == c).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample_per_class) for c in (0, 1)]
    sample = F.broadcast(parts[0].unionByName(parts[1]))  # twice sample_per_class rows at most
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).join(sample, "doc_id")

    def describe(batches):
        for batch in batches:
            data, offsets = blocks.text_bytes(batch.column("text"))
            for low, high in blocks.blocks(offsets):
                found, count = passages(data[offsets[low]:offsets[high]], offsets[low:high + 1])
                ends = np.concatenate([[0], np.cumsum(count)])
                yield pa.record_batch([
                    batch.column("doc_id").slice(low, high - low), batch.column("label").slice(low, high - low),
                    pa.array([found[a:b].tobytes() for a, b in zip(ends, ends[1:])], pa.binary()),
                ], ["doc_id", "label", "passages"])

    kind = rows.schema["doc_id"].dataType.simpleString()
    taken = rows.select("doc_id", "label", "text").mapInArrow(describe, f"doc_id {kind}, label int, passages binary")
    bags = sorted(taken.collect(), key=lambda r: (str(r.doc_id), r.label, r.passages))
    if len({r.label for r in bags}) < 2:
        return Model(classes[1] / sum(classes.values()))
    arrays = [np.frombuffer(r.passages, np.float32).reshape(-1, FEATURES) for r in bags]
    label_of = np.array([r.label for r in bags])
    share = np.array([classes[c] / max((label_of == c).sum(), 1) for c in (0, 1)])
    weights = learn(np.concatenate(arrays), np.array([len(a) for a in arrays]), label_of, share[label_of])
    return Model(classes[1] / sum(classes.values()), weights)


def score(docs: DataFrame, model: Model, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, score) per row: how likely label 1 is. Null texts are empty; other columns are ignored."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        own = shared.value
        for batch in batches:
            data, offsets = blocks.text_bytes(batch.column("text"))
            for low, high in blocks.blocks(offsets):
                found, count = passages(data[offsets[low]:offsets[high]], offsets[low:high + 1])
                yield pa.record_batch([batch.column("doc_id").slice(low, high - low), pa.array(own.scores(found, count))], ["doc_id", "score"])

    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    return rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, score double")


def keep(docs: DataFrame, model: Model, text: str = "text", threshold: float = 0.5) -> DataFrame:
    """Rows of ``docs``, with all their columns, whose text scores ``threshold`` or more."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        own = shared.value
        for batch in batches:
            data, offsets = blocks.text_bytes(batch.column(text))
            for low, high in blocks.blocks(offsets):
                found, count = passages(data[offsets[low]:offsets[high]], offsets[low:high + 1])
                yield batch.slice(low, high - low).filter(pa.array(own.scores(found, count) >= threshold))

    return docs.mapInArrow(run, docs.schema)


def held_out(doc_id: str = "doc_id"):
    """Rows kept from learning."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % 3 == 1
