import random

import numpy as np
import pytest

from clickloom.llm import quality

from .conftest import EDGE_TEXTS, prose


def rows():
    rng, found = random.Random(2), []
    for n in range(160):
        text = prose(n, rng.randrange(20, 200))
        if n % 4 == 0:
            junk = [" ".join(w + rng.choice(["###", "%%%"]) for w in text.split()), text.upper().replace(" ", "!! "),
                    " ".join(w + " " + w + " " + w for w in text.split())]
            text = rng.choice(junk)
        found.append((n, text, int(n % 4 != 0)))
    return found


@pytest.fixture(scope="module")
def model(spark):
    labelled = [r for r in rows() if r[0] % 3]
    docs = spark.createDataFrame([r[:2] for r in rows()], "doc_id long, text string")
    labels = spark.createDataFrame([(r[0], r[2]) for r in labelled] + [(999, 1), (1, None)], "doc_id long, quality int")
    return quality.fit(docs, labels)


def test_documents_that_were_not_learned(spark, model):
    docs = spark.createDataFrame([r[:2] for r in rows()], "doc_id long, text string")
    score = {r.doc_id: r.score for r in quality.score(docs, model).collect()}
    right = [(score[n] >= 0.5) == label for n, _, label in rows() if n % 3 == 0]
    assert sum(right) / len(right) > 0.9


def plain_score(w, passages):
    """Score of one document from the definition, and the attention its passages get."""
    encoded = [np.tanh((p - w["mean"]) / w["scale"] @ w["encode"] + w["encode_0"]) for p in passages]
    raised = [np.exp(sum(np.tanh(h @ w["view"][:, i]) / (1 + np.exp(-h @ w["gate"][:, i])) * w["attend"][i] for i in range(len(w["attend"]))))
              for h in encoded]
    attention = [r / sum(raised) for r in raised]
    whole = sum(a * h for a, h in zip(attention, encoded))
    return 1 / (1 + np.exp(-(whole @ w["weigh"] + w["weigh_0"][0]))), attention


def bags(seed, size=5):
    rng = np.random.default_rng(seed)
    count = rng.integers(1, 6, 12)
    return rng.normal(size=(count.sum(), size)), count, rng.integers(0, 2, 12), rng.uniform(0.5, 2, 12)


@pytest.mark.parametrize("seed", range(3))
def test_scores_and_attention_equal_plain_form(seed):
    x, count, label, weight = bags(seed)
    weights = quality.learn(x, count, label, weight)
    scores, (*_, attention, _, _, _) = quality.Model(0.5, weights).bags(x, count)
    ends = np.cumsum(count)
    for n, (low, high) in enumerate(zip(ends - count, ends)):
        score, shares = plain_score(weights, x[low:high])
        assert scores[n] == pytest.approx(score, abs=1e-6)
        assert attention[low:high] == pytest.approx(shares, abs=1e-6)
    assert ((scores >= 0.5) == label).mean() > 0.9


@pytest.mark.parametrize("seed", range(3))
def test_slopes_match_differences(monkeypatch, seed):
    """The first step moves every weight against the slope of the loss, taken here from differences of the plain form."""
    x, count, label, weight = bags(seed)
    ends = np.cumsum(count)
    monkeypatch.setattr(quality, "EPOCHS", 0)
    start = {k: v.astype(float) for k, v in quality.learn(x, count, label, weight).items()}
    monkeypatch.setattr(quality, "EPOCHS", 1)
    moved = quality.learn(x, count, label, weight)

    def loss(w):
        scores = np.array([plain_score(w, x[low:high])[0] for low, high in zip(ends - count, ends)])
        decay = sum((w[k] ** 2).sum() for k in w if k not in ("mean", "scale")) * 1e-4 / 2
        return -(weight * np.log(np.where(label == 1, scores, 1 - scores))).sum() / weight.sum() + decay

    checked = 0
    for name in ("encode", "encode_0", "view", "gate", "attend", "weigh", "weigh_0"):
        for at in np.ndindex(start[name].shape):
            up, down = ({**start, name: start[name].copy()} for _ in range(2))
            up[name][at] += 1e-5
            down[name][at] -= 1e-5
            slope = (loss(up) - loss(down)) / 2e-5
            if abs(slope) > 1e-5:  # others are within the error of the differences
                assert moved[name][at] - start[name][at] == pytest.approx(-quality.STEP * np.sign(slope), abs=1e-4), (name, at)
                checked += 1
    assert checked > 0.9 * sum(start[k].size for k in start if k not in ("mean", "scale"))


def test_odd_rows(edge_docs, model):
    scores = quality.score(edge_docs, model).collect()
    assert sorted(r.doc_id for r in scores) == sorted(i for i, _ in EDGE_TEXTS)
    assert all(0 <= r.score <= 1 for r in scores)
    kept = quality.keep(edge_docs, model)
    assert kept.schema == edge_docs.schema
    assert sorted(r.doc_id for r in kept.collect()) == sorted(r.doc_id for r in scores if r.score >= 0.5)


def test_passages_do_not_see_their_neighbours():
    texts = [b"", b"abc " * 300, b"Zed!" * 200]
    data = np.frombuffer(b"".join(texts), np.uint8)
    whole, count = quality.passages(data, np.cumsum([0, *map(len, texts)]))
    alone = [quality.passages(np.frombuffer(t, np.uint8), np.array([0, len(t)]))[0] for t in texts]
    assert count.tolist() == [1, 3, 2]
    assert np.allclose(whole, np.concatenate(alone))


@pytest.mark.parametrize("labels,score", [([], 0.5), ([(1, 1)], 1.0), ([(1, 0)], 0.0), ([(555, 1), (556, 0)], 0.5)])
def test_too_few_labels(spark, edge_docs, labels, score):
    frame = spark.createDataFrame(labels, "doc_id long, quality int")
    model = quality.fit(edge_docs, frame)
    assert {r.score for r in quality.score(edge_docs, model).collect()} == {score}


def test_no_rows(no_docs, model):
    assert quality.score(no_docs, model).count() == 0
    assert quality.keep(no_docs, model).count() == 0
