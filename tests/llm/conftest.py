import random

import pytest

WORDS = "able about above acid across act addition after again air all almost among animal answer any apple arm art".split()


def prose(seed, words):
    rng = random.Random(seed)
    return " ".join(rng.choice(WORDS) + rng.choice(["", "", "s", "ed", "Ω"]) for _ in range(words))


#: Null, empty, blank, short, repeated and very long texts; a repeated row; ids in no order.
EDGE_TEXTS = [
    (7, None), (2, ""), (3, " \n\t "), (4, "word"), (9, "word"), (5, prose(1, 30_000)), (6, prose(2, 90)), (6, prose(2, 90)),
    (8, prose(2, 60) + " Änderung " + prose(3, 40)), (1, "!" * 700), (10, "one TWO three\nfour 5"), (11, "äöü " * 120),
]
#: Columns that operators use themselves.
CLASHES = "fingerprint score n_words n_hit items spans ids shard slot block bytes rest text_hash node key segment passages file place"


@pytest.fixture(scope="session")
def edge_docs(spark):
    """The odd texts with a source and with columns that clash with the operators' own."""
    rows = [(i, t, "a" if i % 2 else None, *(["x"] * len(CLASHES.split()))) for i, t in EDGE_TEXTS]
    return spark.createDataFrame(rows, "doc_id long, text string, source string, " + ", ".join(f"{c} string" for c in CLASHES.split()))


@pytest.fixture(scope="session")
def no_docs(edge_docs):
    return edge_docs.where("false")
