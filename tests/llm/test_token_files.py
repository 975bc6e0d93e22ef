import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from clickloom.llm import token_files

from .conftest import EDGE_TEXTS, prose

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(PATH)


def test_words_as_whole_texts(tokenizer):
    texts = [t or "" for _, t in EDGE_TEXTS] + [
        "a\x1cb c d　e", "É É H̱ H ̱x", "ΑΣ ΑΣΑ İ K", "it's 'S don't9x 12 !?", "<|endoftext|>x <|startoftext|>", "a <|ENDOFTEXT|> b<|endoftext|>c", "<|endof text|>", " lead  and\ttrail ",
        "́x ́ y", "漢字 😀👍🏽", "a., b.. c ., d_, e5, f. g . , h²,. ¼. µ, 'S, it'S. ", "Ünder, ÀÉ. \xa0x\xa0, y\x85. z", "", " ", ", . ",
    ]
    encoder = token_files.WordEncoder(open(PATH, encoding="utf-8").read())
    got = [np.frombuffer(x, encoder.dtype).tolist() for x in encoder.encode(texts)]
    assert got == [tokenizer.encode(t, add_special_tokens=False).ids for t in texts]


@pytest.mark.parametrize("sequence,batch", [(2048, 128), (8, 3)])
def test_files_hold_all_ids_in_order(spark, edge_docs, tokenizer, sequence, batch):
    index = token_files.write(edge_docs, PATH, sequence=sequence, batch=batch)
    got = [(r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in token_files.checksums(token_files.starts(index)).orderBy("start").collect()]
    want, start = [], 0
    for i, t in sorted(EDGE_TEXTS, key=lambda r: r[0]):
        ids = tokenizer.encode(t or "", add_special_tokens=False).ids + [1]
        want.append((i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert got == want
    rows = token_files.read_sequences(spark, index).orderBy("file", "sequence").collect()
    assert all(len(r.tokens) == len(r["mask"]) == sequence for r in rows)
    assert sum(map(sum, (r["mask"] for r in rows))) == start


def test_sequences_are_views(edge_docs):
    index = token_files.write(edge_docs, PATH, sequence=16)
    file = token_files.SequenceFile(index.first().file)
    tokens, mask = file[len(file) - 1]
    assert len(tokens) == len(mask) == 16
    assert not tokens.flags.owndata and not tokens.flags.writeable


def test_no_rows(no_docs):
    assert token_files.checksums(token_files.starts(token_files.write(no_docs, PATH))).count() == 0
