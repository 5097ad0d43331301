"""Token files against the tokenizers library itself."""

import random
import zlib

import numpy as np
import pytest

from supplyloom.llm import catalog, tokens
from supplyloom.storage import scratch_path

BITS = ["a", "B", "é", "ß", " ", "  ", "\n", "\n\n", "'s", "'", '"', "'re", "!", "***", "123", "²", "Ⅷ", "一", "\t", "\xa0",
        "\x1c", "_", "<|endoftext|>", "don't", "x'll ", "ünï", ".", "…", "😀", "́", "İ", "-"]


@pytest.fixture(scope="module")
def encoder():
    return tokens.Encoder(catalog.tokenizer_file())


def test_pieces_encode_like_whole_texts(encoder):
    draw = random.Random(4)
    for _ in range(20_000):
        text = "".join(draw.choice(BITS) for _ in range(draw.randrange(14)))
        assert encoder.encode(text) == encoder.direct(text), repr(text)


def test_forgetting_changes_nothing(encoder, monkeypatch):
    monkeypatch.setattr(tokens, "REMEMBERED", 3)
    text = " ".join(f"word{i % 7}, other{i % 5}." for i in range(50))
    assert encoder.encode(text) == encoder.direct(text)


def test_round_trip(spark, encoder, sf, monkeypatch):
    monkeypatch.setattr(tokens, "BLOCK_BYTES", 2000)
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    folder = scratch_path(spark, "t")
    tokens.write_tokens(docs, folder, catalog.tokenizer_file)
    found = {r.doc_id: r for r in tokens.read_tokens(spark, folder).collect()}
    start = 0
    for row in docs.orderBy("doc_id").collect():
        ids = np.array(encoder.whole.encode(row.text, add_special_tokens=False).ids + [0], dtype="<u4")
        got = found.pop(row.doc_id)
        assert (got.start, got.n_tokens, got.ids_crc32, got.ids) == (start, len(ids), zlib.crc32(ids), ids.tolist())
        start += len(ids)
    assert not found
    index = tokens.index_of(spark, folder)
    assert index.count() == docs.count() and index.agg({"n_tokens": "sum"}).first()[0] == start
    some = {r.doc_id: r.ids_crc32 for r in tokens.read_tokens(spark, folder, wanted=[7, 150]).collect()}
    assert set(some) == {7, 150}


def test_dictionary_of_few_samples():
    assert tokens.train_dictionary([]) == b"" and tokens.train_dictionary([b"ab", b"c"]) == b"abc"
