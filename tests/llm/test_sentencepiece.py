"""op8 against the sentencepiece library."""

import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import sentencepiece

from predlake.llm import queries, sentencepiece_bpe as bpe

SF = "/root/testdata/sf0.001"
PATH = public_tokenizers.path("piece_bpe_32k.model")
ODD = ["", "a", " a", "  a  ", "\n", " ", "a\x00b", "▁x", "<s>hi</s>", "áé", "x\ty", "é😀z", "<0x0A>", "▁", "a ▁ b", "a" * 300, "日本語 テスト", "\r\n\r\n",
       "    def f(x):\n\treturn x", "é ﻿", "!?" * 40, "A1b2C3" * 30]


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PATH)


@pytest.fixture(scope="module")
def encoder():
    return bpe.Encoder(bpe.read_model(PATH))


def test_equals_the_library_on_odd_and_random_texts(encoder, library):
    rng = random.Random(0)
    texts = ODD + ["".join(rng.choice("ab cdeéß▁\n\t 日本a<>0x,.") for _ in range(rng.randint(1, 200))) for _ in range(300)]
    for t in texts:
        ids, decoded = encoder.encode(t)
        want = library.encode(t, add_bos=True, add_eos=True)
        assert np.frombuffer(ids, "<u4").tolist() == want, t
        assert decoded.decode() == library.decode(want), t


def test_one_very_long_word(encoder, library):
    word = "".join(random.Random(1).choice("aeinrst") for _ in range(60_000))
    assert np.frombuffer(encoder.encode(word)[0], "<u4").tolist() == library.encode(word, add_bos=True, add_eos=True)


def test_split_agrees_with_plain_merging(encoder):
    rng = random.Random(2)
    for _ in range(300):
        word = "▁" + "".join(rng.choice("thernaiosd") for _ in range(rng.randint(1, 14)))
        assert encoder.split(word) == encoder.merge(word)


def test_query_equals_the_library(spark, library):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    got = {r.doc_id: tuple(r)[1:] for r in queries.QUERIES["op8_sentencepiece"](spark, SF).collect()}
    assert got.keys() == docs.keys()
    for i, t in docs.items():
        ids = library.encode(t, add_bos=True, add_eos=True)
        sha = hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert got[i] == (len(ids), sha, hashlib.sha256(library.decode(ids).encode()).hexdigest())


def test_nulls_and_extra_columns(spark):
    rows = spark.createDataFrame([(1, None, "x"), (None, "a b", None), (1, None, "x")], "doc_id long, text string, ids string")
    got = sorted(((r.doc_id or 0), r.ids, r.decoded) for r in bpe.encode_texts(rows, PATH).collect())
    assert got == [(0, [1, 264, 287, 2], "a b"), (1, [1, 2], ""), (1, [1, 2], "")]
    assert bpe.encode_texts(rows.limit(0), PATH).count() == 0
