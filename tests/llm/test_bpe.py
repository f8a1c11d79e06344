import hashlib
import random

import numpy as np
import public_tokenizers as P
import pytest
import tiktoken
from hypothesis import given, settings, strategies as st

from acreage.llm import bpe

PATH = P.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def tools():
    ranks = bpe.load_ranks(PATH)
    return bpe.tokenizer(PATH, P.PATTERN)[0], bpe.tokenizer(PATH, P.PATTERN)[1], tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


def ids(packed, text):
    return np.frombuffer(packed.text(text), "<u4").tolist()


@settings(max_examples=500, deadline=None)
@given(st.one_of(st.text(max_size=50), st.text(alphabet=" \n\t\x1c a1.'s漢é½٣", max_size=40)))
def test_ids_equal_the_library(text):
    packed, vocabulary, own = bpe.tokenizer(PATH, P.PATTERN)[0], bpe.tokenizer(PATH, P.PATTERN)[1], _own()
    assert ids(packed, text) == own.encode_ordinary(text)
    assert bpe.decode(packed.text(text), vocabulary) == text.encode()


_OWN = []


def _own():
    if not _OWN:
        _OWN.append(tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=bpe.load_ranks(PATH), special_tokens={}))
    return _OWN[0]


def test_long_pieces_and_special_strings(tools):
    packed, vocabulary, own = tools
    for text in ("a" * 5000, "#" * 3000 + "x", "<|endoftext|>", "abc" * 2000, " " * 500 + "x" + " " * 7, "1" * 999, "don't  we'll\n\n\n x"):
        assert ids(packed, text) == own.encode_ordinary(text)


def test_append_and_replace_equal_a_new_encoding(tools):
    vocabulary = tools[1]
    r = random.Random(4)
    for _ in range(40):
        data = bytes(r.choice(b"abcde thing") for _ in range(r.randint(1, 400)))
        e = bpe.PrefixEncoder(vocabulary, data[:50])
        e.append(data[50:])
        assert e.tokens() == vocabulary.merge(data)
        for _ in range(4):
            i = r.randint(0, len(e.data))
            j = r.randint(i, min(len(e.data), i + 5))
            e.replace(i, j, bytes(r.choice(b"aethn ") for _ in range(r.randint(0, 6))))
            assert e.tokens() == vocabulary.merge(bytes(e.data))
    e = bpe.PrefixEncoder(vocabulary, b"thing " * 400)
    assert e.replace(10, 12, b"x") < 600


def test_query_over_whole_table(spark, tools):
    from acreage.llm.queries import QUERIES

    sf = "/root/testdata/sf0.001"
    got = {r["doc_id"]: r for r in QUERIES["op3_byte_bpe"](spark, sf).collect()}
    rows = spark.read.parquet(f"{sf}/documents.parquet").collect()
    assert len(got) == len(rows)
    for r in rows:
        want = tools[2].encode_ordinary(r["text"] or "")
        g = got[r["doc_id"]]
        assert g["n_tokens"] == len(want) and g["ids_sha256"] == hashlib.sha256(np.array(want, "<u4").tobytes()).hexdigest()
        assert g["decoded_sha256"] == hashlib.sha256((r["text"] or "").encode()).hexdigest()


def test_nulls_empty_table_and_extra_columns(spark):
    docs = spark.createDataFrame([(1, None, "x"), (2, "", "y"), (2, "a b", None)], "doc_id bigint, text string, k string")
    got = bpe.round_trip(docs, PATH, P.PATTERN)
    assert sorted(r["n_tokens"] for r in got.collect()) == [0, 0, 2]
    assert bpe.round_trip(docs.limit(0), PATH, P.PATTERN).count() == 0
    own = bpe.encode(docs.withColumnRenamed("k", "token_ids"), PATH, P.PATTERN)
    assert own.columns == ["doc_id", "text", "token_ids"] and sorted(len(r["token_ids"]) for r in own.collect()) == [0, 0, 2]
