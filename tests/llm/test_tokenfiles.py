import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from acreage.llm import packing, tokenfiles

SCHEMA = "doc_id bigint, text string, t string, k int, row int"
PATHS = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN


#: Without a name, as a worker can't import this module.
ids_of = lambda paths=PATHS: packing.encoder(*paths)


def frame(spark, docs):
    return spark.createDataFrame([(*d, "x", 1, 2) for d in docs], SCHEMA).repartition(3)


def plain(docs):
    full = Tokenizer.from_file(PATHS[0])
    out, at = [], 0
    for i, t in sorted(docs, key=lambda d: (d[0] is not None, d[0] or 0)):
        ids = full.encode(t or "", add_special_tokens=False).ids + [0]
        out.append((i, at, ids))
        at += len(ids)
    return out


def summary(i, at, ids):
    return i, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())


DOCS = [(7, "one two"), (3, None), (-5, ""), (9, "é" * 3000), (4, "a <|endoftext|> b"), *[(100 + i, f"text {i} " * (i % 7)) for i in range(60)]]


@pytest.mark.parametrize("vocabulary, kind", [(50257, "<u2"), (70000, "<u4")])
def test_round_trip(spark, tmp_path, monkeypatch, vocabulary, kind):
    monkeypatch.setattr(tokenfiles, "DOCUMENTS", 7)
    monkeypatch.setattr(tokenfiles, "TEXT_BYTES", 100)
    shards, folder, got = tokenfiles.write(frame(spark, DOCS), ids_of, vocabulary, f"{tmp_path}/out", shards=5)
    want = plain(DOCS)
    assert got == kind and shards.count() == 5
    rows = tokenfiles.read(shards, folder, kind, ids=True).orderBy("start").collect()
    assert [(r.doc_id, r.start, r.ids) for r in rows] == want
    assert [(r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in rows] == [summary(*w) for w in want]
    files = tokenfiles.TokenFiles(folder)
    assert len(files) == len(want)
    assert [(k, s, i.tolist()) for k, s, i in files] == want
    with pytest.raises(IndexError):
        files[len(want)]


def test_repeated_and_null_keys(spark):
    docs = [(5, "same")] * 40 + [(None, "no key")] * 3 + [(2**63 - 1, "big"), (-(2**63), "small")]
    rows = tokenfiles.round_trip(frame(spark, docs), ids_of, 50257).orderBy("start").collect()
    assert [tuple(r) for r in rows] == [summary(*w) for w in plain(docs)]


def test_empty_table(spark, tmp_path):
    shards, folder, kind = tokenfiles.write(frame(spark, DOCS).limit(0), ids_of, 50257, f"{tmp_path}/none")
    assert tokenfiles.read(shards, folder, kind).collect() == [] and len(tokenfiles.TokenFiles(folder)) == 0


def test_damaged_files_are_told(spark, tmp_path):
    _, folder, kind = tokenfiles.write(frame(spark, DOCS), ids_of, 50257, f"{tmp_path}/cut", shards=2)
    name = tokenfiles.TokenFiles(folder).shards[0]["name"]
    with open(f"{folder}/tokens-{name}", "r+b") as f:
        f.truncate(6)
    with pytest.raises(ValueError, match="sizes"):
        tokenfiles.TokenFiles(folder)[0]


def test_files_read_by_ranges(spark, tmp_path):
    (tmp_path / "n").write_bytes(np.arange(10, dtype="<u2").tobytes())
    flat = tokenfiles.Flat(f"{tmp_path}/n", "<u2")
    flat.file, flat.map = open(tmp_path / "n", "rb"), None
    assert flat.size == 10 and flat.read(3, 6).tolist() == [3, 4, 5]
