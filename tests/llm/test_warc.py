import gzip
import json

import pytest

from acreage.llm import warc


def test_records_survive_small_chunks_and_many_members(tmp_path, monkeypatch):
    monkeypatch.setattr(warc, "CHUNK", 7)
    made = [warc.page_record(str(i), f"http://x/{i}\r\nX: 1", b"line\r\n\r\n" * i, None, False) for i in range(6)]
    whole, many = tmp_path / "whole.warc.gz", tmp_path / "many.warc.gz"
    whole.write_bytes(gzip.compress(b"".join(made)))
    many.write_bytes(b"".join(gzip.compress(m) for m in made))
    for name in (whole, many):
        target = f"{tmp_path}/out-{name.name}"
        assert warc.normalise_file(str(name), target) == 6
        data = open(target, "rb").read()
        index = [json.loads(x) for x in open(target + ".idx")]
        assert [x["page_id"] for x in index] == [str(i) for i in range(6)]
        for i, x in enumerate(index):
            member = data[x["offset"] : x["offset"] + x["length"]]
            assert gzip.decompress(member) == made[i]
            assert warc.read_member(member)[1] == b"line\r\n\r\n" * i
        assert gzip.decompress(data) == b"".join(made)


def test_damaged_archives_are_told(tmp_path):
    record = warc.page_record("1", "u", b"abc", None, False)
    for bad in (record[:-9], record[:20], b"nothing\r\n\r\n"):
        path = tmp_path / "bad.warc.gz"
        path.write_bytes(gzip.compress(bad))
        with pytest.raises(ValueError):
            warc.normalise_file(str(path), f"{tmp_path}/out")
    with pytest.raises(ValueError):
        warc.read_member(gzip.compress(record.replace(b"abc", b"abd")))


def test_round_trip_with_copies_nulls_and_long_pages(spark, monkeypatch):
    pages = [(1, "a", "same"), (2, "b", "same"), (9, None, "same"), (3, "c", None), (4, "d", ""), (5, "é", "é" * 200_000), (6, "f", "own"), (6, "f", "own"), (None, "g", "own"), (None, "h", "alone")]
    docs = spark.createDataFrame([(*p, 1) for p in pages], "page_id bigint, url string, html string, payload int")
    archives, folder = warc.archive(spark, docs)
    rows = warc.read_archives(archives, folder, payload=True).collect()
    got = sorted(((r["page_id"], r["record_type"], r["refers_to"], r["payload_bytes"]) for r in rows), key=repr)
    assert got == sorted(
        [("1", "revisit", "9", 4), ("2", "revisit", "9", 4), ("9", "response", None, 4), ("3", "revisit", "4", 0), ("4", "response", None, 0), ("5", "response", None, 400_000)]
        + [("6", "response", None, 3)] * 2 + [(None, "revisit", "6", 3), (None, "response", None, 5)],
        key=repr,
    )
    assert {r["payload"] for r in rows if r["page_id"] == "5"} == {("é" * 200_000).encode()}
    assert {r["payload_digest"] for r in rows if r["payload_bytes"] == 4} == {warc.digest(b"same")}
    archives, folder = warc.archive(spark, docs, least=4)
    assert {r["record_type"] for r in warc.read_archives(archives, folder).collect() if r["payload_bytes"] < 4} == {"response"}


def test_empty_table(spark):
    archives, folder = warc.archive(spark, spark.createDataFrame([], "page_id bigint, url string, html string"))
    assert warc.read_archives(archives, folder).count() == 0
