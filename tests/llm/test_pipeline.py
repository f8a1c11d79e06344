import duckdb
import pytest

import corpus_pipeline
from acreage.llm import lines, pii
from acreage.llm.queries import ORACLES
from llm.test_lines import plain as plain_lines
from llm.test_packing import check as check_packing

SF = "/root/testdata/sf0.001"


def shingles(text):
    w = (text or "").encode().lower().split()
    return {b" ".join(w[i : i + 5]) for i in range(max(1, len(w) - 4))}


def similarity(a, b):
    return len(a & b) / len(a | b)


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """What each stage returned, the raw documents first."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = [("documents", docs.columns, docs.collect())]
    for name, f in corpus_pipeline.STAGES:
        made = f(spark, docs, SF)
        path = str(tmp_path_factory.mktemp(name) / "out")
        made.write.parquet(path)
        docs = spark.read.parquet(path)
        out.append((name, docs.columns, docs.collect()))
    return out


def test_columns_and_order(stages):
    assert [s[0] for s in stages[1:]] == ["quality_rules", "line_dedup", "near_dedup", "pii", "packing"]
    assert all(s[1] == stages[0][1] for s in stages[:-1])
    assert all(r["n_chars"] == len(r["text"]) for s in stages[2:-1] for r in s[2])


def test_quality_stage(stages):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    kept = {r[0] for r in con.execute(f"SELECT doc_id FROM ({ORACLES['op10_quality_rules']}) WHERE kept").fetchall()}
    assert {r["doc_id"] for r in stages[1][2]} == kept and 0 < len(kept) < len(stages[0][2])


def test_quality_stage_keeps_very_long_documents(spark):
    text = " ".join(f"the w{i}" for i in range(500_001))
    docs = spark.createDataFrame([(1, text), (2, "too short")], "doc_id bigint, text string")
    assert [r["doc_id"] for r in corpus_pipeline.quality_rules(spark, docs, SF).select("doc_id").collect()] == [1]


def test_line_stage(stages):
    want = plain_lines([(r["doc_id"], r["text"], r["source"]) for r in stages[1][2]], lines.MIN_SITES)
    assert sorted(((r["doc_id"], r["text"]) for r in stages[2][2]), key=repr) == want


def test_near_copies_stage(stages):
    before = [(r["doc_id"], shingles(r["text"])) for r in stages[2][2]]
    after = {r["doc_id"] for r in stages[3][2]}
    assert len(after) == len(stages[3][2])
    left = [(d, s) for d, s in before if d in after]
    for i, (d, s) in enumerate(left):
        assert all(similarity(s, t) < 0.9 for _, t in left[:i])
    for d, s in before:
        if all(similarity(s, t) < 0.5 for e, t in before if e != d):
            assert d in after
        if d not in after:
            assert any(e < d and similarity(s, t) >= 0.6 for e, t in before)


def test_personal_data_stage(stages):
    clean = {r["doc_id"]: r["text"] for r in stages[4][2]}
    for r in stages[3][2]:
        assert clean[r["doc_id"]] == pii.redact(r["text"], pii.find(r["text"]))


def test_packing_stage(stages):
    check_packing(stages[5][2], {r["doc_id"]: r["text"] for r in stages[4][2]}, 2048)


def test_run_gives_the_last_stage(spark, stages):
    key = lambda r: (r["doc_id"], r["piece"], r["length"], r["ids_crc32"])
    assert sorted(map(key, corpus_pipeline.run(spark, SF).collect())) == sorted(map(key, stages[5][2]))


def test_stages_take_nulls_repeats_and_empty_tables(spark):
    text = "the of and to in is that for with this " * 2 + " ".join(f"w{i}" for i in range(60))
    rows = [(1, text, "en", "s", 1), (1, text, "en", "s", 1), (2, text + " x", None, None, None), (None, text + " y", "en", "s", 1), (3, None, "en", "s", 1), (4, "", "en", "s", 1), (None, None, None, None, None)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    for start in (docs, docs.limit(0)):
        d = start
        for _, f in corpus_pipeline.STAGES[:-1]:
            d = f(spark, d, SF)
            assert d.columns == docs.columns
        assert [r["doc_id"] for r in d.collect()] == ([1] if start is docs else [])
        assert corpus_pipeline.STAGES[-1][1](spark, start, SF).count() == (len(rows) if start is docs else 0)
    assert sorted((r["doc_id"] for r in corpus_pipeline.near_dedup(spark, docs, SF).collect()), key=str) == [1, 3]
