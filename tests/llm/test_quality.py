import re

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from acreage.llm import quality

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain(text):
    """Base measures by brute force."""
    text = text or ""
    w = WORD.findall(text)
    grams = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
    covered = {i + k for i, g in enumerate(grams) if grams.count(g) > 1 for k in range(3)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    n = len(w)
    return n, sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered), n < 50 or 100 * len(covered) > 50 * n


TEXTS = [None, "", " \n\t", "a", "a b", "a b c", "a b c a b c", "x x x x x", "l\nl\n l\nl", "é漢😀 # *\x0b$|<>&%", "a\x1cb c  d", "k " * 500, " ".join(f"w{i}" for i in range(120)), "the of and " + " ".join(f"w{i % 40}" for i in range(200))]


def measured(spark, texts):
    docs = spark.createDataFrame([(i, t, "z") for i, t in enumerate(texts)], "doc_id bigint, text string, kept string")
    return {r["doc_id"]: r for r in quality.judge(docs).collect()}


def same(r, t):
    return (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"], r["base_failed"]) == plain(t)


def test_measures_equal_brute_force(spark):
    got = measured(spark, TEXTS)
    assert all(same(got[i], t) for i, t in enumerate(TEXTS))
    assert all(not r["kept"] for r in got.values() if r["base_failed"])


@pytest.fixture(scope="module")
def session(spark):
    return spark


def test_random_texts(session):
    @settings(max_examples=5, deadline=None)
    @given(st.lists(st.text(alphabet="ab \n\t#|é", max_size=80), min_size=20, max_size=40))
    def check(texts):
        got = measured(session, texts)
        assert all(same(got[i], t) for i, t in enumerate(texts))

    check()


def test_kept_rows_keep_their_columns(spark):
    fine = "the of and to in " + " ".join(f"w{i}" for i in range(60))
    rows = [(1, fine, 5, "a"), (1, fine, 5, "a"), (2, "short", 6, "b"), (None, fine, None, None), (3, None, 1, "c"), (4, "# " + "x#y " * 60, 1, "d")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, n_words int, kept string")
    got = quality.only_kept(docs)
    assert got.columns == docs.columns
    assert sorted(map(tuple, got.collect()), key=repr) == sorted([r for r in rows if r[1] == fine], key=repr)
    assert quality.only_kept(docs.limit(0)).count() == 0


def test_no_user_function_and_no_shuffle(spark):
    docs = spark.createDataFrame([(1, "a")], "doc_id bigint, text string")
    for df in (quality.judge(docs), quality.only_kept(docs)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in plan and "Exchange" not in plan


def test_own_columns_with_helper_names_and_line_ends(spark):
    words = lambda j: " ".join(f"the w{j}x{i}" for i in range(8))
    open_lines = "".join(f"{words(j)} {j}...\r\n" for j in range(12))
    rows = [(1, open_lines, "a", 1, "x"), (2, open_lines.replace("\r", ""), "b", 2, "y")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, _t string, _base int, __l string")
    got = {r["doc_id"]: r for r in quality.judge(docs).collect()}
    assert [(r["doc_id"], r["_t"], r["_base"], r["__l"]) for r in got.values()] == [(1, "a", 1, "x"), (2, "b", 2, "y")]
    # A line that ends in a carriage return does not end in dots.
    assert got[1]["kept"] and not got[2]["kept"]


def test_no_text_fails_for_its_length(spark):
    docs = spark.range(1).select("id", F.concat_ws(" ", F.transform(F.sequence(F.lit(1), F.lit(1_000_100)), lambda i: F.concat(F.lit("the"), i.cast("string")))).alias("text"))
    row = quality.judge(docs.withColumn("text", F.concat("text", F.repeat(F.lit(" the"), 1)))).select("n_words", "failed_rules").first()
    assert row["n_words"] == 1_000_101 and "few_words" not in row["failed_rules"] and "many_words" not in row["failed_rules"]
