import itertools
import random

import pytest
import xxhash
from pyspark.sql import functions as F

from acreage.llm import graph, simhash


def plain_print(text, shingle=4):
    words = (text or "").encode().lower().split()
    runs = [b" ".join(words[i : i + shingle]) for i in range(len(words) - shingle + 1)] or ([b" ".join(words)] if words else [])
    h = [xxhash.xxh64_intdigest(r, 42) for r in runs]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def plain_components(prints, radius):
    label = {k: k for k, _ in prints}
    for (a, x), (b, y) in itertools.combinations(prints, 2):
        if (x ^ y).bit_count() <= radius and label[a] != label[b]:
            lo, hi = sorted((label[a], label[b]))
            label = {k: lo if v == hi else v for k, v in label.items()}
    return label


def texts(n=120):
    r = random.Random(3)
    words = [f"w{i}" for i in range(300)]
    out = ["", None, " \t\n", "One two", "one TWO", "É é", "a b c d", "x " * 3000]
    while len(out) < n:
        base = [r.choice(words) for _ in range(r.randint(5, 200))]
        for _ in range(r.randint(1, 5)):
            copy = list(base)
            if r.random() < 0.7:
                copy[r.randrange(len(copy))] = r.choice(words)
            out.append(" ".join(copy))
    return out[:n]


@pytest.mark.parametrize("piece", [4096, 8])
def test_duplicates_match_all_pairs(spark, piece, monkeypatch):
    monkeypatch.setattr(simhash, "PIECE", piece)
    monkeypatch.setattr(simhash.linked, "__defaults__", (piece,))
    rows = [(i, t, i % 3) for i, t in enumerate(texts())]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, k int")
    got = {r[0]: (int(r[1], 16), r[2]) for r in simhash.duplicates(simhash.fingerprints(docs).cache()).select("doc_id", simhash.hexadecimal(), "component_id").collect()}
    prints = [(i, plain_print(t)) for i, t, _ in rows]
    assert {k: v[0] for k, v in got.items()} == dict(prints)
    assert {k: v[1] for k, v in got.items()} == plain_components(prints, 4)


def test_sliced_comparison_finds_each_hit():
    r = random.Random(1)
    base = [r.getrandbits(64) for _ in range(40)]
    values = base + [b ^ sum(1 << i for i in r.sample(range(64), r.randint(0, 7))) for b in base for _ in range(4)]
    import numpy as np

    bits = np.unpackbits(np.array(values, dtype=">u8").view(np.uint8)).reshape(-1, 64)
    for radius in (0, 1, 4, 9):
        who, hit = simhash.within(bits[:50], simhash.planes(bits), radius)
        found = {(int(w), j) for w, m in zip(who, hit) for j in range(len(values)) if int(m[j // 64]) >> (j % 64) & 1}
        assert found == {(i, j) for i in range(50) for j in range(len(values)) if (values[i] ^ values[j]).bit_count() <= radius}


@pytest.mark.parametrize("n", [10, 10**8, 10**10])
def test_masks_keep_every_pair_in_reach(n):
    r = random.Random(2)
    masks = simhash.tables(n, 4)
    for _ in range(500):
        flips = sum(1 << i for i in r.sample(range(64), 4))
        assert any(not flips & m for m in masks)


def test_components_of_chains_and_loops(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 101), (101, 102), (102, 100), (7, 7), (200, None)]
    got = {r["node"]: r["root"] for r in graph.components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert got == {**{i: 0 for i in range(41)}, 100: 100, 101: 100, 102: 100}


def test_empty_table_and_nulls(spark):
    none = spark.createDataFrame([], "doc_id bigint, text string")
    assert simhash.duplicates(simhash.fingerprints(none)).count() == 0
    some = spark.createDataFrame([(None, "a b c d e"), (5, "a b c d e"), (5, "a b c d e"), (9, None)], "doc_id bigint, text string")
    got = simhash.duplicates(simhash.fingerprints(some)).select("doc_id", "component_id")
    assert sorted(map(tuple, got.collect()), key=repr) == [(5, 5), (5, 5), (9, 9), (None, 5)]
    assert simhash.fingerprints(some.withColumn("k", F.lit(1))).columns == ["doc_id", "fingerprint"]


@pytest.mark.parametrize("piece", [4096, 8])
def test_near_copies_are_decided_at_the_similarity_itself(spark, piece, monkeypatch):
    monkeypatch.setattr(simhash, "PIECE", piece)
    rows = []
    for i in range(80):
        n = (44, 84, 404)[i % 3]
        more = (n - 4) // 4  # n - 4 common runs of n - 4 + more: 0.8; one run more is less
        start = [f"d{i}w{j}" for j in range(n)]
        rows += [(4 * i, " ".join(start)), (4 * i + 1, " ".join([*start, *(f"e{i}x{j}" for j in range(more))]))]
        start = [f"f{i}w{j}" for j in range(n)]
        rows += [(4 * i + 2, " ".join(start)), (4 * i + 3, " ".join([*start, *(f"g{i}x{j}" for j in range(more + 1))]))]
    # A repeated passage counts once; short texts, and a chain in which only neighbours are near.
    passage = [f"p{j}" for j in range(30)]
    rows += [(1000, " ".join(passage)), (1001, " ".join(passage * 1 + ["p0", "p1"])), (1010, "s1 s2 s3 s4 s5 s6 s7 s8"), (1011, "s1 s2 s3 s4 s5 s6 s7 s8 s9")]
    rows += [(1100 + i, " ".join(f"c{j}" for j in range(2 * i, 2 * i + 60))) for i in range(40)]
    got = {r[0] for r in simhash.without_near_copies(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert got == {4 * i + k for i in range(80) for k in (0, 2, 3)} | {1000, 1010, 1100}


def test_near_copies_of_repeated_rows_and_any_column_names(spark, monkeypatch):
    """Repeats of a row add nothing to the groups that are compared, and no input column is lost."""
    body = " ".join(f"w{i}" for i in range(100))
    rows = [(1, body, "r", "a")] * 300 + [(2, body + " more", "r", "b")] * 300 + [(3, "quite another text of some words", "r", "c")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, _row string, `all` string").repartition(7)
    plain, lots = simhash._exact, []

    def counted(similarity):
        run = plain(similarity)

        def small(key, t):
            assert t.num_rows <= 2, t.num_rows
            return run(key, t)

        lots.append(similarity)
        return small

    monkeypatch.setattr(simhash, "_exact", counted)
    got = simhash.without_near_copies(docs)
    assert got.columns == docs.columns
    assert sorted(map(tuple, got.collect())) == [(1, body, "r", "a"), (3, "quite another text of some words", "r", "c")] and lots
