import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers as P
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from acreage.llm import packing

PATHS = (P.path("byte_bpe_50k.json"), P.path("byte_bpe_50k.tiktoken"), P.PATTERN)


def best_fit_decreasing(lengths, capacity):
    room = []
    for n in sorted(lengths, reverse=True):
        fits = [i for i, r in enumerate(room) if r >= n]
        if fits:
            room[min(fits, key=lambda i: room[i])] -= n
        else:
            room.append(capacity - n)
    return len(room)


@pytest.mark.parametrize("kind", ["uniform", "short", "long", "one", "thirds"])
def test_plan_is_valid_and_as_good_as_best_fit(kind):
    r = random.Random(5)
    draw = {"uniform": lambda: r.randint(1, 100), "short": lambda: r.randint(1, 12), "long": lambda: r.randint(60, 100), "one": lambda: 37, "thirds": lambda: r.choice([33, 34, 50, 99, 1])}[kind]
    lengths = [draw() for _ in range(1500)]
    plan = packing.make_plan(Counter(lengths), 100, 20, 3)
    used = Counter()
    for p, n in plan.kinds.items():
        assert sum(p) <= 100
        for x in p:
            used[x] += n
    assert used == Counter(lengths)
    assert plan.sequences <= 1.02 * best_fit_decreasing(lengths, 100) + 1


def test_fit_is_the_least_squares_with_no_negative_part():
    r = np.random.default_rng(0)
    a, y = r.random((12, 6)), r.random(12)
    x = packing.non_negative_fit(a, y)
    gain = a.T @ (y - a @ x)
    assert (x >= 0).all() and (gain <= 1e-6).all() and np.abs(gain[x > 1e-9]).max(initial=0) < 1e-6


def test_cut_leaves_only_the_first_piece_short():
    assert packing.cut(5, 4) == [(0, 1), (1, 4)] and packing.cut(8, 4) == [(0, 4), (4, 4)] and packing.cut(4, 4) == [(0, 4)] and packing.cut(1, 4) == [(0, 1)]


def check(rows, texts, capacity):
    """Every token of every document once; sequences gapless from 0 and within capacity."""
    own = Tokenizer.from_file(PATHS[0])
    by_sequence, by_doc = defaultdict(list), defaultdict(list)
    for r in rows:
        by_sequence[r["sequence_id"]].append((r["offset"], r["length"]))
        by_doc[r["doc_id"]].append(r)
    for s in by_sequence.values():
        at = 0
        for o, n in sorted(s):
            assert o == at
            at += n
        assert at <= capacity
    for d, t in texts.items():
        ids = np.array(own.encode(t or "", add_special_tokens=False).ids + [0], "<u4")
        got = sorted(by_doc.pop(d), key=lambda r: r["piece"])
        assert [r["piece"] for r in got] == list(range(len(got))) and sum(r["length"] for r in got) == len(ids)
        assert len(got) == 1 if len(ids) <= capacity else all(r["length"] == capacity for r in got[1:])
        for r in got:
            assert r["ids_crc32"] == zlib.crc32(ids[r["start"] : r["start"] + r["length"]].tobytes())
    assert not by_doc
    return len(by_sequence)


def test_query_over_whole_table(spark):
    from acreage.llm.queries import QUERIES

    sf = "/root/testdata/sf0.001"
    rows = QUERIES["op6_packing"](spark, sf).collect()
    used = check(rows, {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}, 2048)
    assert used <= best_fit_decreasing([r["length"] for r in rows], 2048)


def test_special_strings_ties_nulls_and_repeated_rows(spark):
    texts = {1: None, 2: "", 3: "<|endoftext|> x  <|endoftext|>", 4: "a b c " * 300, 5: "same", 6: "same", 7: "é  \n x"}
    docs = spark.createDataFrame([(k, v, "x") for k, v in texts.items()], "doc_id bigint, text string, piece string")
    check(packing.pack_documents(docs, *PATHS, capacity=64).collect(), texts, 64)
    twice = packing.pack_documents(docs.unionByName(docs), *PATHS, capacity=64)
    assert twice.select("sequence_id", "offset").distinct().count() == twice.count()
    assert packing.pack_documents(docs.limit(0), *PATHS).count() == 0
    none = docs.withColumn("doc_id", F.lit(None).cast("bigint"))
    assert packing.pack_documents(none, *PATHS, capacity=64).select("sequence_id", "offset").distinct().count() == twice.count() // 2


def test_patterns_of_lengths_save_sequences_that_best_fit_needs(monkeypatch):
    lengths = Counter({51: 600, 27: 600, 26: 600, 23: 1200})
    with_patterns = packing.make_plan(lengths, 100)
    assert with_patterns.sequences == 900 and set(with_patterns.kinds) == {(51, 26, 23), (27, 27, 23, 23)}
    monkeypatch.setattr(packing, "_fit", lambda found, y: [])
    assert packing.make_plan(lengths, 100).sequences > 1000


@pytest.mark.parametrize("low, high", [(40, 60), (30, 80)])
def test_patterns_hold_short_documents_of_any_number_and_length(low, high):
    """Documents far below an eighth of a sequence, of few and of many lengths, sixteen to a sequence."""
    r = random.Random(4)
    lengths = Counter(r.randrange(low, high) for _ in range(30_000))
    plan = packing.make_plan(lengths, 1000)
    used = Counter()
    for p, n in plan.kinds.items():
        assert sum(p) <= 1000
        for x in p:
            used[x] += n
    assert used == lengths
    alone = packing._filled(lengths, 1000, [])
    least = -(-sum(n * c for n, c in lengths.items()) // 1000)
    assert plan.sequences < alone.sequences and plan.sequences - least <= 2


def test_best_pattern_is_that_of_all_multisets():
    r = np.random.default_rng(1)
    for depth in (None, 2, 3):
        gain = np.where(r.random(13) < 0.7, r.normal(size=13), -np.inf)

        def fillings(head, left):
            if not left:
                yield head
            elif depth is None or len(head) < depth:
                for n in range(1, min(left, head[-1] if head else left) + 1):
                    if np.isfinite(gain[n]):
                        yield from fillings((*head, n), left - n)

        want = max(fillings((), 12), key=lambda p: gain[list(p)].sum(), default=None)
        got = packing.best_patterns(gain, depth, 4)
        assert (got[0] if got else None) == want or gain[list(got[0])].sum() == pytest.approx(gain[list(want)].sum())
        assert len(set(got)) == len(got) <= 4 and all(sum(p) == 12 and (depth is None or len(p) <= depth) for p in got)
