import math
import re
from collections import Counter

import numpy as np
import pytest

from acreage.llm import lexical

DOCS = "doc_id bigint, text string, row int, t int, term string"
ITEMS = "item_id bigint, text string, q int"


def plain(docs, items, k):
    terms = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    had = [(i, Counter(terms(t)), len(terms(t))) for i, t in docs if terms(t)]
    n, total = len(had), sum(x[2] for x in had)
    df = Counter(t for _, c, _ in had for t in c)
    out = []
    for item, text in items:
        scored = []
        for r, (i, c, size) in enumerate(had):
            m = 75 + 25 * size * n // total
            s = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (1000000000 * c[t] // (1000 * c[t] + 12 * m)) for t in terms(text) if c[t])
            if s > 0:
                scored.append((-s, i is None, i or 0, r, i))
        out += [(item, rank, x[4], -x[0]) for rank, x in enumerate(sorted(scored)[:k], 1)]
    return sorted(out, key=str)


def run(spark, docs, items, **more):
    d = spark.createDataFrame([(*x, 1, 2, "x") for x in docs], DOCS)
    i = spark.createDataFrame([(*x, 7) for x in items], ITEMS)
    return sorted((tuple(r) for r in lexical.search(d, i, **more).collect()), key=str)


def corpus(seed, n, words):
    r = np.random.default_rng(seed)
    names = [f"w{j}" for j in range(words)]
    return [(i, " ".join(names[min(words - 1, int(x))] for x in r.zipf(1.3, r.integers(1, 40)) - 1)) for i in range(n)]


@pytest.mark.parametrize("small, owners", [(False, (1.0,)), (True, lexical.OWNERS)])
def test_equals_brute_force(spark, small, owners, monkeypatch):
    if small:
        for name, value in (("DOCUMENTS", 40), ("ITEMS", 3), ("PIECE", 5), ("TEXT_BYTES", 64)):
            monkeypatch.setattr(lexical, name, value)
    docs = corpus(0, 300, 60)
    docs += [(1000 + i, "W3 w5  w5;ÄÖ é") for i in range(25)] + [(2000, "same w1 text")] * 6 + [(None, "same w1 text"), (3000, None), (3001, ""), (3002, "!?")]
    items = [(i, t) for i, t in corpus(1, 8, 60)] + [(100, "w5 W5 ÄÖ äö é zzz"), (101, None), (102, "..."), (None, "text w1"), (103, "same w1"), (103, "same w1")]
    assert run(spark, docs, items, k=7, owners=owners) == plain(docs, items, 7)


def test_empty_tables_and_few_rows(spark):
    assert run(spark, [], [(1, "a")]) == [] and run(spark, [(1, "a")], []) == []
    assert run(spark, [(1, None)], [(1, "a")]) == []
    docs, items = [(5, "a b"), (4, "a c"), (6, "d")], [(1, "a a b"), (2, "q")]
    assert run(spark, docs, items) == plain(docs, items, 20) and len(run(spark, docs, items)) == 2


def test_long_text(spark, monkeypatch):
    monkeypatch.setattr(lexical, "PIECE", 1000)
    docs = [(1, "alpha beta " * 30_000), (2, "beta"), (3, "x" * 5000), (4, "gamma")]
    items = [(1, "alpha beta " + "x" * 5000)]
    assert run(spark, docs, items) == plain(docs, items, 20)
