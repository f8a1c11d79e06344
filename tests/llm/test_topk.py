import math

import numpy as np
import pytest

from acreage.llm import topk


def plain(rows, every, k):
    width = max((len(v) for _, v in rows if v), default=0)
    fine = [(i, [math.floor(256 * x) for x in v] + [0] * (width - len(v))) for i, v in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for a, (i, q) in enumerate(fine):
        if i % every == 0:
            best = sorted((-sum(x * y for x, y in zip(q, v)), j) for b, (j, v) in enumerate(fine) if b != a)[:k]
            out += [(i, r + 1, j, -s) for r, (s, j) in enumerate(best)]
    return sorted(out)


def run(spark, rows, every=5, k=4, pivots=6):
    df = spark.createDataFrame([(*r, 1) for r in rows], "vec_id bigint, embedding array<float>, id int")
    return sorted(map(tuple, topk.top_k(df, every=every, k=k, pivots=pivots).collect()))


@pytest.mark.parametrize("small", [False, True])
def test_equals_brute_force(spark, small, monkeypatch):
    if small:
        for name, value in (("PACK", 8), ("GROUP", 32), ("QUERIES", 4)):
            monkeypatch.setattr(topk, name, value)
    r = np.random.default_rng(0)
    base = r.normal(size=(8, 6))
    rows = [(i, (base[i % 8] * r.choice([0.2, 1, 3]) + r.normal(size=6) * 0.1).astype(np.float32).tolist()) for i in range(150)]
    rows += [(200 + i, [0.5] * 6) for i in range(60)] + [(300, [0.5] * 6)] * 3
    rows += [(400, None), (405, [1.0, None, 2.0]), (410, [float("nan")] * 6), (415, [float("inf")] * 6), (420, []), (425, [1.0]), (None, [9.0] * 6)]
    assert run(spark, rows) == plain([(i, None if v is None else [None if x is None else float(np.float32(x)) for x in v]) for i, v in rows], 5, 4)


def test_few_rows_and_none(spark):
    assert run(spark, [(0, [1.0, 2.0])]) == []
    assert run(spark, [(0, [1.0]), (5, [1.0]), (7, [-1.0])]) == [(0, 1, 5, 65536), (0, 2, 7, -65536), (5, 1, 0, 65536), (5, 2, 7, -65536)]
    assert run(spark, []) == []
    assert run(spark, [(0, [0.0]), (1, [0.0])]) == [(0, 1, 1, 0)]


def test_large_components_stay_exact(spark):
    rows = [(0, [3e6, 1.0]), (1, [3e6, 2.0]), (2, [3e6, 3.0])]
    assert run(spark, rows) == plain(rows, 5, 4)


def doubles(spark, rows, k=4):
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    return sorted(map(tuple, topk.top_k(df, every=5, k=k, pivots=3).collect()))


def test_components_beyond_four_bytes(spark):
    rows = [(0, [1e7, 0.0]), (1, [1.0, 2.0]), (2, [-3.0, 0.5]), (5, [0.25, 1e7]), (6, [1e7, 1.0])]
    assert doubles(spark, rows) == plain(rows, 5, 4)
    # The product of the first row with itself is no long, but is not asked for.
    rows = [(0, [1e13, -1e13]), (1, [1.0, 2.0]), (2, [1e13, 1e13]), (3, [-3.0, 0.5])]
    assert doubles(spark, rows) == plain(rows, 5, 4)


def test_scores_beyond_a_long_raise(spark):
    top = (2**31 - 1) / 256
    with pytest.raises(Exception, match="a score is no long"):
        doubles(spark, [(0, [top] * 3), (1, [top] * 3), (2, [1.0, 0.0, 0.0])])
    with pytest.raises(ValueError, match="too large for a long"):
        doubles(spark, [(0, [1e30]), (1, [1.0])])
