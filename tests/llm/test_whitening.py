import math

import numpy as np
import pytest

from acreage.llm import whitening as W


def spectrum(values, seed=0):
    q = np.linalg.qr(np.random.default_rng(seed).normal(size=(len(values), len(values))))[0]
    return (q * values) @ q.T


@pytest.mark.parametrize("values", [
    np.linspace(1, 50, 40), np.geomspace(1e-6, 1, 12), [1.0] * 5, [3.0, 3.0, 3.0, 2.0, 1.0, 1.0], [0.0, 0.0, 1.0],
    [1, 1 + 1e-9, 1 + 2e-9, 1 + 1e-8, 2, 2 + 1e-9, 3], [1 + 1e-7 * i for i in range(10)], [5e300, 1e300], [1e-300, 2e-300],
])
def test_refined_to_double(values):
    v = spectrum(np.array(values, float))
    v = (v + v.T) / 2
    e, x = W.refined_eigen(v)
    top = np.abs(v).max()
    assert np.all(np.diff(e) <= 0)
    assert np.abs(e - np.linalg.eigvalsh(v)[::-1]).max() <= 1e-14 * len(v) * top
    assert np.abs(x.T @ x - np.eye(len(v))).max() < 1e-14
    assert np.abs(v / top @ x - x * (e / top)).max() < 2e-15 * len(v)


def test_clusters_are_resolved_beyond_float32():
    values = np.array([1 + 3e-9 * i for i in range(6)] + [0.5, 0.25])
    q = np.linalg.qr(np.random.default_rng(3).normal(size=(8, 8)))[0]
    v = (q * values) @ q.T
    e, x = W.refined_eigen((v + v.T) / 2)
    want = q[:, np.argsort(-values)]
    assert np.abs(np.abs((x * want).sum(axis=0)) - 1).max() < 1e-9


def plain(rows, components=4):
    fine = [(i, v) for i, v in rows if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    width = max((len(v) for _, v in fine), default=0)
    xs = [(i, [math.floor(256 * float(np.float32(c))) for c in v] + [0] * (width - len(v))) for i, v in fine]
    fit = sorted({tuple(x) for _, x in xs})
    n = len(fit)
    s = [sum(c) for c in zip(*fit)]
    f = np.array(fit, float) - np.array([t / n for t in s])
    v = f.T @ f / n
    e, q = np.linalg.eigh(v)
    e, q = e[::-1], q[:, ::-1]
    out = []
    for i, x in xs:
        for c in range(min(components, width)):
            y = float((np.array(x) - np.array(s) / n) @ q[:, c] / math.sqrt(e[c])) if e[c] > 1e-9 else None
            out.append((i, c + 1, n, sum((n * a - b) ** 2 for a, b in zip(x, s)), y, e[c] / np.trace(v) if np.trace(v) else None))
    return out


def run(spark, rows):
    d = spark.createDataFrame([(*r, 1, 2) for r in rows], "vec_id bigint, embedding array<float>, x int, n int")
    return [tuple(r) for r in W.whiten(d).collect()]


def compare(spark, rows):
    order = lambda r: (r[0] is None, r[0] or 0, r[1], r[3])
    got, want = sorted(run(spark, rows), key=order), sorted(plain(rows), key=order)
    assert [g[:4] for g in got] == [w[:4] for w in want]
    for c in {g[1] for g in got}:
        g, w = ([r for r in t if r[1] == c] for t in (got, want))
        assert all((a[4] is None) == (b[4] is None) for a, b in zip(g, w))
        a, b = (np.array([r[4] or 0.0 for r in t]) for t in (g, w))
        assert min(np.abs(a - b).max(), np.abs(a + b).max()) < 1e-8
        assert all(x[5] == pytest.approx(y[5], rel=1e-9) for x, y in zip(g, w))
    return got


def test_equals_plain_eigen(spark, monkeypatch):
    monkeypatch.setattr(W, "ROWS", 16)
    r = np.random.default_rng(0)
    rows = [(i, (r.normal(size=6) * [1, 2, 3, 4, 5, 6]).tolist()) for i in range(200)]
    rows += [(300 + i, [0.25] * 6) for i in range(50)] + [(400, [0.25] * 6)] * 3
    rows += [(500, None), (501, [1.0, None] + [0.0] * 4), (502, [float("nan")] * 6), (503, [float("inf")] * 6), (504, [1.0]), (505, []), (None, [-0.0, 1.0, 2.0, 3.0, 4.0, 5.0])]
    got = compare(spark, rows)
    assert {g[6] for g in got} == {got[0][6]} and got[0][6] < 1e-12
    assert all(g[7] == g[3] for g in got)


def test_few_rows(spark):
    assert run(spark, []) == [] and run(spark, [(1, None)]) == [] and run(spark, [(1, [])]) == []
    one = run(spark, [(1, [1.0, 2.0]), (2, [1.0, 2.0])])
    assert [(r[0], r[1], r[2], r[3], r[4], r[5], r[6]) for r in sorted(one)] == [(i, c, 1, 0, None, None, None) for i in (1, 2) for c in (1, 2)]
    compare(spark, [(1, [1.0, 2.0]), (2, [3.0, 2.0])])


def test_deviations_beyond_64_bits(spark):
    rows = [(0, [1e7, 0.0]), (1, [-1e7, 1.0]), (2, [3.0, 4.0])]
    got = sorted(run(spark, rows))
    want = {(r[0], r[1]): r[3] for r in plain(rows)}
    assert [int(r[7]) for r in got] == [want[r[0], r[1]] for r in got]
    assert [r[3] for r in got] == [None if w >= 2**63 else w for w in map(int, (r[7] for r in got))]
    assert any(r[3] is None for r in got)
    d = spark.createDataFrame([(0, [1e300])], "vec_id bigint, embedding array<double>")
    with pytest.raises(Exception, match="64-bit"):
        W.whiten(d).collect()
