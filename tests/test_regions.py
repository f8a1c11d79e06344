import numpy as np
import pytest
from helpers import clean_serial, flood, forest_serial, merge_serial, to_array, to_px

from acreage.functions import arrays as A
from acreage.operators import components as C, distance as D, outline as O, regions as R, stencil as T

RNG = np.random.default_rng(5)


@pytest.mark.parametrize("density", [0.35, 0.6])
def test_components_across_blocks(spark, density):
    m = (RNG.random((23, 19)) < density).astype(np.int32)
    got = to_array(C.connected_components(to_px(spark, m=m), "m", block=4), "label", m.shape)
    assert (got == flood(m)).all()


def test_spiral_is_one_component(spark):
    m = np.zeros((17, 17), dtype=np.int32)
    top, left, bottom, right = 0, 0, 16, 16
    while top <= bottom and left <= right:
        m[top, left:right + 1] = 1
        m[top:bottom + 1, right] = 1
        m[bottom, left + 2:right + 1] = 1
        m[top + 2:bottom + 1, left + 2 if left + 2 <= right else right] = 1
        top, left, bottom, right = top + 2, left + 2, bottom - 2, right - 2
    got = to_array(C.connected_components(to_px(spark, m=m), "m", block=3), "label", m.shape)
    assert (got == flood(m)).all()


def test_size_filters_match_global_components(spark):
    m = (RNG.random((30, 30)) < 0.5).astype(np.int32)
    lab = flood(m)
    keep = np.array([[m[r, k] and (lab == lab[r, k]).sum() >= 5 for k in range(30)] for r in range(30)]).astype(int)
    got = to_array(C.remove_small_objects(to_px(spark, m=m), "m", 5, block=8), "kept", m.shape)
    assert (got == keep).all()


def test_merge_small_follows_serial_order(spark):
    lab = np.kron(RNG.integers(0, 9, (4, 4)), np.ones((3, 3), dtype=int)).astype(np.int32)
    lab[RNG.random(lab.shape) < 0.2] = 0
    got = to_array(C.merge_small_exact(to_px(spark, label=lab), 12, block=5), "label", lab.shape)
    assert (got == merge_serial(lab, 12)).all()


def test_fill_holes_exact_blocks(spark):
    lab = np.zeros((20, 20), dtype=np.int32)
    lab[2:9, 2:9] = 4
    lab[4:6, 4:6] = 0
    lab[12:18, 3:15] = 2
    lab[14, 5] = 0
    got = to_array(C.fill_holes_exact(to_px(spark, label=lab), 5, block=6), "label", lab.shape)
    want = lab.copy()
    want[4:6, 4:6], want[14, 5] = 4, 2
    assert (got == want).all()


def test_clean_labels_serial_twin(spark):
    lab = flood((RNG.random((20, 20)) < 0.55).astype(int)).astype(np.int32)
    got = to_array(C.clean_labels(to_px(spark, label=lab), 3, 3, 4, "exact", block=8), "label", lab.shape)
    assert (got == clean_serial(lab, 3, 3, 4)).all()


def test_distance_brute_force(spark):
    m = (RNG.random((13, 21)) < 0.8).astype(np.int32)
    bg = np.argwhere(m == 0)
    want = np.array([[((bg - (r, k)) ** 2).sum(1).min() for k in range(21)] for r in range(13)])
    assert (to_array(D.distance_to_background(to_px(spark, m=m), "m"), "d2", m.shape) == want).all()


def brute_nearest(target, value):
    at = np.argwhere(target == 1)
    out = np.empty(target.shape, dtype=object)
    for r, k in np.ndindex(target.shape):
        d, y, x = min(((r - y) ** 2 + (k - x) ** 2, y, x) for y, x in at.tolist())
        out[r, k] = (d, y, x, int(value[y, x]))
    return out


@pytest.mark.parametrize("block", [3, 7, 64])
@pytest.mark.parametrize("kind", ["dense", "sparse", "one", "diagonal", "border"])
def test_nearest_across_blocks(spark, block, kind):
    h, w = 19, 16
    t = {"dense": RNG.random((h, w)) < 0.3, "sparse": RNG.random((h, w)) < 0.03, "one": np.zeros((h, w)), "diagonal": np.eye(h, w), "border": np.zeros((h, w))}[kind].astype(np.int32)
    t[(17, 2) if kind != "border" else (0, slice(0, 5))] = 1
    v = RNG.integers(1, 100, (h, w)).astype(np.int32)
    px = to_px(spark, t=t, v=v).filter("row_ != 5 OR col_ != 9 OR t = 1")
    got = D.nearest(px, "t", "v", keep=["v"], block=block).collect()
    want = brute_nearest(t, v)
    assert len(got) == px.count()
    assert all((r.d2, r.near_row, r.near_col, r.near_value) == want[r.row_, r.col_] and r.v == v[r.row_, r.col_] for r in got)


def test_row_pass_across_blocks(spark):
    t = (RNG.random((9, 17)) < 0.15).astype(np.int32)
    for r in D.row_pass(to_px(spark, t=t, v=t + 1), "t", block=4).collect():
        hit = np.flatnonzero(t[r.row_]).tolist()
        assert (r.left_, r.right_, r.v) == (max((x for x in hit if x <= r.col_), default=None), min((x for x in hit if x >= r.col_), default=None), t[r.row_, r.col_] + 1)


def test_distance_without_background_is_null(spark):
    assert D.distance_to_background(to_px(spark, m=np.ones((3, 3), dtype=np.int32)), "m").filter("distance IS NOT NULL").count() == 0


def test_peaks_keep_spacing(spark):
    v = np.ones((9, 9))
    v[2, 2] = v[2, 3] = v[7, 7] = 5.0
    px = to_px(spark, v=v, inside=np.ones((9, 9), dtype=np.int32))
    got = {(r["row_"], r["col_"]) for r in D.local_maxima(px, "v", 2, "inside", block=4).collect()}
    assert got == {(2, 2), (7, 7)}


def test_region_grow_blocks_agree_and_cover(spark):
    e = RNG.random((18, 18))
    m = np.zeros((18, 18), dtype=np.int32)
    m[3, 3], m[14, 4], m[8, 15] = 1, 2, 3
    inside = np.ones((18, 18), dtype=np.int32)
    px = to_px(spark, e=e, m=m, inside=inside)
    small = to_array(R.region_grow(px, "e", "m", "inside", line=False, block=5), "label", e.shape)
    whole = to_array(R.region_grow(px, "e", "m", "inside", line=False, block=64), "label", e.shape)
    assert (small == whole).all() and set(small.ravel()) == {1, 2, 3}
    for v in (1, 2, 3):
        assert flood((small == v).astype(int)).max() == 1


@pytest.mark.parametrize("block", [3, 8, 64])
@pytest.mark.parametrize("kind", ["distinct", "plateaus", "holes"])
def test_region_grow_is_the_rooted_forest(spark, block, kind):
    rng = np.random.default_rng(11)
    h, w = 17, 21
    e = rng.random((h, w)) if kind == "distinct" else np.round(rng.random((h, w)) * 3)
    then = np.round(rng.random((h, w)) * 5) if kind == "plateaus" else np.zeros((h, w))
    inside = (rng.random((h, w)) < (0.75 if kind == "holes" else 0.97)).astype(np.int32)
    m = np.where(rng.random((h, w)) < 0.04, rng.integers(1, 9, (h, w)), 0).astype(np.int32) * inside
    px = to_px(spark, e=e, m=m, inside=inside, then=then)
    got = to_array(R.region_grow(px, "e", "m", "inside", line=False, block=block, then="then"), "label", e.shape)
    assert (got == forest_serial(e, m, inside, then)).all()


def test_region_grow_rounds_are_logarithmic(spark, monkeypatch):
    """One marker at the end of a strip that rises away from it and runs through 48 blocks."""
    e = np.arange(96, dtype=float)[None, :]
    m = np.zeros((1, 96), dtype=np.int32)
    m[0, 0] = 7
    rounds = []
    monkeypatch.setattr(R, "_minimum_pairs", lambda *a, f=R._minimum_pairs: (rounds.append(1), f(*a))[1])
    for energy in (e, -e):
        rounds.clear()
        got = to_array(R.region_grow(to_px(spark, e=energy, m=m, inside=np.ones((1, 96), dtype=np.int32)), "e", "m", "inside", line=False, block=2), "label", e.shape)
        assert (got == 7).all() and len(rounds) <= 7


def test_polygon_area_is_pixel_count(spark):
    from pyspark.sql import functions as F

    from acreage.functions.geometry import polygon_area
    lab = RNG.integers(0, 3, (16, 16)).astype(np.int32)
    polys = O.polygonize(to_px(spark, label=lab), block=5).select("label_id", polygon_area(F.col("rings")).alias("a"))
    area = {r["label_id"]: r["s"] for r in polys.groupBy("label_id").agg(F.sum("a").alias("s")).collect()}
    assert area == {v: float((lab == v).sum()) for v in (1, 2)}
    assert polys.count() == sum(flood((lab == v).astype(int)).max() for v in (1, 2))


def test_band_around_invalid_block(spark):
    v = np.ones((7, 7), dtype=np.int32)
    v[2:5, 2:5] = 0
    got = to_array(T.near_invalid(to_px(spark, valid=v), "valid", 1, block=3), "near", v.shape)
    assert got[3, 3] == 0 and got[1, 1] == 1 and got[0, 0] == 0 and got.sum() == 16


def test_two_disk_shapes():
    assert len(A.disk(2)) == 13 and len(A.ellipse(2)) == 17


def test_smoothing_block_size_does_not_matter(spark):
    p = RNG.random((20, 20))
    px = to_px(spark, p=p)
    a = to_array(T.smooth(px, ["p"], 1.2, block=7), "p", p.shape).astype(float)
    b = to_array(T.smooth(px, ["p"], 1.2, block=64), "p", p.shape).astype(float)
    assert np.allclose(a, b)
