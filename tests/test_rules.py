import math

import numpy as np
import pyarrow as pa
import pytest
from helpers import as_rings, ring_around, slab_area, to_array, to_px
from pyspark.sql import functions as F

from acreage.functions import arrays as A, geometry as G, scalars as S
from acreage.operators import budget as B, masks as M, matching as X, postprocess as P, search as Q, spatial as J, splits as SP, stencil as T, vectors as V
from acreage.session import number_rows, top_per_group
from acreage.sources import catalog as K


def one(spark, *cols):
    return spark.range(1).select(*cols).first()


def test_valid_rules(spark):
    b1, b2 = np.array([[65536., 1.], [65536., 65536.]]), np.array([[65536., 1.], [2., 65536.]])
    px = to_px(spark, b1=b1, b2=b2).withColumn("a", M.valid_all_bands([F.col("b1"), F.col("b2")], 65536)).withColumn("c", M.valid_control([F.col("b1"), F.col("b2")], 1, 65536))
    assert to_array(px, "a", (2, 2)).tolist() == [[0, 1], [1, 0]]
    assert to_array(px, "c", (2, 2)).tolist() == [[0, 1], [0, 0]]
    with pytest.raises(ValueError):
        M.valid_control([F.col("b1")], 3, 65536)


def test_ignore_policy(spark):
    px = to_px(spark, e=np.array([[0, 1], [1, 0]]), v=np.array([[1, 0], [1, 0]])).withColumn("o", M.ignore_where_invalid(F.col("e"), F.col("v"), 255))
    assert to_array(px, "o", (2, 2)).tolist() == [[0, 255], [1, 255]]


def test_budget_numbers(spark):
    i = spark.createDataFrame([("a", 1e6, 0.8, 3e5, 5000.0)], "dataset string, raster_area double, valid_ratio double, field_area double, boundary_len double")
    r = B.auto_budget(i, 100, 100, 0.2, 0.6, 0.4, 0.5, 100.0, 10, 0).first()
    assert (r["estimated_total_capacity"], r["estimated_center_capacity"], r["estimated_boundary_capacity"], r["estimated_negative_capacity"], r["effective_stride_px"], r["skipped"]) == (62, 30, 50, 50, 100.0, False)
    r = B.auto_budget(i, 100, 100, 0.2, 0.6, 0.4, 0.5, 100.0, 70, 0).first()
    assert (r["estimated_total_capacity"], r["estimated_total_target"], r["skipped"]) == (62, 0, True)


def test_even_sample_first_and_last(spark):
    got = [r["id"] for r in spark.range(50).filter(Q.evenly(F.col("id"), F.lit(50), 7)).orderBy("id").collect()]
    assert len(got) == 7 and got[0] == 0 and got[-1] == 49


def test_refine_neighbours(spark):
    top = spark.createDataFrame([(0.5, 0.45)], "a double, b double")
    got = Q.refine(top, {"a": [0.45, 0.5, 0.55], "b": [0.35, 0.45, 0.55]}, top, 1)
    assert got.count() == 4


def test_unique_ids_with_taken_suffix(spark):
    d = spark.createDataFrame([(1, "My Scene.tif"), (2, "My@Scene.tiff"), (3, "a.tif"), (4, "A.tiff"), (5, "a_2.tif")], "n int, file string")
    got = {r["n"]: r["sample_id"] for r in K.unique_ids(d, "file", "n").collect()}
    assert sorted([got[1], got[2]]) == ["my_scene", "my_scene_2"]
    assert (got[3], got[4], got[5]) == ("a", "a_2", "a_2_2")


def test_blend_weights(spark):
    g = spark.range(81).select(S.gaussian_weight(F.floor(F.col("id") / 9), F.col("id") % 9, F.lit(9), F.lit(9), 0.3, 0.05).alias("w"))
    w = [r["w"] for r in g.collect()]
    assert max(w) == pytest.approx(1.0) and w[40] == max(w) and min(w) == pytest.approx(0.05)


def test_seed_bytes(spark):
    import hashlib
    want = (123 + int.from_bytes(hashlib.sha256(b"first").digest()[:8], "little")) % (2**63 - 1)
    assert one(spark, S.dataset_seed(F.lit("first"), 123).alias("s"))["s"] == want


def test_number_rows_per_group(spark):
    d = spark.range(1000).select((F.col("id") % 3).alias("g"), F.col("id"))
    got = number_rows(d, ["id"], "rn", ["g"])
    assert got.filter(F.col("rn") != F.floor(F.col("id") / 3) + 1).count() == 0


def test_top_per_group_hot_key(spark):
    d = spark.range(5000).select(F.when(F.col("id") % 10 == 0, 1).otherwise(0).alias("g"), "id")
    got = top_per_group(d, ["g"], ["id"], 7, ["id"]).groupBy("g").agg(F.count("*").alias("n"), F.sum("id").alias("s")).collect()
    assert {(r["g"], r["n"], r["s"]) for r in got} == {(1, 7, 210), (0, 7, 28)}


def test_box_pairs_with_crowded_cells(spark):
    d = spark.range(400).select(F.col("id").alias("k"), (F.col("id") * 7 % 40).cast("double").alias("x0"), (F.col("id") * 11 % 30).cast("double").alias("y0"))
    d = d.withColumn("x1", F.col("x0") + 1 + F.col("k") % 5).withColumn("y1", F.col("y0") + 1 + F.col("k") % 3)
    got = {(r["l_k"], r["r_k"]) for r in J.box_pairs(d, d, cell=16.0, hot=50, fan=4, depth=2).collect()}
    rows = d.collect()
    want = {(a["k"], b["k"]) for a in rows for b in rows if a["x0"] <= b["x1"] and b["x0"] <= a["x1"] and a["y0"] <= b["y1"] and b["y0"] <= a["y1"]}
    assert got == want


def test_tiny_hot_cells_keep_each_pair_once(spark):
    d = spark.range(60).select(F.col("id").alias("k"), F.lit(1.0).alias("x0"), F.lit(1.0).alias("y0"), F.lit(2.0).alias("x1"), F.lit(2.0).alias("y1"))
    assert J.box_pairs(d, d, cell=8.0, hot=10, fan=2, depth=2).count() == 3600


@pytest.mark.parametrize("pairs", [1 << 21, 60])
def test_overlap_of_general_polygons(monkeypatch, pairs):
    monkeypatch.setattr(V, "EDGE_PAIRS", pairs)
    rng = np.random.default_rng(2)
    a, b = [], []
    for i in range(60):
        shell = ring_around(rng, 1e5, 1e5, 7 + i % 5)
        hole = [(1e5 + x, 1e5 + y) for x, y in ((-0.2, -0.2), (0.3, -0.2), (0.1, 0.3))]
        other = ring_around(rng, 1e5 + 3 * rng.random(), 1e5 + 3 * rng.random(), 6)
        a.append(as_rings(shell[:: 1 if i % 2 else -1], *([hole] if i % 3 == 0 and min(np.hypot(x - 1e5, y - 1e5) for x, y in shell) > 1 else [])))
        b.append(as_rings(other[:: -1 if i % 4 else 1]))
    a += [as_rings([(0, 0), (4, 0), (0, 4)]), as_rings([(0, 0), (2, 0), (2, 2), (0, 2)]), None, as_rings([(0, 0), (1, 0), (1, 1), (0, 1)])]
    b += [as_rings([(0, 0), (2, 0), (2, 2), (0, 2)]), as_rings([(0, 0), (2, 0), (2, 2), (0, 2)]), as_rings([(0, 0), (1, 0), (1, 1)]), as_rings([(1, 0), (2, 0), (2, 1), (1, 1)])]
    kind = V._ARROW[G.RINGS]
    got = V.overlap_areas(pa.array(a, kind), pa.array(b, kind))
    # A triangle at the middle is inside a star-shaped ring only if no chord of the ring cuts it; take pairs where it is.
    want = [0.0 if x is None else slab_area(x, y) for x, y in zip(a, b)]
    valid = [x is None or len(x) == 1 or slab_area(x, as_rings([(p["x"], p["y"]) for p in x[1][:-1]])) == pytest.approx(0, abs=1e-9) for x in a]
    assert sum(valid) > 50
    for g, w, ok in zip(got, want, valid):
        if ok:
            assert g == pytest.approx(w, abs=1e-8)


def test_greedy_match_serial(spark):
    rng = np.random.default_rng(3)
    pairs = [(int(p), int(g), float(i)) for p, g, i in zip(rng.integers(0, 25, 150), rng.integers(0, 25, 150), rng.random(150).round(2))]
    pairs = list({(p, g): (p, g, i) for p, g, i in pairs}.values())
    d = spark.createDataFrame(pairs, "pred_idx int, gt_idx int, iou double")
    got = {(r["pred_idx"], r["gt_idx"]) for r in X.greedy_match(d, [], 0.3).collect()}
    used_p, used_g, want = set(), set(), set()
    for p, g, i in sorted(pairs, key=lambda t: (-t[2], t[0], t[1])):
        if i >= 0.3 and p not in used_p and g not in used_g:
            used_p.add(p), used_g.add(g), want.add((p, g))
    assert got == want


def test_score_special_cases(spark):
    s = spark.createDataFrame([("none",), ("only_gt",), ("only_pred",)], "sample string")
    gt = spark.createDataFrame([("only_gt", 2, 5.0)], "sample string, gt_count int, gt_area double")
    pr = spark.createDataFrame([("only_pred", 3, 5.0, 1, 0)], "sample string, pred_count int, pred_area double, holes_penalty int, invalid_geometries int")
    pairs = spark.createDataFrame([], "sample string, pred_idx int, gt_idx int, inter double, iou double, gt_area double")
    r = {x["sample"]: x for x in X.score(s, gt, pr, pairs, ["sample"]).collect()}
    assert r["none"]["f1"] == 1.0 and r["only_gt"]["fn"] == 2 and r["only_gt"]["f1"] == 0.0 and r["only_pred"]["fp"] == 3


def test_split_keeps_groups_whole_and_shares_near_target(spark):
    recs = spark.range(300).select(F.col("id").alias("ord"), F.concat(F.lit("p"), F.col("id")).alias("patch_id"), F.concat(F.lit("g"), F.col("id") % 90).alias("gk"))
    old = spark.createDataFrame([("p0", "test"), ("p1", "validation")], "patch_id string, split string")
    a = SP.assign_records(recs, old, (0.7, 0.2, 0.1), 5).cache()
    assert a.groupBy("gk").agg(F.countDistinct("split").alias("n")).filter("n > 1").count() == 0
    assert a.filter("gk = 'g0'").select("split").distinct().first()["split"] == "test"
    done = old.unionByName(a.select("patch_id", "split"))
    got = {r["split"]: r["count"] for r in done.groupBy("split").count().collect()}
    largest = a.groupBy("gk").count().agg(F.max("count")).first()[0]
    assert all(abs(got[s] - n) <= 2 * largest for s, n in (("train", 210), ("validation", 60), ("test", 30)))
    assert SP.assign_records(recs, done, (0.7, 0.2, 0.1), 5).count() == 0


def test_early_exit(spark):
    z = np.zeros((4, 4))
    px = to_px(spark, 1, extent_prob=z + .9, boundary_prob=z, valid=np.zeros((4, 4), dtype=np.int32)).unionByName(
        to_px(spark, 2, extent_prob=z + .2, boundary_prob=z, valid=np.ones((4, 4), dtype=np.int32)))
    got = {r["raster_id"]: r["exit_reason"] for r in P.exit_reason(px, P.Params()).collect()}
    assert got == {1: "all_invalid", 2: "no_extent_above_threshold"}
    assert P.postprocess(px, P.Params()).count() == 0


def test_postprocess_two_fields(spark):
    e = np.full((24, 24), 0.1)
    e[2:10, 2:22], e[13:22, 2:22] = 0.95, 0.95
    b = np.zeros((24, 24))
    b[:, 11:13] = 0.9
    px = to_px(spark, extent_prob=e, boundary_prob=b, valid=np.ones((24, 24), dtype=np.int32))
    got = P.postprocess(px, P.Params(sigma=0.0, dilate_px=0, erode_px=1, seed_distance=3, use_watershed=False, min_px=4))
    assert got.count() == 4 and sorted(r["area_m2"] for r in got.collect()) == [72.0, 72.0, 81.0, 81.0]


def test_empty_band_gives_nan(spark):
    from acreage.plans.stencils import near_metrics
    z = np.zeros((6, 6))
    i = lambda v: np.full((6, 6), v, dtype=np.int32)
    px = to_px(spark, boundary_prob=z + .4, boundary_gt=i(0), valid=i(1), extent_prob=z + .4, extent_gt=i(1))
    r = near_metrics(px).first()
    assert r["near_frac"] == 0.0 and math.isnan(r["iou"]) and math.isnan(r["boundary_f1"]) and math.isnan(r["gap"])


def test_lines_keep_shared_border(spark):
    boxes = spark.createDataFrame([(1, 2., 2., 16., 20.), (2, 16., 2., 30., 20.)], "k int, x0 double, y0 double, x1 double, y1 double")
    polys = boxes.select("k", F.array(G.box_ring(F.col("x0"), F.col("y0"), F.col("x1"), F.col("y1"))).alias("rings"))
    line = V.lines(polys, ["k"], 32, 32).select("row_", "col_").distinct()
    inner = line.filter("col_ = 16 AND row_ BETWEEN 4 AND 18").count()
    px = spark.range(1024).select(F.lit(0).alias("raster_id"), F.floor(F.col("id") / 32).cast("int").alias("row_"), (F.col("id") % 32).cast("int").alias("col_"))
    burnt = V.fill(polys, ["k"], 32, 32).select("row_", "col_", F.lit(1).alias("m")).distinct()
    ext = px.join(burnt, ["row_", "col_"], "left").withColumn("m", F.coalesce("m", F.lit(0)))
    grad = T.gradient(ext, "m").filter("edge = 1 AND col_ = 16 AND row_ BETWEEN 4 AND 18").count()
    assert inner == 15 and inner >= grad + 8


def test_utm_round_trip(spark):
    d = spark.createDataFrame([(9.0, 0.0), (11.5, 48.1), (-70.6, -33.4)], "lon double, lat double").withColumn("z", F.floor((F.col("lon") + 180) / 6) + 1).withColumn("s", F.col("lat") < 0)
    x, y = G.utm_forward(F.col("lon"), F.col("lat"), F.col("z"), F.col("s"))
    d = d.withColumn("x", x).withColumn("y", y)
    lon, lat = G.utm_inverse(F.col("x"), F.col("y"), F.col("z"), F.col("s"))
    rows = d.select("lon", "lat", "x", "y", lon.alias("lo"), lat.alias("la")).collect()
    assert rows[0]["x"] == pytest.approx(500000.0, abs=1e-3) and rows[0]["y"] == pytest.approx(0.0, abs=1e-3)
    assert all(abs(r["lo"] - r["lon"]) < 1e-7 and abs(r["la"] - r["lat"]) < 1e-7 for r in rows)


def test_manifest_missing_key_fails(spark, tmp_path):
    p = tmp_path / "m.json"
    p.write_text('{"dataset": "a"}\n')
    with pytest.raises(Exception):
        K.read_manifest(spark, str(p), K.CHECK_MANIFEST, ["dataset", "qa_ok"]).collect()


def test_thinning_keeps_line():
    m = np.zeros((9, 12), dtype=bool)
    m[3:6, 1:11] = True
    t = A.thin(m)
    assert 0 < t.sum() <= 10 and t.sum(axis=0).max() == 1


def test_a_failed_raster_is_tried_again_and_others_go_on(spark, tmp_path):
    from acreage.streaming import jobs

    px = spark.createDataFrame([(r, i) for r in range(6) for i in range(3)], "raster_id int, v int")
    px.write.parquet(str(tmp_path / "in"))
    broken = {3}

    def process(rows):
        if rows.filter(F.col("raster_id").isin(list(broken) or [-1])).count():
            raise ValueError("cannot read raster")
        return rows.groupBy("raster_id").agg(F.sum("v").alias("total"))

    def run():
        jobs.raster_intake(spark, str(tmp_path / "in"), "raster_id int, v int", str(tmp_path / "out"), str(tmp_path / "ckpt"), process)
        status = {r["raster_id"]: (r["status"], r["error"]) for r in jobs.latest_status(spark, str(tmp_path / "out")).collect()}
        done = spark.read.option("recursiveFileLookup", "true").parquet(str(tmp_path / "out/results"))
        return status, sorted(map(tuple, done.collect()))

    status, done = run()
    assert status == {r: ("failed", "cannot read raster") if r == 3 else ("ok", "") for r in range(6)}
    assert done == [(r, 3) for r in range(6) if r != 3]
    broken.clear()
    status, done = run()
    assert set(status.values()) == {("ok", "")} and done == [(r, 3) for r in range(6)]


def test_a_patch_beyond_its_side_is_an_error(spark):
    from acreage.operators.labels import skeletonize

    px = spark.createDataFrame([(1, 0, 0, 1), (1, 5, 0, 1)], "win int, row_ int, col_ int, m int")
    assert skeletonize(px, "m", ["win"], side=6).count() == 2
    with pytest.raises(Exception, match="beyond its side"):
        skeletonize(px, "m", ["win"], side=5).count()


def test_trials_are_scored_by_the_whole_flow(spark):
    r = np.random.default_rng(4)
    wave = np.sin(np.arange(20) / 2.5)
    field = np.clip(0.5 + 0.4 * np.outer(wave, wave) + r.normal(0, 0.12, (20, 20)), 0, 1)
    px = to_px(spark, 1, extent_prob=field, boundary_prob=1 - field, valid=np.ones((20, 20), dtype=np.int32), gt=(field > 0.6).astype(np.int32))
    base = dict(extent_thr=0.5, boundary_thr=0.7, sigma=0.0, dilate_px=0, use_watershed=False)
    changes = [{}, {"extent_thr": 0.65}, {"boundary_thr": 0.55}, {"min_px": 6}, {"min_area": 9.0}, {"opening_px": 1}]
    trials = [(i, P.Params(**{**base, **c})) for i, c in enumerate(changes)]
    got = {x["trial"]: x for x in P.evaluate_trials(px, trials).collect()}
    for i, p in trials:
        polys = P.postprocess(px.drop("gt"), p).collect()
        assert got[i]["pred_count"] == len(polys) and got[i]["holes_penalty"] == sum(len(x["rings"]) - 1 for x in polys)
    assert len({(x["pred_count"], x["tp"], x["area_f1"]) for x in got.values()}) >= 4
    with pytest.raises(TypeError):
        P.search_params(px, {"no_such": [1, 2]}, 2, 1, 1)


def test_numbers_of_null_groups(spark):
    d = spark.createDataFrame([(None, 3), (None, 1), (5, 2), (5, 1), (None, 2)], "g int, v int")
    got = sorted(((r.g is None, r.g, r.v, r.rn) for r in number_rows(d, ["v"], "rn", ["g"]).collect()), key=str)
    assert got == sorted([(True, None, 1, 1), (True, None, 2, 2), (True, None, 3, 3), (False, 5, 1, 1), (False, 5, 2, 2)], key=str)
