"""What keeps the work of shared steps in proportion to the input: no broadcast of tables that grow, copies counted once."""

import random

import numpy as np
from pyspark.sql import functions as F

from acreage.functions import arrays as A, geometry as G
from acreage.operators import components as C, matching as M, outline as O, patches as P, spatial as J, stencil as T, vectors as V
from acreage.operators.settings import PerKey
from acreage.operators.stencil import Tile, each_block, mosaic_rows, pack_blocks
from acreage.session import materialize, spread


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def boxes(spark, rows):
    """Rows (id, x0, y0, x1, y1) as polygons."""
    d = spark.createDataFrame(rows, "idx bigint, x0 double, y0 double, x1 double, y1 double")
    return d.select("idx", F.array(G.box_ring(F.col("x0"), F.col("y0"), F.col("x1"), F.col("y1"))).alias("rings"))


def test_distance_filter_broadcasts_no_edges_and_counts_copies_once(spark, tmp_path):
    boxes(spark, [(i, 10.0, 10.0, 30.0, 30.0) for i in range(50)]).write.parquet(f"{tmp_path}/polys")
    polys = V.with_bounds(spark.read.parquet(f"{tmp_path}/polys"))
    points = spark.createDataFrame([(0, 20.0, 20.0), (1, 31.5, 20.0), (2, 34.0, 20.0), (3, 100.0, 5.0)], "pid int, x double, y double")
    far = J.far_from_polygons(points, polys, 3.0)
    assert "Broadcast" not in plan_of(far)
    assert {r["pid"] for r in far.collect()} == {2, 3}


def test_box_pairs_broadcast_no_boxes(spark, tmp_path):
    V.with_bounds(boxes(spark, [(i, float(i), 0.0, i + 2.0, 2.0) for i in range(50)])).write.parquet(f"{tmp_path}/polys")
    d = spark.read.parquet(f"{tmp_path}/polys").select("idx", *J.BOX)
    p = J.box_pairs(d, d)
    assert "Broadcast" not in plan_of(p)
    assert {(r["l_idx"], r["r_idx"]) for r in p.collect()} == {(i, k) for i in range(50) for k in range(50) if abs(i - k) <= 2}


def odd_rings(rng):
    """A shell and perhaps holes on a small lattice: many touch, cross, repeat points or stay open."""
    rings = []
    for r in range(rng.choice([1, 1, 2, 3])):
        at = [(float(rng.randint(0, 5)), float(rng.randint(0, 5))) for _ in range(rng.randint(0, 6))]
        if r == 0 and rng.random() < 0.4:
            at = [(0.0, 0.0), (5.0, 0.0), (5.0, 5.0), (0.0, 5.0)]
        elif rng.random() < 0.5:
            x, y = rng.randint(0, 3) + 0.5, rng.randint(0, 3) + 0.5
            at = [(x, y), (x + 1, y), (x + 1, y + 1)]
        at = at[:1] + at if rng.random() < 0.2 else at
        rings.append(at + at[:1] if rng.random() < 0.95 else at)
    return rings


def test_small_polygons_are_judged_in_place_as_large_ones_are_by_cells(spark):
    rng = random.Random(5)
    d = spark.createDataFrame([(i, odd_rings(rng)) for i in range(400)], f"id int, rings {G.RINGS}")
    large = {r["id"] for r in V._invalid_large(d, ["id"]).collect()}
    judged = V.with_validity(d, ["id"], "bad")
    assert 50 < len(large) < 350 and {r["id"] for r in judged.filter("bad").collect()} == large
    assert judged.count() == 400 and "Exchange" not in plan_of(judged)


def test_a_small_file_is_spread_before_geometry(spark, tmp_path):
    spark.range(100).coalesce(1).write.parquet(f"{tmp_path}/t")
    assert spread(spark.read.parquet(f"{tmp_path}/t"), "id").rdd.getNumPartitions() == int(spark.conf.get("spark.sql.shuffle.partitions"))


def test_matching_of_shapes_equals_matching_of_their_polygons(spark):
    rng = random.Random(3)
    rows = [(k, i, *(lambda x, w: (x, 0.0, x + w, 2.0))(float(rng.randint(0, 12)), float(rng.choice([4, 5, 6, 8])))) for k in range(3) for i in range(60)]
    def side(rows):
        d = spark.createDataFrame(rows, "sample int, idx bigint, x0 double, y0 double, x1 double, y1 double")
        return d.select("sample", "idx", F.array(G.box_ring(F.col("x0"), F.col("y0"), F.col("x1"), F.col("y1"))).alias("rings"))
    rng.shuffle(rows)
    gt, pred = side(rows[:95]), side([(k, i, x0 + rng.choice([0.0, 1.0]), y0, x1 + 1.0, y1) for k, i, x0, y0, x1, y1 in rows[60:]])
    (one_gt, gt_of), (one_pred, pred_of) = M.shapes(gt, ["sample"]), M.shapes(pred, ["sample"])
    found = M.match_shapes(M.shape_pairs(one_gt, one_pred, ["sample"]), [gt_of, pred_of], ["sample"])
    got = {tuple(r) for r in M.matched_members(found, [gt_of, pred_of], ["sample"]).select("sample", "pred_idx", "gt_idx").collect()}
    pairs = sorted((r["sample"], -r["iou"], r["pred_idx"], r["gt_idx"]) for r in M.iou_pairs(gt, pred, ["sample"]).collect() if r["iou"] >= 0.5)
    want, used = set(), set()
    for k, _, p, g in pairs:
        if not {(k, "p", p), (k, "g", g)} & used:
            used |= {(k, "p", p), (k, "g", g)}
            want.add((k, p, g))
    assert len(want) > 30 and got == want


def test_clip_of_boxes_is_what_the_general_cut_gives_without_python(spark):
    a = boxes(spark, [(0, 0.0, 0.0, 4.0, 4.0), (1, 3.0, 3.0, 8.0, 5.0), (2, 20.0, 0.0, 22.0, 1.0)])
    z = boxes(spark, [(7, 2.0, -1.0, 6.0, 4.0), (8, 4.0, 0.0, 6.0, 2.0)])
    got = {(r["l_idx"], r["r_idx"], str(r["rings"])) for r in V.clip(a, z).collect()}
    pairs = a.crossJoin(z.select(F.col("idx").alias("z"), F.col("rings").alias("zone"))).select("idx", "z", F.explode(V.intersection(F.col("rings"), F.col("zone"))).alias("cut"))
    assert len(got) == 2 and got == {(r["idx"], r["z"], str(r["cut"])) for r in pairs.collect()}


def test_lines_shuffle_no_pixels(spark):
    p = boxes(spark, [(0, -1.5, 0.0, 2.0, 3.0), (1, 5.0, 5.0, 5.5, 20.0)])
    got = V.lines(p, ["idx"], 10, 8)
    assert "Exchange" not in plan_of(got)
    rows = [tuple(r) for r in got.collect()]
    assert len(rows) == len(set(rows)) and {(r, k) for i, r, k in rows if i == 1} == {(r, 5) for r in (5, 6, 7)}
    assert {(r, k) for i, r, k in rows if i == 0} == {(r, k) for r in range(4) for k in range(3)} - {(1, 0), (2, 0), (1, 1), (2, 1)}


def test_points_inside_are_drawn_without_a_shuffle(spark):
    d = V.with_bounds(boxes(spark, [(i, 0.0, 0.0, 4.0, 4.0) for i in range(20)]))
    got = P.point_inside(d.withColumnRenamed("idx", "pid"), "pid", 21)
    assert "Exchange" not in plan_of(got)
    assert all(0 <= r["px"] <= 4 and 0 <= r["py"] <= 4 for r in got.collect())


def test_windows_of_patches_are_not_broadcast_and_copies_share_a_reading(spark, tmp_path):
    spark.range(40).selectExpr("0 AS raster_id", "'center' AS kind", "id AS attempt", "cast(id % 2 AS int) AS x", "0 AS y", "4 AS w", "4 AS h").write.parquet(f"{tmp_path}/w")
    px = spark.range(64).selectExpr("0 AS raster_id", "cast(id / 8 AS int) AS row_", "cast(id % 8 AS int) AS col_", "1 AS valid", "cast(id % 8 < 2 AS int) AS extent")
    r = P.window_ratios(spark.read.parquet(f"{tmp_path}/w"), px)
    assert "Broadcast" not in plan_of(r)
    got = {x["attempt"]: (x["valid_ratio"], x["mask_ratio"]) for x in r.collect()}
    assert got == {i: (1.0, 0.5 if i % 2 == 0 else 0.25) for i in range(40)}


def test_a_chain_of_joins_does_not_blow_up_the_size_estimate(spark):
    d = spark.createDataFrame([(i, [float(i)]) for i in range(4)], "id bigint, v array<double>")
    for _ in range(6):
        d = materialize(d.join(d.select("id", F.col("v").alias("top")), "id").select("id", F.col("top").alias("v")))
    # Digits double with each join, so that planning a long chain took minutes.
    assert d._jdf.queryExecution().optimizedPlan().stats().sizeInBytes().bit_length() <= 1024
    assert sorted((r["id"], r["v"]) for r in d.collect()) == [(i, [float(i)]) for i in range(4)]


def test_small_blocks_share_calls(spark):
    cells = spark.range(12).select((F.col("id") / 4).cast("int").alias("row_"), (F.col("id") % 4).cast("int").alias("col_"))
    px = spark.range(300).select(F.col("id").cast("int").alias("raster_id")).crossJoin(cells)
    px = px.filter("raster_id % 5 <> row_").withColumn("v", F.expr("raster_id * 100 + row_ * 10 + col_"))
    calls = spark.sparkContext.accumulator(0)

    def own(t):
        calls.add(1)
        y, x = np.nonzero(t.core)
        rows, cols = t.place(y, x)
        return {"row_": rows, "col_": cols, "v": t["v"][y, x], "_y": y}

    def packed(t, row):
        calls.add(1)
        b, y, x = np.nonzero(t.present)
        return {"row_": y + t.row0[b], "col_": x + t.col0[b], "v": t["v"][b, y, x], "_b": b}

    kinds = "row_ int, col_ int, v int"
    want = sorted(px.collect())
    for halo in (0, 1):
        assert sorted(mosaic_rows(px, own, kinds, halo, ["raster_id"], ["v"], 2).collect()) == want
    assert sorted(each_block(pack_blocks(px, ["v"], ["raster_id"], 2), {"v": "int"}, packed, kinds).collect()) == want
    assert calls.value <= 60  # of 3,000 blocks


def holes_filled(lab, limit):
    out = lab.copy()
    for value in np.unique(lab[lab > 0]):
        rest = lab != value
        small = rest & (A.sizes_of(A.label4(rest)) < limit) & (out == 0)
        out[small] = value
    return out


def test_holes_of_many_small_rasters_are_filled_in_shared_calls(monkeypatch):
    r = np.random.default_rng(4)
    labs = [np.where(r.random((8, 8)) < 0.7, r.integers(1, 5, (8, 8)), 0) for _ in range(300)]
    gap, calls, label4 = 3, [], A.label4
    rows = [np.vstack([x, np.zeros((gap, 8), int)]) for x in labs]
    present = np.vstack([np.vstack([np.ones((8, 8), bool), np.zeros((gap, 8), bool)]) for _ in labs])
    of = np.repeat(np.arange(300), 8 + gap)
    limit = np.where(of % 2, 3, 2)[:, None] * np.ones(8, int)
    sheet = np.vstack(rows)
    monkeypatch.setattr(C.A, "label4", lambda v: calls.append(1) or label4(v))
    got = C._fill_holes(Tile({"label": sheet, "_limit": limit}, present, 0, 0, present, {}, np.tile(np.arange(8 + gap), 300), np.zeros(len(of), int), of))
    monkeypatch.undo()
    assert len(calls) <= 10
    for i, lab in enumerate(labs):
        assert (got[of == i][:8] == holes_filled(lab, 3 if i % 2 else 2)).all()


def test_polygons_get_their_edges_without_a_join_and_no_sigma_needs_no_blocks(spark, tmp_path):
    lab = np.array([[1, 1, 1, 2], [1, 0, 1, 2], [1, 1, 1, 0]])
    px = spark.createDataFrame([(0, y, x, int(v)) for (y, x), v in np.ndenumerate(lab)], "raster_id int, row_ int, col_ int, label int")
    made = O.polygonize(px)
    assert "Join" not in plan_of(made)
    assert sorted((r["label_id"], len(r["rings"])) for r in made.collect()) == [(1, 2), (2, 1)]
    v = spark.createDataFrame([(0, 0, 0, 1.5, 1), (0, 0, 1, -1.0, 1), (0, 0, 2, 0.25, 0), (0, 0, 3, 0.25, 1)], "raster_id int, row_ int, col_ int, v double, ok int")
    flat = T.smooth(v, ["v"], 0.0, "ok")
    assert "Exchange" not in plan_of(flat) and [r["v"] for r in flat.orderBy("col_").collect()] == [1.0, 0.0, 0.0, 0.25]


def test_polygons_pass_python_without_a_queue_of_their_rows(spark, monkeypatch):
    """Beside an Arrow UDF the rows of a task wait in a queue in the JVM; simplification, validity, repair and turning let them pass through Python whole."""
    plans, keep = [], V.materialize
    monkeypatch.setattr(V, "materialize", lambda d: plans.append(plan_of(d)) or keep(d))
    angle = np.linspace(0, 2 * np.pi, 401)[:-1]
    close = lambda x, y: [[{"x": float(a), "y": float(b)} for a, b in zip([*x, x[0]], [*y, y[0]])]]
    circle, eight = close(np.cos(angle), np.sin(angle)), close(np.sin(angle + 0.001), np.sin(2 * angle + 0.002))
    bent = close([0, 1, 2, 2, 0], [0, -0.05, 0, 2, 2])
    bow = close([0, 1, 2, 0, 2], [0, -0.05, 0, 2, 2])
    rows = [(0, circle, 1e-9, "a"), (1, eight, 1e-9, "b"), (2, bent, 0.2, "c"), (3, bow, 0.2, "d"), (4, bent, 0.0, "e"), (5, bent, -1.0, None), (6, circle, 0.05, "g")]
    polys = spark.createDataFrame(rows, f"idx int, rings {G.RINGS}, tol double, name string")
    got = {r["idx"]: r for r in V.simplify(polys, ["idx"], PerKey.of("idx", {i: tol for i, _, tol, _ in rows})).collect()}
    assert len(got) == len(rows) and all(got[i]["name"] == name and got[i]["tol"] == tol for i, _, tol, name in rows)
    points = {i: len(r["rings"][0]) for i, r in got.items()}
    assert (points[0], points[1], points[2], points[3], points[4], points[5]) == (401, 401, 5, 6, 6, 6) and points[6] < 40
    bad = {r["idx"] for r in V.with_validity(polys, ["idx"]).filter("was_invalid").collect()}
    assert bad == {1, 3}
    fixed = V.repair(polys.filter("idx > 1"), ["idx"]).cache()
    assert {r["idx"]: r["n"] for r in fixed.groupBy("idx").agg(F.count("*").alias("n")).collect()} == {2: 1, 3: 2, 4: 1, 5: 1, 6: 1}
    plans += [plan_of(V.repair(polys, ["idx"])), plan_of(V.straighten(polys, 90.0))]
    assert sum("MapInArrow" in p for p in plans) >= 4 and not any("ArrowEvalPython" in p for p in plans)


def test_pairs_become_rows_of_polygons_last(spark, monkeypatch):
    """Shapes of many polygons, in several packs: all pairs, and nothing is shuffled or joined once they are listed."""
    from acreage.functions import geometry as G
    from acreage.operators import matching as M

    monkeypatch.setattr(M.packs, "__defaults__", ((), 3))
    boxes = [(k, 4.0 * (k % 2), 0.0, 4.0 * (k % 2) + 6, 5.0) for k in range(20)]
    side = lambda shift: spark.createDataFrame([(k, x0 + shift, y0, x1 + shift, y1) for k, x0, y0, x1, y1 in boxes], "idx bigint, x0 double, y0 double, x1 double, y1 double").select(
        "idx", F.array(G.box_ring(F.col("x0"), F.col("y0"), F.col("x1"), F.col("y1"))).alias("rings"))
    found = M.iou_pairs(side(0.0), side(1.0)).select("pred_idx", "gt_idx", "inter")
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert min(plan.index("Generate"), len(plan)) < min(plan.index(w) for w in ("Repartition", "Join") if w in plan)
    got = sorted((r["pred_idx"], r["gt_idx"], r["inter"]) for r in found.collect())
    cross = lambda p, g: 5.0 * max(0.0, min(p[3] + 1, g[3]) - max(p[1] + 1, g[1]))
    assert got == sorted((p[0], g[0], cross(p, g)) for p in boxes for g in boxes if cross(p, g) > 0)


def test_intersections_of_shifted_pairs_are_worked_out_once():
    from acreage.operators import overlay as O, vectors as V

    ring = lambda x0, y0, x1, y1: [{"x": float(x), "y": float(y)} for x, y in ((x0, y0), (x1, y0), (x1, y1), (x0, y1), (x0, y0))]
    before = V._common_at_origin.cache_info().misses
    for dx, dy in ((0, 0), (100, 7), (-3, 2**30), (0.5, 0.25)):
        for reach in (20, 90):
            a = [ring(3 + dx, 3 + dy, 12 + dx, 10 + dy), ring(4 + dx, 4 + dy, 11 + dx, 9 + dy)]
            b = [ring(dx - reach, dy - reach, 8 + dx, 6 + dy)]
            assert V._common(a, b) == O.common(a, b)
    assert V._common_at_origin.cache_info().misses - before <= 2
    tiny = [ring(0.1, 1e-17, 5.3, 4.7)]
    assert V._common(tiny, [ring(1, 1, 9, 9)]) == O.common(tiny, [ring(1, 1, 9, 9)])
    assert V._common([], [ring(1, 1, 9, 9)]) == O.common([], [ring(1, 1, 9, 9)])
