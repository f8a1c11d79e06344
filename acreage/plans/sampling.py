"""Sampling, label layers, patch assembly and splits."""

from __future__ import annotations

from pyspark.sql import functions as F

from acreage.functions import arrays as A, geometry as G
from acreage.functions.scalars import draw, draw_int
from acreage.operators import augment as U, labels as L, masks as M, patches as P, spatial as X, splits as SP, vectors as V
from acreage.operators.statistics import band_percentiles
from acreage.plans.registry import draw_sql, fixture, query, table
from acreage.plans.stencils import hits
from acreage.plans.vectors import FILL, HEIGHT, IDS, INSIDE, W, polygons, scene_height
from acreage.session import join_checked, materialize, number_rows

c = F.col


def pid():
    """Number of a polygon part. Made when it is called: columns need a session, importing a module must not."""
    return c("feat_index") * 2 + c("part")


def requests(spark, sf):
    return V.with_bounds(polygons(spark, sf)).withColumn("pid", pid())


def tries_sql(key, seed, src, extra=""):
    return f"""tr AS (SELECT p.*, t.t, x0 + {draw_sql(key, '10 + 2 * t.t', seed)} * (x1 - x0) AS px, y0 + {draw_sql(key, '11 + 2 * t.t', seed)} * (y1 - y0) AS py FROM {src} p CROSS JOIN generate_series(0, 199) t(t)),
 hit AS (SELECT *, row_number() OVER (PARTITION BY {key} ORDER BY t) AS hn FROM tr p WHERE {INSIDE.format(x='p.px', y='p.py')} {extra})"""


@query("sample_center", f"WITH s AS (SELECT *, feat_index * 2 + part AS pid FROM field_parts), {tries_sql('pid', 21, 's')} SELECT s.pid, round(h.px, 6) AS px, round(h.py, 6) AS py FROM s LEFT JOIN (SELECT * FROM hit WHERE hn = 1) h ON h.pid = s.pid")
def sample_center(spark, sf):
    return P.point_inside(requests(spark, sf), "pid", 21).select("pid", F.round("px", 6).alias("px"), F.round("py", 6).alias("py"))


BOUNDARY_AT = """e AS (SELECT *, sqrt((bx - ax) * (bx - ax) + (by_ - ay) * (by_ - ay)) AS len FROM field_edges), s AS (SELECT *, sum(len) OVER (PARTITION BY feat_index, part ORDER BY ring, i) AS upto, sum(len) OVER (PARTITION BY feat_index, part) AS total FROM e)"""


@query("sample_boundary", f"""
WITH {BOUNDARY_AT}, t AS (SELECT *, feat_index * 2 + part AS pid, {draw_sql('feat_index * 2 + part', '2', 31)} * total AS t FROM s), h AS (SELECT pid, ax + (bx - ax) * (t - (upto - len)) / len AS x, ay + (by_ - ay) * (t - (upto - len)) / len AS y FROM t WHERE t > upto - len AND t <= upto)
SELECT pid, round(x + (2 * {draw_sql('pid', '3', 31)} - 1) * 1.6e0, 6) AS px, round(y + (2 * {draw_sql('pid', '4', 31)} - 1) * 1.6e0, 6) AS py FROM h""")
def sample_boundary(spark, sf):
    """Uniform boundary point, jittered by max(1, a tenth of a 16 px patch)."""
    p = polygons(spark, sf).withColumn("pid", pid())
    p = p.select("pid", G.point_at_length(c("rings"), draw(c("pid"), 2, 31) * G.polygon_perimeter(c("rings"))).alias("b"))
    x, y = P.jitter(c("b.x"), c("b.y"), c("pid"), max(1.0, 0.1 * 16), 31)
    return p.select("pid", F.round(x, 6).alias("px"), F.round(y, 6).alias("py"))


NEG = f"""q AS (SELECT c_custkey AS attempt, CAST(8 + floor({draw_sql('c_custkey', '5', 41)} * ({{w}} - 16 + 1)) AS INT) AS col_, CAST(8 + floor({draw_sql('c_custkey', '6', 41)} * ({{h}} - 16 + 1)) AS INT) AS row_ FROM customer), qq AS (SELECT *, col_ + 0.5e0 AS x, row_ + 0.5e0 AS y FROM q),
 ne AS (SELECT q.attempt FROM qq q JOIN field_edges e ON least(ax, bx) - 3 <= x AND greatest(ax, bx) + 3 >= x AND least(ay, by_) - 3 <= y AND greatest(ay, by_) + 3 >= y,
  LATERAL (SELECT greatest(0e0, least(1e0, ((x - ax) * (bx - ax) + (y - ay) * (by_ - ay)) / ((bx - ax) * (bx - ax) + (by_ - ay) * (by_ - ay)))) AS t) WHERE pow(x - ax - t * (bx - ax), 2) + pow(y - ay - t * (by_ - ay), 2) <= 9),
 ni AS (SELECT q.attempt FROM qq q JOIN field_parts p ON x BETWEEN x0 AND x1 AND y BETWEEN y0 AND y1 WHERE {INSIDE.format(x='q.x', y='q.y')})"""


def negative_centres(spark, sf, seed=41):
    h = scene_height(spark, sf)
    k = c("c_custkey")
    q = table(spark, sf, "customer").select(k.alias("attempt"), draw_int(k, 5, seed, 8, W - 8).alias("col_"), draw_int(k, 6, seed, 8, h - 8).alias("row_"))
    return q.withColumn("x", c("col_") + 0.5).withColumn("y", c("row_") + 0.5)


@query("sample_negative", f"WITH {NEG.format(w=W, h=HEIGHT)} SELECT attempt, row_, col_ FROM q WHERE attempt NOT IN (SELECT attempt FROM ne) AND attempt NOT IN (SELECT attempt FROM ni)")
def sample_negative(spark, sf):
    return X.far_from_polygons(negative_centres(spark, sf), V.with_bounds(polygons(spark, sf)), 3.0).select("attempt", "row_", "col_")


TARGETS = {"center": 120, "boundary": 90, "negative": 40}
LIMITS = dict(min_valid=0.95, min_mask=0.05, max_mask=0.9, neg_max=0.05)

MAKE = f"""
WITH RECURSIVE fp AS (SELECT *, row_number() OVER (ORDER BY feat_index, part) - 1 AS fi FROM field_parts), nf AS (SELECT count(*) AS n FROM fp),
 ca AS (SELECT c_custkey AS attempt, CAST(floor({draw_sql('c_custkey', '1', 51)} * n) AS BIGINT) AS fi FROM customer, nf), ba AS (SELECT c_custkey AS attempt, CAST(floor({draw_sql('c_custkey', '1', 52)} * n) AS BIGINT) AS fi FROM customer, nf),
 sc AS (SELECT ca.attempt, fp.feat_index, fp.part, x0, y0, x1, y1 FROM ca JOIN fp USING (fi)), {tries_sql('attempt', 51, 'sc')},
 {BOUNDARY_AT}, bt AS (SELECT s.*, ba.attempt, {draw_sql('ba.attempt', '2', 52)} * total AS t FROM ba JOIN fp USING (fi) JOIN s ON s.feat_index = fp.feat_index AND s.part = fp.part),
 bh AS (SELECT attempt, ax + (bx - ax) * (t - (upto - len)) / len + (2 * {draw_sql('attempt', '3', 52)} - 1) * 1.6e0 AS px, ay + (by_ - ay) * (t - (upto - len)) / len + (2 * {draw_sql('attempt', '4', 52)} - 1) * 1.6e0 AS py FROM bt WHERE t > upto - len AND t <= upto),
 {NEG.format(w=W, h=HEIGHT)},
 ct AS (SELECT 1 AS k, sc.attempt, h.px, h.py, CASE WHEN h.px IS NULL THEN 'other' END AS pre FROM sc LEFT JOIN (SELECT * FROM hit WHERE hn = 1) h USING (attempt)
  UNION ALL SELECT 2, attempt, px, py, NULL FROM bh UNION ALL SELECT 3, attempt, x, y, CASE WHEN attempt IN (SELECT attempt FROM ne) OR attempt IN (SELECT attempt FROM ni) THEN 'neg_dist' END FROM qq),
 pl AS (SELECT *, CASE WHEN pre IS NULL THEN CAST(floor(px) AS INT) - 8 END AS x, CASE WHEN pre IS NULL THEN CAST(floor(py) AS INT) - 8 END AS y FROM ct),
 pw AS (SELECT *, pre IS NULL AND x >= 0 AND y >= 0 AND x + 16 <= 250 AND y + 16 <= {HEIGHT} AS placed FROM pl), ex AS (SELECT DISTINCT row_, col_ FROM ({FILL})),
 fx AS (SELECT p.row_, p.col_, valid, CASE WHEN ex.row_ IS NULL THEN 0 ELSE 1 END AS extent FROM scene_px p LEFT JOIN ex USING (row_, col_)),
 rt AS (SELECT k, attempt, avg(CAST(valid AS DOUBLE)) AS vr, avg(CAST(extent AS DOUBLE)) AS mr FROM pw JOIN fx ON placed AND col_ >= x AND col_ < x + 16 AND row_ >= y AND row_ < y + 16 GROUP BY k, attempt),
 jd AS (SELECT pw.k, pw.attempt, x, y, placed, vr, mr, coalesce(pre, CASE WHEN NOT placed THEN 'oob' WHEN vr < 0.95e0 THEN 'valid' WHEN pw.k = 3 AND mr > 0.05e0 THEN 'neg_mask' WHEN pw.k < 3 AND (mr < 0.05e0 OR mr > 0.9e0) THEN 'mask' END) AS reject FROM pw LEFT JOIN rt ON rt.k = pw.k AND rt.attempt = pw.attempt),
 ac AS (SELECT k, attempt, row_number() OVER (PARTITION BY k ORDER BY attempt) AS n FROM jd WHERE reject IS NULL), st AS (SELECT k, attempt AS stop FROM ac WHERE (k = 1 AND n = 120) OR (k = 2 AND n = 90) OR (k = 3 AND n = 40)),
 ke AS (SELECT jd.* FROM jd LEFT JOIN st USING (k) WHERE stop IS NULL OR attempt <= stop), ix AS (SELECT k, attempt, row_number() OVER (ORDER BY k, attempt) - 1 AS patch_idx FROM ke WHERE placed)
SELECT CASE k WHEN 1 THEN 'center' WHEN 2 THEN 'boundary' ELSE 'negative' END AS kind, attempt, reject, patch_idx, CASE WHEN placed THEN x END AS x, CASE WHEN placed THEN y END AS y, vr AS valid_ratio, mr AS mask_ratio FROM ke LEFT JOIN ix USING (k, attempt)"""


@query("make_patches", MAKE)
def make_patches(spark, sf):
    """All attempts a serial patch loop would make, with reject class and patch number; accepted ones have no reject."""
    h = scene_height(spark, sf)
    polys = materialize(number_rows(V.with_bounds(polygons(spark, sf)), IDS, "rn").withColumn("fi", c("rn") - 1))
    n = polys.count()
    k = c("c_custkey")
    picks = lambda seed: table(spark, sf, "customer").select(k.alias("attempt"), draw_int(k, 1, seed, 0, n - 1).cast("bigint").alias("fi")).join(polys.hint("merge"), "fi")
    centre = P.point_inside(picks(51), "attempt", 51).select(F.lit("center").alias("kind"), "attempt", "px", "py", F.when(c("px").isNull(), "other").alias("reject"))
    b = picks(52)
    b = b.select("attempt", G.point_at_length(c("rings"), draw(c("attempt"), 2, 52) * G.polygon_perimeter(c("rings"))).alias("b"))
    jx, jy = P.jitter(c("b.x"), c("b.y"), c("attempt"), 1.6, 52)
    edge = b.select(F.lit("boundary").alias("kind"), "attempt", jx.alias("px"), jy.alias("py"), F.lit(None).cast("string").alias("reject"))
    q = negative_centres(spark, sf)
    far = X.far_from_polygons(q, polys, 3.0).select("attempt", F.lit(1).alias("far"))
    neg = q.join(far.hint("merge"), "attempt", "left").select(F.lit("negative").alias("kind"), "attempt", c("x").alias("px"), c("y").alias("py"), F.when(c("far").isNull(), "neg_dist").alias("reject"))
    tries = P.place(centre.unionByName(edge).unionByName(neg), 16, 16, W, h)
    tries = materialize(tries.withColumn("placed", c("placed") & c("reject").isNull()).withColumn("placed", F.coalesce("placed", F.lit(False))))
    # Polygons that lie on each other burn the same pixels.
    burnt = V.fill(polys.dropDuplicates(["rings"]), IDS, W, h).select("row_", "col_", F.lit(1).alias("e")).distinct()
    px = fixture(spark, sf, "scene_px").select("raster_id", "row_", "col_", "valid").join(burnt.hint("merge"), ["row_", "col_"], "left").withColumn("extent", F.coalesce("e", F.lit(0))).drop("e")
    win = tries.filter("placed").select(F.lit(0).alias("raster_id"), "kind", "attempt", "x", "y", F.lit(16).alias("w"), F.lit(16).alias("h"))
    judged = P.judge(tries, P.window_ratios(win, px), **LIMITS)
    out = P.cut_to_targets(judged, TARGETS)
    return out.select("kind", "attempt", "reject", "patch_idx", F.when(c("placed"), c("x")).alias("x"), F.when(c("placed"), c("y")).alias("y"), "valid_ratio", "mask_ratio")


def chip_layers(spark, sf):
    v = c("v")
    return fixture(spark, sf, "chip_px").select(
        "chip", "row_", "col_", "v", c("fg").alias("extent"), (v > 0.15).cast("int").alias("boundary_raw"), (v > 0.2).cast("int").alias("skeleton"),
        F.when(v > 0.25, 255).otherwise(c("fg")).alias("extent_ig"), (v > -0.3).cast("int").alias("valid"))


@query("patch_stats", """
SELECT chip, avg(CAST(fg AS DOUBLE)) AS mask_ratio, avg(CASE WHEN v > 0.15 THEN 1e0 ELSE 0e0 END) AS edge_ratio, avg(CASE WHEN v > 0.2 THEN 1e0 ELSE 0e0 END) AS skeleton_ratio, avg(CASE WHEN v > 0.25 THEN 1e0 ELSE 0e0 END) AS ignore_ratio FROM chip_px GROUP BY chip""")
def patch_stats(spark, sf):
    return L.label_stats(chip_layers(spark, sf), ["chip"])


@query("bwbl_label", f"""
WITH h AS ({hits(A.ellipse(1), 'v > 0.2')}) SELECT p.chip, p.row_, p.col_, CASE WHEN v <= -0.3 THEN 2 WHEN p.row_ IN (0, 7) OR p.col_ IN (0, 7) THEN 2 WHEN v > 0.2 THEN 1 WHEN h.chip IS NOT NULL THEN 2 ELSE 0 END AS bwbl
FROM chip_px p LEFT JOIN h ON h.chip = p.chip AND h.row_ = p.row_ AND h.col_ = p.col_""")
def bwbl_label(spark, sf):
    px = chip_layers(spark, sf).select("chip", "row_", "col_", "skeleton", "valid")
    return L.boundary_label(px, "skeleton", ["chip"], 1, (8, 8), 1, "valid").select("chip", "row_", "col_", "bwbl")


@query("skeletonize")
def skeletonize(spark, sf):
    return L.skeletonize(fixture(spark, sf, "chip_px").select("chip", "row_", "col_", "fg"), "fg", ["chip"])


@query("patch_labels")
def patch_labels(spark, sf):
    k = c("s_suppkey")
    h = scene_height(spark, sf)
    w = table(spark, sf, "supplier").select(F.lit(0).alias("raster_id"), k.alias("win"), ((k * 29) % 230).cast("int").alias("x"), ((k * 31) % (h - 20)).cast("int").alias("y"), F.lit(20).alias("w"), F.lit(20).alias("h"))
    px = fixture(spark, sf, "scene_px").select("raster_id", "row_", "col_", "valid")
    return L.window_labels(w, px, polygons(spark, sf).withColumn("raster_id", F.lit(0)), W, h, 20, pad=1)


CROP = f"""t AS (SELECT ch.chip, t.t, CAST(floor({draw_sql('ch.chip', '10 + 2 * t.t', 61)} * 5) AS INT) AS y, CAST(floor({draw_sql('ch.chip', '11 + 2 * t.t', 61)} * 5) AS INT) AS x FROM (SELECT DISTINCT chip FROM chip_px) ch CROSS JOIN generate_series(0, 5) t(t)),
 n AS (SELECT t.chip, t.t, x, y, count(*) FILTER (fg = 1) AS e, count(*) FILTER (v > 0.15) AS b FROM t JOIN chip_px p ON p.chip = t.chip AND col_ >= x AND col_ < x + 4 AND row_ >= y AND row_ < y + 4 GROUP BY t.chip, t.t, x, y),
 r AS (SELECT *, e >= 9 AND b >= 3 AS ok, row_number() OVER (PARTITION BY chip ORDER BY CASE WHEN e >= 9 AND b >= 3 THEN 0 ELSE 1 END, t) AS rf, row_number() OVER (PARTITION BY chip ORDER BY b DESC, e DESC, t) AS rb FROM n),
 g AS (SELECT chip, bool_or(ok) AS met, max(CASE WHEN rf = 1 THEN x END) AS fx, max(CASE WHEN rf = 1 THEN y END) AS fy, max(CASE WHEN rb = 1 THEN x END) AS bx, max(CASE WHEN rb = 1 THEN y END) AS byy FROM r GROUP BY chip),
 cr AS (SELECT chip, met, CASE WHEN met THEN fx WHEN {draw_sql('chip', '7', 61)} < 0.6e0 THEN bx ELSE CAST(floor({draw_sql('chip', '9', 61)} * 5) AS INT) END AS x, CASE WHEN met THEN fy WHEN {draw_sql('chip', '7', 61)} < 0.6e0 THEN byy ELSE CAST(floor({draw_sql('chip', '8', 61)} * 5) AS INT) END AS y FROM g)"""


def crops(spark, sf):
    px = chip_layers(spark, sf).select("chip", "row_", "col_", "extent", c("boundary_raw").alias("boundary"))
    return P.choose_crop(px, "chip", 4, 8, 8, 6, 9, 3, 0.6, 61)


@query("crop_policy", f"WITH {CROP} SELECT chip, met, x, y FROM cr")
def crop_policy(spark, sf):
    return crops(spark, sf)


@query("center_crop_pad", """
SELECT chip, CAST(gr.r AS INT) AS row_, CAST(gk.k AS INT) AS col_, coalesce(p.v, 0e0) AS v, coalesce(p.fg, 255) AS extent, 12 AS size FROM (SELECT DISTINCT chip FROM chip_px) ch CROSS JOIN generate_series(0, 11) gr(r) CROSS JOIN generate_series(0, 11) gk(k) LEFT JOIN chip_px p USING (chip) WHERE p.row_ = gr.r - 2 AND p.col_ = gk.k - 2
UNION ALL SELECT chip, CAST(gr.r AS INT), CAST(gk.k AS INT), 0e0, 255, 12 FROM (SELECT DISTINCT chip FROM chip_px) ch CROSS JOIN generate_series(0, 11) gr(r) CROSS JOIN generate_series(0, 11) gk(k) WHERE r < 2 OR r > 9 OR k < 2 OR k > 9
UNION ALL SELECT chip, row_ - 1, col_ - 1, v, fg, 5 FROM chip_px WHERE row_ BETWEEN 1 AND 5 AND col_ BETWEEN 1 AND 5""")
def center_crop_pad(spark, sf):
    px = chip_layers(spark, sf).select("chip", "row_", "col_", "v", "extent")
    fit = lambda n: P.center_fit(px, "chip", 8, 8, n, {"v": 0.0, "extent": 255}).withColumn("size", F.lit(n))
    return fit(12).unionByName(fit(5))


def turned(px):
    """Random flips, then a random quarter turn, per chip."""
    k, n = c("chip"), F.lit(8)
    r = F.when(draw(k, 2, 71) < 0.5, U.flip(c("row_"), n)).otherwise(c("row_"))
    q = F.when(draw(k, 1, 71) < 0.5, U.flip(c("col_"), n)).otherwise(c("col_"))
    p = px.withColumn("row_", r).withColumn("col_", q)
    nr, nk = U.rotate_by(c("row_"), c("col_"), n, draw_int(k, 3, 71, 0, 3))
    return p.select("chip", nr.alias("row_"), nk.alias("col_"), *[x for x in px.columns if x not in ("chip", "row_", "col_")])


def i_draw(j, lo, hi):
    return f"CAST({lo} + floor({draw_sql('chip', j, 71)} * ({hi} - {lo} + 1)) AS INT)"


AUG = f"""a AS (SELECT chip, v, fg, CASE WHEN {draw_sql('chip', '2', 71)} < 0.5e0 THEN 7 - row_ ELSE row_ END AS r, CASE WHEN {draw_sql('chip', '1', 71)} < 0.5e0 THEN 7 - col_ ELSE col_ END AS k, {i_draw('3', 0, 3)} AS q FROM chip_px),
 t AS (SELECT chip, v, fg, CASE q WHEN 1 THEN 7 - k WHEN 2 THEN 7 - r WHEN 3 THEN k ELSE r END AS row_, CASE q WHEN 1 THEN r WHEN 2 THEN 7 - k WHEN 3 THEN 7 - r ELSE k END AS col_ FROM a),
 z AS (SELECT *, {draw_sql('chip', '10', 71)} < 0.7e0 AS go, {draw_sql('chip', '11', 71)} < 0.4e0 AS blk, least({i_draw('12', 2, 6)}, 8) AS bw, least({i_draw('13', 2, 6)}, 8) AS bh, {i_draw('16', 0, 3)} AS side FROM t),
 y AS (SELECT *, greatest(1, CAST(floor(bw * CASE WHEN bh * bw > 19 THEN sqrt(19e0 / (bh * bw)) ELSE 1 END) AS INT)) AS w2, greatest(1, CAST(floor(bh * CASE WHEN bh * bw > 19 THEN sqrt(19e0 / (bh * bw)) ELSE 1 END) AS INT)) AS h2, CASE WHEN 8 * least(bw, 7) > 19 THEN 2 ELSE least(bw, 7) END AS ww FROM z),
 x AS (SELECT *, {i_draw('14', 0, '(8 - h2)')} AS y0, {i_draw('15', 0, '(8 - w2)')} AS x0 FROM y),
 m AS (SELECT *, go AND CASE WHEN blk THEN row_ >= y0 AND row_ < y0 + h2 AND col_ >= x0 AND col_ < x0 + w2 ELSE CASE side WHEN 0 THEN col_ < ww WHEN 1 THEN col_ >= 8 - ww WHEN 2 THEN row_ < ww ELSE row_ >= 8 - ww END END AS hid FROM x)"""


@query("augment_patches", f"WITH {AUG} SELECT chip, row_, col_, CASE WHEN hid THEN 0e0 ELSE v END AS v, fg, CASE WHEN hid THEN 0 ELSE 1 END AS valid FROM m")
def augment_patches(spark, sf):
    t = turned(fixture(spark, sf, "chip_px").select("chip", "row_", "col_", "v", "fg"))
    hid = U.invalid_area(c("chip"), c("row_"), c("col_"), 8, 8, 71, 0.7, 2, 6, 0.4, 0.3)
    t = t.withColumn("hid", hid)
    return t.select("chip", "row_", "col_", F.when(c("hid"), 0.0).otherwise(c("v")).alias("v"), "fg", F.when(c("hid"), 0).otherwise(1).alias("valid"))


@query("training_samples", f"""
WITH {CROP}, q AS (SELECT quantile_cont(v, 0.02) AS lo, quantile_cont(v, 0.98) AS hi FROM chip_px WHERE v > -0.3),
 p AS (SELECT p.chip, p.row_ - cr.y AS r, p.col_ - cr.x AS k, v, fg, CASE WHEN v > -0.3 THEN 1 ELSE 0 END AS valid FROM chip_px p JOIN cr ON cr.chip = p.chip AND col_ >= x AND col_ < x + 4 AND row_ >= y AND row_ < y + 4)
SELECT chip, r AS row_, CASE WHEN {draw_sql('chip', '1', 71)} < 0.5e0 THEN 3 - k ELSE k END AS col_, round(CASE WHEN valid = 0 THEN 0e0 ELSE greatest(0e0, least(1e0, (v - lo) / greatest(hi - lo, 1e-6))) END, 6) AS band, valid, CASE WHEN valid = 0 THEN 255 ELSE fg END AS extent FROM p CROSS JOIN q""")
def training_samples(spark, sf):
    """Cropped, flipped, normalised pixels with the valid channel and ignore codes."""
    px = chip_layers(spark, sf).select("chip", "row_", "col_", "v", "extent", "valid")
    st = band_percentiles(px.filter("valid = 1").withColumn("one", F.lit(1)), ["one"], ["v"], (0.02, 0.98))
    win = crops(spark, sf).select("chip", "x", "y", F.lit(4).alias("w"), F.lit(4).alias("h"))
    p = X.pixels_in_windows(px, win, ["chip"]).withColumn("one", F.lit(1))
    p = join_checked(p, st, ["one"], "inner")
    k = c("col_") - c("x")
    return p.select("chip", (c("row_") - c("y")).alias("row_"), F.when(draw(c("chip"), 1, 71) < 0.5, F.lit(3) - k).otherwise(k).alias("col_"),
                    F.round(M.robust_scale(c("v"), c("q_v")[0], c("q_v")[1], c("valid")), 6).alias("band"), "valid", M.ignore_where_invalid(c("extent"), c("valid"), 255).alias("extent"))


RECS = """recs AS (SELECT c_custkey AS ord, concat('p', CAST(c_custkey AS VARCHAR(20))) AS patch_id, CASE WHEN c_custkey % 6 = 0 THEN concat('neg::p', CAST(c_custkey AS VARCHAR(20))) ELSE concat('field::', c_mktsegment, '::', CAST(c_custkey % 200 AS VARCHAR(20))) END AS gk FROM {t}),
 old AS (SELECT concat('p', CAST(c_custkey AS VARCHAR(20))) AS patch_id, CASE c_custkey % 3 WHEN 0 THEN 'train' WHEN 1 THEN 'validation' ELSE 'test' END AS split FROM {t} WHERE c_custkey % 9 = 4 OR c_custkey % 11 = 5)"""


def records(spark, sf):
    t = f"parquet.`{sf}/customer.parquet`"
    return tuple(spark.sql(f"WITH {RECS.format(t=t)} SELECT * FROM {n}") for n in ("recs", "old"))


@query("split_new_records", f"WITH {RECS.format(t='customer')} SELECT patch_id, gk FROM recs WHERE patch_id NOT IN (SELECT patch_id FROM old)")
def split_new_records(spark, sf):
    recs, old = records(spark, sf)
    return SP.new_records(recs, old).select("patch_id", "gk")


@query("split_conflicts", """
WITH e AS (SELECT patch_id, split FROM samples UNION ALL SELECT patch_id, 'test' FROM samples WHERE patch_no % 35 = 0) SELECT patch_id, count(DISTINCT split) AS n_splits FROM e GROUP BY patch_id HAVING count(DISTINCT split) > 1""")
def split_conflicts(spark, sf):
    s = fixture(spark, sf, "samples")
    return SP.conflicts(s.select("patch_id", "split").unionByName(s.filter("patch_no % 35 = 0").select("patch_id", F.lit("test").alias("split"))))


@query("split_pinned", f"WITH {RECS.format(t='customer')} SELECT gk, split AS pinned FROM (SELECT gk, split, row_number() OVER (PARTITION BY gk ORDER BY ord) AS rn FROM recs JOIN old USING (patch_id)) WHERE rn = 1")
def split_pinned(spark, sf):
    return SP.pins(*records(spark, sf))


def split_sql(recs: str, old: str, tag: str) -> str:
    """CTEs that assign the new patches of ``recs`` given those of ``old``; the result is ``done<tag>`` (patch_id, gk, split)."""
    have = lambda s: f"(SELECT count(*) FROM {old} WHERE split = '{s}')"
    lack = lambda s, t: f"greatest(0, {t} - {have(s)} - (SELECT coalesce(sum(n), 0) FROM o{tag} WHERE pinned = '{s}'))"
    return f"""fr{tag} AS (SELECT * FROM {recs} WHERE patch_id NOT IN (SELECT patch_id FROM {old})), pn{tag} AS (SELECT gk, split AS pinned FROM (SELECT r.gk, q.split, row_number() OVER (PARTITION BY r.gk ORDER BY r.ord) AS rn FROM {recs} r JOIN {old} q USING (patch_id)) WHERE rn = 1),
 g{tag} AS (SELECT gk, count(*) AS n, min(ord) AS first FROM fr{tag} GROUP BY gk), o{tag} AS (SELECT g{tag}.gk, n, first, pinned FROM g{tag} LEFT JOIN pn{tag} USING (gk)),
 tt{tag} AS (SELECT (SELECT count(*) FROM fr{tag}) + (SELECT count(*) FROM {old}) AS n), tg{tag} AS (SELECT CAST(round_even(n * 0.7e0, 0) AS BIGINT) AS a, CAST(round_even(n * 0.2e0, 0) AS BIGINT) AS b, n FROM tt{tag}),
 lk{tag} AS (SELECT {lack('train', 'a')} AS a, {lack('validation', 'b')} AS b, {lack('test', '(n - a - b)')} AS e FROM tg{tag}),
 up{tag} AS (SELECT gk, sum(n) OVER (ORDER BY {draw_sql('first', '1', 81)}, gk) - n AS before, sum(n) OVER () AS rest FROM o{tag} WHERE pinned IS NULL),
 s{tag} AS (SELECT gk, CASE WHEN before * (a + b + e) < a * rest THEN 'train' WHEN before * (a + b + e) < (a + b) * rest THEN 'validation' ELSE 'test' END AS split FROM up{tag} CROSS JOIN lk{tag} UNION ALL SELECT gk, pinned FROM o{tag} WHERE pinned IS NOT NULL),
 done{tag} AS (SELECT patch_id, gk, split FROM fr{tag} JOIN s{tag} USING (gk))"""


@query("split_assign", f"WITH {RECS.format(t='customer')}, {split_sql('recs', 'old', '1')} SELECT patch_id, split FROM done1")
def split_assign(spark, sf):
    return SP.assign_records(*records(spark, sf), (0.7, 0.2, 0.1), 81).select("patch_id", "split")
