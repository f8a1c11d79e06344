"""Neighbourhood queries and the metrics built on them."""

from __future__ import annotations

from pyspark.sql import functions as F

from acreage.functions import arrays as A
from acreage.functions.scalars import NAN, f1_from_counts, ratio
from acreage.operators import metrics as Q, stencil as T
from acreage.plans.registry import fixture, query

c = F.col
CHIP = ("chip",)


def chips(spark, sf):
    return fixture(spark, sf, "chip_px")


def values(offsets):
    return "(VALUES " + ", ".join(f"({dy}, {dx})" for dy, dx in offsets) + ")"


def hits(offsets, mask="fg = 1", src="chip_px", key="chip"):
    """Pixels hit by an element centred on the set pixels."""
    return (f"SELECT DISTINCT p.{key}, p.row_ + o.dy AS row_, p.col_ + o.dx AS col_ FROM {src} p CROSS JOIN {values(offsets)} o(dy, dx) WHERE {mask}")


@query("dilate8", f"""
WITH h AS ({hits(A.square(1))}) SELECT p.chip, p.row_, p.col_, CASE WHEN h.chip IS NULL THEN 0 ELSE 1 END AS dilated
FROM chip_px p LEFT JOIN h ON h.chip = p.chip AND h.row_ = p.row_ AND h.col_ = p.col_""")
def dilate8(spark, sf):
    return T.dilate(chips(spark, sf), "fg", A.square(1), keys=CHIP)


@query("dilate_disk", f"""
WITH h AS ({hits(A.disk(2), 'v > 0.15')}) SELECT p.chip, p.row_, p.col_, CASE WHEN h.chip IS NULL THEN 0 ELSE 1 END AS dilated
FROM chip_px p LEFT JOIN h ON h.chip = p.chip AND h.row_ = p.row_ AND h.col_ = p.col_""")
def dilate_disk(spark, sf):
    px = chips(spark, sf).select("chip", "row_", "col_", (c("v") > 0.15).cast("int").alias("m"))
    return T.dilate(px, "m", A.disk(2), keys=CHIP)


@query("ignore_zone", f"""
WITH h AS ({hits(A.ellipse(2), 'v > 0.15')}) SELECT p.chip, p.row_, p.col_, CASE WHEN h.chip IS NULL THEN fg ELSE 255 END AS extent_ig
FROM chip_px p LEFT JOIN h ON h.chip = p.chip AND h.row_ = p.row_ AND h.col_ = p.col_""")
def ignore_zone(spark, sf):
    px = chips(spark, sf).select("chip", "row_", "col_", "fg", (c("v") > 0.15).cast("int").alias("m"))
    d = T.dilate(px, "m", A.ellipse(2), keep=["fg"], keys=CHIP)
    return d.select("chip", "row_", "col_", F.when(c("dilated") > 0, 255).otherwise(c("fg")).alias("extent_ig"))


@query("erode_disk", f"""
WITH h AS ({hits(A.disk(1), 'v <= -0.1')}) SELECT p.chip, p.row_, p.col_, CASE WHEN h.chip IS NULL THEN 1 ELSE 0 END AS eroded
FROM chip_px p LEFT JOIN h ON h.chip = p.chip AND h.row_ = p.row_ AND h.col_ = p.col_""")
def erode_disk(spark, sf):
    px = chips(spark, sf).select("chip", "row_", "col_", (c("v") > -0.1).cast("int").alias("m"))
    return T.erode(px, "m", A.disk(1), keys=CHIP)


@query("open_close", f"""
WITH e AS ({hits(A.disk(1), 'fg = 0')}), er AS (SELECT p.chip, p.row_, p.col_ FROM chip_px p LEFT JOIN e ON e.chip = p.chip AND e.row_ = p.row_ AND e.col_ = p.col_ WHERE e.chip IS NULL),
 op AS ({hits(A.disk(1), 'true', 'er')}), d AS ({hits(A.disk(1))}),
 nd AS (SELECT p.chip, p.row_, p.col_ FROM chip_px p LEFT JOIN d ON d.chip = p.chip AND d.row_ = p.row_ AND d.col_ = p.col_ WHERE d.chip IS NULL), cl AS ({hits(A.disk(1), 'true', 'nd')})
SELECT p.chip, p.row_, p.col_, CASE WHEN op.chip IS NULL THEN 0 ELSE 1 END AS opened, CASE WHEN cl.chip IS NULL THEN 1 ELSE 0 END AS closed
FROM chip_px p LEFT JOIN op ON op.chip = p.chip AND op.row_ = p.row_ AND op.col_ = p.col_ LEFT JOIN cl ON cl.chip = p.chip AND cl.row_ = p.row_ AND cl.col_ = p.col_""")
def open_close(spark, sf):
    o = T.opening(chips(spark, sf), "fg", A.disk(1), keep=["fg"], keys=CHIP)
    return T.closing(o, "fg", A.disk(1), keep=["opened"], keys=CHIP)


@query("morph_gradient", """
SELECT p.chip, p.row_, p.col_, CAST(max(q.fg) > min(q.fg) AS INT) AS edge FROM chip_px p JOIN chip_px q ON q.chip = p.chip AND abs(q.row_ - p.row_) <= 1 AND abs(q.col_ - p.col_) <= 1
GROUP BY p.chip, p.row_, p.col_""")
def morph_gradient(spark, sf):
    return T.gradient(chips(spark, sf), "fg", keys=CHIP)


@query("sobel", """
WITH o AS (SELECT a.dy, b.dx FROM (VALUES (-1), (0), (1)) a(dy) CROSS JOIN (VALUES (-1), (0), (1)) b(dx)),
 n AS (SELECT p.chip, p.row_, p.col_, o.dy, o.dx, q.v FROM chip_px p CROSS JOIN o JOIN chip_px q ON q.chip = p.chip AND q.row_ = greatest(0, least(7, p.row_ + o.dy)) AND q.col_ = greatest(0, least(7, p.col_ + o.dx))),
 g AS (SELECT chip, row_, col_, sum(v * dy * (2 - abs(dx))) / 4 AS gy, sum(v * dx * (2 - abs(dy))) / 4 AS gx FROM n GROUP BY chip, row_, col_)
SELECT chip, row_, col_, round(sqrt((gx * gx + gy * gy) / 2), 6) AS sobel FROM g""")
def sobel(spark, sf):
    return T.sobel(chips(spark, sf), "v", keys=CHIP).withColumn("sobel", F.round("sobel", 6))


_K = A.gaussian_kernel(1.0)


@query("gaussian_smooth", f"""
WITH k(d, w) AS (VALUES {', '.join(f'({i - 4}, {w!r}e0)' for i, w in enumerate(float(x) for x in _K))}),
 r AS (SELECT p.row_, p.col_, sum(k.w * q.extent_prob) AS v, max(p.valid) AS valid FROM scene_px p CROSS JOIN k JOIN scene_px q ON q.col_ = p.col_ AND q.row_ = greatest(0, least((SELECT max(row_) FROM scene_px), p.row_ + k.d)) GROUP BY p.row_, p.col_),
 z AS (SELECT p.row_, p.col_, sum(k.w * q.v) AS v, max(p.valid) AS valid FROM r p CROSS JOIN k JOIN r q ON q.row_ = p.row_ AND q.col_ = greatest(0, least(249, p.col_ + k.d)) GROUP BY p.row_, p.col_)
SELECT row_, col_, round(CASE WHEN valid = 0 THEN 0 ELSE greatest(0e0, least(1e0, v)) END, 6) AS extent_smooth FROM z""")
def gaussian_smooth(spark, sf):
    px = fixture(spark, sf, "scene_px").select("raster_id", "row_", "col_", "extent_prob", "valid")
    return T.smooth(px, ["extent_prob"], 1.0, "valid", block=64).select("row_", "col_", F.round("extent_prob", 6).alias("extent_smooth"))


NEAR2 = """n AS (SELECT DISTINCT p.row_ + o.dy AS row_, p.col_ + o.dx AS col_ FROM scene_px p CROSS JOIN (SELECT a.dy, b.dx FROM (VALUES (-2), (-1), (0), (1), (2)) a(dy)
 CROSS JOIN (VALUES (-2), (-1), (0), (1), (2)) b(dx)) o WHERE p.valid = 0),
 band AS (SELECT s.*, CASE WHEN s.valid = 1 AND n.row_ IS NOT NULL THEN 1 ELSE 0 END AS near FROM scene_px s LEFT JOIN n ON n.row_ = s.row_ AND n.col_ = s.col_)"""


@query("near_invalid_band", f"WITH {NEAR2} SELECT row_, col_, near FROM band")
def near_invalid_band(spark, sf):
    return T.near_invalid(fixture(spark, sf, "scene_px").select("raster_id", "row_", "col_", "valid"), "valid", 2).select("row_", "col_", "near")


@query("invalid_edge_guard", f"""
WITH {NEAR2} SELECT row_, col_, CASE WHEN near = 1 THEN extent_prob * 0.5e0 ELSE extent_prob END AS extent_prob, CASE WHEN near = 1 THEN boundary_prob * 0.25e0 ELSE boundary_prob END AS boundary_prob, near FROM band""")
def invalid_edge_guard(spark, sf):
    px = fixture(spark, sf, "scene_px").select("raster_id", "row_", "col_", "valid", "extent_prob", "boundary_prob")
    n = T.near_invalid(px, "valid", 2, keep=["extent_prob", "boundary_prob"])
    scaled = lambda p, s: F.when(c("near") == 1, c(p) * s).otherwise(c(p)).alias(p)
    return n.select("row_", "col_", scaled("extent_prob", 0.5), scaled("boundary_prob", 0.25), "near")


THRS = [0.2, 0.35, 0.5, 0.65]


def sweep_sql(within=""):
    return f"""t(ord, threshold) AS (VALUES {', '.join(f'({i}, {x}e0)' for i, x in enumerate(THRS))}),
 u AS (SELECT row_, col_, boundary_prob, boundary_gt FROM {'band' if within else 'scene_px'} WHERE boundary_gt <> 2 {within}),
 g AS (SELECT row_, col_ FROM u WHERE boundary_gt = 1), p AS (SELECT t.ord, u.row_, u.col_ FROM u CROSS JOIN t WHERE boundary_prob >= threshold),
 o(dy, dx) AS (VALUES {', '.join(f'({a}, {b})' for a, b in A.disk(2))}),
 dg AS (SELECT DISTINCT row_ + dy AS row_, col_ + dx AS col_ FROM g CROSS JOIN o), dp AS (SELECT DISTINCT ord, row_ + dy AS row_, col_ + dx AS col_ FROM p CROSS JOIN o),
 a AS (SELECT p.ord, count(dg.row_) AS tp, count(*) - count(dg.row_) AS fp FROM p LEFT JOIN dg ON dg.row_ = p.row_ AND dg.col_ = p.col_ GROUP BY p.ord),
 b AS (SELECT t.ord, count(*) FILTER (dp.row_ IS NULL AND g.row_ IS NOT NULL) AS fn FROM t LEFT JOIN g ON true LEFT JOIN dp ON dp.ord = t.ord AND dp.row_ = g.row_ AND dp.col_ = g.col_ GROUP BY t.ord),
 q AS (SELECT t.ord, t.threshold, coalesce(tp, 0) AS tp, coalesce(fp, 0) AS fp, coalesce(fn, 0) AS fn FROM t LEFT JOIN a ON a.ord = t.ord LEFT JOIN b ON b.ord = t.ord),
 pr AS (SELECT *, CASE WHEN tp + fp > 0 THEN CAST(tp AS DOUBLE) / (tp + fp) ELSE 1e0 END AS p, CASE WHEN tp + fn > 0 THEN CAST(tp AS DOUBLE) / (tp + fn) ELSE 1e0 END AS r FROM q),
 f AS (SELECT ord, threshold, tp, fp, fn, round(p, 6) AS precision_, round(r, 6) AS recall_, round(CASE WHEN p + r > 0 THEN 2 * p * r / (p + r) ELSE 0 END, 6) AS f1 FROM pr)"""


def boundary_sweep(px, thresholds, within=None, empty=None):
    m = T.tolerance_marks(px, "boundary_prob", "boundary_gt", thresholds, 2, within=within)
    tp, fp, fn = c("tp"), c("fp"), c("fn")
    return m.select("raster_id", "ord", "threshold", "tp", "fp", "fn", F.round(ratio(tp, tp + fp, 1.0), 6).alias("precision_"),
                    F.round(ratio(tp, tp + fn, 1.0), 6).alias("recall_"), F.round(f1_from_counts(tp, fp, fn, empty), 6).alias("f1"))


def scored(spark, sf):
    return fixture(spark, sf, "scene_px").select("raster_id", "row_", "col_", "boundary_prob", "boundary_gt", "valid", "extent_prob", "extent_gt")


@query("boundary_f1_sweep", f"WITH {sweep_sql()} SELECT threshold, tp, fp, fn, precision_, recall_, f1 FROM f")
def boundary_f1_sweep(spark, sf):
    return boundary_sweep(scored(spark, sf), THRS).drop("raster_id", "ord")


@query("boundary_f1", f"WITH {sweep_sql()} SELECT tp, fp, fn, precision_, recall_, f1 FROM f WHERE ord = 2")
def boundary_f1(spark, sf):
    return boundary_sweep(scored(spark, sf), [0.5]).select("tp", "fp", "fn", "precision_", "recall_", "f1")


@query("boundary_best_threshold", f"WITH {sweep_sql()} SELECT threshold, precision_, recall_, f1 FROM f ORDER BY f1 DESC, ord LIMIT 1")
def boundary_best_threshold(spark, sf):
    return Q.best_threshold(boundary_sweep(scored(spark, sf), THRS), ["raster_id"]).select("threshold", "precision_", "recall_", "f1")


@query("near_invalid_metrics", f"""
WITH {NEAR2}, {sweep_sql('AND near = 1')}, best AS (SELECT threshold, f1 FROM f WHERE tp + fp + fn > 0 ORDER BY f1 DESC, ord LIMIT 1),
 e AS (SELECT count(*) FILTER (extent_gt <> 255) AS supervised, count(*) FILTER (near = 1 AND extent_gt <> 255) AS near_px, count(*) FILTER (near = 1 AND extent_gt = 1 AND extent_prob >= 0.5e0) AS tp,
  count(*) FILTER (near = 1 AND extent_gt = 0 AND extent_prob >= 0.5e0) AS fp, count(*) FILTER (near = 1 AND extent_gt = 1 AND extent_prob < 0.5e0) AS fn,
  avg(boundary_prob) FILTER (near = 1 AND boundary_gt = 1) - avg(boundary_prob) FILTER (near = 1 AND boundary_gt = 0) AS gap FROM band)
SELECT round(CAST(near_px AS DOUBLE) / supervised, 6) AS near_frac, tp, fp, fn, round(CAST(tp AS DOUBLE) / (tp + fp + fn), 6) AS iou, (SELECT f1 FROM best) AS boundary_f1, (SELECT threshold FROM best) AS boundary_thr, round(gap, 6) AS gap FROM e""")
def near_invalid_metrics(spark, sf):
    return near_metrics(scored(spark, sf)).drop("raster_id")


def near_metrics(px):
    """Extent, boundary and probability-gap metrics on the band next to invalid pixels; NaN where it is empty."""
    band = T.near_invalid(px, "valid", 2, keep=["boundary_prob", "boundary_gt", "extent_prob", "extent_gt"])
    near, pred, pos, sup = c("near") == 1, c("extent_prob") >= 0.5, c("extent_gt") == 1, c("extent_gt") != 255
    bp = lambda v: F.coalesce(F.avg(F.when(near & (c("boundary_gt") == v), c("boundary_prob"))), F.lit(NAN))
    e = band.groupBy("raster_id").agg(
        F.count_if(sup).alias("_s"), F.count_if(near & sup).alias("_n"), F.count_if(near & sup & pred & pos).alias("tp"),
        F.count_if(near & sup & pred & ~pos).alias("fp"), F.count_if(near & sup & ~pred & pos).alias("fn"), F.round(bp(1) - bp(0), 6).alias("gap"))
    best = Q.best_threshold(boundary_sweep(band, THRS, within="near", empty=NAN), ["raster_id"])
    best = best.select("raster_id", c("f1").alias("boundary_f1"), c("threshold").alias("boundary_thr"))
    nan = F.lit(NAN)
    return e.join(best, "raster_id", "left").select(
        "raster_id", F.round(ratio(c("_n"), c("_s"), 0.0), 6).alias("near_frac"), "tp", "fp", "fn", F.round(ratio(c("tp"), c("tp") + c("fp") + c("fn"), NAN), 6).alias("iou"),
        F.coalesce("boundary_f1", nan).alias("boundary_f1"), F.coalesce("boundary_thr", nan).alias("boundary_thr"), "gap")


@query("eval_split", f"""
WITH {sweep_sql()}, best AS (SELECT threshold, f1 FROM f ORDER BY f1 DESC, ord LIMIT 1),
 e AS (SELECT count(*) FILTER (extent_gt = 1 AND extent_prob >= 0.5e0) AS tp, count(*) FILTER (extent_gt = 0 AND extent_prob >= 0.5e0) AS fp, count(*) FILTER (extent_gt = 1 AND extent_prob < 0.5e0) AS fn FROM scene_px)
SELECT 'extent_iou' AS metric, round(CAST(tp AS DOUBLE) / (tp + fp + fn), 6) AS value FROM e UNION ALL SELECT 'extent_f1', round(2e0 * tp / (2 * tp + fp + fn), 6) FROM e
UNION ALL SELECT 'boundary_f1_max', f1 FROM best UNION ALL SELECT 'boundary_f1_max_threshold', threshold FROM best""")
def eval_split(spark, sf):
    """Metrics of a scored split as a long table."""
    px = scored(spark, sf)
    e = Q.extent_scores(Q.extent_counts(px, ["raster_id"], c("extent_prob") >= 0.5, c("extent_gt"), 255))
    b = Q.best_threshold(boundary_sweep(px, THRS), ["raster_id"])
    wide = e.select("raster_id", c("iou").alias("extent_iou"), c("f1").alias("extent_f1")).join(
        b.select("raster_id", c("f1").alias("boundary_f1_max"), c("threshold").alias("boundary_f1_max_threshold")), "raster_id")
    return wide.unpivot("raster_id", ["extent_iou", "extent_f1", "boundary_f1_max", "boundary_f1_max_threshold"], "metric", "value").drop("raster_id")
