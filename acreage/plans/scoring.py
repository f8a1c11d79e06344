"""Tiling, padding, scoring and blending queries."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from acreage.operators import masks as M, score as S
from acreage.operators.statistics import band_percentiles
from acreage.plans.registry import fixture, query
from acreage.session import join_checked

c = F.col
BANDS = ["b1", "b2", "b3", "b4"]


def starts_sql(total, win, stride):
    return f"(SELECT DISTINCT v FROM (SELECT unnest(list_append(generate_series(0, {total} - {win}, {stride}), {total} - {win})) AS v))"


@query("tile_windows", f"""
WITH m AS (SELECT raster_id, width, height, least(64, width) AS w, least(64, height) AS h FROM raster_meta)
SELECT raster_id, CAST(xs.v AS INT) AS x, CAST(ys.v AS INT) AS y, w, h FROM m, LATERAL {starts_sql('width', 'w', 48)} xs, LATERAL {starts_sql('height', 'h', 48)} ys""")
def tile_windows(spark, sf):
    return S.tile_windows(fixture(spark, sf, "raster_meta"), 64, 48)


def scene_meta(spark, sf):
    return fixture(spark, sf, "scene_px").groupBy("raster_id").agg((F.max("col_") + 1).alias("width"), (F.max("row_") + 1).alias("height"))


HGT = "(SELECT max(row_) + 1 FROM scene_px)"
TILES = f"tl AS (SELECT xs.v AS x, ys.v AS y, 64 AS w, least(64, hh.h) AS h FROM (SELECT {HGT} AS h) hh, LATERAL {starts_sql('250', '64', 48)} xs, LATERAL {starts_sql('hh.h', 'least(64, hh.h)', 48)} ys)"


@query("tile_pad", f"""
WITH {TILES} SELECT CAST(tl.x AS INT) AS x, CAST(tl.y AS INT) AS y, CAST(gr.r AS INT) AS r, CAST(gk.k AS INT) AS k, coalesce(p.valid, 0) AS valid, coalesce(p.b1, 0e0) AS b1, coalesce(p.b4, 0e0) AS b4
FROM tl CROSS JOIN generate_series(0, 63) gr(r) CROSS JOIN generate_series(0, 63) gk(k) LEFT JOIN scene_px p ON p.row_ = tl.y + gr.r AND p.col_ = tl.x + gk.k AND gr.r < tl.h AND gk.k < tl.w""")
def tile_pad(spark, sf):
    tiles = S.tile_windows(scene_meta(spark, sf), 64, 48)
    px = fixture(spark, sf, "scene_px").select("raster_id", "row_", "col_", "valid", "b1", "b4")
    return S.pad_tiles(S.tile_pixels(px, tiles, cell=64), tiles, 64, ["b1", "b4"]).drop("raster_id")


@query("blend_tiles", f"""
WITH {TILES}, p AS (SELECT row_, col_, row_ - tl.y AS r, col_ - tl.x AS k, tl.h, extent_prob * (1 + tl.x / 1000e0) AS e, boundary_prob * (1 - tl.x / 1000e0) AS b FROM tl JOIN scene_px s ON col_ >= tl.x AND col_ < tl.x + 64 AND row_ >= tl.y AND row_ < tl.y + tl.h),
 g AS (SELECT *, -1 + 2e0 * k / 63 AS gx, CASE WHEN h <= 1 THEN -1e0 ELSE -1 + 2e0 * r / (h - 1) END AS gy, exp(-0.5e0 * (pow(1e0 / 63, 2) + CASE WHEN h % 2 = 1 THEN 0e0 ELSE pow(1e0 / (h - 1), 2) END) / 0.09e0) AS pk FROM p),
 w AS (SELECT *, greatest(0.05e0, exp(-0.5e0 * (gx * gx + gy * gy) / 0.09e0) / greatest(pk, 1e-6)) AS w FROM g)
SELECT row_, col_, round(sum(e * w) / greatest(sum(w), 1e-6), 9) AS extent_prob, round(sum(b * w) / greatest(sum(w), 1e-6), 9) AS boundary_prob FROM w GROUP BY row_, col_""")
def blend_tiles(spark, sf):
    tiles = S.tile_windows(scene_meta(spark, sf), 64, 48)
    px = fixture(spark, sf, "scene_px").select("raster_id", "row_", "col_", "extent_prob", "boundary_prob")
    t = S.tile_pixels(px, tiles, cell=64)
    t = t.withColumn("extent_prob", c("extent_prob") * (F.lit(1) + c("x") / 1000.0)).withColumn("boundary_prob", c("boundary_prob") * (F.lit(1) - c("x") / 1000.0))
    b = S.blend(t, ["extent_prob", "boundary_prob"], S.blend_weight("gaussian"))
    return b.select("row_", "col_", F.round("extent_prob", 9).alias("extent_prob"), F.round("boundary_prob", 9).alias("boundary_prob"))


def linear_model(chip: np.ndarray):
    """Stand-in for a user model: one weighted sum per head over the bands and the valid channel."""
    head = lambda w: np.tensordot(np.array(w), chip, axes=1)
    return head([2.0, -1.0, 0.5, 1.0, -0.5]), head([-1.0, 1.5, 1.0, -0.5, 0.25])


_Q = ", ".join(f"quantile_cont({b}, 0.02) AS lo_{b}, quantile_cont({b}, 0.98) AS hi_{b}" for b in BANDS)
_N = ", ".join(f"greatest(0e0, least(1e0, ({b} - lo_{b}) / greatest(hi_{b} - lo_{b}, 1e-6))) AS n_{b}" for b in BANDS)


@query("tiled_score", f"""
WITH st AS (SELECT {_Q} FROM scene_px WHERE valid = 1), n AS (SELECT row_, col_, valid, {_N} FROM scene_px CROSS JOIN st)
SELECT row_, col_, round(CASE WHEN valid = 0 THEN 0 ELSE 1 / (1 + exp(-(2 * n_b1 - n_b2 + 0.5e0 * n_b3 + n_b4 - 0.5e0))) END, 6) AS extent_prob,
 round(CASE WHEN valid = 0 THEN 0 ELSE 1 / (1 + exp(-(-n_b1 + 1.5e0 * n_b2 + n_b3 - 0.5e0 * n_b4 + 0.25e0))) END, 6) AS boundary_prob FROM n""")
def tiled_score(spark, sf):
    """Normalise, tile with overlap, score each tile with the model, blend; a per-pixel model shows no seams."""
    px = fixture(spark, sf, "scene_px").select("raster_id", "row_", "col_", "valid", *BANDS)
    st = band_percentiles(px.filter("valid = 1"), ["raster_id"], BANDS, (0.02, 0.98))
    n = join_checked(px, st, ["raster_id"], "inner")
    n = n.select("raster_id", "row_", "col_", "valid", *[M.robust_scale(c(b), c(f"q_{b}")[0], c(f"q_{b}")[1], c("valid")).alias(b) for b in BANDS])
    t = S.tile_pixels(n, S.tile_windows(scene_meta(spark, sf), 64, 48), cell=64)
    b = S.blend(S.score_tiles(t, linear_model, BANDS, 64), ["extent_prob", "boundary_prob"], S.blend_weight("gaussian"))
    return b.select("row_", "col_", F.round("extent_prob", 6).alias("extent_prob"), F.round("boundary_prob", 6).alias("boundary_prob"))
