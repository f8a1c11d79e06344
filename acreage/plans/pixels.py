"""Queries on single pixels: masks, policies, thresholds, scaling, layer rules."""

from __future__ import annotations

from pyspark.sql import functions as F

from acreage.functions.scalars import area_to_px, gaussian_weight, sigmoid
from acreage.operators import masks as M
from acreage.operators.statistics import band_mean_std, band_percentiles
from acreage.plans.registry import fixture, query
from acreage.session import join_checked

BANDS = ["b1", "b2", "b3", "b4"]
ND = 65536.0
c = F.col


def bands():
    return [c(b) for b in BANDS]


@query("valid_mask_control", "SELECT row_, col_, CASE WHEN b2 <> 65536 THEN 1 ELSE 0 END AS valid_out FROM scene_px")
def valid_mask_control(spark, sf):
    return fixture(spark, sf, "scene_px").select("row_", "col_", M.valid_control(bands(), 2, ND).alias("valid_out"))


@query("valid_mask_allbands", """
SELECT row_, col_, CASE WHEN b1 = 2 AND b2 = 2 AND b3 = 2 AND b4 = 2 THEN 0 WHEN b1 = 65536 AND b2 = 65536
  AND b3 = 65536 AND b4 = 65536 THEN 0 ELSE 1 END AS valid_out FROM scene_px""")
def valid_mask_allbands(spark, sf):
    px = fixture(spark, sf, "scene_px")
    both = F.least(M.valid_all_bands(bands(), 2.0), M.valid_all_bands(bands(), ND))
    return px.select("row_", "col_", both.alias("valid_out"))


@query("valid_mask_footprint_any", """
SELECT row_, col_, CASE WHEN b1 = 4 OR b2 = 4 OR b3 = 4 OR b4 = 4 THEN 0 ELSE 1 END AS valid_out FROM scene_px""")
def valid_mask_footprint_any(spark, sf):
    return fixture(spark, sf, "scene_px").select("row_", "col_", M.valid_any_band(bands(), F.lit(4.0)).alias("valid_out"))


@query("valid_from_footprint", """
WITH s AS (SELECT row_, col_, b1, CASE WHEN row_ % 3 = 0 THEN 65536e0 END AS explicit_nd,
                  CASE WHEN row_ % 3 = 1 THEN 25e0 END AS file_nd FROM scene_px)
SELECT row_, col_, CASE WHEN coalesce(explicit_nd, file_nd) IS NULL THEN CASE WHEN b1 > 0 THEN 1 ELSE 0 END
  WHEN b1 <> coalesce(explicit_nd, file_nd) THEN 1 ELSE 0 END AS valid_out,
  CASE WHEN coalesce(explicit_nd, file_nd) IS NULL THEN 'footprint_nonzero_fallback' ELSE 'footprint_nodata' END AS valid_source
FROM s""")
def valid_from_footprint(spark, sf):
    px = fixture(spark, sf, "scene_px")
    explicit = F.when(c("row_") % 3 == 0, F.lit(65536.0))
    in_file = F.when(c("row_") % 3 == 1, F.lit(25.0))
    valid, source = M.valid_from_footprint(c("b1"), explicit, in_file)
    return px.select("row_", "col_", valid.alias("valid_out"), source.alias("valid_source"))


@query("valid_precedence", """
WITH m AS (SELECT row_, col_, extent_gt AS mask_value FROM scene_px WHERE row_ % 4 = 0),
     f AS (SELECT row_, col_, valid FROM scene_px WHERE row_ % 4 = 1)
SELECT s.row_, s.col_, coalesce(CASE WHEN m.mask_value > 0 THEN 1 WHEN m.mask_value IS NOT NULL THEN 0 END, f.valid, 1) AS valid_out,
  CASE WHEN m.mask_value IS NOT NULL THEN 'valid_mask' WHEN f.valid IS NOT NULL THEN 'footprint' ELSE 'all_valid' END AS valid_source
FROM scene_px s LEFT JOIN m ON s.row_ = m.row_ AND s.col_ = m.col_ LEFT JOIN f ON s.row_ = f.row_ AND s.col_ = f.col_""")
def valid_precedence(spark, sf):
    px = fixture(spark, sf, "scene_px")
    mask = px.filter(c("row_") % 4 == 0).select("raster_id", "row_", "col_", c("extent_gt").alias("mask_value"))
    foot = px.filter(c("row_") % 4 == 1).select("raster_id", "row_", "col_", c("valid").alias("foot_valid"))
    on = ["raster_id", "row_", "col_"]
    j = px.select(*on).join(mask, on, "left").join(foot, on, "left")
    return j.select(
        "row_", "col_",
        F.coalesce((c("mask_value") > 0).cast("int"), c("foot_valid"), F.lit(1)).alias("valid_out"),
        F.when(c("mask_value").isNotNull(), "valid_mask").when(c("foot_valid").isNotNull(), "footprint")
        .otherwise("all_valid").alias("valid_source"),
    )


@query("hard_background", """
SELECT row_, col_, CASE WHEN valid = 0 THEN 0e0 ELSE extent_prob + 0.25e0 END AS extent_out FROM scene_px""")
def hard_background(spark, sf):
    px = fixture(spark, sf, "scene_px")
    return px.select("row_", "col_", M.hard_background(c("extent_prob") + 0.25, c("valid")).alias("extent_out"))


@query("prob_autoscale", """
WITH r AS (SELECT CAST(o_custkey % 4 AS INT) AS rid, o_orderkey AS px,
  CASE o_custkey % 4 WHEN 0 THEN CAST(o_orderkey % 100 AS DOUBLE) / 100 WHEN 1 THEN CAST(o_orderkey % 256 AS DOUBLE)
       WHEN 2 THEN CAST(o_orderkey % 101 AS DOUBLE) ELSE CAST(o_orderkey % 2 AS DOUBLE) END AS v FROM orders),
 s AS (SELECT rid, min(v) AS lo, max(v) AS hi FROM r GROUP BY rid)
SELECT r.rid, r.px, round(greatest(0e0, least(1e0, v / CASE WHEN hi <= 1.000001e0 THEN 1e0 ELSE 255e0 END)), 6) AS prob
FROM r JOIN s ON r.rid = s.rid""")
def prob_autoscale(spark, sf):
    from acreage.plans.registry import table
    o = table(spark, sf, "orders").select((c("o_custkey") % 4).cast("int").alias("rid"), c("o_orderkey").alias("px"))
    k = c("px")
    v = (F.when(c("rid") == 0, (k % 100).cast("double") / 100).when(c("rid") == 1, (k % 256).cast("double"))
         .when(c("rid") == 2, (k % 101).cast("double")).otherwise((k % 2).cast("double")))
    out = M.autoscale(o.withColumn("v", v), "v", ["rid"])
    return out.select("rid", "px", F.round("prob", 6).alias("prob"))


@query("nodata_ignore", """
SELECT row_, col_, CASE WHEN valid = 0 THEN 255 ELSE extent_gt END AS extent_ig,
       CASE WHEN valid = 0 THEN 2 ELSE boundary_gt END AS bwbl FROM scene_px""")
def nodata_ignore(spark, sf):
    return fixture(spark, sf, "scene_px").select(
        "row_", "col_", M.ignore_where_invalid(c("extent_gt"), c("valid"), 255).alias("extent_ig"),
        M.ignore_where_invalid(c("boundary_gt"), c("valid"), 2).alias("bwbl"))


@query("field_mask_threshold", """
SELECT row_, col_, CAST(extent_prob >= 0.5e0 AND valid = 1 AS INT) AS field, CAST(boundary_prob >= 0.5e0 AND valid = 1 AS INT) AS barrier
FROM scene_px""")
def field_mask_threshold(spark, sf):
    return fixture(spark, sf, "scene_px").select(
        "row_", "col_", ((c("extent_prob") >= 0.5) & (c("valid") == 1)).cast("int").alias("field"),
        ((c("boundary_prob") >= 0.5) & (c("valid") == 1)).cast("int").alias("barrier"))


@query("patch_accept", """
SELECT patch_id, CASE WHEN valid_ratio < 0.6e0 THEN 'valid' WHEN inside_mode = 'negative' AND mask_ratio > 0.05e0 THEN 'neg_mask'
  WHEN inside_mode <> 'negative' AND (mask_ratio < 0.1e0 OR mask_ratio > 0.95e0) THEN 'mask' END AS reject_reason FROM patch_meta""")
def patch_accept(spark, sf):
    p = fixture(spark, sf, "patch_meta")
    return p.select("patch_id", M.accept_patch(c("inside_mode"), c("valid_ratio"), c("mask_ratio"), 0.6, 0.1, 0.95, 0.05)
                    .alias("reject_reason"))


def with_height(px):
    """Pixels with the height of their raster."""
    heights = px.groupBy("raster_id").agg((F.max("row_") + 1).alias("height"))
    return join_checked(px, heights, ["raster_id"], "inner")


@query("window_centered", """
SELECT row_, col_, CASE WHEN col_ - 16 >= 0 AND row_ - 10 >= 0 AND col_ + 16 <= 250 AND row_ + 10 <= (SELECT max(row_) + 1 FROM scene_px) THEN col_ - 16 END AS xoff,
 CASE WHEN col_ - 16 >= 0 AND row_ - 10 >= 0 AND col_ + 16 <= 250 AND row_ + 10 <= (SELECT max(row_) + 1 FROM scene_px) THEN row_ - 10 END AS yoff FROM scene_px""")
def window_centered(spark, sf):
    x, y = M.centered_window(c("row_"), c("col_"), 32, 20, F.lit(250), c("height"))
    return with_height(fixture(spark, sf, "scene_px")).select("row_", "col_", x.alias("xoff"), y.alias("yoff"))


def _norm_sql(expr, stats):
    cols = ", ".join(f"round(CASE WHEN valid = 0 THEN 0e0 ELSE {expr.format(b=b)} END, 6) AS n{b[1]}" for b in BANDS)
    return f"WITH st AS (SELECT {stats} FROM scene_px WHERE valid = 1) SELECT row_, col_, {cols} FROM scene_px CROSS JOIN st"


@query("normalize_robust", _norm_sql(
    "greatest(0e0, least(1e0, ({b} - lo_{b}) / greatest(hi_{b} - lo_{b}, 1e-6)))",
    ", ".join(f"quantile_cont({b}, 0.02) AS lo_{b}, quantile_cont({b}, 0.98) AS hi_{b}" for b in BANDS)))
def normalize_robust(spark, sf):
    px = fixture(spark, sf, "scene_px")
    st = band_percentiles(px.filter("valid = 1"), ["raster_id"], BANDS, (0.02, 0.98))
    j = join_checked(px, st, ["raster_id"], "inner")
    return j.select("row_", "col_", *[
        F.round(M.robust_scale(c(b), c(f"q_{b}")[0], c(f"q_{b}")[1], c("valid")), 6).alias(f"n{b[1]}") for b in BANDS])


@query("normalize_meanstd", _norm_sql(
    "({b} - mu_{b}) / greatest(sd_{b}, 1e-6)",
    ", ".join(f"avg({b}) AS mu_{b}, stddev_pop({b}) AS sd_{b}" for b in BANDS)))
def normalize_meanstd(spark, sf):
    px = fixture(spark, sf, "scene_px")
    st = band_mean_std(px.filter("valid = 1"), ["raster_id"], BANDS)
    j = join_checked(px, st, ["raster_id"], "inner")
    return j.select("row_", "col_", *[
        F.round(M.standard_scale(c(b), c(f"mean_{b}"), c(f"std_{b}"), c("valid")), 6).alias(f"n{b[1]}") for b in BANDS])


@query("stack_valid", "SELECT row_, col_, b1 AS c1, b2 AS c2, b3 AS c3, b4 AS c4, CAST(valid AS DOUBLE) AS c5 FROM scene_px")
def stack_valid(spark, sf):
    px = fixture(spark, sf, "scene_px").select(
        "row_", "col_", F.concat(F.array(*bands()), F.array(c("valid").cast("double"))).alias("stack"))
    return px.select("row_", "col_", *[c("stack")[i].alias(f"c{i + 1}") for i in range(5)])


@query("layer_switch", """
SELECT row_, col_, extent_gt AS extent, 0 AS extent_ig, 0 AS boundary_raw, 0 AS boundary_bwbl FROM scene_px""")
def layer_switch(spark, sf):
    on = {"extent": True, "extent_ig": False, "boundary_raw": False, "boundary_bwbl": False}
    source = {"extent": "extent_gt", "extent_ig": "extent_gt", "boundary_raw": "boundary_gt", "boundary_bwbl": "boundary_gt"}
    return fixture(spark, sf, "scene_px").select(
        "row_", "col_", *[(c(source[k]) if v else F.lit(0)).alias(k) for k, v in on.items()])


@query("pad_border_ignore", """
SELECT row_, col_, CASE WHEN row_ < 7 OR row_ >= (SELECT max(row_) + 1 FROM scene_px) - 7 OR col_ < 7 OR col_ >= 243 THEN 255 ELSE extent_gt END AS extent_ig,
  CASE WHEN row_ < 7 OR row_ >= (SELECT max(row_) + 1 FROM scene_px) - 7 OR col_ < 7 OR col_ >= 243 THEN 2 ELSE boundary_gt END AS bwbl FROM scene_px""")
def pad_border_ignore(spark, sf):
    args = (c("row_"), c("col_"), c("height"), F.lit(250), 7)
    return with_height(fixture(spark, sf, "scene_px")).select(
        "row_", "col_", M.pad_border(c("extent_gt"), *args, 255).alias("extent_ig"),
        M.pad_border(c("boundary_gt"), *args, 2).alias("bwbl"))


@query("mask_domain_check", """
SELECT 'extent' AS layer, extent_gt AS value, count(*) AS n, CAST(sum(CASE WHEN valid = 0 AND extent_gt <> 255 THEN 1 ELSE 0 END) AS BIGINT) AS bad_invalid,
  extent_gt NOT IN (0, 1) AS unexpected FROM scene_px GROUP BY extent_gt
UNION ALL SELECT 'boundary', boundary_gt, count(*), CAST(sum(CASE WHEN valid = 0 AND boundary_gt <> 2 THEN 1 ELSE 0 END) AS BIGINT),
  boundary_gt NOT IN (0, 1, 2) FROM scene_px GROUP BY boundary_gt""")
def mask_domain_check(spark, sf):
    """Values of each mask, how often, and whether they belong to the allowed set."""
    px = fixture(spark, sf, "scene_px")
    rules = F.array(
        F.struct(F.lit("extent").alias("layer"), c("extent_gt").alias("value"), F.lit(255).alias("ignore"), F.array(F.lit(0), F.lit(1)).alias("allowed")),
        F.struct(F.lit("boundary").alias("layer"), c("boundary_gt").alias("value"), F.lit(2).alias("ignore"), F.array(F.lit(0), F.lit(1), F.lit(2)).alias("allowed")))
    long = px.select("valid", F.explode(rules).alias("r"))
    return long.groupBy(c("r.layer").alias("layer"), c("r.value").alias("value")).agg(
        F.count("*").alias("n"),
        F.sum(((c("valid") == 0) & (c("r.value") != c("r.ignore"))).cast("bigint")).alias("bad_invalid"),
        F.max(~F.array_contains(c("r.allowed"), c("r.value"))).alias("unexpected"))


@query("coregister", """
WITH e AS (SELECT row_, col_, extent_prob FROM scene_px), b AS (SELECT row_, col_, boundary_prob FROM scene_px),
 v AS (SELECT row_, col_, valid FROM scene_px)
SELECT e.row_, e.col_, CASE WHEN valid = 0 THEN 0e0 ELSE extent_prob END AS extent_prob,
  CASE WHEN valid = 0 THEN 0e0 ELSE boundary_prob END AS boundary_prob, valid
FROM e JOIN b ON e.row_ = b.row_ AND e.col_ = b.col_ JOIN v ON e.row_ = v.row_ AND e.col_ = v.col_""")
def coregister(spark, sf):
    px = fixture(spark, sf, "scene_px")
    on = ["raster_id", "row_", "col_"]
    j = (px.select(*on, "extent_prob")
         .join(px.select(*on, "boundary_prob"), on)
         .join(px.select(*on, "valid"), on))
    return j.select("row_", "col_", M.hard_background(c("extent_prob"), c("valid")).alias("extent_prob"),
                    M.hard_background(c("boundary_prob"), c("valid")).alias("boundary_prob"), "valid")


@query("split_mask", """
SELECT row_, col_, CAST(extent_prob >= 0.4e0 AND boundary_prob < 0.6e0 AS INT) AS core,
  CAST(extent_prob >= 0.4e0 AND boundary_prob < 0.6e0 AND b4 >= 3 AND valid = 1 AS INT) AS seeds FROM scene_px""")
def split_mask(spark, sf):
    field, barrier = c("extent_prob") >= 0.4, c("boundary_prob") >= 0.6
    core = field & ~barrier
    return fixture(spark, sf, "scene_px").select(
        "row_", "col_", core.cast("int").alias("core"), (core & (c("b4") >= 3) & (c("valid") == 1)).cast("int").alias("seeds"))


@query("sigmoid_probs", "SELECT row_, col_, round(1e0 / (1e0 + exp(-(b2 - b3) / 10)), 6) AS prob FROM scene_px")
def sigmoid_probs(spark, sf):
    return fixture(spark, sf, "scene_px").select("row_", "col_", F.round(sigmoid((c("b2") - c("b3")) / 10), 6).alias("prob"))


@query("blend_weights", """
WITH s AS (SELECT row_, col_, CAST(row_ % 9 AS DOUBLE) / 4 - 1 AS y, CAST(col_ % 12 AS DOUBLE) * 2 / 11 - 1 AS x FROM scene_px)
SELECT row_, col_, round(greatest(0.05e0, exp(-0.5e0 * (x * x + y * y) / 0.09e0) / exp(-0.5e0 * (1e0 / 121) / 0.09e0)), 6) AS w_gauss, 1e0 AS w_mean FROM s""")
def blend_weights(spark, sf):
    w = gaussian_weight(c("row_") % 9, c("col_") % 12, F.lit(9), F.lit(12), 0.3, 0.05)
    return fixture(spark, sf, "scene_px").select("row_", "col_", F.round(w, 6).alias("w_gauss"), F.lit(1.0).alias("w_mean"))


@query("augment_flip_rot", """
SELECT chip, v, row_, 7 - col_ AS h_col, 7 - row_ AS v_row, col_, 7 - col_ AS r1_row, row_ AS r1_col, 7 - row_ AS r2_row, 7 - col_ AS r2_col,
  col_ AS r3_row, 7 - row_ AS r3_col FROM chip_px""")
def augment_flip_rot(spark, sf):
    """New coordinates of every pixel under both flips and the three quarter turns (counter-clockwise)."""
    from acreage.operators.augment import flip, rotate
    n = F.lit(8)
    r, k = c("row_"), c("col_")
    cols = {"h_col": flip(k, n), "v_row": flip(r, n)}
    for q in (1, 2, 3):
        cols[f"r{q}_row"], cols[f"r{q}_col"] = rotate(r, k, n, q)
    return fixture(spark, sf, "chip_px").select("chip", "v", "row_", "col_", *[e.alias(a) for a, e in cols.items()])


@query("area_to_px", """
SELECT p_partkey, CASE WHEN p_size - 5 <= 0 THEN 0 ELSE greatest(1, CAST(round_even(CAST(p_size - 5 AS DOUBLE) / 4, 0) AS BIGINT)) END AS px FROM part""")
def area_to_px_q(spark, sf):
    from acreage.plans.registry import table
    return table(spark, sf, "part").select("p_partkey", area_to_px((c("p_size") - 5).cast("double"), F.lit(4.0)).alias("px"))
