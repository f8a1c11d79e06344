"""Aggregates, windows and scalar formulas on pixels, patches, run histories and manifests."""

from __future__ import annotations

from pyspark.sql import Window, functions as F

from acreage.functions import scalars as S
from acreage.operators import masks as M
from acreage.operators.budget import auto_budget, patch_targets, shortfall, split_targets
from acreage.operators.metrics import boundary_gap, extent_counts, extent_scores
from acreage.operators.statistics import band_mean_std, band_percentiles, weighted_scores
from acreage.plans.registry import draw_sql, fixture, query, table
from acreage.session import join_checked, number_rows, top_per_group

BANDS = ["b1", "b2", "b3", "b4"]
c = F.col
TILE = "CAST(floor(row_ / 64e0) AS INT) AS tile_row, CAST(floor(col_ / 64e0) AS INT) AS tile_col"


def tile_cols():
    return F.floor(c("row_") / 64).cast("int").alias("tile_row"), F.floor(c("col_") / 64).cast("int").alias("tile_col")


CONFUSION = """tp, fp, fn, round(CASE WHEN tp + fp + fn > 0 THEN CAST(tp AS DOUBLE) / (tp + fp + fn) ELSE 1 END, 6) AS iou,
 round(p, 6) AS precision_, round(r, 6) AS recall_, round(CASE WHEN p + r > 0 THEN 2 * p * r / (p + r) ELSE 0 END, 6) AS f1"""
PR = """CASE WHEN tp + fp > 0 THEN CAST(tp AS DOUBLE) / (tp + fp) ELSE 1e0 END AS p,
 CASE WHEN tp + fn > 0 THEN CAST(tp AS DOUBLE) / (tp + fn) ELSE 1e0 END AS r"""


@query("extent_metrics", f"""
WITH m AS (SELECT {TILE}, CASE WHEN valid = 0 THEN 0e0 ELSE extent_prob END >= 0.5e0 AS pred,
   CASE WHEN valid = 0 THEN 255 ELSE extent_gt END AS gt FROM scene_px),
 n AS (SELECT tile_row, tile_col, CAST(sum(CASE WHEN pred AND gt = 1 THEN 1 ELSE 0 END) AS BIGINT) AS tp,
   CAST(sum(CASE WHEN pred AND gt = 0 THEN 1 ELSE 0 END) AS BIGINT) AS fp,
   CAST(sum(CASE WHEN NOT pred AND gt = 1 THEN 1 ELSE 0 END) AS BIGINT) AS fn FROM m GROUP BY tile_row, tile_col),
 q AS (SELECT *, {PR} FROM n)
SELECT tile_row, tile_col, {CONFUSION} FROM q""")
def extent_metrics(spark, sf):
    px = fixture(spark, sf, "scene_px")
    prob = M.hard_background(c("extent_prob"), c("valid"))
    gt = M.ignore_where_invalid(c("extent_gt"), c("valid"), 255)
    flat = px.select(*tile_cols(), (prob >= 0.5).alias("pred"), gt.alias("gt"))
    return extent_scores(extent_counts(flat, ["tile_row", "tile_col"], c("pred"), c("gt"), 255))


@query("boundary_prob_gap", """
SELECT raster_id, round(coalesce(avg(boundary_prob) FILTER (boundary_gt = 1), 0), 6) AS pos_mean, round(coalesce(avg(boundary_prob) FILTER (boundary_gt = 0), 0), 6) AS neg_mean,
 round(coalesce(avg(boundary_prob) FILTER (boundary_gt = 1), 0) - coalesce(avg(boundary_prob) FILTER (boundary_gt = 0), 0), 6) AS gap FROM scene_px GROUP BY raster_id""")
def boundary_prob_gap(spark, sf):
    return boundary_gap(fixture(spark, sf, "scene_px"), ["raster_id"], c("boundary_prob"), c("boundary_gt"))


@query("supervision_fracs", """
WITH t AS (SELECT CAST(floor(row_ / 10e0) AS INT) AS batch, avg(CASE WHEN extent_gt <> 255 THEN 1e0 ELSE 0e0 END) AS sup_e,
  avg(CASE WHEN boundary_gt <> 2 THEN 1e0 ELSE 0e0 END) AS sup_b, avg(CASE WHEN valid = 0 THEN 1e0 ELSE 0e0 END) AS inv,
  CASE WHEN count(*) FILTER (boundary_gt <> 2) > 0 THEN CAST(count(*) FILTER (boundary_gt = 1) AS DOUBLE) / count(*) FILTER (boundary_gt <> 2) ELSE CAST('nan' AS DOUBLE) END AS pos_b
  FROM scene_px GROUP BY 1)
SELECT round(avg(sup_e), 6) AS extent_supervised, round(avg(sup_b), 6) AS boundary_supervised, round(avg(inv), 6) AS invalid_frac,
 round(avg(pos_b) FILTER (NOT isnan(pos_b)), 6) AS boundary_pos_frac FROM t""")
def supervision_fracs(spark, sf):
    px = fixture(spark, sf, "scene_px")
    share = lambda cond: F.avg(cond.cast("double"))
    per_batch = px.groupBy(F.floor(c("row_") / 10).cast("int").alias("batch")).agg(
        share(c("extent_gt") != 255).alias("e"), share(c("boundary_gt") != 2).alias("b"), share(c("valid") == 0).alias("i"),
        S.ratio(F.count_if(c("boundary_gt") == 1), F.count_if(c("boundary_gt") != 2), S.NAN).alias("p"))
    finite = F.avg(F.when(~F.isnan("p"), c("p")))
    return per_batch.agg(F.round(F.avg("e"), 6).alias("extent_supervised"), F.round(F.avg("b"), 6).alias("boundary_supervised"),
                         F.round(F.avg("i"), 6).alias("invalid_frac"), F.round(finite, 6).alias("boundary_pos_frac"))


@query("bce_dice_scores", f"""
WITH s AS (SELECT {TILE}, (boundary_prob - 0.5e0) * 4 AS x, boundary_gt AS t FROM scene_px),
 e AS (SELECT *, 1e0 / (1e0 + exp(-x)) AS p, CASE WHEN t = 1 THEN greatest(-x, 0e0) + ln(1 + exp(-abs(x))) ELSE greatest(x, 0e0) + ln(1 + exp(-abs(x))) END AS raw FROM s),
 f AS (SELECT *, raw * pow(greatest(1e0 - CASE WHEN t = 1 THEN p ELSE 1 - p END, 1e-6), 2) AS fl FROM e WHERE t <> 2),
 g AS (SELECT tile_row, tile_col, sum(CASE WHEN t = 1 THEN fl ELSE 0 END) AS pl, sum(CASE WHEN t = 0 THEN fl ELSE 0 END) AS nl, CAST(count(*) FILTER (t = 1) AS DOUBLE) AS pos,
   CAST(count(*) AS DOUBLE) AS n, sum(CASE WHEN t = 1 THEN p ELSE 0 END) AS inter, sum(p) AS ps FROM f GROUP BY tile_row, tile_col),
 h AS (SELECT *, CASE WHEN pos > 0 THEN greatest(1e0, least(16e0, (n - pos) / greatest(pos, 1e0))) ELSE 1e0 END AS w FROM g)
SELECT tile_row, tile_col, round(w, 6) AS pos_weight, round((pl * w + nl) / greatest(n, 1e0), 6) AS bce, round(1 - (2 * inter + 1) / (ps + pos + 1), 6) AS dice,
 round(pos / n, 6) AS pos_frac, CAST(n AS BIGINT) AS valid_pixels FROM h""")
def bce_dice_scores(spark, sf):
    px = fixture(spark, sf, "scene_px").select(*tile_cols(), ((c("boundary_prob") - 0.5) * 4).alias("x"), "boundary_gt")
    s = weighted_scores(px, ["tile_row", "tile_col"], "x", "boundary_gt", 2, gamma=2.0, auto_weight=True)
    r = lambda n: F.round(n, 6).alias(n)
    return s.select("tile_row", "tile_col", r("pos_weight"), r("bce"), r("dice"), r("pos_frac"), c("valid_pixels").cast("bigint"))


@query("valid_ratio", f"SELECT {TILE}, avg(CAST(valid AS DOUBLE)) AS valid_ratio, count(*) AS px FROM scene_px GROUP BY 1, 2")
def valid_ratio(spark, sf):
    return fixture(spark, sf, "scene_px").groupBy(*tile_cols()).agg(F.avg(c("valid").cast("double")).alias("valid_ratio"), F.count("*").alias("px"))


@query("valid_ratio_sampled", f"""
WITH w AS (SELECT n_nationkey AS win, CAST(floor({draw_sql('n_nationkey', '1', 123)} * (250 - 16 + 1)) AS INT) AS x, CAST(floor({draw_sql('n_nationkey', '2', 123)} * ((SELECT max(row_) + 1 FROM scene_px) - 16 + 1)) AS INT) AS y FROM nation)
SELECT CAST(sum(valid) AS BIGINT) AS valid_px, count(*) AS total_px, round(CAST(sum(valid) AS DOUBLE) / count(*), 6) AS valid_ratio
FROM w JOIN scene_px s ON s.col_ >= w.x AND s.col_ < w.x + 16 AND s.row_ >= w.y AND s.row_ < w.y + 16""")
def valid_ratio_sampled(spark, sf):
    """Valid share over randomly placed 16 px windows (one per row of ``nation``)."""
    from acreage.operators.spatial import pixels_in_windows
    k = c("n_nationkey")
    px = fixture(spark, sf, "scene_px").select("raster_id", "row_", "col_", "valid")
    w = table(spark, sf, "nation").select(
        F.lit(0).alias("raster_id"), k.alias("win"), S.draw_int(k, 1, 123, 0, 250 - 16).alias("x"), S.draw(k, 2, 123).alias("_u"), F.lit(16).alias("w"), F.lit(16).alias("h"))
    heights = px.groupBy("raster_id").agg((F.max("row_") + 1).alias("_height"))
    w = join_checked(w, heights, ["raster_id"], "inner").withColumn("y", F.floor(c("_u") * (c("_height") - 16 + 1)).cast("int")).drop("_u", "_height")
    hit = pixels_in_windows(px, w, cell=64)
    return hit.agg(F.sum(c("valid").cast("bigint")).alias("valid_px"), F.count("*").alias("total_px"),
                   F.round(F.avg(c("valid").cast("double")), 6).alias("valid_ratio"))


_PCT = ", ".join(f"round(quantile_cont({b}, 0.02), 6) AS {b}_lo, round(quantile_cont({b}, 0.5), 6) AS {b}_mid, round(quantile_cont({b}, 0.98), 6) AS {b}_hi" for b in BANDS)


@query("band_percentiles", f"SELECT raster_id, {_PCT} FROM scene_px WHERE valid = 1 GROUP BY raster_id")
def band_percentiles_q(spark, sf):
    st = band_percentiles(fixture(spark, sf, "scene_px").filter("valid = 1"), ["raster_id"], BANDS, (0.02, 0.5, 0.98))
    return st.select("raster_id", *[F.round(c(f"q_{b}")[i], 6).alias(f"{b}_{n}") for b in BANDS for i, n in enumerate(("lo", "mid", "hi"))])


@query("band_mean_std", "SELECT raster_id, " + ", ".join(f"round(avg({b}), 6) AS mean_{b}, round(greatest(stddev_pop({b}), 1e-6), 6) AS std_{b}" for b in BANDS)
       + " FROM scene_px WHERE valid = 1 GROUP BY raster_id")
def band_mean_std_q(spark, sf):
    st = band_mean_std(fixture(spark, sf, "scene_px").filter("valid = 1"), ["raster_id"], BANDS)
    return st.select("raster_id", *[F.round(n, 6).alias(n) for n in st.columns if n != "raster_id"])


@query("meta_stats", """
SELECT split, dataset, count(*) AS n, round(min(valid_ratio), 6) AS vmin, round(avg(valid_ratio), 6) AS vmean, round(median(valid_ratio), 6) AS vmedian, round(max(valid_ratio), 6) AS vmax,
 round(avg(mask_ratio), 6) AS mmean, round(median(edge_ratio), 6) AS emedian FROM samples GROUP BY split, dataset""")
def meta_stats(spark, sf):
    s = fixture(spark, sf, "samples")
    q = band_percentiles(s, ["split", "dataset"], ["valid_ratio", "edge_ratio"], (0.5,))
    g = s.groupBy("split", "dataset").agg(
        F.count("*").alias("n"), F.round(F.min("valid_ratio"), 6).alias("vmin"), F.round(F.avg("valid_ratio"), 6).alias("vmean"),
        F.round(F.max("valid_ratio"), 6).alias("vmax"), F.round(F.avg("mask_ratio"), 6).alias("mmean"))
    return g.join(q, ["split", "dataset"]).select("split", "dataset", "n", "vmin", "vmean", "vmax", "mmean",
        F.round(c("q_valid_ratio")[0], 6).alias("vmedian"), F.round(c("q_edge_ratio")[0], 6).alias("emedian"))


@query("epoch_means", "SELECT epoch, metric, CAST(sum(CAST(round(value * 100) AS BIGINT)) AS DOUBLE) / (100 * count(*)) AS value FROM history GROUP BY epoch, metric")
def epoch_means(spark, sf):
    return fixture(spark, sf, "history").groupBy("epoch", "metric").agg(
        (F.sum(F.round(c("value") * 100).cast("bigint")).cast("double") / (F.count("*") * 100)).alias("value"))


@query("moving_average", """
SELECT run_id, epoch, round(avg(value) OVER (PARTITION BY run_id ORDER BY epoch ROWS BETWEEN 4 PRECEDING AND CURRENT ROW), 6) AS smooth FROM history""")
def moving_average(spark, sf):
    w = Window.partitionBy("run_id").orderBy("epoch").rowsBetween(-4, 0)
    return fixture(spark, sf, "history").select("run_id", "epoch", F.round(F.avg("value").over(w), 6).alias("smooth"))


@query("best_so_far", """
WITH h AS (SELECT run_id, epoch, CASE WHEN epoch % 11 = 0 THEN CAST('nan' AS DOUBLE) ELSE value END AS value FROM history),
 b AS (SELECT *, max(CASE WHEN isnan(value) THEN NULL ELSE value END) OVER (PARTITION BY run_id ORDER BY epoch ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS prev,
  max(epoch) OVER (PARTITION BY run_id) AS last_epoch FROM h)
SELECT run_id, epoch, NOT isnan(value) AND (prev IS NULL OR value > prev) AS saved_best, epoch = last_epoch AS is_last FROM b""")
def best_so_far(spark, sf):
    """Checkpoint rule: saved where a finite metric strictly beats every earlier one of the run."""
    h = fixture(spark, sf, "history").select("run_id", "epoch", F.when(c("epoch") % 11 == 0, F.lit(S.NAN)).otherwise(c("value")).alias("value"))
    finite = F.when(~F.isnan("value"), c("value"))
    prev = F.max(finite).over(Window.partitionBy("run_id").orderBy("epoch").rowsBetween(Window.unboundedPreceding, -1))
    last = F.max("epoch").over(Window.partitionBy("run_id"))
    return h.select("run_id", "epoch", (~F.isnan("value") & (prev.isNull() | (c("value") > prev))).alias("saved_best"), (c("epoch") == last).alias("is_last"))


@query("scalar_ratios", """
WITH t AS (SELECT p_partkey, p_size % 5 AS tp, p_partkey % 4 AS fp, p_size % 3 AS fn FROM part), q AS (SELECT *, """ + PR + """ FROM t)
SELECT p_partkey, greatest(2, least(4, tp)) AS clamped, round(p, 6) AS precision_, round(CASE WHEN p + r > 0 THEN 2 * p * r / (p + r) ELSE 0 END, 6) AS f1,
 CASE WHEN tp + fp + fn <= 0 THEN NULL ELSE round(CASE WHEN p + r > 0 THEN 2 * p * r / (p + r) ELSE 0 END, 6) END AS f1_or_null FROM q""")
def scalar_ratios(spark, sf):
    t = table(spark, sf, "part").select("p_partkey", (c("p_size") % 5).alias("tp"), (c("p_partkey") % 4).alias("fp"), (c("p_size") % 3).alias("fn"))
    nan_f1 = S.f1_from_counts(c("tp"), c("fp"), c("fn"), S.NAN)
    return t.select("p_partkey", S.clamp(c("tp"), 2, 4).alias("clamped"), F.round(S.ratio(c("tp"), c("tp") + c("fp"), 1.0), 6).alias("precision_"),
                    F.round(S.f1_from_counts(c("tp"), c("fp"), c("fn")), 6).alias("f1"), F.when(~F.isnan(nan_f1), F.round(nan_f1, 6)).alias("f1_or_null"))


@query("utm_epsg", """
SELECT c_custkey, CAST((CASE WHEN lat >= 0 THEN 32600 ELSE 32700 END) + greatest(1, least(60, floor((lon + 180) / 6) + 1)) AS INT) AS epsg,
 CAST((CASE WHEN lat >= 0 THEN 32600 ELSE 32700 END) + floor((lon + 180) / 6) + 1 AS INT) AS epsg_unclamped
FROM (SELECT c_custkey, CAST((c_custkey * 7) % 361 AS DOUBLE) - 180 AS lon, CAST(c_custkey % 161 AS DOUBLE) - 80 AS lat FROM customer)""")
def utm_epsg_q(spark, sf):
    lon, lat = ((c("c_custkey") * 7) % 361).cast("double") - 180, (c("c_custkey") % 161).cast("double") - 80
    return table(spark, sf, "customer").select("c_custkey", S.utm_epsg(lon, lat).alias("epsg"), S.utm_epsg(lon, lat, False).alias("epsg_unclamped"))


@query("dataset_seed", """
WITH h AS (SELECT c_custkey, sha256(c_name) AS d FROM customer),
 b AS (SELECT c_custkey, concat('0x', d[15:16], d[13:14], d[11:12], d[9:10], d[7:8], d[5:6], d[3:4], d[1:2]) AS x FROM h)
SELECT c_custkey, CAST((CAST(CAST(x AS UBIGINT) AS HUGEINT) + 123) % 9223372036854775807 AS BIGINT) AS seed FROM b""")
def dataset_seed(spark, sf):
    return table(spark, sf, "customer").select("c_custkey", S.dataset_seed(c("c_name"), 123).alias("seed"))


@query("safe_ids", """
SELECT page_id, CASE WHEN s = '' THEN 'sample' ELSE s END AS safe FROM (
 SELECT page_id, regexp_replace(regexp_replace(lower(trim(url)), '[^a-z0-9]+', '_', 'g'), '^_+|_+$', '', 'g') AS s FROM pages)""")
def safe_ids(spark, sf):
    return table(spark, sf, "pages").select("page_id", S.slug(c("url")).alias("safe"))


@query("field_ids", """
SELECT c_custkey, concat('ds::', coalesce(v, CAST(c_custkey AS VARCHAR))) AS by_column, concat('ds::', CAST(c_nationkey AS VARCHAR)) AS by_orig, concat('ds::', CAST(c_custkey AS VARCHAR)) AS by_index
FROM (SELECT c_custkey, c_nationkey, CASE WHEN c_custkey % 9 = 0 OR c_custkey % 10 = 1 OR c_custkey % 11 = 2 THEN NULL ELSE trim(c_name) END AS v FROM customer)""")
def field_ids(spark, sf):
    k = c("c_custkey")
    value = F.when(k % 9 == 0, "  ").when(k % 10 == 1, "None").when(k % 11 == 2, "NaN").otherwise(F.concat(F.lit(" "), c("c_name")))
    return table(spark, sf, "customer").select("c_custkey", S.field_id(F.lit("ds"), k, id_value=value).alias("by_column"),
        S.field_id(F.lit("ds"), k, orig_fid=c("c_nationkey")).alias("by_orig"), S.field_id(F.lit("ds"), k).alias("by_index"))


@query("split_group_key", """
SELECT patch_id, CASE WHEN field_id IS NOT NULL THEN concat('field::', dataset, '::', field_id) WHEN feat_index IS NULL THEN concat('neg::', patch_id)
 ELSE concat('field::', dataset, '::', CAST(feat_index AS VARCHAR)) END AS gk FROM patch_meta""")
def split_group_key(spark, sf):
    return fixture(spark, sf, "patch_meta").select("patch_id", S.split_group(c("dataset"), c("patch_id"), c("field_id"), c("feat_index")).alias("gk"))


@query("run_id_format", "SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%SZ') AS iso, strftime(ts, '%Y%m%d_%H%M%S') AS run_id FROM events")
def run_id_format(spark, sf):
    return table(spark, sf, "events").select("event_id", F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("iso"), F.date_format("ts", "yyyyMMdd_HHmmss").alias("run_id"))


@query("params_override", """
SELECT p_partkey, CASE WHEN p_size % 2 = 0 THEN 0.25e0 ELSE 0.5e0 END AS extent_thr, CASE WHEN p_size % 3 = 0 THEN CAST(p_size AS DOUBLE) ELSE 0.45e0 END AS boundary_thr,
 1e0 AS sigma, CASE WHEN p_size % 5 = 0 THEN 7e0 END AS extra FROM part""")
def params_override(spark, sf):
    """Nested override: keys of the override win, all other keys of the base stay."""
    base = F.create_map(F.lit("extent_thr"), F.lit(0.5), F.lit("boundary_thr"), F.lit(0.45), F.lit("sigma"), F.lit(1.0))
    item = lambda cond, k, v: F.when(cond, F.create_map(F.lit(k), v)).otherwise(F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<double>")))
    over = F.map_concat(item(c("p_size") % 2 == 0, "extent_thr", F.lit(0.25)), item(c("p_size") % 3 == 0, "boundary_thr", c("p_size").cast("double")), item(c("p_size") % 5 == 0, "extra", F.lit(7.0)))
    merged = F.map_zip_with(base, over, lambda k, a, b: F.coalesce(b, a))
    return table(spark, sf, "part").select("p_partkey", merged.alias("m")).select("p_partkey", *[c("m")[k].alias(k) for k in ("extent_thr", "boundary_thr", "sigma", "extra")])


@query("patch_targets", """
WITH t AS (SELECT p_partkey, p_size * 7 AS total, CAST(round_even(p_size * 7 * 0.75e0, 0) AS BIGINT) AS pos FROM part), u AS (SELECT *, CAST(round_even(pos * 0.625e0, 0) AS BIGINT) AS cen FROM t)
SELECT p_partkey, total AS target_total, pos AS pos_target, cen AS center_target, pos - cen AS boundary_target, total - pos AS neg_target FROM u""")
def patch_targets_q(spark, sf):
    p = table(spark, sf, "part")
    return p.select("p_partkey", *[e.alias(n) for n, e in patch_targets(c("p_size") * 7, 0.25, 0.625, 0.375).items()])


_BUDGET_IN = """SELECT c_nationkey AS dataset, CAST(count(*) AS DOUBLE) * 40000 AS raster_area, CAST(min(c_custkey) % 10 AS DOUBLE) / 8 AS valid_ratio,
 CAST(sum(c_custkey % 4000) AS DOUBLE) * 8 AS field_area, CAST(sum(c_custkey % 700) AS DOUBLE) * 4 AS boundary_len FROM {customer} GROUP BY c_nationkey"""


@query("patch_budget", f"""
WITH i AS ({_BUDGET_IN.replace('{customer}', 'customer')}),
 a AS (SELECT *, raster_area * least(1e0, valid_ratio) AS valid_area FROM i),
 k AS (SELECT dataset, CAST(floor(least(raster_area, valid_area) / 4096) AS BIGINT) AS area_cap, CAST(floor(least(field_area, valid_area) / 4096) AS BIGINT) AS cen,
   CAST(floor(least(boundary_len / 80, valid_area / 4096)) AS BIGINT) AS bnd, CAST(floor(least(greatest(valid_area - field_area, 0), valid_area) / 4096) AS BIGINT) AS neg FROM a),
 b AS (SELECT *, CASE WHEN cen <= 0 THEN 0e0 ELSE cen / 0.5e0 END AS b_c, CASE WHEN bnd <= 0 THEN 0e0 ELSE bnd / 0.25e0 END AS b_b, CASE WHEN neg <= 0 THEN 0e0 ELSE neg / 0.25e0 END AS b_n FROM k),
 t AS (SELECT *, least(CAST(area_cap AS DOUBLE), b_c, b_b, b_n) AS lim FROM b),
 u AS (SELECT *, CAST(floor(lim) AS BIGINT) AS total FROM t), v AS (SELECT *, CASE WHEN total < 20 THEN 0 ELSE least(total, 300) END AS target FROM u),
 w AS (SELECT *, CAST(round_even(target * 0.75e0, 0) AS BIGINT) AS pos FROM v)
SELECT dataset, total AS estimated_total_capacity, cen AS estimated_center_capacity, bnd AS estimated_boundary_capacity, neg AS estimated_negative_capacity, target AS estimated_total_target,
 CAST(round_even(pos * (0.5e0 / 0.75e0), 0) AS BIGINT) AS estimated_center_target, target - pos AS estimated_negative_target, total < 20 AS skipped,
 concat_ws(',', CASE WHEN area_cap - lim < 1e-9 THEN 'area' END, CASE WHEN b_b - lim < 1e-9 THEN 'boundary' END, CASE WHEN b_c - lim < 1e-9 THEN 'center' END, CASE WHEN b_n - lim < 1e-9 THEN 'negative' END) AS limiters
FROM w""")
def patch_budget(spark, sf):
    i = spark.sql(_BUDGET_IN.replace("{customer}", f"parquet.`{sf}/customer.parquet`"))
    b = auto_budget(i, patch_size=64, train_crop=64, neg_ratio=0.25, center_w=0.5, boundary_w=0.25, overlap=0.5, span=80.0, min_keep=20, max_total=300)
    return b.select("dataset", "estimated_total_capacity", "estimated_center_capacity", "estimated_boundary_capacity", "estimated_negative_capacity",
                    "estimated_total_target", "estimated_center_target", "estimated_negative_target", "skipped", F.array_join("limiters", ",").alias("limiters"))


@query("budget_preview", """
WITH t AS (SELECT p_brand, p_partkey % 5 = 0 AS skipped, CASE WHEN p_partkey % 5 = 0 THEN 0 ELSE p_size * 4 END AS auto_total, 100 AS fixed_total FROM part)
SELECT p_brand, count(*) AS checked, count(*) FILTER (skipped) AS skipped_auto, CAST(sum(auto_total) AS BIGINT) AS auto_target, CAST(sum(fixed_total) AS BIGINT) AS fixed_target,
 CAST(sum(round_even(auto_total * 0.75e0, 0)) AS BIGINT) AS auto_pos, CAST(sum(CASE WHEN p_brand LIKE '%1' THEN auto_total ELSE fixed_total END) AS BIGINT) AS effective_target FROM t GROUP BY p_brand""")
def budget_preview(spark, sf):
    skipped = c("p_partkey") % 5 == 0
    p = table(spark, sf, "part").select("p_brand", skipped.alias("skipped"), F.when(skipped, 0).otherwise(c("p_size") * 4).alias("auto_total"), F.lit(100).alias("fixed_total"))
    t = patch_targets(c("auto_total"), 0.25, 0.625, 0.375)
    s = lambda e: F.sum(e.cast("bigint"))
    return p.groupBy("p_brand").agg(F.count("*").alias("checked"), F.count_if("skipped").alias("skipped_auto"), s(c("auto_total")).alias("auto_target"), s(c("fixed_total")).alias("fixed_target"),
        s(t["pos_target"]).alias("auto_pos"), s(F.when(c("p_brand").like("%1"), c("auto_total")).otherwise(c("fixed_total"))).alias("effective_target"))


@query("shortfall_reasons", """
WITH r AS (SELECT dataset, count(*) FILTER (inside_mode = 'center' AND valid_ratio >= 0.6e0 AND mask_ratio >= 0.1e0) AS center, count(*) FILTER (inside_mode = 'boundary' AND valid_ratio >= 0.6e0 AND mask_ratio >= 0.1e0) AS boundary,
  count(*) FILTER (inside_mode = 'negative' AND valid_ratio >= 0.6e0 AND mask_ratio <= 0.05e0) AS negative, count(*) FILTER (valid_ratio < 0.6e0) AS valid, count(*) FILTER (inside_mode <> 'negative' AND valid_ratio >= 0.6e0 AND mask_ratio < 0.1e0) AS mask,
  count(*) FILTER (inside_mode = 'negative' AND valid_ratio >= 0.6e0 AND mask_ratio > 0.05e0) AS neg_mask FROM patch_meta GROUP BY dataset)
SELECT dataset, greatest(0, 3000 - center) AS short_center, greatest(0, 2000 - boundary) AS short_boundary, greatest(0, 2500 - negative) AS short_negative,
 CASE WHEN center < 3000 THEN coalesce(nullif(concat_ws(',', CASE WHEN valid > 0 THEN 'min_valid_ratio' END, CASE WHEN mask > 0 THEN 'mask_ratio_constraints' END), ''), 'insufficient_candidates') END AS center_reasons,
 CASE WHEN negative < 2500 THEN coalesce(nullif(concat_ws(',', CASE WHEN neg_mask > 0 THEN 'negative_mask_ratio' END, CASE WHEN valid > 0 THEN 'min_valid_ratio' END), ''), 'insufficient_candidates') END AS negative_reasons FROM r""")
def shortfall_reasons(spark, sf):
    p = fixture(spark, sf, "patch_meta")
    p = p.withColumn("reject", M.accept_patch(c("inside_mode"), c("valid_ratio"), c("mask_ratio"), 0.6, 0.1, 2.0, 0.05))
    s = shortfall(p, ["dataset"], {"center": 3000, "boundary": 2000, "negative": 2500})
    return s.select("dataset", "short_center", "short_boundary", "short_negative", F.array_join("center_reasons", ",").alias("center_reasons"), F.array_join("negative_reasons", ",").alias("negative_reasons"))


@query("split_ratios", """
SELECT p_partkey, round(CAST(p_size AS DOUBLE) / (p_size + 5 + p_partkey % 3), 6) AS train, round(5e0 / (p_size + 5 + p_partkey % 3), 6) AS validation, round(CAST(p_partkey % 3 AS DOUBLE) / (p_size + 5 + p_partkey % 3), 6) AS test FROM part""")
def split_ratios(spark, sf):
    from acreage.operators.splits import normalised_ratios
    tr, va, te = normalised_ratios(c("p_size") / 100, F.lit(0.05), (c("p_partkey") % 3) / 100)
    return table(spark, sf, "part").select("p_partkey", F.round(tr, 6).alias("train"), F.round(va, 6).alias("validation"), F.round(te, 6).alias("test"))


@query("pixel_sample_cap", f"""
WITH d AS (SELECT CAST(floor(row_ / 20e0) AS INT) AS image, row_, col_, b1, {draw_sql('row_ * 250 + col_', '7', 5)} AS u FROM scene_px WHERE valid = 1),
 r AS (SELECT *, row_number() OVER (PARTITION BY image ORDER BY u, row_, col_) AS rn FROM d)
SELECT image, row_, col_, b1 FROM r WHERE rn <= 500""")
def pixel_sample_cap(spark, sf):
    px = fixture(spark, sf, "scene_px").filter("valid = 1").select(F.floor(c("row_") / 20).cast("int").alias("image"), "row_", "col_", "b1")
    px = px.withColumn("u", S.draw(c("row_") * 250 + c("col_"), 7, 5))
    return top_per_group(px, ["image"], ["u", "row_", "col_"], 500, ["row_", "col_"]).select("image", "row_", "col_", "b1")


@query("check_sample", """
SELECT split, patch_no FROM (SELECT split, patch_no, row_number() OVER (PARTITION BY split ORDER BY patch_no) AS rn FROM samples) WHERE rn <= 8""")
def check_sample(spark, sf):
    return top_per_group(fixture(spark, sf, "samples").select("split", "patch_no"), ["split"], ["patch_no"], 8, ["patch_no"])


@query("latest_run", "SELECT user_id, max(strftime(ts, '%Y%m%d_%H%M%S')) AS run_id FROM events GROUP BY user_id")
def latest_run(spark, sf):
    return table(spark, sf, "events").groupBy("user_id").agg(F.max(F.date_format("ts", "yyyyMMdd_HHmmss")).alias("run_id"))


@query("patch_union", """
SELECT 'center' AS kind, patch_id, mask_ratio FROM patch_meta WHERE inside_mode = 'center' UNION ALL SELECT 'boundary', patch_id, mask_ratio FROM patch_meta WHERE inside_mode = 'boundary'
UNION ALL SELECT 'negative', patch_id, mask_ratio FROM patch_meta WHERE inside_mode = 'negative'""")
def patch_union(spark, sf):
    p = fixture(spark, sf, "patch_meta").select("inside_mode", "patch_id", "mask_ratio")
    kinds = [p.filter(c("inside_mode") == k).select(F.lit(k).alias("kind"), "patch_id", "mask_ratio") for k in ("center", "boundary", "negative")]
    return kinds[0].unionByName(kinds[1]).unionByName(kinds[2])


@query("dedupe_candidates", """
SELECT dir, name, page_id FROM (SELECT dir, name, page_id, row_number() OVER (PARTITION BY dir, name ORDER BY page_id) AS rn FROM files) WHERE rn = 1""")
def dedupe_candidates(spark, sf):
    """First occurrence of each path."""
    return fixture(spark, sf, "files").groupBy("dir", "name").agg(F.min("page_id").alias("page_id"))


@query("split_counts", """
SELECT split, count(*) AS n, count(DISTINCT field_id) AS fields, CAST(CASE split WHEN 'train' THEN round_even((SELECT count(*) FROM samples) * 0.8e0, 0) WHEN 'validation' THEN round_even((SELECT count(*) FROM samples) * 0.1e0, 0)
 ELSE (SELECT count(*) FROM samples) - round_even((SELECT count(*) FROM samples) * 0.8e0, 0) - round_even((SELECT count(*) FROM samples) * 0.1e0, 0) END AS BIGINT) AS target FROM samples GROUP BY split""")
def split_counts(spark, sf):
    s = fixture(spark, sf, "samples").groupBy("split").agg(F.count("*").alias("n"), F.countDistinct("field_id").alias("fields"))
    total = F.sum("n").over(Window.partitionBy())
    tgt = split_targets(total, F.lit(0.8), F.lit(0.1))
    return s.select("split", "n", "fields", F.when(c("split") == "train", tgt[0]).when(c("split") == "validation", tgt[1]).otherwise(tgt[2]).alias("target"))


@query("qa_report", """
WITH m AS (SELECT dataset, raster_id, CASE WHEN epsg IS NULL THEN concat(CAST(raster_id AS VARCHAR), ': raster CRS is missing') END AS err, CASE WHEN nodata IS NULL THEN concat(CAST(raster_id AS VARCHAR), ': nodata is missing') END AS warn FROM raster_meta)
SELECT dataset, count(*) AS rasters, count(err) = 0 AS ok, count(err) AS n_errors, count(warn) AS n_warnings, coalesce(string_agg(err, '; ' ORDER BY err), '') AS errors FROM m GROUP BY dataset""")
def qa_report(spark, sf):
    m = fixture(spark, sf, "raster_meta")
    note = lambda cond, text: F.when(cond, F.concat(c("raster_id").cast("string"), F.lit(text)))
    m = m.select("dataset", note(c("epsg").isNull(), ": raster CRS is missing").alias("err"), note(c("nodata").isNull(), ": nodata is missing").alias("warn"))
    return m.groupBy("dataset").agg(F.count("*").alias("rasters"), (F.count("err") == 0).alias("ok"), F.count("err").alias("n_errors"), F.count("warn").alias("n_warnings"),
                                    F.array_join(F.array_sort(F.collect_list("err")), "; ").alias("errors"))
