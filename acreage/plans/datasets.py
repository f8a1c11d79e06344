"""Dataset-level reports and the incremental jobs."""

from __future__ import annotations

from pyspark.sql import functions as F

from acreage.functions import geometry as G
from acreage.operators import vectors as V
from acreage.plans.registry import fixture, query
from acreage.plans.sampling import RECS, records, split_sql
from acreage.plans.scans import CHECKS, LAYERS, checked
from acreage.plans.vectors import AREA, IDS, features
from acreage.session import join_checked, scratch_path
from acreage.sources import catalog as K
from acreage.streaming import jobs

c = F.col


@query("check_prep", """
WITH l AS (SELECT s.*, t.layer FROM samples s CROSS JOIN (VALUES ('img'), ('extent'), ('bwbl'), ('valid')) t(layer)), m AS (SELECT split, count(*) AS missing FROM l WHERE (layer = 'bwbl' AND patch_no % 50 = 7 AND split = 'train') GROUP BY split),
 s AS (SELECT split, count(*) AS n, count(DISTINCT dataset) AS datasets, round(avg(valid_ratio), 6) AS valid_mean, round(min(mask_ratio), 6) AS mask_min, round(max(mask_ratio), 6) AS mask_max, count(*) FILTER (mask_ratio > 1 OR mask_ratio < 0 OR valid_ratio > 1 OR valid_ratio < 0) AS bad_ratio FROM samples GROUP BY split)
SELECT s.split, n, datasets, valid_mean, mask_min, mask_max, coalesce(missing, 0) AS missing_layers, bad_ratio, n > 0 AND coalesce(missing, 0) = 0 AND bad_ratio = 0 AS ok FROM s LEFT JOIN m ON m.split = s.split""")
def check_prep(spark, sf):
    """Per split: sample statistics, missing layer files, ratios out of range, and the verdict."""
    s = fixture(spark, sf, "samples")
    files = K.layer_paths(s, LAYERS).filter(~((c("layer") == "bwbl") & (c("patch_no") % 50 == 7) & (c("split") == "train")))
    missing = K.missing_layers(s, files, LAYERS).groupBy("split").agg(F.count("*").alias("missing_layers"))
    out = lambda n: (c(n) > 1) | (c(n) < 0)
    g = s.groupBy("split").agg(F.count("*").alias("n"), F.countDistinct("dataset").alias("datasets"), F.round(F.avg("valid_ratio"), 6).alias("valid_mean"),
                               F.round(F.min("mask_ratio"), 6).alias("mask_min"), F.round(F.max("mask_ratio"), 6).alias("mask_max"), F.count_if(out("mask_ratio") | out("valid_ratio")).alias("bad_ratio"))
    j = g.join(missing, "split", "left").withColumn("missing_layers", F.coalesce("missing_layers", F.lit(0)))
    return j.withColumn("ok", (c("n") > 0) & (c("missing_layers") == 0) & (c("bad_ratio") == 0))


@query("check_inputs", f"""
WITH {CHECKS}, r AS (SELECT dataset, count(*) AS rasters, count(*) FILTER (errors <> '') AS with_errors, count(*) FILTER (warnings <> '') AS with_warnings, round(avg(valid_ratio), 6) AS valid_ratio FROM chk GROUP BY dataset),
 f AS (SELECT concat('ds_', CAST(orig_fid AS VARCHAR)) AS dataset, count(*) AS features_raw, count(*) FILTER (is_empty) AS empty_dropped FROM fields GROUP BY orig_fid), p AS (SELECT concat('ds_', CAST(orig_fid AS VARCHAR)) AS dataset, count(*) FILTER (is_bowtie) AS invalid, count(*) FILTER ({AREA} >= 15) AS kept FROM field_parts GROUP BY orig_fid)
SELECT r.dataset, rasters, with_errors, with_warnings, valid_ratio, coalesce(features_raw, 0) AS features_raw, coalesce(empty_dropped, 0) AS empty_dropped, coalesce(invalid, 0) AS invalid, coalesce(kept, 0) AS kept, with_errors = 0 AND coalesce(kept, 0) > 0 AS qa_ok
FROM r LEFT JOIN f USING (dataset) LEFT JOIN p USING (dataset)""")
def check_inputs(spark, sf):
    """Raster expectations, valid ratio and vector preparation rolled up per dataset."""
    r = checked(spark, sf).groupBy("dataset").agg(
        F.count("*").alias("rasters"), F.count_if(F.size("errors") > 0).alias("with_errors"), F.count_if(F.size("warnings") > 0).alias("with_warnings"), F.round(F.avg("valid_ratio"), 6).alias("valid_ratio"))
    feats = features(spark, sf).withColumn("dataset", F.concat(F.lit("ds_"), c("orig_fid").cast("string")))
    f = feats.groupBy("dataset").agg(F.count("*").alias("features_raw"), F.count_if(F.size("parts") == 0).alias("empty_dropped"))
    polys = V.explode_parts(feats)
    bad = V.invalid_parts(polys.select(*IDS, "rings"), IDS).withColumn("bad", F.lit(1))
    p = join_checked(polys.select(*IDS, "dataset", G.polygon_area(c("rings")).alias("area")), bad, IDS, "left")
    p = p.groupBy("dataset").agg(F.count("bad").alias("invalid"), F.count_if(c("area") >= 15).alias("kept"))
    j = r.join(f, "dataset", "left").join(p, "dataset", "left")
    zero = lambda n: F.coalesce(n, F.lit(0)).alias(n)
    j = j.select("dataset", "rasters", "with_errors", "with_warnings", "valid_ratio", *[zero(n) for n in ("features_raw", "empty_dropped", "invalid", "kept")])
    return j.withColumn("qa_ok", (c("with_errors") == 0) & (c("kept") > 0))


@query("stream_intake", """
WITH b AS (SELECT CAST(floor(row_ / 10e0) AS INT) AS raster_id, count(*) AS px, count(*) FILTER (valid = 1 AND extent_prob >= 0.5e0) AS field_px FROM scene_px GROUP BY 1) SELECT raster_id, 'ok' AS status, px, field_px FROM b""")
def stream_intake(spark, sf):
    """Bands of the scene arrive in two deliveries; each is processed once."""
    root = scratch_path(spark, "intake")
    px = fixture(spark, sf, "scene_px").select(F.floor(c("row_") / 10).cast("int").alias("raster_id"), "row_", "col_", "valid", "extent_prob")
    process = lambda df: df.groupBy("raster_id").agg(F.count("*").alias("px"), F.count_if((c("valid") == 1) & (c("extent_prob") >= 0.5)).alias("field_px"))
    for part in (px.filter("raster_id % 2 = 0"), px.filter("raster_id % 2 = 1")):
        part.repartition(4, "raster_id").write.mode("append").parquet(f"{root}/in")
        jobs.raster_intake(spark, f"{root}/in", "raster_id int, row_ int, col_ int, valid int, extent_prob double", f"{root}/out", f"{root}/ckpt", process)
    done = spark.read.option("recursiveFileLookup", "true").parquet(f"{root}/out/results")
    return jobs.latest_status(spark, f"{root}/out").select("raster_id", "status").join(done, "raster_id", "left")


@query("stream_split", f"""WITH {RECS.format(t='customer')}, first AS (SELECT * FROM recs WHERE ord % 3 <> 0), none AS (SELECT patch_id, 'train' AS split FROM recs WHERE false),
 {split_sql('first', 'none', '1')}, {split_sql('recs', 'done1', '2')} SELECT * FROM done1 UNION ALL SELECT * FROM done2""")
def stream_split(spark, sf):
    """Patches arrive in two deliveries; the second keeps the first one's assignments."""
    root = scratch_path(spark, "split-stream")
    recs, _ = records(spark, sf)
    for part in (recs.filter("ord % 3 <> 0"), recs):
        part.write.mode("append").parquet(f"{root}/in")
        jobs.split_intake(spark, f"{root}/in", "ord bigint, patch_id string, gk string", f"{root}/assigned", f"{root}/ckpt", (0.7, 0.2, 0.1), 81)
    return spark.read.parquet(f"{root}/assigned").select("patch_id", "gk", "split")
