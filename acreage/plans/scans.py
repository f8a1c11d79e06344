"""Scans, discovery, resolution and sinks."""

from __future__ import annotations

from pyspark.sql import functions as F

from acreage.operators.statistics import band_percentiles
from acreage.plans.registry import fixture, query, table
from acreage.plans.vectors import polygons
from acreage.session import scratch_path
from acreage.sources import catalog as K, sinks as W

c = F.col


@query("raster_catalog", """
SELECT raster_id, dataset, width, height, band_count, dtype, nodata, epsg, c AS "left", f AS top, c + a * width AS "right", f + e * height AS bottom FROM raster_meta""")
def raster_catalog(spark, sf):
    return fixture(spark, sf, "raster_meta").select("raster_id", "dataset", "width", "height", "band_count", "dtype", "nodata", "epsg", *[e.alias(n) for n, e in K.raster_bounds().items()])


@query("window_scan", "SELECT row_, col_, b1, b2 FROM scene_px WHERE row_ >= 10 AND row_ < 42 AND col_ >= 100 AND col_ < 164")
def window_scan(spark, sf):
    return fixture(spark, sf, "scene_px").filter((c("row_") >= 10) & (c("row_") < 42) & (c("col_") >= 100) & (c("col_") < 164)).select("row_", "col_", "b1", "b2")


@query("band_subset", "SELECT row_, col_, b1, b2, b3 FROM scene_px")
def band_subset(spark, sf):
    """First bands only; asking for more bands than a raster has fails."""
    px = fixture(spark, sf, "scene_px")
    return W.first_bands(px, ["b1", "b2", "b3", "b4"], 3).select("row_", "col_", "b1", "b2", "b3")


@query("discover_inputs", """
SELECT dir, count(DISTINCT name) AS matches, CASE WHEN count(DISTINCT name) = 1 THEN min(name) END AS resolved FROM files WHERE name LIKE '%_prob.tif' OR name LIKE 'aoi%' GROUP BY dir""")
def discover_inputs(spark, sf):
    f = fixture(spark, sf, "files").filter(c("name").like("%_prob.tif") | c("name").like("aoi%"))
    return K.single_match(f, ["dir"], "name")


@query("patch_index", "SELECT split, patch_id, dataset, inside_mode FROM samples WHERE patch_id <> ''")
def patch_index(spark, sf):
    return fixture(spark, sf, "samples").filter(c("patch_id").isNotNull() & (c("patch_id") != "")).select("split", "patch_id", "dataset", "inside_mode")


LAYERS = ["img", "extent", "bwbl", "valid"]


@query("patch_index_missing", """
WITH l AS (SELECT s.*, t.layer FROM samples s CROSS JOIN (VALUES ('img'), ('extent'), ('bwbl'), ('valid')) t(layer)) SELECT split, patch_id, layer FROM l
WHERE (layer = 'bwbl' AND patch_no % 50 = 7) OR (layer = 'valid' AND patch_no % 33 = 5)""")
def patch_index_missing(spark, sf):
    s = fixture(spark, sf, "samples")
    files = K.layer_paths(s, LAYERS).filter(~((c("layer") == "bwbl") & (c("patch_no") % 50 == 7)) & ~((c("layer") == "valid") & (c("patch_no") % 33 == 5)))
    return K.missing_layers(s, files, LAYERS).select("split", "patch_id", "layer")


@query("discover_samples", """
SELECT dir AS pred_dir, regexp_replace(dir, '^/data/pred/', '') AS sample_id FROM files GROUP BY dir HAVING count(*) FILTER (name = 'extent_prob.tif') > 0 AND count(*) FILTER (name = 'boundary_prob.tif') > 0""")
def discover_samples(spark, sf):
    """Folders that hold both probability rasters; the id is the relative folder."""
    g = fixture(spark, sf, "files").groupBy("dir").agg(F.max(c("name") == "extent_prob.tif").alias("e"), F.max(c("name") == "boundary_prob.tif").alias("b"))
    return g.filter("e AND b").select(c("dir").alias("pred_dir"), F.regexp_replace("dir", "^/data/pred/", "").alias("sample_id"))


MAN = """man AS (SELECT dir, max(CASE WHEN page_id % 4 = 0 THEN url END) AS extent_path, max(CASE WHEN page_id % 3 = 0 THEN url END) AS aoi_raster, max(CASE WHEN page_id % 5 = 0 THEN url END) AS source_raster, max(url) AS input_raster,
  CASE WHEN max(page_id) % 2 = 0 THEN 65536e0 END AS nodata_value FROM files GROUP BY dir)"""


def manifest(spark, sf):
    g = fixture(spark, sf, "files").groupBy("dir")
    pick = lambda n: F.max(F.when(c("page_id") % n == 0, c("url")))
    return g.agg(pick(4).alias("extent_path"), pick(3).alias("aoi_raster"), pick(5).alias("source_raster"), F.max("url").alias("input_raster"), F.when(F.max("page_id") % 2 == 0, F.lit(65536.0)).alias("nodata_value"))


@query("resolve_samples", f"""
WITH {MAN} SELECT dir, coalesce(extent_path, concat(dir, '/extent_prob.tif')) AS extent_prob_path, coalesce(aoi_raster, source_raster, input_raster) AS footprint_path, nodata_value, CASE WHEN nodata_value IS NULL THEN 'control-band' ELSE 'all-bands' END AS nodata_rule FROM man""")
def resolve_samples(spark, sf):
    return manifest(spark, sf).select("dir", F.coalesce("extent_path", F.concat("dir", F.lit("/extent_prob.tif"))).alias("extent_prob_path"),
                                      F.coalesce("aoi_raster", "source_raster", "input_raster").alias("footprint_path"), "nodata_value",
                                      F.when(c("nodata_value").isNull(), "control-band").otherwise("all-bands").alias("nodata_rule"))


@query("sample_by_run", """
WITH s AS (SELECT DISTINCT dir, regexp_extract(dir, 'run_[0-9]+') AS run_id, regexp_extract(dir, 'sample_[0-9]+') AS sample FROM files)
SELECT sample, count(*) AS n_runs, CASE WHEN count(*) = 1 THEN min(dir) END AS only_dir, max_by(dir, run_id) AS last_dir FROM s GROUP BY sample""")
def sample_by_run(spark, sf):
    """Folder of each sample; ambiguous when several runs hold it."""
    s = fixture(spark, sf, "files").select("dir", F.regexp_extract("dir", "run_[0-9]+", 0).alias("run_id"), F.regexp_extract("dir", "sample_[0-9]+", 0).alias("sample")).distinct()
    return s.groupBy("sample").agg(F.count("*").alias("n_runs"), F.when(F.count("*") == 1, F.min("dir")).alias("only_dir"), F.max_by("dir", "run_id").alias("last_dir"))


@query("batch_sample_ids", """
WITH s AS (SELECT p_partkey, p_name, regexp_replace(regexp_replace(lower(trim(concat(p_name, CASE WHEN p_partkey % 50 = 0 THEN '@' ELSE '' END))), '[^a-z0-9]+', '_', 'g'), '^_+|_+$', '', 'g') AS slug, lower(concat(p_name, CASE WHEN p_partkey % 50 = 0 THEN '@.tif' ELSE '.tif' END)) AS k FROM part),
 n AS (SELECT *, row_number() OVER (PARTITION BY slug ORDER BY k, p_partkey) AS rn FROM s) SELECT p_partkey, CASE WHEN rn = 1 THEN slug ELSE concat(slug, '_', CAST(rn AS VARCHAR)) END AS sample_id FROM n""")
def batch_sample_ids(spark, sf):
    p = table(spark, sf, "part").select("p_partkey", F.concat("p_name", F.when(c("p_partkey") % 50 == 0, "@.tif").otherwise(".tif")).alias("file"))
    return K.unique_ids(p, "file", "p_partkey").select("p_partkey", "sample_id")


@query("resolve_aoi", """
WITH m AS (SELECT raster_id, dataset, CASE raster_id % 4 WHEN 0 THEN 'clipped' WHEN 1 THEN '' WHEN 2 THEN 'failed' ELSE 'clipped' END AS status FROM raster_meta),
 u AS (SELECT raster_id, 1 AS priority, concat('/aoi/strict_', CAST(raster_id AS VARCHAR)) AS path FROM m WHERE status IN ('clipped', '') AND raster_id % 3 <> 1 UNION ALL SELECT raster_id, 2, concat('/aoi/map_', CAST(raster_id AS VARCHAR)) FROM m WHERE raster_id % 5 < 3 UNION ALL SELECT raster_id, 3, concat('/aoi/old_', CAST(raster_id AS VARCHAR)) FROM m)
SELECT raster_id, min_by(path, priority) AS path FROM u GROUP BY raster_id""")
def resolve_aoi(spark, sf):
    """Three manifest layouts in order of preference."""
    k = c("raster_id")
    status = F.element_at(F.array(F.lit("clipped"), F.lit(""), F.lit("failed"), F.lit("clipped")), (k % 4 + 1).cast("int"))
    m = fixture(spark, sf, "raster_meta").select("raster_id", status.alias("status"))
    strict = m.filter(c("status").isin("clipped", "") & (k % 3 != 1)).select("raster_id", F.lit(1).alias("priority"), F.concat(F.lit("/aoi/strict_"), k.cast("string")).alias("path"))
    mapped = m.filter(k % 5 < 3).select("raster_id", F.lit(2).alias("priority"), F.concat(F.lit("/aoi/map_"), k.cast("string")).alias("path"))
    old = m.select("raster_id", F.lit(3).alias("priority"), F.concat(F.lit("/aoi/old_"), k.cast("string")).alias("path"))
    return K.first_by_priority(strict.unionByName(mapped).unionByName(old), ["raster_id"])


@query("resolve_patch_inputs", """
WITH m AS (SELECT raster_id, dataset, raster_id % 7 <> 0 AS prepared, raster_id % 2 = 0 AS aoi_on, CASE WHEN raster_id % 6 = 0 THEN 'failed' ELSE 'clipped' END AS status FROM raster_meta)
SELECT raster_id, CASE WHEN NOT prepared THEN NULL WHEN aoi_on AND status = 'clipped' THEN concat('/aoi/', dataset) WHEN aoi_on THEN NULL ELSE concat('/raw/', dataset) END AS raster_path, CASE WHEN NOT prepared THEN 'prepared_vector_missing' WHEN aoi_on AND status <> 'clipped' THEN 'aoi_not_clipped' END AS problem,
 CASE WHEN prepared AND aoi_on AND status = 'clipped' THEN 'aoi' WHEN prepared AND NOT aoi_on THEN 'raw' END AS raster_source FROM m""")
def resolve_patch_inputs(spark, sf):
    k = c("raster_id")
    meta = fixture(spark, sf, "raster_meta")
    check = meta.filter(k % 7 != 0).select("raster_id", F.concat(F.lit("/prep/"), "dataset").alias("prepared_vector_path"))
    aoi = meta.filter(k % 2 == 0).select("raster_id", F.lit(True).alias("aoi_on"), F.when(k % 6 == 0, "failed").otherwise("clipped").alias("status"))
    j = meta.select("raster_id", "dataset").join(check, "raster_id", "left").join(aoi, "raster_id", "left")
    on, ready, clipped = F.coalesce("aoi_on", F.lit(False)), c("prepared_vector_path").isNotNull(), c("status") == "clipped"
    path = F.when(ready & on & clipped, F.concat(F.lit("/aoi/"), "dataset")).when(ready & ~on, F.concat(F.lit("/raw/"), "dataset"))
    return j.select("raster_id", path.alias("raster_path"), F.when(~ready, "prepared_vector_missing").when(on & ~clipped, "aoi_not_clipped").alias("problem"),
                    F.when(ready & on & clipped, "aoi").when(ready & ~on, "raw").alias("raster_source"))


# Ground-truth file extensions, vectors before rasters (fixed values).
GT_EXT = (".gpkg", ".shp", ".geojson", ".json", ".tif", ".tiff")


@query("resolve_gt", """
WITH e AS (SELECT * FROM (VALUES (0, '.gpkg'), (1, '.shp'), (2, '.geojson'), (3, '.json'), (4, '.tif'), (5, '.tiff')) e(i, ext)),
 cand AS (SELECT s_suppkey, concat('/gt/s', CAST(s_suppkey AS VARCHAR), p.tail, ext) AS path FROM supplier CROSS JOIN e CROSS JOIN (VALUES (''), ('/gt'), ('/leaf')) p(tail)),
 lst AS (SELECT concat('/gt/s', CAST(s_suppkey AS VARCHAR), CASE s_suppkey % 3 WHEN 0 THEN '' WHEN 1 THEN '/gt' ELSE '/leaf' END, ext) AS path FROM supplier CROSS JOIN e WHERE (s_suppkey + i) % 4 < 2 AND s_suppkey % 11 <> 0)
SELECT s_suppkey, path FROM (SELECT s_suppkey, path, row_number() OVER (PARTITION BY s_suppkey ORDER BY length(path), path) AS rn FROM cand JOIN lst USING (path)) WHERE rn = 1""")
def resolve_gt(spark, sf):
    k = c("s_suppkey")
    s = table(spark, sf, "supplier").select("s_suppkey", F.posexplode(F.array(*[F.lit(e) for e in GT_EXT])).alias("i", "ext"))
    base = F.concat(F.lit("/gt/s"), k.cast("string"))
    cand = s.withColumn("tail", F.explode(F.array(F.lit(""), F.lit("/gt"), F.lit("/leaf")))).select("s_suppkey", F.concat(base, "tail", "ext").alias("path"))
    tail = F.when(k % 3 == 0, "").when(k % 3 == 1, "/gt").otherwise("/leaf")
    listing = s.filter(((k + c("i")) % 4 < 2) & (k % 11 != 0)).select(F.concat(base, tail, "ext").alias("path"))
    return K.shortest(cand.join(listing, "path", "left_semi"), ["s_suppkey"])


@query("manifest_strict", """
SELECT dataset, count(*) AS rasters, CAST(sum(CASE WHEN epsg IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS n_errors, CAST(sum(CASE WHEN nodata IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS n_warnings FROM raster_meta GROUP BY dataset""")
def manifest_strict(spark, sf):
    """Written manifest read back with a fixed schema; an absent warnings list reads as empty."""
    m = fixture(spark, sf, "raster_meta")
    rows = m.select("dataset", F.lit("/raw").alias("root"), F.concat(F.lit("/raw/"), c("raster_id").cast("string")).alias("raw_raster_path"), c("epsg").isNotNull().alias("qa_ok"),
                    F.when(c("epsg").isNull(), F.array(F.lit("crs"))).otherwise(F.array().cast("array<string>")).alias("errors"), F.when(c("nodata").isNull(), F.array(F.lit("nodata"))).alias("warnings"))
    path = scratch_path(spark, "check-manifest")
    rows.write.json(path)
    r = K.read_manifest(spark, path, K.CHECK_MANIFEST, ["dataset", "qa_ok"])
    return r.groupBy("dataset").agg(F.count("*").alias("rasters"), F.sum(F.size("errors").cast("bigint")).alias("n_errors"), F.sum(F.size("warnings").cast("bigint")).alias("n_warnings"))


@query("alignment_check", """
SELECT raster_id, raster_id % 8 <> 3 AS same_size, epsg IS NOT DISTINCT FROM CASE WHEN raster_id % 9 = 2 THEN 3857 ELSE epsg END AS same_crs, raster_id % 10 <> 4 AS same_affine FROM raster_meta""")
def alignment_check(spark, sf):
    m = fixture(spark, sf, "raster_meta")
    k = c("raster_id")
    other = m.withColumn("width", F.when(k % 8 == 3, c("width") + 1).otherwise(c("width"))).withColumn("epsg", F.when(k % 9 == 2, 3857).otherwise(c("epsg"))).withColumn(
        "c", F.when(k % 10 == 4, c("c") + 1e-6).otherwise(c("c") + 1e-12))
    return K.aligned(m, other, "raster_id")


CHECKS = """x AS (SELECT m.*, f.ebc, f.edt, f.end_, CAST((raster_id * 7) % 10 AS DOUBLE) / 10 AS valid_ratio FROM raster_meta m CROSS JOIN (SELECT band_count AS ebc, dtype AS edt, nodata AS end_ FROM raster_meta ORDER BY raster_id LIMIT 1) f),
 chk AS (SELECT raster_id, dataset, valid_ratio, concat_ws(',', CASE WHEN epsg IS NULL THEN 'crs_missing' END, CASE WHEN abs(b) > 1e-12 OR abs(d) > 1e-12 THEN 'rotated' END, CASE WHEN band_count <> ebc THEN 'band_count_mismatch' END, CASE WHEN dtype <> edt THEN 'dtype_mismatch' END) AS errors,
 concat_ws(',', CASE WHEN end_ IS NOT NULL AND nodata IS DISTINCT FROM end_ THEN 'nodata_mismatch' END, CASE WHEN nodata IS NULL THEN 'nodata_missing' END, CASE WHEN valid_ratio < 0.7e0 THEN 'low_valid_ratio' END) AS warnings FROM x)"""


def checked(spark, sf):
    return K.expectation_checks(fixture(spark, sf, "raster_meta").withColumn("valid_ratio", ((c("raster_id") * 7) % 10).cast("double") / 10))


@query("expectation_checks", f"WITH {CHECKS} SELECT raster_id, errors, warnings FROM chk")
def expectation_checks(spark, sf):
    return checked(spark, sf).select("raster_id", F.array_join("errors", ",").alias("errors"), F.array_join("warnings", ",").alias("warnings"))


@query("patch_layers_sink", "SELECT chip, dataset_id, 64 AS n_px, CAST(sum(fg) AS BIGINT) AS extent_px, 0 AS bwbl_px FROM chip_px GROUP BY chip, dataset_id")
def patch_layers_sink(spark, sf):
    """One row per patch with an array per layer, partitioned by dataset; a disabled layer is written as zeros."""
    px = fixture(spark, sf, "chip_px").select("chip", "dataset_id", "row_", "col_", c("fg").alias("extent"), F.lit(0).alias("bwbl"))
    path = scratch_path(spark, "patch-layers")
    W.write_patch_layers(px, ["chip", "dataset_id"], ["extent", "bwbl"], "dataset_id", path)
    total = lambda a: F.aggregate(a, F.lit(0).cast("bigint"), lambda acc, v: acc + v)
    return spark.read.parquet(path).select("chip", "dataset_id", F.size("extent").alias("n_px"), total("extent").alias("extent_px"), total("bwbl").cast("int").alias("bwbl_px"))


@query("patch_manifest_sink", "SELECT patch_id, dataset, inside_mode, field_id, valid_ratio, 1 - valid_ratio AS nodata_frac, 'control-band' AS rule FROM patch_meta")
def patch_manifest_sink(spark, sf):
    p = fixture(spark, sf, "patch_meta")
    path = scratch_path(spark, "patch-meta")
    policy = F.struct(F.lit(65536.0).alias("value"), F.lit("control-band").alias("rule"), F.lit(1).alias("control_band_1based"))
    W.write_json(p.select("patch_id", "dataset", "inside_mode", "field_id", "valid_ratio", (F.lit(1) - c("valid_ratio")).alias("nodata_frac"), policy.alias("nodata_policy")), path)
    r = spark.read.schema("patch_id string, dataset string, inside_mode string, field_id string, valid_ratio double, nodata_frac double, nodata_policy struct<value:double,rule:string,control_band_1based:int>").json(path)
    return r.select("patch_id", "dataset", "inside_mode", "field_id", "valid_ratio", "nodata_frac", c("nodata_policy.rule").alias("rule"))


@query("stage_manifest_roundtrip", "SELECT dataset, CAST(raster_id AS VARCHAR) AS raster, CASE WHEN epsg IS NULL THEN 'failed' ELSE 'clipped' END AS status, nodata FROM raster_meta")
def stage_manifest_roundtrip(spark, sf):
    m = fixture(spark, sf, "raster_meta").select("dataset", c("raster_id").cast("string").alias("raster"), F.when(c("epsg").isNull(), "failed").otherwise("clipped").alias("status"), "nodata")
    path = scratch_path(spark, "aoi-manifest")
    W.write_json(m, path)
    return spark.read.schema(m.schema).json(path, mode="FAILFAST").select("dataset", "raster", "status", "nodata")


@query("split_export", "SELECT split, count(*) AS n, count(DISTINCT patch_id) AS patches FROM samples GROUP BY split")
def split_export(spark, sf):
    """Two exports into one folder; the second adds only patches that are not there yet."""
    s = fixture(spark, sf, "samples").select("patch_id", "dataset", "split")
    path = scratch_path(spark, "split-export")
    W.export_split(s.filter("dataset <> 'ds_3'"), path)
    W.export_split(s, path)
    return spark.read.parquet(path).groupBy("split").agg(F.count("*").alias("n"), F.countDistinct("patch_id").alias("patches"))


@query("vector_sink", "SELECT feat_index, part, CASE WHEN has_hole THEN 2 ELSE 1 END AS n_rings, x0, y0 FROM field_parts")
def vector_sink(spark, sf):
    path = scratch_path(spark, "fields")
    W.write_geojson(polygons(spark, sf), ["feat_index", "part"], path)
    r = W.read_geojson(spark, path, "feat_index bigint, part int")
    return r.select("feat_index", "part", F.size("rings").alias("n_rings"), c("rings")[0][0]["x"].alias("x0"), c("rings")[0][0]["y"].alias("y0"))


@query("raster_sink", "SELECT row_, col_, CAST(extent_prob AS FLOAT) AS extent_prob FROM scene_px")
def raster_sink(spark, sf):
    px = fixture(spark, sf, "scene_px").select("raster_id", "row_", "col_", "extent_prob")
    path = scratch_path(spark, "extent-raster")
    W.write_raster(px, "extent_prob", "float", path, block=64)
    return W.read_raster(spark, path, "extent_prob").select("row_", "col_", "extent_prob")


@query("band_stats_roundtrip", "SELECT raster_id, " + ", ".join(f"round(quantile_cont({b}, 0.02), 6) AS {b}_lo, round(quantile_cont({b}, 0.98), 6) AS {b}_hi" for b in ("b1", "b2")) + " FROM scene_px WHERE valid = 1 GROUP BY raster_id")
def band_stats_roundtrip(spark, sf):
    st = band_percentiles(fixture(spark, sf, "scene_px").filter("valid = 1"), ["raster_id"], ["b1", "b2"], (0.02, 0.98))
    path = scratch_path(spark, "band-stats")
    st.write.parquet(path)
    r = spark.read.parquet(path)
    return r.select("raster_id", *[F.round(c(f"q_{b}")[i], 6).alias(f"{b}_{n}") for b in ("b1", "b2") for i, n in enumerate(("lo", "hi"))])


@query("history_csv", "SELECT run_id, epoch, metric, value FROM history")
def history_csv(spark, sf):
    """History rows appended in two writes and read back."""
    h = fixture(spark, sf, "history")
    path = scratch_path(spark, "history")
    for part in (h.filter("epoch <= 10"), h.filter("epoch > 10")):
        W.append_csv(part, path)
    return spark.read.schema("run_id bigint, epoch int, metric string, value double").csv(path, header=True)


BATCH = """b AS (SELECT o_custkey % 50 AS batch, o_orderkey AS item, CASE WHEN o_orderstatus = 'P' THEN 'failed' ELSE 'ok' END AS status, row_number() OVER (PARTITION BY o_custkey % 50 ORDER BY o_orderkey) AS pos FROM orders)"""


@query("batch_summary", f"""
WITH {BATCH}, f AS (SELECT batch, min(pos) FILTER (status = 'failed') AS first_fail FROM b GROUP BY batch), s AS (SELECT b.*, CASE WHEN batch % 2 = 0 AND pos > first_fail THEN 'skipped' ELSE status END AS final FROM b JOIN f USING (batch))
SELECT batch, count(*) AS total, count(*) FILTER (final = 'ok') AS ok, count(*) FILTER (final = 'failed') AS failed, count(*) FILTER (final = 'skipped') AS skipped FROM s GROUP BY batch""")
def batch_summary(spark, sf):
    """Status counts per batch; a fail-fast batch skips everything after its first failure."""
    b = table(spark, sf, "orders").select((c("o_custkey") % 50).alias("batch"), c("o_orderkey").alias("item"), F.when(c("o_orderstatus") == "P", "failed").otherwise("ok").alias("status"))
    return W.batch_summary(b, "batch", "item", c("batch") % 2 == 0)
