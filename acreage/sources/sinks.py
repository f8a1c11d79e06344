"""Writers: patch layers, JSON manifests, split export, GeoJSON lines, tiled rasters, histories."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from acreage.functions.geometry import RINGS
from acreage.session import join_checked


def first_bands(px: DataFrame, bands: Sequence[str], n: int) -> DataFrame:
    """Keep the first ``n`` bands (column pruning reaches the scan)."""
    if n > len(bands):
        raise ValueError(f"expected at least {n} bands, got {len(bands)}")
    drop = set(bands[n:])
    return px.select(*[c for c in px.columns if c not in drop])


def write_patch_layers(px: DataFrame, ids: Sequence[str], layers: Sequence[str], partition: str, path: str) -> None:
    """One row per patch; each layer is an array in scan order. A patch has a fixed, small size."""
    rows = px.groupBy(*ids).agg(F.array_sort(F.collect_list(F.struct("row_", "col_", *layers))).alias("_p"))
    layer = lambda n: F.transform("_p", lambda s: s[n]).alias(n)
    rows.select(*ids, *[layer(n) for n in layers]).write.mode("overwrite").partitionBy(partition).parquet(path)


def write_json(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def export_split(samples: DataFrame, path: str, overwrite: bool = False) -> None:
    """Append patches that are not exported yet, partitioned by split; ``overwrite`` replaces the export."""
    spark = samples.sparkSession
    if not overwrite:
        hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
        if hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop):
            samples = samples.join(spark.read.parquet(path).select("patch_id"), "patch_id", "left_anti")
    samples.write.mode("overwrite" if overwrite else "append").partitionBy("split").parquet(path)


def write_geojson(polys: DataFrame, props: Sequence[str], path: str) -> None:
    """GeoJSON features, one per line."""
    coords = F.transform("rings", lambda r: F.transform(r, lambda p: F.array(p["x"], p["y"])))
    feature = F.struct(F.lit("Feature").alias("type"), F.struct(*props).alias("properties"), F.struct(F.lit("Polygon").alias("type"), coords.alias("coordinates")).alias("geometry"))
    polys.select(F.to_json(feature).alias("value")).write.mode("overwrite").text(path)


def read_geojson(spark: SparkSession, path: str, props: str) -> DataFrame:
    schema = f"type string, properties struct<{', '.join(':'.join(p.split()) for p in props.split(','))}>, geometry struct<type:string,coordinates:array<array<array<double>>>>"
    df = spark.read.schema(schema).json(path, mode="FAILFAST")
    rings = F.transform("geometry.coordinates", lambda r: F.transform(r, lambda p: F.struct(p[0].alias("x"), p[1].alias("y"))))
    return df.select("properties.*", rings.cast(RINGS).alias("rings"))


def write_raster(px: DataFrame, value: str, dtype: str, path: str, block: int = 256) -> None:
    """Tiles of at most block x block pixels: one row per tile, sorted by position for row-group pruning."""
    at = lambda c: F.floor(F.col(c) / block).cast("int")
    t = px.groupBy("raster_id", at("row_").alias("tile_row"), at("col_").alias("tile_col")).agg(
        F.array_sort(F.collect_list(F.struct("row_", "col_", F.col(value).cast(dtype).alias(value)))).alias("px"))
    t.sortWithinPartitions("raster_id", "tile_row", "tile_col").write.mode("overwrite").parquet(path)


def read_raster(spark: SparkSession, path: str, value: str) -> DataFrame:
    return spark.read.parquet(path).select("raster_id", F.inline("px")).select("raster_id", "row_", "col_", value)


def append_csv(rows: DataFrame, path: str) -> None:
    rows.write.mode("append").option("header", True).csv(path)


def batch_summary(items: DataFrame, batch: str, order: str, fail_fast: Column) -> DataFrame:
    """Counts by status. With ``fail_fast`` items after the first failed one count as skipped."""
    first = items.filter("status = 'failed'").groupBy(batch).agg(F.min(order).alias("_fail"))
    j = join_checked(items, first, [batch], "left")
    final = F.when(fail_fast & F.col("_fail").isNotNull() & (F.col(order) > F.col("_fail")), "skipped").otherwise(F.col("status"))
    n = lambda s: F.count_if(final == s).alias(s)
    return j.groupBy(batch).agg(F.count("*").alias("total"), n("ok"), n("failed"), n("skipped"))
