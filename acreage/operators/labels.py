"""Training labels: skeletons, boundary labels and all label layers of a set of windows."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import DataFrame, functions as F

from acreage.functions import arrays as A
from acreage.operators import stencil as T, vectors as V
from acreage.operators.masks import pad_border
from acreage.operators.spatial import pixels_in_windows
from acreage.operators.stencil import Tile, block_map

#: Side of the largest patch unless the caller names another; a patch is one block, and a larger one is an error, never cut.
PATCH_SIDE = 4096


def whole_patch(px: DataFrame, side: int) -> DataFrame:
    """Pixels of patches that fit in one block of that side; others raise."""
    outside = F.raise_error(F.concat(F.lit("a patch has a pixel beyond its side: "), F.greatest("row_", "col_").cast("string"))).cast("int")
    return px.withColumn("row_", F.when((F.col("row_") < side) & (F.col("col_") < side), F.col("row_")).otherwise(outside))


def skeletonize(px: DataFrame, mask: str, keys: Sequence[str], keep: Sequence[str] = (), out: str = "skeleton", side: int = PATCH_SIDE) -> DataFrame:
    """One-pixel lines per patch of at most ``side`` pixels a side."""
    def fn(t: Tile):
        return {out: A.thin(t.present & (t[mask] > 0)).astype(np.int32), **{k: t[k] for k in keep}}

    types = dict(px.dtypes)
    ddl = f"{out} int" + "".join(f", {k} {types[k]}" for k in keep)
    return block_map(whole_patch(px, side), fn, ddl, 0, keys, list(dict.fromkeys([mask, *keep])), side)


def boundary_label(px: DataFrame, skeleton: str, keys: Sequence[str], radius: int, size: tuple[int, int], pad: int = 0, valid: str | None = None,
                   keep: Sequence[str] = (), codes: tuple[int, int, int] = (0, 1, 2), out: str = "bwbl") -> DataFrame:
    """Background, skeleton and buffer: the buffer is set first, the skeleton over it, then border, then invalid pixels."""
    background, line, buffer_ = codes
    cols = list(dict.fromkeys([skeleton, *([valid] if valid else []), *keep]))
    d = T.dilate(whole_patch(px, max(size)), skeleton, A.ellipse(radius), "_near", cols, keys, max(size)) if radius > 0 else px.withColumn("_near", F.lit(0))
    v = F.when(F.col(skeleton) > 0, line).when(F.col("_near") > 0, buffer_).otherwise(background)
    v = pad_border(v, F.col("row_"), F.col("col_"), F.lit(size[0]), F.lit(size[1]), pad, buffer_)
    if valid:
        v = F.when(F.col(valid) == 0, buffer_).otherwise(v)
    return d.select(*keys, "row_", "col_", v.alias(out), *cols)


def window_labels(windows: DataFrame, px: DataFrame, polys: DataFrame, width: int, height: int, size: int, ignore_radius: int = 1, buffer_radius: int = 1,
                  pad: int = 0, include_holes: bool = True, cell: int = 64) -> DataFrame:
    """All label layers of every window, in window coordinates.

    Polygons are burnt once for the whole raster; windows then cut the pixels they need.
    """
    from acreage.functions.geometry import strip_holes
    if not include_holes:
        polys = polys.withColumn("rings", strip_holes(F.col("rings")))
    on = ["raster_id", "row_", "col_"]
    burn = lambda d, name: d.select("raster_id", "row_", "col_", F.lit(1).alias(name)).distinct()
    ids = ["raster_id", "feat_index", "part"]
    full = px.select(*on, "valid").join(burn(V.fill(polys, ids, width, height), "extent"), on, "left").join(burn(V.lines(polys, ids, width, height), "line"), on, "left")
    full = full.select(*on, "valid", F.coalesce("extent", F.lit(0)).alias("extent"), F.coalesce("line", F.lit(0)).alias("line"))
    cut = pixels_in_windows(full, windows, ["raster_id"], cell)
    cut = cut.select("win", (F.col("row_") - F.col("y")).alias("row_"), (F.col("col_") - F.col("x")).alias("col_"), "valid", "extent", "line")

    def draw_boundary(t: Tile):
        line, ext = t["line"], (t["extent"] > 0).astype(np.int32)
        if not line.any() and ext.any():
            hi = A.stencil_max(np.where(t.present, ext, 0), A.square(1), 0)
            lo = A.stencil_min(np.where(t.present, ext, 1), A.square(1), 1)
            line = (hi > lo).astype(np.int32)
        zone = A.stencil_max(line.astype(np.uint8), A.ellipse(ignore_radius), 0) if ignore_radius > 0 else np.zeros_like(line)
        return {"extent": ext, "extent_ig": np.where(zone > 0, 255, ext), "boundary_raw": line, "skeleton": A.thin(line > 0), "valid": t["valid"]}

    lab = block_map(cut, draw_boundary, "extent int, extent_ig int, boundary_raw int, skeleton int, valid int", 0, ["win"], ["valid", "extent", "line"], size)
    ig = pad_border(F.col("extent_ig"), F.col("row_"), F.col("col_"), F.lit(size), F.lit(size), pad, 255)
    lab = lab.withColumn("extent_ig", ig)
    out = boundary_label(lab, "skeleton", ["win"], buffer_radius, (size, size), pad, "valid", ["extent", "extent_ig", "boundary_raw"])
    return out.withColumn("extent_ig", F.when(F.col("valid") == 0, 255).otherwise(F.col("extent_ig")))


def label_stats(labels: DataFrame, keys: Sequence[str], ignore: int = 255) -> DataFrame:
    share = lambda cond: F.avg(cond.cast("double"))
    return labels.groupBy(*keys).agg(
        share(F.col("extent") > 0).alias("mask_ratio"), share(F.col("boundary_raw") > 0).alias("edge_ratio"), share(F.col("skeleton") > 0).alias("skeleton_ratio"),
        share(F.col("extent_ig") == ignore).alias("ignore_ratio"))
