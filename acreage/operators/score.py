"""Tiled scoring of rasters with a user model, and blending of overlapping tiles."""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from acreage.functions.scalars import gaussian_weight
from acreage.operators.spatial import pixels_in_windows
from acreage.operators.stencil import stream_groups

KEYS = ("raster_id",)


def starts(total: Column, window: Column, stride: int) -> Column:
    """Tile starts by stride, plus a last tile flush with the end."""
    end = F.greatest(total - window, F.lit(0)).cast("int")
    regular = F.sequence(F.lit(0), end, F.lit(stride))
    return F.array_distinct(F.concat(regular, F.array(end)))


def tile_windows(rasters: DataFrame, window: int, stride: int, keys: Sequence[str] = KEYS) -> DataFrame:
    """Overlapping windows of every raster (columns keys, width, height): x, y, w, h."""
    if not 1 <= stride <= window:
        raise ValueError(f"stride {stride} must lie in 1..{window}")
    w, h = F.least(F.lit(window), F.col("width")), F.least(F.lit(window), F.col("height"))
    t = rasters.select(*keys, "width", "height", w.alias("w"), h.alias("h"))
    t = t.withColumn("y", F.explode(starts(F.col("height"), F.col("h"), stride)))
    return t.withColumn("x", F.explode(starts(F.col("width"), F.col("w"), stride))).select(*keys, "x", "y", "w", "h")


def tile_pixels(px: DataFrame, tiles: DataFrame, keys: Sequence[str] = KEYS, cell: int = 256) -> DataFrame:
    """Pixels of every tile with their position r, k inside it."""
    j = pixels_in_windows(px, tiles, keys, cell)
    return j.withColumn("r", F.col("row_") - F.col("y")).withColumn("k", F.col("col_") - F.col("x"))


def pad_tiles(pixels: DataFrame, tiles: DataFrame, window: int, bands: Sequence[str], keys: Sequence[str] = KEYS) -> DataFrame:
    """Fill tiles to window x window; padding is 0 and invalid."""
    ids = [*keys, "x", "y"]
    span = F.sequence(F.lit(0), F.lit(window - 1))
    grid = tiles.select(*ids).withColumn("r", F.explode(span)).withColumn("k", F.explode(span))
    j = grid.join(pixels.select(*ids, "r", "k", "valid", *bands), [*ids, "r", "k"], "left")
    return j.select(*ids, "r", "k", F.coalesce("valid", F.lit(0)).alias("valid"), *[F.coalesce(F.col(b), F.lit(0.0)).alias(b) for b in bands])


def blend(tiles: DataFrame, probs: Sequence[str], weight: Column, keys: Sequence[str] = KEYS) -> DataFrame:
    """Weighted mean of overlapping tile values per pixel."""
    t = tiles.withColumn("_w", weight)
    g = t.groupBy(*keys, "row_", "col_").agg(F.sum("_w").alias("_ws"), *[F.sum(F.col(p) * F.col("_w")).alias(p) for p in probs])
    return g.select(*keys, "row_", "col_", *[(F.col(p) / F.greatest(F.col("_ws"), F.lit(1e-6))).alias(p) for p in probs])


def score_tiles(pixels: DataFrame, model: Callable[[np.ndarray], tuple[np.ndarray, np.ndarray]], bands: Sequence[str], window: int, keys: Sequence[str] = KEYS) -> DataFrame:
    """Call ``model`` on every padded tile, an array (bands + valid, window, window), for extent and boundary logits.

    ``bands`` are normalised already. The model is any picklable callable; results outside the raster are
    dropped and invalid pixels score 0.
    """
    ids = [*keys, "x", "y"]
    bands = list(bands)
    types = dict(pixels.dtypes)
    ddl = ", ".join([*(f"{i} {types[i]}" for i in ids), "w int, h int, row_ int, col_ int, r int, k int, extent_prob double, boundary_prob double, valid int"])

    def run(cols):
        r, k, valid = cols["r"], cols["k"], cols["valid"]
        chip = np.zeros((len(bands) + 1, window, window))
        for i, b in enumerate(bands):
            chip[i, r, k] = cols[b]
        chip[-1, r, k] = valid
        logits = model(chip)
        prob = [np.where(valid == 0, 0.0, 1.0 / (1.0 + np.exp(-np.asarray(z)[r, k]))) for z in logits]
        n = len(r)
        return {**{i: np.repeat(cols[i][:1], n) for i in ids}, "w": cols["w"], "h": cols["h"], "row_": cols["row_"], "col_": cols["col_"], "r": r, "k": k,
                "extent_prob": prob[0], "boundary_prob": prob[1], "valid": valid}

    return stream_groups(pixels, ids, ["w", "h", "row_", "col_", "r", "k", "valid", *bands], run, ddl)


def blend_weight(mode: str, sigma: float = 0.3, floor: float = 0.05) -> Column:
    if mode == "mean":
        return F.lit(1.0)
    if mode == "gaussian":
        return gaussian_weight(F.col("r"), F.col("k"), F.col("h"), F.col("w"), sigma, floor)
    raise ValueError(f"unknown blend mode {mode}")
