"""Per-pixel masks, target policies and value normalisation (no shuffle unless stated)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from acreage.functions.scalars import clamp
from acreage.session import join_checked


def valid_control(bands: Sequence[Column], control_band: int, nodata: float, clamp_band: bool = False) -> Column:
    """1 where the control band differs from NoData. Out-of-range bands raise, or are clamped."""
    band = control_band
    if clamp_band:
        band = max(1, min(len(bands), band))
    elif not 1 <= band <= len(bands):
        raise ValueError(f"control band {control_band} is outside 1..{len(bands)}")
    return (bands[band - 1] != F.lit(float(nodata))).cast("int")


def valid_all_bands(bands: Sequence[Column], nodata: float) -> Column:
    """0 only where every band equals NoData."""
    return F.exists(F.array(*bands), lambda b: b != F.lit(float(nodata))).cast("int")


def valid_any_band(bands: Sequence[Column], nodata: Column) -> Column:
    """Footprint rule: 0 where any band equals NoData."""
    return F.forall(F.array(*bands), lambda b: b != nodata).cast("int")


def valid_from_footprint(first_band: Column, explicit: Column, file_nodata: Column) -> tuple[Column, Column]:
    """(valid, source): explicit NoData, then the file's NoData, then ``value > 0``."""
    nd = F.coalesce(explicit, file_nodata)
    valid = F.when(nd.isNull(), first_band > 0).otherwise(first_band != nd).cast("int")
    source = F.when(nd.isNull(), F.lit("footprint_nonzero_fallback")).otherwise(F.lit("footprint_nodata"))
    return valid, source


def hard_background(prob: Column, valid: Column) -> Column:
    return F.when(valid == 0, F.lit(0.0)).otherwise(prob)


def autoscale(px: DataFrame, value: str, keys: Sequence[str], out: str = "prob") -> DataFrame:
    """Bring a probability raster to [0, 1]; the scale follows the whole raster's minimum and maximum."""
    finite = (~F.isnan(value)) & (F.abs(F.col(value)) < F.lit(float("inf")))
    stats = px.groupBy(*keys).agg(
        F.min(value).alias("_lo"), F.max(value).alias("_hi"), F.min(finite.cast("int")).alias("_ok")
    )
    scale = (
        F.when(F.col("_ok") == 0, F.raise_error(F.lit("raster contains NaN or Inf values")))
        .when((F.col("_lo") >= -1e-6) & (F.col("_hi") <= 1.0 + 1e-6), F.lit(1.0))
        .when((F.col("_lo") >= -1e-6) & (F.col("_hi") <= 255.0 + 1e-6), F.lit(255.0))
        .when((F.col("_lo") >= -1e-6) & (F.col("_hi") <= 100.0 + 1e-6), F.lit(100.0))
        .otherwise(F.raise_error(F.lit("probability range must be [0,1], [0,100] or [0,255]")).cast("double"))
    )
    joined = join_checked(px, stats.select(*keys, scale.alias("_scale")), keys, "inner")
    return joined.withColumn(out, clamp(F.col(value) / F.col("_scale"), 0.0, 1.0)).drop("_scale")


def ignore_where_invalid(target: Column, valid: Column, code: int) -> Column:
    return F.when(valid == 0, F.lit(code)).otherwise(target)


def pad_border(target: Column, row: Column, col: Column, h: Column, w: Column, pad: int, code: int) -> Column:
    """Set the outer ``pad`` pixels (at most half the size) to an ignore code."""
    b = F.least(F.lit(pad), F.floor(h / 2), F.floor(w / 2))
    edge = (row < b) | (row >= h - b) | (col < b) | (col >= w - b)
    return F.when(edge & (b > 0), F.lit(code)).otherwise(target)


def robust_scale(x: Column, q_low: Column, q_high: Column, valid: Column) -> Column:
    scaled = clamp((x - q_low) / F.greatest(q_high - q_low, F.lit(1e-6)), 0.0, 1.0)
    return F.when(valid == 0, F.lit(0.0)).otherwise(scaled)


def standard_scale(x: Column, mean: Column, std: Column, valid: Column) -> Column:
    return F.when(valid == 0, F.lit(0.0)).otherwise((x - mean) / std)


def accept_patch(mode: Column, valid_ratio: Column, mask_ratio: Column, min_valid: float, min_mask: float,
                 max_mask: float, neg_max: float) -> Column:
    """First failing rule as reject class, NULL for an accepted patch."""
    return (
        F.when(valid_ratio < min_valid, F.lit("valid"))
        .when((mode == "negative") & (mask_ratio > neg_max), F.lit("neg_mask"))
        .when((mode != "negative") & ((mask_ratio < min_mask) | (mask_ratio > max_mask)), F.lit("mask"))
    )


def centered_window(row: Column, col: Column, w: int, h: int, width: Column, height: Column) -> tuple[Column, Column]:
    """(xoff, yoff) of the window around a pixel; NULL where it leaves the raster."""
    x, y = col - F.lit(w // 2), row - F.lit(h // 2)
    fits = (x >= 0) & (y >= 0) & (x + w <= width) & (y + h <= height)
    return F.when(fits, x), F.when(fits, y)
