"""Patch budgets, targets and shortfall as one-row-per-dataset projections."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from acreage.functions.scalars import clamp


def patch_targets(total: Column, neg_ratio: float, center_w: float, boundary_w: float) -> dict[str, Column]:
    """Negatives first, the rest split by weight; halves round to even."""
    total = F.greatest(total, F.lit(0)).cast("bigint")
    neg = min(max(neg_ratio, 0.0), 1.0)
    pos = F.bround(total * F.lit(1.0 - neg), 0).cast("bigint")
    center = F.bround(pos * F.lit(center_w / max(1e-9, center_w + boundary_w)), 0).cast("bigint")
    return {"target_total": total, "pos_target": pos, "center_target": center,
            "boundary_target": F.greatest(pos - center, F.lit(0)), "neg_target": F.greatest(total - pos, F.lit(0))}


def split_targets(total: Column, train: Column, val: Column) -> tuple[Column, Column, Column]:
    tr, va = (F.bround(total * r, 0).cast("bigint") for r in (train, val))
    return tr, va, total - tr - va


def auto_budget(inputs: DataFrame, patch_size: int, train_crop: int, neg_ratio: float, center_w: float, boundary_w: float,
                overlap: float, span: float, min_keep: int, max_total: int) -> DataFrame:
    """How many patches a dataset can feed.

    ``inputs`` holds raster_area, valid_ratio, field_area and boundary_len (pixels) per dataset.
    """
    size = max(1, patch_size)
    crop = float(max(1, min(train_crop, size)))
    stride = min(max(max(crop, size * min(max(overlap, 0.05), 1.0)), 1.0), float(size))
    cell = stride * stride
    span = span if span > 0 else size * 1.25
    area = F.greatest(F.col("raster_area"), F.lit(0.0))
    valid = area * clamp(F.col("valid_ratio"), 0.0, 1.0)
    field = F.greatest(F.col("field_area"), F.lit(0.0))
    line = F.greatest(F.col("boundary_len"), F.lit(0.0))
    whole = lambda e: F.greatest(F.lit(0), F.floor(e)).cast("bigint")
    caps = {
        "area": whole(F.least(area, valid) / cell),
        "center": whole(F.least(field, valid) / cell),
        "boundary": whole(F.least(line / max(1.0, span), valid / cell)),
        "negative": whole(F.least(F.greatest(valid - field, F.lit(0.0)), valid) / cell),
    }
    neg = min(max(neg_ratio, 0.0), 1.0)
    weights = center_w + boundary_w
    center_share = (1.0 - neg) * (center_w / weights if weights > 1e-9 else 1.0)
    shares = {"center": center_share, "boundary": (1.0 - neg) - center_share, "negative": neg}
    df = inputs.select("*", *[e.alias(f"_cap_{k}") for k, e in caps.items()])
    bounds = {"area": F.col("_cap_area").cast("double")}
    for k, share in shares.items():
        if share > 1e-9:
            bounds[k] = F.when(F.col(f"_cap_{k}") <= 0, F.lit(0.0)).otherwise(F.col(f"_cap_{k}") / F.lit(share))
    lowest = F.least(*bounds.values()) if len(bounds) > 1 else bounds["area"]
    df = df.withColumn("_low", lowest).withColumn("estimated_total_capacity", F.greatest(F.lit(0), F.floor("_low")).cast("bigint"))
    total = F.col("estimated_total_capacity")
    skipped = total < F.lit(max(0, min_keep))
    capped = F.least(total, F.lit(max_total)) if max_total > 0 else total
    df = df.withColumn("skipped", skipped).withColumn("estimated_total_target", F.when(skipped, F.lit(0)).otherwise(capped).cast("bigint"))
    t = patch_targets(F.col("estimated_total_target"), neg_ratio, center_w, boundary_w)
    limiters = F.array_compact(F.array(*[F.when(F.abs(bounds[k] - F.col("_low")) < 1e-9, F.lit(k)) for k in sorted(bounds)]))
    reason = F.when(F.col("skipped"), F.concat(F.lit("estimated_total_capacity="), total.cast("string"), F.lit(f" < min_valid_patches_to_keep={max(0, min_keep)}")))
    return df.select(
        *inputs.columns, F.lit(stride).alias("effective_stride_px"), "estimated_total_capacity",
        *[F.col(f"_cap_{k}").alias(f"estimated_{k}_capacity") for k in ("center", "boundary", "negative")],
        "estimated_total_target", t["center_target"].alias("estimated_center_target"), t["boundary_target"].alias("estimated_boundary_target"),
        t["neg_target"].alias("estimated_negative_target"), "skipped", reason.alias("skip_reason"), limiters.alias("limiters"))


# Reject classes that explain a shortfall, per patch type, in reporting order (fixed values).
SHORTFALL_TAGS = {
    "center": (("valid", "min_valid_ratio"), ("mask", "mask_ratio_constraints"), ("oob", "window_out_of_bounds"), ("other", "geometry_sampling")),
    "boundary": (("valid", "min_valid_ratio"), ("mask", "mask_ratio_constraints"), ("oob", "window_out_of_bounds"), ("other", "boundary_sampling")),
    "negative": (("neg_dist", "negative_min_distance"), ("neg_mask", "negative_mask_ratio"), ("valid", "min_valid_ratio"), ("oob", "window_out_of_bounds")),
}


def shortfall(attempts: DataFrame, keys: Sequence[str], targets: Mapping[str, int]) -> DataFrame:
    """Missing patches per type and the reject classes behind them (``reject`` is NULL for written ones)."""
    classes = sorted({k for tags in SHORTFALL_TAGS.values() for k, _ in tags})
    g = attempts.groupBy(*keys).agg(
        *[F.count_if(F.col("reject").isNull() & (F.col("inside_mode") == t)).alias(f"_w_{t}") for t in targets],
        *[F.count_if(F.col("reject") == k).alias(f"_r_{k}") for k in classes])
    out = []
    for t, target in targets.items():
        tags = F.array_compact(F.array(*[F.when(F.col(f"_r_{k}") > 0, F.lit(text)) for k, text in SHORTFALL_TAGS[t]]))
        tags = F.when(F.size(tags) == 0, F.array(F.lit("insufficient_candidates"))).otherwise(tags)
        out += [F.greatest(F.lit(0), F.lit(target) - F.col(f"_w_{t}")).cast("bigint").alias(f"short_{t}"),
                F.when(F.col(f"_w_{t}") < target, tags).alias(f"{t}_reasons")]
    return g.select(*keys, *out)
