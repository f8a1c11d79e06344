"""Band statistics and weighted score aggregates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from acreage.session import join_checked, running_total



def band_percentiles(px: DataFrame, keys: Sequence[str], bands: Sequence[str], probs: Sequence[float], exact: bool = True,
                     accuracy: int = 100_000) -> DataFrame:
    """Percentiles per band with linear interpolation, as arrays ``q_<band>``.

    The exact form counts equal values, takes running counts over the range-partitioned values and picks
    the two order statistics around each rank, so no task holds all values of a raster. ``exact=False``
    merges sketches of fixed size instead.
    """
    if not exact:
        return px.groupBy(*keys).agg(*[F.percentile_approx(b, list(probs), accuracy).alias(f"q_{b}") for b in bands])
    pairs = F.array(*[F.struct(F.lit(b).alias("band"), F.col(b).cast("double").alias("x")) for b in bands])
    counts = px.select(*keys, F.inline(pairs)).groupBy(*keys, "band", "x").agg(F.count("*").alias("n"))
    run = running_total(counts, ["x"], "n", "upto", [*keys, "band"])
    total = run.groupBy(*keys, "band").agg(F.max("upto").alias("all_n"))
    run = join_checked(run, total, [*keys, "band"], "inner")
    picks = []
    for i, p in enumerate(probs):
        rank = F.lit(float(p)) * (F.col("all_n") - 1)
        at = lambda r: F.max(F.when((F.col("upto") - F.col("n") <= r) & (r < F.col("upto")), F.col("x")))
        lo, hi = at(F.floor(rank)), at(F.ceil(rank))
        frac = F.max(rank - F.floor(rank))
        picks.append((lo + (hi - lo) * frac).alias(f"p{i}"))
    per_band = run.groupBy(*keys, "band").agg(*picks).select(*keys, "band", F.array(*[f"p{i}" for i in range(len(probs))]).alias("q"))
    return per_band.groupBy(*keys).agg(*[F.max(F.when(F.col("band") == b, F.col("q"))).alias(f"q_{b}") for b in bands])


def band_mean_std(px: DataFrame, keys: Sequence[str], bands: Sequence[str]) -> DataFrame:
    return px.groupBy(*keys).agg(
        *[F.avg(b).alias(f"mean_{b}") for b in bands],
        *[F.greatest(F.stddev_pop(b), F.lit(1e-6)).alias(f"std_{b}") for b in bands],
    )


def weighted_scores(px: DataFrame, keys: Sequence[str], logit: str, target: str, ignore: int, gamma: float = 0.0,
                    auto_weight: bool = False, smooth: float = 1.0) -> DataFrame:
    """Binary cross-entropy and soft dice per key, ignore-aware, optionally focal and class-weighted."""
    x, t = F.col(logit), (F.col(target) == 1).cast("double")
    use = F.col(target) != ignore
    p = F.lit(1.0) / (F.lit(1.0) + F.exp(-x))
    softplus = lambda z: F.greatest(z, F.lit(0.0)) + F.log1p(F.exp(-F.abs(z)))
    focal = F.pow(F.greatest(F.lit(1.0) - (t * p + (1.0 - t) * (1.0 - p)), F.lit(1e-6)), F.lit(float(gamma))) if gamma > 0 else F.lit(1.0)
    part = lambda cond, e: F.sum(F.when(use & cond, e).otherwise(F.lit(0.0)))
    sums = px.groupBy(*keys).agg(
        part(t == 1.0, softplus(-x) * focal).alias("_pos_loss"), part(t == 0.0, softplus(x) * focal).alias("_neg_loss"),
        part(F.lit(True), t).alias("_pos"), part(F.lit(True), F.lit(1.0)).alias("valid_pixels"),
        part(F.lit(True), p * t).alias("_inter"), part(F.lit(True), p).alias("_psum"))
    pos, n = F.col("_pos"), F.col("valid_pixels")
    weight = F.when(pos > 0, F.greatest(F.lit(1.0), F.least(F.lit(16.0), (n - pos) / F.greatest(pos, F.lit(1.0))))).otherwise(F.lit(1.0)) if auto_weight else F.lit(1.0)
    return sums.select(
        *keys, weight.alias("pos_weight"),
        ((F.col("_pos_loss") * weight + F.col("_neg_loss")) / F.greatest(n, F.lit(1.0))).alias("bce"),
        (F.lit(1.0) - (F.col("_inter") * 2.0 + smooth) / (F.col("_psum") + pos + smooth)).alias("dice"),
        F.when(n > 0, pos / n).otherwise(F.lit(0.0)).alias("pos_frac"), "valid_pixels")
