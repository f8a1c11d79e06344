"""Pixel-level quality metrics as single-pass aggregates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from acreage.functions.scalars import f1_from_counts, ratio


def extent_counts(px: DataFrame, keys: Sequence[str], pred: Column, gt: Column, ignore: int) -> DataFrame:
    """tp, fp, fn per key; ignore pixels count on neither side."""
    use, pos = gt != ignore, gt == 1
    n = lambda cond: F.count_if(use & cond)
    return px.groupBy(*keys).agg(n(pred & pos).alias("tp"), n(pred & ~pos).alias("fp"), n(~pred & pos).alias("fn"))


def extent_scores(counts: DataFrame, digits: int = 6) -> DataFrame:
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    r = lambda e: F.round(e, digits)
    return counts.select(
        "*", r(ratio(tp, tp + fp + fn, 1.0)).alias("iou"), r(ratio(tp, tp + fp, 1.0)).alias("precision_"),
        r(ratio(tp, tp + fn, 1.0)).alias("recall_"), r(f1_from_counts(tp, fp, fn)).alias("f1"))


def boundary_gap(px: DataFrame, keys: Sequence[str], prob: Column, gt: Column, empty: float = 0.0, digits: int = 6) -> DataFrame:
    """Mean probability on positive minus on negative pixels."""
    mean = lambda cond: F.coalesce(F.avg(F.when(cond, prob)), F.lit(float(empty)))
    g = px.groupBy(*keys).agg(mean(gt == 1).alias("_p"), mean(gt == 0).alias("_n"))
    return g.select(*keys, F.round("_p", digits).alias("pos_mean"), F.round("_n", digits).alias("neg_mean"), F.round(F.col("_p") - F.col("_n"), digits).alias("gap"))


def tolerant_counts(px: DataFrame, keys: Sequence[str], pred: str, gt: str, near_gt: str, near_pred: str) -> DataFrame:
    """Boundary counts with tolerance: predicted pixels near truth, far from truth, truth far from prediction.

    Recall mixes both sides, tp of the prediction over tp + missed truth, on purpose.
    """
    p, g, ng, np_ = (F.col(x) == 1 for x in (pred, gt, near_gt, near_pred))
    return px.groupBy(*keys).agg(F.count_if(p & ng).alias("tp"), F.count_if(p & ~ng).alias("fp"), F.count_if(g & ~np_).alias("fn"))


def best_threshold(scores: DataFrame, keys: Sequence[str], f1: str = "f1", order: str = "ord") -> DataFrame:
    """Row with the highest finite F1 per key; the first listed threshold wins ties."""
    best = scores.filter(~F.isnan(f1)).groupBy(*keys).agg(
        F.min_by(F.struct(*[c for c in scores.columns if c not in keys]), F.struct(-F.col(f1), F.col(order))).alias("_b"))
    return best.select(*keys, "_b.*")
