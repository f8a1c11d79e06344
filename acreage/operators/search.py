"""Parameter grids, even sampling, ranking and refinement of search trials."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from acreage.session import number_rows


def grid(configs: DataFrame, lists: Mapping[str, Column], out: str = "ord") -> DataFrame:
    """Every combination of the value lists of each configuration, numbered from 0 in list order (last list fastest)."""
    df = configs.withColumn(out, F.lit(0))
    for name, values in lists.items():
        size = F.size(values)
        df = df.select(*[c for c in df.columns if c != out], F.col(out).alias("_o"), size.alias("_n"), F.posexplode(values).alias("_i", name))
        df = df.withColumn(out, F.col("_o") * F.col("_n") + F.col("_i")).drop("_o", "_n", "_i")
    return df


def evenly(position: Column, n: Column, limit: int | Column) -> Column:
    """TRUE for the positions (0-based) of an even sample: first, last and rounded steps between (halves to even)."""
    k = limit if isinstance(limit, Column) else F.lit(limit)
    step = (n - 1) / F.nullif(k - 1, F.lit(0)).cast("double")
    near = F.floor(position / step)
    hit = F.lit(False)
    for d in (-1, 0, 1):
        i = near + d
        hit = hit | ((i >= 0) & (i <= k - 1) & (F.bround(i * step, 0) == position))
    return F.when(n <= k, F.lit(True)).when(k <= 1, position == 0).otherwise(hit)


RANKING = ("_f", "_i", "merge_penalty", "holes_penalty", "invalid_geometries", "trial")


def rank(trials: DataFrame, group: Sequence[str] = ()) -> DataFrame:
    """Best first: F1, matched IoU, fewer merges, holes and invalid shapes, then the earlier trial."""
    t = trials.withColumn("_f", -F.col("f1")).withColumn("_i", -F.col("mean_iou_matched"))
    return number_rows(t, list(RANKING), "rank", list(group)).drop("_f", "_i")


def order_columns() -> list[Column]:
    return [F.desc("f1"), F.desc("mean_iou_matched"), F.asc("merge_penalty"), F.asc("holes_penalty"), F.asc("invalid_geometries"), F.asc("trial")]


def refine(top: DataFrame, lists: Mapping[str, Sequence], known: DataFrame, span: int, keys: Sequence[str] = ()) -> DataFrame:
    """Neighbours of the best trials, one parameter at a time within ``span`` list positions, without known ones."""
    keys, names = list(keys), list(lists)
    out = None
    for name, values in lists.items():
        arr = F.array(*[F.lit(v) for v in values])
        at = F.array_position(arr, F.col(name))
        lo, hi = F.greatest(F.lit(1), at - span), F.least(F.lit(len(values)).cast("bigint"), at + span)
        near = top.filter(at > 0).select(*keys, *[c for c in names if c != name], F.explode(F.slice(arr, lo.cast("int"), (hi - lo + 1).cast("int"))).alias(name))
        near = near.select(*keys, *names)
        out = near if out is None else out.unionByName(near)
    return out.distinct().join(known.select(*keys, *names), [*keys, *names], "left_anti")


def budget(n_grid: int, max_trials: int | None, max_auto: int, coarse: int, fine: bool) -> int:
    """Trials of the first phase, by the same rule as :func:`plan`."""
    first = max(1, min(n_grid, coarse)) if fine else min(n_grid, max_auto if max_trials is None else n_grid)
    return first if max_trials is None else min(first, max_trials)


def plan(n_grid: Column, max_trials: Column, max_auto: int, coarse: int, mode: Column) -> dict[str, Column]:
    """How many trials run, whether the grid is cut and how (prefix, even sample or all)."""
    is_coarse = (mode == "coarse_to_fine") & (n_grid > 1)
    first = F.greatest(F.lit(1), F.least(n_grid, F.lit(coarse)))
    first = F.when(max_trials.isNotNull(), F.least(first, max_trials)).otherwise(first)
    flat = F.when(max_trials.isNotNull(), F.least(n_grid, max_trials)).otherwise(F.least(n_grid, F.lit(max_auto)))
    how = F.when(is_coarse, "even").when(max_trials.isNotNull(), "prefix").when(n_grid > max_auto, "even").otherwise("all")
    return {"n_trials": F.when(is_coarse, first).otherwise(flat), "how": how,
            "grid_truncated": F.when(is_coarse, F.lit(False)).otherwise(flat < n_grid)}
