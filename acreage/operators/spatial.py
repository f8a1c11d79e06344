"""Grid-cell joins: windows to pixels, boxes to boxes, points to boxes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from acreage.session import join_checked, materialize, spread


def _cells(lo: Column, hi: Column, size: float) -> Column:
    return F.sequence(F.floor(lo / size).cast("int"), F.floor(hi / size).cast("int"))


def pixels_in_windows(px: DataFrame, windows: DataFrame, keys: Sequence[str] = ("raster_id",), cell: int = 256) -> DataFrame:
    """Every (window, pixel) pair; the join key is the pixel's grid cell, so one raster spreads over many tasks."""
    w = windows.withColumn("_cy", F.explode(_cells(F.col("y"), F.col("y") + F.col("h") - 1, cell)))
    w = w.withColumn("_cx", F.explode(_cells(F.col("x"), F.col("x") + F.col("w") - 1, cell)))
    p = px.withColumn("_cy", F.floor(F.col("row_") / cell).cast("int")).withColumn("_cx", F.floor(F.col("col_") / cell).cast("int"))
    inside = (
        (F.col("row_") >= F.col("y")) & (F.col("row_") < F.col("y") + F.col("h"))
        & (F.col("col_") >= F.col("x")) & (F.col("col_") < F.col("x") + F.col("w"))
    )
    # Windows dealt to cells are many times their table, which the planner doesn't see: they must not be broadcast.
    return p.join(w.hint("merge"), [*keys, "_cy", "_cx"]).filter(inside).drop("_cy", "_cx")


BOX = ("x0", "y0", "x1", "y1")


def box_pairs(left: DataFrame, right: DataFrame, keys: Sequence[str] = (), cell: float | None = None, hot: int = 4096,
              fan: int = 8, depth: int = 3) -> DataFrame:
    """Pairs of boxes that touch or overlap, each reported once.

    Boxes go to every grid cell they meet and join on the cell, twice as wide as boxes are on average if not given. Cells that hold more than ``hot`` boxes
    are split ``fan`` x ``fan`` and joined again on the finer cells, up to ``depth`` times, so a crowded
    area does not pair everything with everything. A pair belongs to the cell of the lower-left corner of
    its common box; columns of the sides come out with prefixes ``l_`` and ``r_``.
    """
    sides = []
    for df, p in ((left, "l_"), (right, "r_")):
        sides.append(df.select(*keys, *[F.col(c).alias(p + c) for c in df.columns if c not in keys]))
    out = None
    ltodo, rtodo = sides
    if cell is None:
        spans = left.select(*BOX).unionByName(right.select(*BOX)).select(F.greatest(F.col("x1") - F.col("x0"), F.col("y1") - F.col("y0")).alias("s"))
        cell = 2.0 * (spans.agg(F.avg("s")).first()[0] or 16.0)
    size = float(cell)
    for level in range(depth + 1):
        ltodo, rtodo = (_to_cells(d, p, keys, size) for d, p in ((ltodo, "l_"), (rtodo, "r_")))
        last = level == depth
        cold_l, cold_r = ltodo, rtodo
        crowded = None
        if not last:
            load = ltodo.select(*keys, "_cx", "_cy").unionByName(rtodo.select(*keys, "_cx", "_cy"))
            crowded = materialize(load.groupBy(*keys, "_cx", "_cy").count().filter(F.col("count") > hot).drop("count"))
            if crowded.isEmpty():
                last = True
            else:
                cold_l, cold_r = (join_checked(d, crowded, [*keys, "_cx", "_cy"], "left_anti") for d in (ltodo, rtodo))
        found = _pairs_in_cells(cold_l, cold_r, keys, size)
        out = found if out is None else out.unionByName(found)
        if last:
            break
        ltodo, rtodo = (
            join_checked(d, crowded, [*keys, "_cx", "_cy"], "left_semi").withColumn("_px", F.col("_cx") * size).withColumn("_py", F.col("_cy") * size).withColumn("_ps", F.lit(size))
            .drop("_cx", "_cy") for d in (ltodo, rtodo))
        size = size / fan
    return out


def _to_cells(df: DataFrame, p: str, keys: Sequence[str], size: float) -> DataFrame:
    x0, y0, x1, y1 = (F.col(p + c) for c in BOX)
    if "_px" in df.columns:  # stay inside the crowded parent cell
        eps = size / 2
        x0, x1 = F.greatest(x0, F.col("_px")), F.least(x1, F.col("_px") + F.col("_ps") - eps)
        y0, y1 = F.greatest(y0, F.col("_py")), F.least(y1, F.col("_py") + F.col("_ps") - eps)
    out = df.withColumn("_cx", F.explode(_cells(x0, x1, size))).withColumn("_cy", F.explode(_cells(y0, y1, size)))
    return out.drop("_px", "_py", "_ps")


def _pairs_in_cells(left: DataFrame, right: DataFrame, keys: Sequence[str], size: float) -> DataFrame:
    # Boxes dealt to cells are many times the table they come from, which the planner doesn't see: they must not be broadcast.
    # Nor may few boxes, of which many pairs are made and then cut or measured, meet in a few tasks.
    on = [*keys, "_cx", "_cy"]
    j = spread(left, *on).join(spread(right, *on).hint("merge"), on)
    meet = (
        (F.col("l_x0") <= F.col("r_x1")) & (F.col("r_x0") <= F.col("l_x1"))
        & (F.col("l_y0") <= F.col("r_y1")) & (F.col("r_y0") <= F.col("l_y1"))
    )
    home = (F.floor(F.greatest("l_x0", "r_x0") / size) == F.col("_cx")) & (F.floor(F.greatest("l_y0", "r_y0") / size) == F.col("_cy"))
    return j.filter(meet & home).drop("_cx", "_cy")


def far_from_polygons(points: DataFrame, polys: DataFrame, distance: float, keys: Sequence[str] = (), cell: float | None = None) -> DataFrame:
    """Points (x, y) farther than ``distance`` from every polygon (columns rings, x0, y0, x1, y1).

    Two anti-joins on grid cells: points near an edge, then points inside a polygon. Polygons and edges that lie on each other count
    once, so a cell holds no more of them than there are different ones. Cells are as large as polygons are on average, if not given.
    """
    from acreage.functions.geometry import contains
    from acreage.operators.vectors import edges_of
    keys = list(keys)
    polys = materialize(polys.select(*keys, "rings", *BOX).distinct())
    if cell is None:
        cell = 2.0 * (polys.agg(F.avg(F.greatest(F.col("x1") - F.col("x0"), F.col("y1") - F.col("y0")))).first()[0] or 16.0)
    size = max(cell, float(distance))
    p = points.withColumn("_cx", F.floor(F.col("x") / size).cast("int")).withColumn("_cy", F.floor(F.col("y") / size).cast("int"))

    def anti(p, right, test):
        # Exploded edges are many times the table they come from, which the planner doesn't see: they must not be broadcast.
        right = right.select(*[F.col(c).alias(f"_b{c}") for c in right.columns]).hint("merge")
        cond = (p["_cx"] == F.col("_b_cx")) & (p["_cy"] == F.col("_b_cy")) & test
        for k in keys:
            cond = cond & (p[k] == F.col(f"_b{k}"))
        return p.join(right, cond, "left_anti")

    def celled(df, lx, ly, hx, hy, pad):
        df = df.withColumn("_cx", F.explode(_cells(lx - pad, hx + pad, size)))
        return df.withColumn("_cy", F.explode(_cells(ly - pad, hy + pad, size)))

    e = edges_of(polys, keys).drop("ring", "i").distinct()
    e = celled(e, F.least("ax", "bx"), F.least("ay", "by"), F.greatest("ax", "bx"), F.greatest("ay", "by"), float(distance))
    dx, dy = F.col("_bbx") - F.col("_bax"), F.col("_bby") - F.col("_bay")
    t = ((F.col("x") - F.col("_bax")) * dx + (F.col("y") - F.col("_bay")) * dy) / F.nullif(dx * dx + dy * dy, F.lit(0.0))
    t = F.coalesce(F.least(F.lit(1.0), F.greatest(F.lit(0.0), t)), F.lit(0.0))
    ex, ey = F.col("x") - F.col("_bax") - t * dx, F.col("y") - F.col("_bay") - t * dy
    p = anti(p, e, ex * ex + ey * ey <= F.lit(float(distance) ** 2))
    inner = celled(polys, F.col("x0"), F.col("y0"), F.col("x1"), F.col("y1"), 0.0)
    boxed = F.col("x").between(F.col("_bx0"), F.col("_bx1")) & F.col("y").between(F.col("_by0"), F.col("_by1"))
    return anti(p, inner, boxed & contains(F.col("_brings"), F.col("x"), F.col("y"))).drop("_cx", "_cy")
