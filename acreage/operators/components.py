"""Connected regions on label and mask rasters: labelling, size filters, hole filling, merging."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from acreage.functions import arrays as A
from acreage.operators.distance import nearest
from acreage.operators.settings import any_set, at, column, largest
from acreage.operators.stencil import BLOCK, MOSAIC, Tile, block_map, mosaic_rows
from acreage.session import join_checked, materialize, number_rows

KEYS = ("raster_id",)
CODE = 1 << 31


def pixel_code(row: Column, col: Column) -> Column:
    """Raster-scan position as one number."""
    return row.cast("bigint") * F.lit(CODE) + col.cast("bigint")


def components(px: DataFrame, mask: str, keys: Sequence[str] = KEYS, block: int = BLOCK) -> DataFrame:
    """4-connected components of the set pixels; ``comp`` is the scan position of the component's first pixel.

    Blocks are labelled on their own. Labels that meet across a block border form a small graph (at most
    one block perimeter of edges per label), which is contracted with joins; pixels never take part in
    the iteration.
    """
    keys = list(keys)

    def fn(t: Tile):
        fg = t.core & (t[mask] > 0)
        run = A.label4(fg)
        y, x = np.nonzero(fg)
        rows, cols = t.place(y, x)
        code = rows.astype(np.int64) * CODE + cols
        first = np.zeros(int(run.max()) + 1 if run.size else 1, dtype=np.int64)
        ids = run[fg]
        first[ids[::-1]] = code[::-1]
        out = np.zeros(fg.shape, dtype=np.int64)
        out[fg] = first[ids]
        return {"comp": out, "_fg": fg}

    local = materialize(block_map(px, fn, "comp bigint", 0, keys, [mask], block, emit="_fg", mosaic=True))
    last = block - 1
    lower = local.filter(F.col("row_") % block == last).select(*keys, (F.col("row_") + 1).alias("row_"), "col_", F.col("comp").alias("a"))
    upper = local.filter((F.col("row_") % block == 0) & (F.col("row_") > 0)).select(*keys, "row_", "col_", F.col("comp").alias("b"))
    right = local.filter(F.col("col_") % block == last).select(*keys, "row_", (F.col("col_") + 1).alias("col_"), F.col("comp").alias("a"))
    left = local.filter((F.col("col_") % block == 0) & (F.col("col_") > 0)).select(*keys, "row_", "col_", F.col("comp").alias("b"))
    on = [*keys, "row_", "col_"]
    edges = lower.join(upper, on).select(*keys, "a", "b").unionByName(right.join(left, on).select(*keys, "a", "b")).distinct()
    edges = materialize(edges)
    if edges.isEmpty():
        return local
    roots = contract(edges, keys).withColumnRenamed("node", "comp")
    joined = join_checked(local, roots, [*keys, "comp"], "left")
    return joined.select(*keys, "row_", "col_", F.coalesce("root", "comp").alias("comp"))


def contract(edges: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Smallest node of every connected group of an edge list (a, b): columns node, root.

    Each round every tree takes the smallest root among its neighbours and the chain of roots is halved,
    so the number of rounds grows with the logarithm of the longest chain.
    """
    keys = list(keys)
    both = materialize(edges.select(*keys, "a", "b").unionByName(edges.select(*keys, F.col("b").alias("a"), F.col("a").alias("b"))).distinct())
    state = both.select(*keys, F.col("a").alias("node")).distinct().withColumn("root", F.col("node"))
    while True:
        seen = both.join(state.select(*keys, F.col("node").alias("b"), F.col("root").alias("rb")), [*keys, "b"])
        seen = seen.groupBy(*keys, "a").agg(F.min("rb").alias("m")).withColumnRenamed("a", "node")
        near = materialize(state.join(seen, [*keys, "node"], "left").select(*keys, "node", "root", F.least("root", "m").alias("m")))
        hook = near.groupBy(*keys, "root").agg(F.min("m").alias("h"))
        jump = hook.select(*keys, F.col("root").alias("h"), F.col("h").alias("hh"))
        hook = materialize(hook)
        hook = join_checked(hook, jump, [*keys, "h"], "left").select(*keys, "root", F.least("h", F.coalesce("hh", "h")).alias("h"))
        state = materialize(join_checked(near, hook, [*keys, "root"], "left").select(*keys, "node", F.col("root").alias("old"), F.least("m", "h").alias("root")))
        moved = state.filter(F.col("old") != F.col("root"))
        if moved.isEmpty():
            return state.select(*keys, "node", "root")
        state = state.drop("old")


def number_components(comps: DataFrame, keys: Sequence[str] = KEYS, out: str = "label") -> DataFrame:
    """Replace ``comp`` by 1..n per raster in scan order."""
    keys = list(keys)
    first = comps.filter(F.col("comp") == pixel_code(F.col("row_"), F.col("col_"))).select(*keys, "comp")
    ids = number_rows(first, ["comp"], out, keys)
    return join_checked(comps, ids, [*keys, "comp"], "inner").select(*keys, "row_", "col_", F.col(out).cast("int").alias(out))


def connected_components(px: DataFrame, mask: str, keys: Sequence[str] = KEYS, block: int = BLOCK) -> DataFrame:
    """Labels 1..n in scan order on every pixel, 0 on the background."""
    keys = list(keys)
    lab = number_components(components(px, mask, keys, block), keys)
    return px.select(*keys, "row_", "col_").join(lab, [*keys, "row_", "col_"], "left").withColumn("label", F.coalesce("label", F.lit(0)))


def _size_filter(px: DataFrame, mask: str, limit, holes: bool, out: str, keep: Sequence[str], keys: Sequence[str], block: int) -> DataFrame:
    """Drop components below ``limit``, which may differ by key. A component smaller than the halo is wholly visible to the block."""
    most = max(0, int(largest(limit)))

    def fn(t: Tile):
        fg = t.present & ((t[mask] > 0) != holes)
        lab = A.label4(fg)
        small = fg & (A.sizes_of(lab) < at(limit, t.keys))
        now = t.present & (t[mask] > 0)
        return {out: ((now | small) if holes else (now & ~small)).astype(np.int32), **{k: t[k] for k in keep}}

    types = dict(px.dtypes)
    ddl = f"{out} int" + "".join(f", {k} {types[k]}" for k in keep)
    return block_map(px, fn, ddl, most, keys, list(dict.fromkeys([mask, *keep])), max(block, 2 * most))


def remove_small_objects(px, mask, min_size, out="kept", keep=(), keys=KEYS, block=BLOCK) -> DataFrame:
    return _size_filter(px, mask, min_size, False, out, keep, keys, block)


def remove_small_holes(px, mask, area, out="filled", keep=(), keys=KEYS, block=BLOCK) -> DataFrame:
    return _size_filter(px, mask, area, True, out, keep, keys, block)


def label_sizes(labels: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    return labels.filter(F.col("label") > 0).groupBy(*keys, "label").agg(F.count("*").alias("n"))


def label_stats(labels: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    s = labels.groupBy(*keys, "label").agg(F.count("*").alias("n"))
    pos = F.col("label") > 0
    return s.groupBy(*keys).agg(F.count_if(pos).alias("num_labels"), F.max("label").alias("max_label"),
                                F.coalesce(F.sum(F.when(pos, F.col("n"))), F.lit(0)).alias("num_pixels_fg"))


def fill_holes_exact(labels: DataFrame, max_area, keys: Sequence[str] = KEYS, block: int = BLOCK, keep: Sequence[str] = ()) -> DataFrame:
    """Background inside a hole (fewer than ``max_area`` pixels) of one label takes that label, lowest label first."""
    most = int(largest(max_area))
    if most <= 0:
        return labels

    def fn(t: Tile):
        return {"label": _fill_holes(t), **{k: t[k] for k in keep}}

    types = dict(labels.dtypes)
    ddl = "label int" + "".join(f", {k} {types[k]}" for k in keep)
    limited = labels.withColumn("_limit", column(max_area).cast("int"))
    return block_map(limited, fn, ddl, most, keys, ["label", "_limit", *keep], max(block, 2 * most), mosaic=True)


def _fill_holes(t: Tile) -> np.ndarray:
    """Labels of a mosaic with the holes of each label filled. The surroundings of all labels lie below each other in shared arrays."""
    lab = np.where(t.present, t["label"], 0)
    tall, wide = lab.shape
    y, x = np.nonzero(lab > 0)
    order = np.lexsort((lab[y, x], t.blocks[y]))
    y, x = y[order], x[order]
    value, home = lab[y, x], t.blocks[y]
    new = np.ones(len(y), bool)
    new[1:] = (value[1:] != value[:-1]) | (home[1:] != home[:-1])
    at = np.flatnonzero(new)
    if not len(at):
        return t["label"]
    value, limit = value[at].astype(np.int64), t["_limit"][y[at], x[at]].astype(np.int64)
    top, bottom = np.maximum(0, np.minimum.reduceat(y, at) - limit), np.minimum(tall, np.maximum.reduceat(y, at) + limit + 1)
    left, right = np.maximum(0, np.minimum.reduceat(x, at) - limit), np.minimum(wide, np.maximum.reduceat(x, at) + limit + 1)
    first = np.full(tall * wide, np.iinfo(np.int64).max)
    todo = np.flatnonzero(limit > 0)
    for lot in np.split(todo, np.flatnonzero(np.diff(np.cumsum((bottom - top + 1)[todo] * (right - left)[todo]) // MOSAIC)) + 1):
        # Narrow windows do not share an array with wide ones, so no array is much larger than what it holds.
        lot = lot[np.argsort((right - left)[lot], kind="stable")]
        for w in np.split(lot, np.flatnonzero(np.diff(np.ceil(np.log2((right - left)[lot])))) + 1):
            h = bottom[w] - top[w] + 1
            of = np.repeat(np.arange(len(w)), h)
            row = np.arange(len(of)) - np.repeat(np.cumsum(h) - h, h) + top[w][of]
            col = left[w][of][:, None] + np.arange((right - left)[w].max(initial=0))
            inside = (row < bottom[w][of])[:, None] & (col < right[w][of][:, None])
            cell = np.where(inside, row[:, None] * wide + col, 0)
            here = lab.ravel()[cell]
            rest = inside & t.present.ravel()[cell] & (here != value[w][of][:, None])
            hole = rest & (here == 0) & (A.sizes_of(A.label4(rest)) < limit[w][of][:, None])
            np.minimum.at(first, cell[hole], np.broadcast_to(value[w][of][:, None], cell.shape)[hole])
    first = first.reshape(tall, wide)
    return np.where(first < np.iinfo(np.int64).max, first, t["label"])


def fill_holes_fast(labels: DataFrame, max_area, keys: Sequence[str] = KEYS, block: int = BLOCK) -> DataFrame:
    """Small holes of the joint foreground take the nearest label (ties: first in scan order)."""
    keys = list(keys)
    if not any_set(max_area):
        return labels
    px = labels.select(*keys, "row_", "col_", "label", (F.col("label") > 0).cast("int").alias("fg"))
    filled = remove_small_holes(px, "fg", max_area, "filled", ["label", "fg"], keys, block)
    near = nearest(filled, "fg", "label", keys, keep=["label", "filled"])
    take = (F.col("label") == 0) & (F.col("filled") == 1) & F.col("near_value").isNotNull()
    return near.select(*keys, "row_", "col_", F.when(take, F.col("near_value")).otherwise(F.col("label")).cast("int").alias("label"))


def drop_tiny(labels: DataFrame, min_area, keys: Sequence[str] = KEYS) -> DataFrame:
    keys = list(keys)
    tiny = label_sizes(labels, keys).filter(F.col("n") < column(min_area)).select(*keys, "label", F.lit(1).alias("_tiny"))
    j = join_checked(labels, tiny, [*keys, "label"], "left")
    return j.select(*keys, "row_", "col_", F.when(F.col("_tiny") == 1, 0).otherwise(F.col("label")).alias("label"))


def relabel(labels: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """Labels to 1..n per raster in ascending old id."""
    keys = list(keys)
    ids = number_rows(labels.filter(F.col("label") > 0).select(*keys, "label").distinct(), ["label"], "new_label", keys)
    j = join_checked(labels, ids, [*keys, "label"], "left")
    return j.select(*keys, "row_", "col_", F.coalesce("new_label", F.lit(0)).cast("int").alias("label"))


def merge_small_fast(labels: DataFrame, max_area, keys: Sequence[str] = KEYS) -> DataFrame:
    """All regions of at most ``max_area`` pixels take the nearest kept label; 0 where the raster keeps none."""
    keys = list(keys)
    small = label_sizes(labels, keys).filter(F.col("n") <= column(max_area)).select(*keys, "label", F.lit(1).alias("_small"))
    j = join_checked(labels, small, [*keys, "label"], "left")
    j = j.select(*keys, "row_", "col_", "label", F.coalesce("_small", F.lit(0)).alias("small"),
                 ((F.col("label") > 0) & F.col("_small").isNull()).cast("int").alias("keep"))
    near = nearest(j, "keep", "label", keys, keep=["label", "small"])
    new = F.when(F.col("small") == 1, F.coalesce("near_value", F.lit(0))).otherwise(F.col("label"))
    return near.select(*keys, "row_", "col_", new.cast("int").alias("label"))


def contacts(labels: DataFrame, keys: Sequence[str] = KEYS, block: int = BLOCK) -> DataFrame:
    """Distinct (pixel, own label, label of an 8-neighbour) where the labels differ and both are positive."""
    def fn(t: Tile):
        lab = np.where(t.present, t["label"], 0)
        rows, cols, own, adj = [], [], [], []
        for dy, dx in A.square(1):
            if dy == 0 and dx == 0:
                continue
            other = A.shifted(lab, dy, dx, 0)
            y, x = np.nonzero(t.core & (lab > 0) & (other > 0) & (other != lab))
            rows.append(y), cols.append(x), own.append(lab[y, x]), adj.append(other[y, x])
        q = np.unique(np.stack([np.concatenate(v) for v in (rows, cols, own, adj)]), axis=1)
        r, k = t.place(q[0], q[1])
        return {"row_": r, "col_": k, "own": q[2], "adj": q[3], "_y": q[0]}

    return mosaic_rows(labels, fn, "row_ int, col_ int, own int, adj int", 1, keys, ["label"], block)


def region_adjacency(labels: DataFrame, keys: Sequence[str] = KEYS, block: int = BLOCK) -> DataFrame:
    """Border pixels of every neighbouring label: (label, nbr, n)."""
    return contacts(labels, keys, block).groupBy(*keys, F.col("adj").alias("label"), F.col("own").alias("nbr")).agg(F.count("*").alias("n"))


def merge_small_exact(labels: DataFrame, max_area, keys: Sequence[str] = KEYS, block: int = BLOCK) -> DataFrame:
    """Regions of at most ``max_area`` pixels join the neighbour with most border pixels, smallest first.

    The order (size at the start, label) is kept exactly: a round processes every small region that no
    earlier unprocessed small region touches, and such regions cannot influence each other.
    """
    keys = list(keys)
    if not any_set(max_area):
        return labels
    labels = materialize(labels)
    todo = label_sizes(labels, keys).filter(F.col("n") <= column(max_area)).select(*keys, "label", F.struct("n", "label").alias("rank"))
    todo = materialize(todo)
    moves = todo.select(*keys, "label", F.col("label").alias("now"))
    touch = contacts(labels, keys, block).join(todo.select(*keys, F.col("label").alias("adj")), [*keys, "adj"])
    touch = materialize(touch)
    while not todo.isEmpty():
        pair = touch.groupBy(*keys, "adj", "own").agg(F.count("*").alias("n"))
        rank_own = todo.select(*keys, F.col("label").alias("own"), F.col("rank").alias("own_rank"))
        view = pair.join(rank_own, [*keys, "own"], "left").groupBy(*keys, F.col("adj").alias("label")).agg(
            F.min("own_rank").alias("first"), F.min_by("own", F.struct(-F.col("n"), F.col("own"))).alias("target"))
        step = todo.join(view, [*keys, "label"], "left").withColumn("ready", F.col("first").isNull() | (F.col("first") > F.col("rank")))
        step = materialize(step)
        done = step.filter("ready").select(*keys, "label", F.coalesce("target", F.lit(0)).alias("target"))
        todo = materialize(step.filter(~F.col("ready")).select(*keys, "label", "rank"))
        moved = done.select(*keys, F.col("label").alias("now"), "target")
        moves = materialize(moves.join(moved, [*keys, "now"], "left").select(*keys, "label", F.coalesce("target", "now").alias("now")))
        as_own = done.select(*keys, F.col("label").alias("own"), F.col("target").alias("own_t"))
        as_adj = done.select(*keys, F.col("label").alias("adj"), F.col("target").alias("adj_t"))
        live = todo.select(*keys, F.col("label").alias("adj"))
        touch = (
            touch.join(as_own, [*keys, "own"], "left").join(as_adj, [*keys, "adj"], "left")
            .select(*keys, "row_", "col_", F.coalesce("own_t", "own").alias("own"), F.coalesce("adj_t", "adj").alias("adj"))
            .filter((F.col("own") != F.col("adj")) & (F.col("own") > 0)).join(live, [*keys, "adj"], "left_semi").distinct())
        touch = materialize(touch)
    j = join_checked(labels, moves, [*keys, "label"], "left")
    return j.select(*keys, "row_", "col_", F.coalesce("now", "label").cast("int").alias("label"))


def clean_labels(labels: DataFrame, fill_area, merge_area, min_area, mode: str = "exact", valid: str | None = None,
                 keys: Sequence[str] = KEYS, block: int = BLOCK) -> DataFrame:
    """Mask, fill holes, merge small regions, drop tiny ones, mask again and renumber.

    ``fast`` takes other holes and neighbours than ``exact`` and is used only when asked for, so that the labels of a raster
    never depend on its size or on the other rasters. The areas may differ by key.
    """
    keys = list(keys)
    if mode not in ("exact", "fast"):
        raise ValueError("mode must be exact or fast")
    cut = lambda df: df if valid is None else df.withColumn("label", F.when(F.col(valid) == 0, 0).otherwise(F.col("label")))
    base = materialize(cut(labels).select(*keys, "row_", "col_", "label", *([valid] if valid else [])))
    on = [*keys, "row_", "col_"]
    lab = base.select(*on, "label")
    if any_set(fill_area) and mode == "exact" and not any_set(merge_area):
        lab = materialize(fill_holes_exact(base, fill_area, keys, block, [valid] if valid else []))
    elif any_set(fill_area) or any_set(merge_area):
        if any_set(fill_area):
            lab = fill_holes_fast(lab, fill_area, keys, block) if mode == "fast" else fill_holes_exact(lab, fill_area, keys, block)
        if any_set(merge_area):
            lab = merge_small_fast(lab, merge_area, keys) if mode == "fast" else merge_small_exact(lab, merge_area, keys, block)
        lab = materialize(lab.join(base.select(*on, valid), on) if valid else lab)
    else:
        lab = base
    # Sizes count pixels that the mask cuts away; a label that keeps none has no number.
    left = F.col("label") if valid is None else F.when(F.col(valid) == 0, 0).otherwise(F.col("label"))
    kept = lab.filter("label > 0").groupBy(*keys, "label").agg(F.count("*").alias("n"), F.count_if(left > 0).alias("_left"))
    kept = materialize(kept.filter((F.col("n") >= column(min_area)) & (F.col("_left") > 0)).select(*keys, "label"))
    ids = number_rows(kept, ["label"], "new_label", keys)
    j = join_checked(lab.select(*on, left.alias("label")), ids, [*keys, "label"], "left")
    return j.select(*on, F.coalesce("new_label", F.lit(0)).cast("int").alias("label"))
