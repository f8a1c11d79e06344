"""Flips, quarter turns and synthetic invalid areas as coordinate arithmetic."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from acreage.functions.scalars import draw, draw_int


def flip(i: Column, n: Column) -> Column:
    return n - 1 - i


def rotate(row: Column, col: Column, n: Column, quarters: int) -> tuple[Column, Column]:
    """Destination of a pixel of an n x n patch after counter-clockwise quarter turns."""
    q = quarters % 4
    if q == 0:
        return row, col
    if q == 1:
        return n - 1 - col, row
    if q == 2:
        return n - 1 - row, n - 1 - col
    return col, n - 1 - row


def rotate_by(row: Column, col: Column, n: Column, quarters: Column) -> tuple[Column, Column]:
    turns = [rotate(row, col, n, q) for q in range(4)]
    pick = lambda i: F.when(quarters == 1, turns[1][i]).when(quarters == 2, turns[2][i]).when(quarters == 3, turns[3][i]).otherwise(turns[0][i])
    return pick(0), pick(1)


def invalid_area(key: Column, row: Column, col: Column, h: int, w: int, seed: int, prob: float, min_w: int, max_w: int,
                 block_prob: float, max_area_ratio: float) -> Column:
    """TRUE on pixels of a synthetic invalid block or side strip; its size never exceeds the area cap."""
    cap = max(1, int(min(max(max_area_ratio, 0.01), 0.95) * h * w))
    size = lambda j, top: F.least(draw_int(key, j, seed, min_w, max(min_w, max_w)), F.lit(top))
    bw, bh = size(12, w), size(13, h)
    shrink = F.when(bh * bw > cap, F.sqrt(F.lit(float(cap)) / (bh * bw))).otherwise(F.lit(1.0))
    bw2, bh2 = (F.greatest(F.lit(1), F.floor(v * shrink)).cast("int") for v in (bw, bh))
    y0, x0 = draw_int(key, 14, seed, 0, F.lit(h) - bh2), draw_int(key, 15, seed, 0, F.lit(w) - bw2)
    block = (row >= y0) & (row < y0 + bh2) & (col >= x0) & (col < x0 + bw2)
    side = draw_int(key, 16, seed, 0, 3)
    strip = lambda along, across: F.when(F.lit(along) * size(12, max(1, across - 1)) > cap, F.lit(max(1, cap // max(1, along)))).otherwise(size(12, max(1, across - 1)))
    ww, hh = strip(h, w), strip(w, h)
    edge = (F.when(side == 0, col < ww).when(side == 1, col >= F.lit(w) - ww).when(side == 2, row < hh).otherwise(row >= F.lit(h) - hh))
    hit = F.when(draw(key, 11, seed) < block_prob, block).otherwise(edge)
    return (draw(key, 10, seed) < prob) & hit
