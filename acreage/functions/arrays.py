"""Small NumPy helpers for one block of a raster; used inside Spark tasks only."""

from __future__ import annotations

import numpy as np


def disk(radius: int) -> list[tuple[int, int]]:
    """Offsets with dx^2 + dy^2 <= r^2."""
    r = max(0, int(radius))
    return [(dy, dx) for dy in range(-r, r + 1) for dx in range(-r, r + 1) if dx * dx + dy * dy <= r * r]


def ellipse(radius: int) -> list[tuple[int, int]]:
    """Offsets of the elliptic element: half-width round(sqrt(r^2 - dy^2)) in every row."""
    r = max(0, int(radius))
    half = {dy: int(round(float(np.sqrt(r * r - dy * dy)))) for dy in range(-r, r + 1)}
    return [(dy, dx) for dy in range(-r, r + 1) for dx in range(-half[dy], half[dy] + 1)]


def square(radius: int) -> list[tuple[int, int]]:
    r = max(0, int(radius))
    return [(dy, dx) for dy in range(-r, r + 1) for dx in range(-r, r + 1)]


CROSS = [(0, 1), (0, -1), (1, 0), (-1, 0)]


def shifted(a: np.ndarray, dy: int, dx: int, fill) -> np.ndarray:
    """out[y, x] = a[y + dy, x + dx], ``fill`` outside."""
    h, w = a.shape
    out = np.full_like(a, fill)
    ys, yd = (slice(max(dy, 0), h + min(dy, 0)), slice(max(-dy, 0), h + min(-dy, 0)))
    xs, xd = (slice(max(dx, 0), w + min(dx, 0)), slice(max(-dx, 0), w + min(-dx, 0)))
    if abs(dy) < h and abs(dx) < w:
        out[yd, xd] = a[ys, xs]
    return out


def stencil_max(a: np.ndarray, offsets, fill):
    out = None
    for dy, dx in offsets:
        s = shifted(a, dy, dx, fill)
        out = s if out is None else np.maximum(out, s)
    return out


def stencil_min(a: np.ndarray, offsets, fill):
    out = None
    for dy, dx in offsets:
        s = shifted(a, dy, dx, fill)
        out = s if out is None else np.minimum(out, s)
    return out


def label4(values: np.ndarray) -> np.ndarray:
    """4-connected regions of equal positive value (or of a mask); the id is the first row-run in scan order, 0 outside."""
    inside = values > 0
    if not inside.any():
        return np.zeros(values.shape, dtype=np.int64)
    start = inside.copy()
    start[:, 1:] &= values[:, 1:] != values[:, :-1]
    run = np.cumsum(start.ravel()).reshape(values.shape) * inside
    parent = np.arange(int(run.max()) + 1)
    both = inside[1:] & (values[1:] == values[:-1])
    a, b = run[:-1][both], run[1:][both]
    while True:
        pa, pb = parent[a], parent[b]
        differ = pa != pb
        if not differ.any():
            return parent[run]
        np.minimum.at(parent, np.maximum(pa, pb)[differ], np.minimum(pa, pb)[differ])
        while True:
            up = parent[parent]
            if np.array_equal(up, parent):
                break
            parent = up


def boxes_of(labels: np.ndarray):
    """(value, row range, column range) of every positive label, ascending."""
    y, x = np.nonzero(labels > 0)
    values, inv = np.unique(labels[y, x], return_inverse=True)
    n = len(values)
    lo, hi = np.full((2, n), np.iinfo(np.int64).max), np.full((2, n), -1)
    for k, v in enumerate((y, x)):
        np.minimum.at(lo[k], inv, v)
        np.maximum.at(hi[k], inv, v)
    return [(values[i], (lo[0, i], hi[0, i]), (lo[1, i], hi[1, i])) for i in range(n)]


def sizes_of(labels: np.ndarray) -> np.ndarray:
    """Size of every pixel's component (label 0 gets the size of the background)."""
    return np.bincount(labels.ravel())[labels]


def gaussian_kernel(sigma: float) -> np.ndarray:
    r = int(4.0 * sigma + 0.5)
    x = np.arange(-r, r + 1)
    k = np.exp(-0.5 * (x / sigma) ** 2)
    return k / k.sum()


def thin(mask: np.ndarray) -> np.ndarray:
    """Two-subiteration thinning to one-pixel lines; pixels outside count as background."""
    img = np.pad(mask.astype(np.uint8), 1)
    while True:
        changed = False
        for step in (0, 1):
            n = [shifted(img, dy, dx, 0) for dy, dx in ((-1, 0), (-1, 1), (0, 1), (1, 1), (1, 0), (1, -1), (0, -1), (-1, -1))]
            count = sum(x.astype(int) for x in n)
            turns = sum(((n[i] == 0) & (n[(i + 1) % 8] == 1)).astype(int) for i in range(8))
            up, right, down, left = n[0], n[2], n[4], n[6]
            if step == 0:
                free = (up * right * down == 0) & (right * down * left == 0)
            else:
                free = (up * right * left == 0) & (up * down * left == 0)
            drop = (img == 1) & (count >= 2) & (count <= 6) & (turns == 1) & free
            if drop.any():
                img = np.where(drop, 0, img).astype(np.uint8)
                changed = True
        if not changed:
            return img[1:-1, 1:-1]
