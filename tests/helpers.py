"""Small rasters as tables, and brute-force twins in plain Python."""

import numpy as np


def to_px(spark, raster_id=0, **arrays):
    names = list(arrays)
    h, w = arrays[names[0]].shape
    rows = [(raster_id, r, k, *[arrays[n][r, k].item() for n in names]) for r in range(h) for k in range(w)]
    kinds = ["double" if arrays[n].dtype.kind == "f" else "int" for n in names]
    return spark.createDataFrame(rows, "raster_id int, row_ int, col_ int, " + ", ".join(f"{n} {k}" for n, k in zip(names, kinds)))


def to_array(df, name, shape, fill=0):
    out = np.full(shape, fill, dtype=object)
    for r in df.select("row_", "col_", name).collect():
        out[r["row_"], r["col_"]] = r[name]
    return out


def flood(mask):
    """4-connected labels in scan order."""
    h, w = mask.shape
    lab, n = np.zeros((h, w), int), 0
    for r in range(h):
        for k in range(w):
            if mask[r, k] and not lab[r, k]:
                n += 1
                stack = [(r, k)]
                lab[r, k] = n
                while stack:
                    y, x = stack.pop()
                    for dy, dx in ((0, 1), (0, -1), (1, 0), (-1, 0)):
                        b, a = y + dy, x + dx
                        if 0 <= b < h and 0 <= a < w and mask[b, a] and not lab[b, a]:
                            lab[b, a] = n
                            stack.append((b, a))
    return lab


def merge_serial(lab, limit):
    """Small regions join the neighbour with most border pixels, one after another."""
    lab = lab.copy()
    h, w = lab.shape
    sizes = {v: int((lab == v).sum()) for v in np.unique(lab) if v > 0}
    for v in sorted([s for s in sizes if sizes[s] <= limit], key=lambda s: (sizes[s], s)):
        ring = set()
        for y, x in zip(*np.nonzero(lab == v)):
            for dy in (-1, 0, 1):
                for dx in (-1, 0, 1):
                    b, a = y + dy, x + dx
                    if 0 <= b < h and 0 <= a < w and lab[b, a] not in (0, v):
                        ring.add((b, a))
        counts = {}
        for p in ring:
            counts[lab[p]] = counts.get(lab[p], 0) + 1
        lab[lab == v] = min(counts, key=lambda t: (-counts[t], t)) if counts else 0
    return lab


def fill_serial(lab, limit):
    """Per label in ascending order: background inside a small component of everything else."""
    out = lab.copy()
    for v in np.unique(lab[lab > 0]):
        rest = flood(lab != v)
        size = np.bincount(rest.ravel())[rest]
        out[(rest > 0) & (size < limit) & (out == 0)] = v
    return out


def clean_serial(lab, fill, merge, least):
    lab = merge_serial(fill_serial(lab, fill), merge)
    size = np.bincount(lab.ravel())[lab]
    lab = np.where(size < least, 0, lab)
    ids = {v: i + 1 for i, v in enumerate(np.unique(lab[lab > 0]))}
    return np.vectorize(lambda v: ids.get(v, 0))(lab)


def forest_serial(e, m, inside, then=None):
    """Edges one after another, cheapest first; two trees that both have a marker stay apart."""
    h, w = e.shape
    then = np.zeros_like(e) if then is None else then
    edges = []
    for r in range(h):
        for k in range(w):
            for way, (y, x) in enumerate(((r, k + 1), (r + 1, k))):
                if y < h and x < w and inside[r, k] and inside[y, x]:
                    p, q = (e[r, k], then[r, k]), (e[y, x], then[y, x])
                    edges.append((max(p[0], q[0]), min(p[0], q[0]), max(p[1], q[1]), min(p[1], q[1]), r, k, way, (r, k), (y, x)))
    tree = {(r, k): [(r, k)] for r in range(h) for k in range(w) if inside[r, k]}
    mark = {p: int(m[p]) for p in tree}
    of = {p: p for p in tree}
    for *_, p, q in sorted(edges):
        a, b = of[p], of[q]
        if a == b or (mark[a] and mark[b]):
            continue
        mark[a] = mark[a] or mark[b]
        for x in tree.pop(b):
            tree[a].append(x)
            of[x] = a
    out = np.zeros((h, w), int)
    for p, a in of.items():
        out[p] = mark[a]
    return out


def segments(rings) -> np.ndarray:
    out = [(p["x"], p["y"], q["x"], q["y"]) for ring in rings for p, q in zip(ring[:-1], ring[1:])]
    return np.array([s for s in out if s[1] != s[3]], dtype=float).reshape(-1, 4)


def levels(seg: np.ndarray) -> np.ndarray:
    """Heights where the order of edges along a scanline may change: end points and crossings."""
    ys = [seg[:, 1], seg[:, 3]]
    for i in range(len(seg) - 1):
        ax, ay, bx, by = seg[i]
        o = seg[i + 1:]
        den = (bx - ax) * (o[:, 3] - o[:, 1]) - (by - ay) * (o[:, 2] - o[:, 0])
        with np.errstate(divide="ignore", invalid="ignore"):
            t = ((o[:, 0] - ax) * (o[:, 3] - o[:, 1]) - (o[:, 1] - ay) * (o[:, 2] - o[:, 0])) / den
            u = ((o[:, 0] - ax) * (by - ay) - (o[:, 1] - ay) * (bx - ax)) / den
        ok = (den != 0) & (t >= 0) & (t <= 1) & (u >= 0) & (u <= 1)
        ys.append(ay + t[ok] * (by - ay))
    return np.unique(np.concatenate(ys)) if len(seg) else np.empty(0)


def active(seg: np.ndarray, y: float) -> np.ndarray:
    """Edges that cross height y, ordered by x."""
    lo, hi = np.minimum(seg[:, 1], seg[:, 3]), np.maximum(seg[:, 1], seg[:, 3])
    idx = np.flatnonzero((lo <= y) & (y < hi))
    return idx[np.argsort(x_at(seg[idx], y), kind="stable")]


def x_at(seg: np.ndarray, y: float) -> np.ndarray:
    return seg[:, 0] + (y - seg[:, 1]) * (seg[:, 2] - seg[:, 0]) / (seg[:, 3] - seg[:, 1])


def as_rings(*rings):
    return [[{"x": float(x), "y": float(y)} for x, y in [*r, r[0]]] for r in rings]


def ring_around(rng, cx, cy, n):
    a = (np.arange(n) + 0.8 * rng.random(n)) * 2 * np.pi / n
    r = 1 + 4 * rng.random(n)
    return list(zip(cx + r * np.cos(a), cy + r * np.sin(a)))


def slab_area(a, b):
    """Area inside both by the even-odd rule: between two levels the common width is linear, so its middle value is exact."""
    sa, sb = segments(a), segments(b)
    ys, area = levels(np.vstack([sa, sb])), 0.0
    for y0, y1 in zip(ys[:-1], ys[1:]):
        xa, xb = (x_at(s[active(s, (y0 + y1) / 2)], (y0 + y1) / 2) for s in (sa, sb))
        area += (y1 - y0) * sum(max(0.0, min(a1, b1) - max(a0, b0)) for a0, a1 in zip(xa[::2], xa[1::2]) for b0, b1 in zip(xb[::2], xb[1::2]))
    return area
