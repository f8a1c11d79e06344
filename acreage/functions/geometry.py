"""Geometry on nested arrays: ``rings ARRAY<ARRAY<STRUCT<x,y>>>``, ring 0 the shell, others holes, all closed."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

POINT = "struct<x:double,y:double>"
RING = f"array<{POINT}>"
RINGS = f"array<{RING}>"


def point(x: Column, y: Column) -> Column:
    return F.struct(x.cast("double").alias("x"), y.cast("double").alias("y"))


def box_ring(x0: Column, y0: Column, x1: Column, y1: Column) -> Column:
    return F.array(point(x0, y0), point(x1, y0), point(x1, y1), point(x0, y1), point(x0, y0))


def _steps(ring: Column) -> Column:
    """Consecutive vertex pairs (a, b)."""
    n = F.size(ring)
    head = F.slice(ring, F.lit(1), F.greatest(n - 1, F.lit(0)))
    tail = F.slice(ring, F.lit(2), F.greatest(n - 1, F.lit(0)))
    return F.zip_with(head, tail, lambda a, b: F.struct(a.alias("a"), b.alias("b")))


def _fold(array: Column, fn) -> Column:
    return F.aggregate(array, F.lit(0.0), lambda acc, s: acc + fn(s))


def ring_area(ring: Column) -> Column:
    """Signed shoelace area; that of rings of four edges, in the same order, is compiled."""
    step = lambda a, b: a["x"] * b["y"] - b["x"] * a["y"]
    four = F.lit(0.0)
    for i in range(4):
        four = four + step(F.get(ring, F.lit(i)), F.get(ring, F.lit(i + 1)))
    return F.when(F.size(ring) == 5, four).otherwise(_fold(_steps(ring), lambda s: step(s["a"], s["b"]))) / 2.0


def ring_length(ring: Column) -> Column:
    return _fold(_steps(ring), lambda s: F.hypot(s["b"]["x"] - s["a"]["x"], s["b"]["y"] - s["a"]["y"]))


def polygon_area(rings: Column) -> Column:
    holes = F.slice(rings, F.lit(2), F.greatest(F.size(rings) - 1, F.lit(0)))
    shell = F.abs(ring_area(rings[0]))
    return F.when(F.size(rings) == 1, shell).otherwise(shell - _fold(holes, lambda r: F.abs(ring_area(r))))


def polygon_perimeter(rings: Column) -> Column:
    return _fold(rings, ring_length)


def bounds(rings: Column) -> dict[str, Column]:
    shell = rings[0]
    xs, ys = F.transform(shell, lambda p: p["x"]), F.transform(shell, lambda p: p["y"])
    return {"x0": F.array_min(xs), "y0": F.array_min(ys), "x1": F.array_max(xs), "y1": F.array_max(ys)}


def centroid(rings: Column) -> tuple[Column, Column]:
    """Area centroid, holes subtracted."""
    def moment(axis: str) -> Column:
        def one(r):
            signed = ring_area(r)
            m = _fold(_steps(r), lambda s: (s["a"][axis] + s["b"][axis]) * (s["a"]["x"] * s["b"]["y"] - s["b"]["x"] * s["a"]["y"])) / 6.0
            return F.when(signed < 0, -m).otherwise(m)
        rest = F.slice(rings, F.lit(2), F.greatest(F.size(rings) - 1, F.lit(0)))
        return one(rings[0]) - _fold(rest, one)
    a = F.nullif(polygon_area(rings), F.lit(0.0))
    return moment("x") / a, moment("y") / a


def contains(rings: Column, x: Column, y: Column) -> Column:
    """Even-odd crossing parity; an edge covers its lower end only, so shared borders count once."""
    def crossings(ring):
        def hit(s):
            up = (s["a"]["y"] <= y) != (s["b"]["y"] <= y)
            rise = F.nullif(s["b"]["y"] - s["a"]["y"], F.lit(0.0))
            at = s["a"]["x"] + (y - s["a"]["y"]) * (s["b"]["x"] - s["a"]["x"]) / rise
            return F.when(up & (x < at), F.lit(1.0)).otherwise(F.lit(0.0))
        return _fold(_steps(ring), hit)
    return (_fold(rings, crossings) % 2) == 1


def strip_holes(rings: Column) -> Column:
    return F.slice(rings, 1, 1)


def map_points(rings: Column, fn) -> Column:
    """Apply ``fn(x, y) -> (x, y)`` to every vertex."""
    return F.transform(rings, lambda r: F.transform(r, lambda p: point(*fn(p["x"], p["y"]))))


def segment_meets_box(a: Column, b: Column, x0: Column, y0: Column, x1: Column, y1: Column) -> Column:
    """Closed segment and closed box share a point (separating axes)."""
    hx, hy = (x1 - x0) / 2, (y1 - y0) / 2
    dx, dy = (b["x"] - a["x"]) / 2, (b["y"] - a["y"]) / 2
    mx, my = (a["x"] + b["x"]) / 2 - (x0 + x1) / 2, (a["y"] + b["y"]) / 2 - (y0 + y1) / 2
    return ((F.abs(mx) <= hx + F.abs(dx)) & (F.abs(my) <= hy + F.abs(dy)) & (F.abs(dx * my - dy * mx) <= hx * F.abs(dy) + hy * F.abs(dx)))


def intersects_box(rings: Column, x0: Column, y0: Column, x1: Column, y1: Column) -> Column:
    """An edge meets the box, or the box lies wholly inside the polygon."""
    hit = F.exists(rings, lambda r: F.exists(_steps(r), lambda s: segment_meets_box(s["a"], s["b"], x0, y0, x1, y1)))
    return hit | contains(rings, (x0 + x1) / 2, (y0 + y1) / 2)


def is_box(ring: Column) -> Column:
    """Closed ring of four axis-parallel edges."""
    parallel = F.forall(_steps(ring), lambda s: (s["a"]["x"] == s["b"]["x"]) | (s["a"]["y"] == s["b"]["y"]))
    return (F.size(ring) == 5) & parallel & (F.abs(ring_area(ring)) > 0)


def as_boxes(rings: Column) -> Column:
    """Bounds of every ring when all rings are axis-parallel boxes, NULL otherwise. ``sign`` is -1 for holes."""
    def one(ring, i):
        xs, ys = F.transform(ring, lambda p: p["x"]), F.transform(ring, lambda p: p["y"])
        return F.struct(F.array_min(xs).alias("x0"), F.array_min(ys).alias("y0"), F.array_max(xs).alias("x1"), F.array_max(ys).alias("y1"),
                        F.when(i == 0, F.lit(1.0)).otherwise(F.lit(-1.0)).alias("sign"))
    return F.when(F.forall(rings, is_box), F.transform(rings, one))


def boxes_overlap(a: Column, b: Column) -> Column:
    """Intersection area of two box polygons: shell and hole terms by sign; that of at most two rings each, in the same order, is compiled."""
    def pair(p, q):
        w = F.least(p["x1"], q["x1"]) - F.greatest(p["x0"], q["x0"])
        h = F.least(p["y1"], q["y1"]) - F.greatest(p["y0"], q["y0"])
        return F.greatest(w, F.lit(0.0)) * F.greatest(h, F.lit(0.0)) * p["sign"] * q["sign"]
    few = F.lit(0.0)
    for i in range(2):
        both = [F.coalesce(pair(F.get(a, F.lit(i)), F.get(b, F.lit(j))), F.lit(0.0)) for j in range(2)]
        few = few + (both[0] + both[1])
    every = F.aggregate(a, F.lit(0.0), lambda acc, p: acc + F.aggregate(b, F.lit(0.0), lambda sub, q: sub + pair(p, q)))
    return F.when((F.size(a) <= 2) & (F.size(b) <= 2), few).otherwise(every)


def point_at_length(rings: Column, t: Column) -> Column:
    """Point at distance ``t`` along the boundary, shell first."""
    start = F.struct(t.cast("double").alias("rest"), F.lit(None).cast("double").alias("x"), F.lit(None).cast("double").alias("y"))

    def walk(acc, s):
        n = F.hypot(s["b"]["x"] - s["a"]["x"], s["b"]["y"] - s["a"]["y"])
        here = acc["rest"].isNotNull() & (acc["rest"] <= n)
        f = acc["rest"] / F.nullif(n, F.lit(0.0))
        return F.struct(
            F.when(acc["rest"].isNotNull() & ~here, acc["rest"] - n).alias("rest"),
            F.when(here, s["a"]["x"] + (s["b"]["x"] - s["a"]["x"]) * f).otherwise(acc["x"]).alias("x"),
            F.when(here, s["a"]["y"] + (s["b"]["y"] - s["a"]["y"]) * f).otherwise(acc["y"]).alias("y"))
    return F.aggregate(F.flatten(F.transform(rings, _steps)), start, walk)


def steps(rings: Column) -> Column:
    """All edges of a polygon with ring and position: array of (ring, i, a, b)."""
    indexed = F.transform(rings, lambda r, k: F.transform(_steps(r), lambda s, i: F.struct(k.alias("ring"), i.alias("i"), s["a"].alias("a"), s["b"].alias("b"))))
    return F.flatten(indexed)


# WGS84 ellipsoid and transverse Mercator constants (fixed values).
WGS84_A = 6378137.0
WGS84_F = 1.0 / 298.257223563
UTM_K0 = 0.9996


def utm_forward(lon: Column, lat: Column, zone: Column, south: Column) -> tuple[Column, Column]:
    """Longitude/latitude (degrees) to UTM metres: series in the third flattening up to n^3."""
    n = WGS84_F / (2.0 - WGS84_F)
    radius = WGS84_A / (1.0 + n) * (1.0 + n**2 / 4.0 + n**4 / 64.0)
    alpha = (n / 2.0 - 2.0 * n**2 / 3.0 + 5.0 * n**3 / 16.0, 13.0 * n**2 / 48.0 - 3.0 * n**3 / 5.0, 61.0 * n**3 / 240.0)
    e = 2.0 * n**0.5 / (1.0 + n)
    s = F.sin(F.radians(lat))
    atanh = lambda v: F.log((F.lit(1.0) + v) / (F.lit(1.0) - v)) / 2.0
    t = F.sinh(atanh(s) - atanh(s * e) * e)
    dl = F.radians(lon - (zone * 6.0 - 183.0))
    xi = F.atan2(t, F.cos(dl))
    eta = atanh(F.sin(dl) / F.sqrt(F.lit(1.0) + t * t))
    x, y = eta, xi
    for j, a in enumerate(alpha, start=1):
        x = x + F.cos(xi * (2.0 * j)) * F.sinh(eta * (2.0 * j)) * a
        y = y + F.sin(xi * (2.0 * j)) * F.cosh(eta * (2.0 * j)) * a
    north = F.when(south, F.lit(10000000.0)).otherwise(F.lit(0.0))
    return x * (UTM_K0 * radius) + 500000.0, y * (UTM_K0 * radius) + north


def utm_inverse(x: Column, y: Column, zone: Column, south: Column) -> tuple[Column, Column]:
    """UTM metres to longitude/latitude in degrees."""
    n = WGS84_F / (2.0 - WGS84_F)
    radius = WGS84_A / (1.0 + n) * (1.0 + n**2 / 4.0 + n**4 / 64.0)
    beta = (n / 2.0 - 2.0 * n**2 / 3.0 + 37.0 * n**3 / 96.0, n**2 / 48.0 + n**3 / 15.0, 17.0 * n**3 / 480.0)
    delta = (2.0 * n - 2.0 * n**2 / 3.0 - 2.0 * n**3, 7.0 * n**2 / 3.0 - 8.0 * n**3 / 5.0, 56.0 * n**3 / 15.0)
    xi0 = (y - F.when(south, F.lit(10000000.0)).otherwise(F.lit(0.0))) / (UTM_K0 * radius)
    eta0 = (x - 500000.0) / (UTM_K0 * radius)
    xi, eta = xi0, eta0
    for j, b in enumerate(beta, start=1):
        xi = xi - F.sin(xi0 * (2.0 * j)) * F.cosh(eta0 * (2.0 * j)) * b
        eta = eta - F.cos(xi0 * (2.0 * j)) * F.sinh(eta0 * (2.0 * j)) * b
    chi = F.asin(F.sin(xi) / F.cosh(eta))
    phi = chi
    for j, d in enumerate(delta, start=1):
        phi = phi + F.sin(chi * (2.0 * j)) * d
    lam = F.atan2(F.sinh(eta), F.cos(xi))
    return F.degrees(lam) + zone * 6.0 - 183.0, F.degrees(phi)


def web_mercator(lon: Column, lat: Column) -> tuple[Column, Column]:
    return F.radians(lon) * WGS84_A, F.log(F.tan(F.radians(lat) / 2.0 + 0.7853981633974483)) * WGS84_A


def zonal_pixel_area(lat: Column, dlon: Column, dlat: Column) -> Column:
    """Ellipsoidal area of a small lon/lat cell centred at ``lat`` (degrees): difference of zonal areas."""
    e2 = WGS84_F * (2.0 - WGS84_F)
    e = e2**0.5
    b2 = (WGS84_A * (1.0 - WGS84_F)) ** 2

    def zone(phi):
        s = F.sin(F.radians(phi))
        return (s / (F.lit(1.0) - s * s * e2) + F.log((F.lit(1.0) + s * e) / (F.lit(1.0) - s * e)) / (2.0 * e)) * (b2 / 2.0)

    return F.abs((zone(lat + dlat / 2.0) - zone(lat - dlat / 2.0)) * F.radians(dlon))
