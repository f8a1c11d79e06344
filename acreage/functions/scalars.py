"""Column expressions for ratios, sizes, identifiers and coordinates."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

NAN = float("nan")


def dbl(c: Column | str) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("double")


def clamp(value: Column, low: Column | float, high: Column | float) -> Column:
    as_col = lambda v: v if isinstance(v, Column) else F.lit(v)
    return F.greatest(as_col(low), F.least(value, as_col(high)))


def ratio(num: Column, den: Column, default: float) -> Column:
    """num / den, or ``default`` where the denominator is not positive."""
    return F.when(den > 0, dbl(num) / dbl(den)).otherwise(F.lit(float(default)))


def f1_from_counts(tp: Column, fp: Column, fn: Column, empty: float | None = None) -> Column:
    """F1 with precision and recall 1 on empty sides; ``empty`` (NaN) where all counts are zero."""
    p, r = ratio(tp, tp + fp, 1.0), ratio(tp, tp + fn, 1.0)
    f1 = ratio(p * r * 2, p + r, 0.0)
    return f1 if empty is None else F.when(tp + fp + fn <= 0, F.lit(float(empty))).otherwise(f1)


def area_to_px(area: Column, pixel_area: Column) -> Column:
    """Pixels for an area: 0 for none, otherwise at least 1, halves to even."""
    return F.when(area <= 0, F.lit(0)).otherwise(F.greatest(F.lit(1), F.bround(area / pixel_area, 0))).cast("bigint")


def utm_epsg(lon: Column, lat: Column, clamped: bool = True) -> Column:
    zone = F.floor((lon + 180.0) / 6.0) + 1
    if clamped:
        zone = clamp(zone, 1, 60)
    return (F.when(lat >= 0, F.lit(32600)).otherwise(F.lit(32700)) + zone).cast("int")


def slug(text: Column, default: str = "sample") -> Column:
    safe = F.regexp_replace(F.lower(F.trim(text)), "[^a-z0-9]+", "_")
    safe = F.regexp_replace(safe, "^_+|_+$", "")
    return F.when(safe == "", F.lit(default)).otherwise(safe)


def blank_to_null(value: Column) -> Column:
    s = F.trim(value.cast("string"))
    return F.when(s.isNull() | (s == "") | F.lower(s).isin("none", "nan"), F.lit(None)).otherwise(s)


def field_id(dataset: Column, feat_index: Column, id_value: Column | None = None, orig_fid: Column | None = None) -> Column:
    """``dataset::value`` of the id column, or of the original row id when no id column is given."""
    source = id_value if id_value is not None else orig_fid
    value = F.coalesce(blank_to_null(source), feat_index.cast("string")) if source is not None else feat_index.cast("string")
    return F.concat(dataset, F.lit("::"), value)


def split_group(dataset: Column, patch_id: Column, field: Column, feat_index: Column) -> Column:
    """All patches of one field stay together; a patch without a field is its own group."""
    return (
        F.when(field.isNotNull() & (field != ""), F.concat(F.lit("field::"), dataset, F.lit("::"), field))
        .when(feat_index.isNull(), F.concat(F.lit("neg::"), patch_id))
        .otherwise(F.concat(F.lit("field::"), dataset, F.lit("::"), feat_index.cast("string")))
    )


def draw(key: Column, j: Column | int, seed: int) -> Column:
    """Uniform number in [0, 1): draw ``j`` of ``key``, integer arithmetic only."""
    k = key.cast("bigint") % F.lit(1000003)
    jj = (j if isinstance(j, Column) else F.lit(j)).cast("bigint")
    x = (k * F.lit(7919) + jj * F.lit(104729) + F.lit(int(seed)).cast("bigint")) % F.lit(2147483648)
    return ((x * F.lit(1103515245).cast("bigint") + F.lit(12345)) % F.lit(2147483648)).cast("double") / F.lit(2147483648.0)


def draw_int(key: Column, j: Column | int, seed: int, low: Column | int, high: Column | int) -> Column:
    """Uniform integer in [low, high]."""
    lo = low if isinstance(low, Column) else F.lit(low)
    hi = high if isinstance(high, Column) else F.lit(high)
    return (lo + F.floor(draw(key, j, seed) * (hi - lo + 1))).cast("int")


def dataset_seed(name: Column, base: int) -> Column:
    """base + first eight sha256 bytes read little-endian, modulo 2^63 - 1."""
    digest = F.sha2(name, 256)
    flipped = F.concat(*[F.substring(digest, 15 - 2 * i, 2) for i in range(8)])
    value = F.conv(flipped, 16, 10).cast("decimal(38,0)")
    return ((value + F.lit(base).cast("decimal(38,0)")) % F.lit(2**63 - 1).cast("decimal(38,0)")).cast("bigint")


def sigmoid(x: Column) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-x))


def gaussian_weight(row: Column, col: Column, h: Column, w: Column, sigma: float, floor: float) -> Column:
    """exp(-r^2 / 2 sigma^2) on [-1, 1]^2, divided by the largest value of the window, floored."""
    axis = lambda i, n: F.when(n <= 1, F.lit(-1.0)).otherwise(F.lit(-1.0) + dbl(i) * 2.0 / dbl(n - 1))
    peak = lambda n: F.when(n <= 1, F.lit(1.0)).when(n % 2 == 1, F.lit(0.0)).otherwise(F.lit(1.0) / dbl(n - 1))
    g = lambda y, x: F.exp((x * x + y * y) * (-0.5 / (sigma * sigma)))
    scaled = g(axis(row, h), axis(col, w)) / F.greatest(g(peak(h), peak(w)), F.lit(1e-6))
    return F.greatest(scaled, F.lit(float(floor)))
