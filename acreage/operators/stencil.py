"""Neighbourhood operators on (raster, row, col) tables.

The raster is cut into blocks. Every pixel goes to its own block and, when it lies within ``halo`` pixels
of a border, to the neighbouring blocks as well; one shuffle on (raster, block) then gives each task all
the pixels its block needs. A block holds at most (block + 2 halo)^2 pixels however large the raster is.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_schema

from acreage.functions import arrays as A
from acreage.operators.settings import any_set, at, largest
from acreage.session import ship

BLOCK = 256


@dataclass
class Tile:
    """Dense view of one block with its halo. Arrays cover exactly the bounding box of the rows received."""

    data: dict[str, np.ndarray]
    present: np.ndarray
    row0: int
    col0: int
    core: np.ndarray
    keys: dict = field(default_factory=dict)
    #: Of a mosaic, see :func:`mosaic_rows`: raster row, first raster column and block of each array row.
    rows: np.ndarray | None = None
    lefts: np.ndarray | None = None
    blocks: np.ndarray | None = None

    def __getitem__(self, name: str) -> np.ndarray:
        return self.data[name]

    def place(self, y: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Raster rows and columns of cells."""
        if self.rows is None:
            return y + self.row0, x + self.col0
        return self.rows[y], self.lefts[y] + x


def stream_groups(df: DataFrame, group: Sequence[str], inputs: Sequence[str], fn: Callable[[dict], dict | None], ddl: str) -> DataFrame:
    """Call ``fn`` once per group with its columns as arrays; it returns equally long arrays or lists (or None).

    Rows are hash-partitioned and sorted by the group, and a task streams its groups one after another. This
    avoids the per-group start-up cost that dominates when groups are many and small.
    """
    group, names_in = list(group), [*group, *inputs]
    out_schema = to_arrow_schema(T.StructType.fromDDL(ddl))

    def column(parts: list[dict], field: pa.Field) -> pa.Array:
        if any(isinstance(q[field.name], list) for q in parts):
            return pa.array([v for q in parts for v in q[field.name]], type=field.type)
        return pa.array(np.concatenate([q[field.name] for q in parts]), type=field.type)

    def run(batches):
        pending: list[dict[str, np.ndarray]] = []

        def flush():
            whole = {c: np.concatenate([q[c] for q in pending]) for c in names_in} if len(pending) > 1 else pending[0]
            pending.clear()
            return fn(whole)

        def pack(parts):
            return pa.RecordBatch.from_arrays([column(parts, f) for f in out_schema], schema=out_schema)

        for b in batches:
            if b.num_rows == 0:
                continue
            cols = {c: b.column(c).to_numpy(zero_copy_only=False) for c in names_in}
            change = np.zeros(b.num_rows - 1, dtype=bool)
            for k in group:
                change |= cols[k][1:] != cols[k][:-1]
            cuts = [0, *(np.flatnonzero(change) + 1).tolist(), b.num_rows]
            ready = []
            for lo, hi in zip(cuts[:-1], cuts[1:]):
                if pending and any(pending[-1][k][0] != cols[k][lo] for k in group):
                    ready.append(flush())
                pending.append({c: cols[c][lo:hi] for c in names_in})
            ready = [r for r in ready if r is not None]
            if ready:
                yield pack(ready)
        if pending:
            last = flush()
            if last is not None:
                yield pack([last])

    ship(df.sparkSession)
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # a fixed number, so that adaptive coalescing (by bytes) does not put compute-heavy groups on few cores
    return df.select(*names_in).repartition(parts, *group).sortWithinPartitions(*group).mapInArrow(run, ddl)


def _to_blocks(px: DataFrame, halo: int, keys: list[str], inputs: list[str], tall: int, wide: int) -> tuple[DataFrame, list[str]]:
    """Pixels once for each block that sees them, and the columns that name a block."""
    near = lambda c, size: F.sequence(
        F.greatest(F.lit(0), F.floor((F.col(c) - halo) / size)).cast("int"), F.floor((F.col(c) + halo) / size).cast("int"))
    home = lambda c, size: F.floor(F.col(c) / size).cast("int")
    p = px.select(*keys, "row_", "col_", *inputs)
    if halo > 0:
        p = p.withColumn("_br", F.explode(near("row_", tall))).withColumn("_bc", F.explode(near("col_", wide)))
    else:
        p = p.withColumn("_br", home("row_", tall)).withColumn("_bc", home("col_", wide))
    return p, [*keys, "_br", "_bc"]


#: Cells of the arrays that blocks share; a larger block has its own.
MOSAIC = 1 << 19


def mosaic_rows(px: DataFrame, fn: Callable[[Tile], dict[str, np.ndarray]], outputs: str, halo: int, keys: Sequence[str] = ("raster_id",),
                inputs: Sequence[str] | None = None, block: int = BLOCK) -> DataFrame:
    """Like :func:`block_rows` for functions that take many blocks at once, as small rasters cost a call each otherwise.

    Blocks lie below each other in one array, with ``halo`` empty rows (one at least) between them: what looks no farther and
    passes only over ``present`` cells stays in its block. The function takes positions from ``place`` and returns, beside the
    outputs, the array row ``_y`` that each row of its result belongs to.
    """
    keys = list(keys)
    inputs = [c for c in px.columns if c not in (*keys, "row_", "col_")] if inputs is None else list(inputs)
    p, part = _to_blocks(px, halo, keys, inputs, block, block)
    names = [o.strip().split()[0] for o in outputs.split(",")]
    types = dict(px.dtypes)
    ddl = ", ".join([*(f"{k} {types[k]}" for k in keys), outputs])
    schema = to_arrow_schema(T.StructType.fromDDL(ddl))
    read, gap = [*part, "row_", "col_", *inputs], max(1, halo)

    def lay(columns: dict[str, np.ndarray]):
        """Whole blocks, one after another, as results."""
        row, col = columns["row_"].astype(np.int64), columns["col_"].astype(np.int64)
        new = np.ones(len(row), dtype=bool)
        new[1:] = np.logical_or.reduce([columns[k][1:] != columns[k][:-1] for k in part])
        first, of = np.flatnonzero(new), np.cumsum(new) - 1
        r0, c0 = np.minimum.reduceat(row, first), np.minimum.reduceat(col, first)
        h, w = np.maximum.reduceat(row, first) - r0 + 1, np.maximum.reduceat(col, first) - c0 + 1
        ends = np.cumsum(h + gap)
        sheet = (ends - h - gap) // max(1, MOSAIC // int(w.max()))
        for k in np.unique(sheet):
            lo, hi = (int(i) for i in np.searchsorted(sheet, [k, k + 1]))
            use = slice(first[lo], first[hi] if hi < len(first) else len(row))
            g, off = of[use] - lo, ends[lo:hi] - ends[lo] + h[lo] - h[lo:hi]
            shape = (int(off[-1] + h[hi - 1] + gap), int(w[lo:hi].max()))
            tall_of = np.repeat(np.arange(hi - lo), h[lo:hi] + gap)
            rows = np.arange(shape[0]) - off[tall_of] + r0[lo:hi][tall_of]
            at = (row[use] - r0[lo:hi][g] + off[g], col[use] - c0[lo:hi][g])
            mine = (row[use] // block == columns["_br"][use]) & (col[use] // block == columns["_bc"][use])
            present, core = np.zeros(shape, dtype=bool), np.zeros(shape, dtype=bool)
            present[at] = True
            core[at[0][mine], at[1][mine]] = True
            data = {}
            for c in inputs:
                v = columns[c][use]
                data[c] = np.zeros(shape, dtype=v.dtype if v.dtype != object else float)
                data[c][at] = v
            res = fn(Tile(data, present, 0, 0, core, {}, rows, c0[lo:hi][tall_of], tall_of))
            from_ = first[lo:hi][tall_of[res["_y"]]]
            yield pa.RecordBatch.from_arrays([pa.array(columns[f.name][from_] if f.name in keys else res[f.name], type=f.type) for f in schema], schema=schema)

    def run(batches):
        held: list[dict[str, np.ndarray]] = []
        for b in batches:
            if b.num_rows == 0:
                continue
            cols = {c: b.column(c).to_numpy(zero_copy_only=False) for c in read}
            change = np.logical_or.reduce([cols[k][1:] != cols[k][:-1] for k in part])
            cut = int(np.flatnonzero(change)[-1]) + 1 if change.any() else 0
            if not cut and held and all(held[-1][k][-1] == cols[k][0] for k in part):
                held.append(cols)
                continue
            held.append({c: v[:cut] for c, v in cols.items()})
            whole = {c: np.concatenate([q[c] for q in held]) for c in read}
            if len(whole["row_"]):
                yield from lay(whole)
            held = [{c: v[cut:] for c, v in cols.items()}]
        if held:
            yield from lay({c: np.concatenate([q[c] for q in held]) for c in read})

    ship(px.sparkSession)
    parts = int(px.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return p.select(*read).repartition(parts, *part).sortWithinPartitions(*part).mapInArrow(run, ddl)


def block_rows(px: DataFrame, fn: Callable[[Tile], dict[str, np.ndarray]], outputs: str, halo: int, keys: Sequence[str] = ("raster_id",),
               inputs: Sequence[str] | None = None, block: int | tuple[int, int] = BLOCK) -> DataFrame:
    """Apply ``fn`` to every block; it returns equally long 1-D arrays, one row each.

    Rows arrive hash-partitioned and sorted by block, so a task streams its blocks one after another and
    holds one block at a time. ``outputs`` is a DDL list such as ``"row_ int, col_ int, dilated int"``.
    """
    keys = list(keys)
    inputs = [c for c in px.columns if c not in (*keys, "row_", "col_")] if inputs is None else list(inputs)
    tall, wide = (int(b) for b in (block if isinstance(block, tuple) else (block, block)))
    p, part = _to_blocks(px, halo, keys, inputs, tall, wide)
    names = [o.strip().split()[0] for o in outputs.split(",")]
    types = dict(px.dtypes)
    ddl = ", ".join([*(f"{k} {types[k]}" for k in keys), outputs])

    def one(columns: dict[str, np.ndarray]) -> dict[str, np.ndarray] | None:
        row, col = columns["row_"], columns["col_"]
        mine = (row // tall == columns["_br"][0]) & (col // wide == columns["_bc"][0])
        if not mine.any():
            return None
        r0, c0 = int(row.min()), int(col.min())
        shape = (int(row.max()) - r0 + 1, int(col.max()) - c0 + 1)
        at = (row - r0, col - c0)
        present = np.zeros(shape, dtype=bool)
        present[at] = True
        core = np.zeros(shape, dtype=bool)
        core[(row[mine] - r0, col[mine] - c0)] = True
        data = {}
        for c in inputs:
            v = columns[c]
            grid = np.zeros(shape, dtype=v.dtype if v.dtype != object else float)
            grid[at] = v
            data[c] = grid
        res = fn(Tile(data, present, r0, c0, core, {k: columns[k][0] for k in keys}))
        n = len(res[names[0]])
        return {**{k: np.repeat(columns[k][:1], n) for k in keys}, **{m: res[m] for m in names}}

    return stream_groups(p, part, ["row_", "col_", *inputs], one, ddl)


def block_map(px: DataFrame, fn: Callable[[Tile], dict[str, np.ndarray]], outputs: str, halo: int, keys: Sequence[str] = ("raster_id",),
              inputs: Sequence[str] | None = None, block: int = BLOCK, emit: str | None = None, mosaic: bool = False) -> DataFrame:
    """Like :func:`block_rows` for functions that return arrays of the tile's shape: one row per own pixel.

    ``emit`` names a boolean output that selects the pixels to return (all by default); ``mosaic`` says that the function
    takes many blocks at once, see :func:`mosaic_rows`.
    """
    names = [o.strip().split()[0] for o in outputs.split(",")]

    def pixels(t: Tile) -> dict[str, np.ndarray]:
        res = fn(t)
        pick = t.core if emit is None else t.core & res[emit]
        y, x = np.nonzero(pick)
        rows, cols = t.place(y, x)
        return {"row_": rows, "col_": cols, "_y": y, **{n: res[n][pick] for n in names}}

    return (mosaic_rows if mosaic else block_rows)(px, pixels, f"row_ int, col_ int, {outputs}", halo, keys, inputs, block)


def pack_blocks(px: DataFrame, inputs: Sequence[str], keys: Sequence[str] = ("raster_id",), block: int = BLOCK) -> DataFrame:
    """One row per block with its pixels as flat arrays: keys, br, bc, row0, col0, h, w, ``present`` and ``inputs`` as binary.

    Passes over the same raster then join and read blocks, and pixels are shuffled once only. See :func:`each_block`.
    """

    def fn(t: Tile) -> dict[str, list]:
        h, w = t.present.shape
        at = {"br": t.row0 // block, "bc": t.col0 // block, "row0": t.row0, "col0": t.col0, "h": h, "w": w}
        return {**{k: np.array([v], np.int32) for k, v in at.items()}, "present": [t.present.tobytes()], **{c: [t[c].tobytes()] for c in inputs}}

    ddl = "br int, bc int, row0 int, col0 int, h int, w int, present binary" + "".join(f", {c} binary" for c in inputs)
    return block_rows(px, fn, ddl, 0, keys, list(inputs), block)


#: Arrays of the Spark types that a packed column may have.
DTYPES = {"int": np.int32, "bigint": np.int64, "double": np.float64, "float": np.float32, "boolean": np.bool_, "smallint": np.int16, "tinyint": np.int8}


def each_block(blocks: DataFrame, kinds: dict[str, str], fn: Callable[[Tile, dict], dict[str, np.ndarray]], outputs: str, keys: Sequence[str] = ("raster_id",)) -> DataFrame:
    """Call ``fn`` with packed blocks of one shape and their other columns; ``kinds`` gives the Spark type of each packed column.

    Arrays of the tile have an axis for blocks before those for rows and columns, ``row0`` and ``col0`` a number for each block, and
    the other columns are Arrow arrays. ``fn`` returns equally long arrays or lists, with the block of each row as ``_b``.
    """
    keys = list(keys)
    types = dict(blocks.dtypes)
    ddl = ", ".join([*(f"{k} {types[k]}" for k in keys), outputs])
    schema = to_arrow_schema(T.StructType.fromDDL(ddl))

    def run(batches):
        for b in batches:
            h, w = (b.column(c).to_numpy() for c in ("h", "w"))
            for tall, wide in sorted(set(zip(h.tolist(), w.tolist()))):
                same = np.flatnonzero((h == tall) & (w == wide))
                step = max(1, MOSAIC // (tall * wide))
                for lo in range(0, len(same), step):
                    rows = b.take(pa.array(same[lo:lo + step]))
                    read = lambda c, kind: np.frombuffer(b"".join(rows.column(c).to_pylist()), kind).reshape(rows.num_rows, tall, wide)
                    present = read("present", np.bool_)
                    tile = Tile({c: read(c, DTYPES[k]) for c, k in kinds.items()}, present, rows.column("row0").to_numpy(), rows.column("col0").to_numpy(), present)
                    made = fn(tile, {c: rows.column(c) for c in rows.schema.names if c not in ("present", *kinds)})
                    of = pa.array(made["_b"])
                    yield pa.RecordBatch.from_arrays([rows.column(f.name).take(of).cast(f.type) if f.name in keys else pa.array(made[f.name], f.type) for f in schema], schema=schema)

    ship(blocks.sparkSession)
    return blocks.mapInArrow(run, ddl)


def dilate(px: DataFrame, mask: str, offsets, out: str = "dilated", keep: Sequence[str] = (), keys=("raster_id",), block: int = BLOCK) -> DataFrame:
    """Pixels within the element of a set pixel; pixels outside the raster neither set nor clear."""
    return _morph(px, mask, out, keep, keys, block, [("max", offsets)])


def erode(px: DataFrame, mask: str, offsets, out: str = "eroded", keep: Sequence[str] = (), keys=("raster_id",), block: int = BLOCK) -> DataFrame:
    return _morph(px, mask, out, keep, keys, block, [("min", offsets)])


def opening(px: DataFrame, mask: str, offsets, out: str = "opened", keep: Sequence[str] = (), keys=("raster_id",), block: int = BLOCK) -> DataFrame:
    return _morph(px, mask, out, keep, keys, block, [("min", offsets), ("max", offsets)])


def closing(px: DataFrame, mask: str, offsets, out: str = "closed", keep: Sequence[str] = (), keys=("raster_id",), block: int = BLOCK) -> DataFrame:
    return _morph(px, mask, out, keep, keys, block, [("max", offsets), ("min", offsets)])


def reach(offsets) -> int:
    """Farthest offset of an element, which may be a function of the keys with a ``reach`` of its own."""
    if callable(offsets):
        return offsets.reach
    return max(max(abs(dy), abs(dx)) for dy, dx in offsets)


def _kinds(px: DataFrame, cols: Sequence[str]) -> str:
    types = dict(px.dtypes)
    return "".join(f", {c} {types[c]}" for c in cols)


def _morph(px, mask, out, keep, keys, block, steps):
    halo = sum(reach(o) for _, o in steps)

    def fn(t: Tile):
        m = (t[mask] > 0).astype(np.uint8)
        for kind, offsets in steps:
            offsets = offsets(t.keys) if callable(offsets) else offsets
            if kind == "max":
                m = A.stencil_max(np.where(t.present, m, 0), offsets, 0)
            else:
                m = A.stencil_min(np.where(t.present, m, 1), offsets, 1)
        return {out: m.astype(np.int32), **{k: t[k] for k in keep}}

    return block_map(px, fn, f"{out} int" + _kinds(px, keep), halo, keys, list(dict.fromkeys([mask, *keep])), block)


def gradient(px: DataFrame, mask: str, out: str = "edge", keys=("raster_id",), block: int = BLOCK) -> DataFrame:
    """3 x 3 maximum differs from the 3 x 3 minimum."""

    def fn(t: Tile):
        m = (t[mask] > 0).astype(np.int32)
        hi = A.stencil_max(np.where(t.present, m, 0), A.square(1), 0)
        lo = A.stencil_min(np.where(t.present, m, 1), A.square(1), 1)
        return {out: (hi > lo).astype(np.int32)}

    return block_map(px, fn, f"{out} int", 1, keys, [mask], block)


def smooth(px: DataFrame, values: Sequence[str], sigma, valid: str | None = None, keys=("raster_id",), block: int = BLOCK) -> DataFrame:
    """Separable Gaussian with clamped coordinates at the raster edge, clipped to [0, 1], 0 where invalid.

    The raster must be dense; sigma <= 0 only clips and masks. ``sigma`` may differ by key.
    """
    values = list(values)
    if not any_set(sigma):
        clipped = lambda v: F.when(F.col(v).isNull() | F.isnan(v), F.lit(float("nan"))).otherwise(F.least(F.lit(1.0), F.greatest(F.lit(0.0), F.col(v).cast("double"))))
        cut = lambda e: e if valid is None else F.when(F.col(valid) == 0, F.lit(0.0)).otherwise(e)
        return px.select(*keys, "row_", "col_", *[cut(clipped(v)).alias(v) for v in values], *([F.col(valid).cast("int").alias(valid)] if valid else []))
    kernel_of = lambda s: A.gaussian_kernel(s) if s > 0 else np.ones(1)
    halo = len(kernel_of(largest(sigma))) // 2

    def fn(t: Tile):
        kernel = kernel_of(at(sigma, t.keys))
        r = len(kernel) // 2
        out = {}
        for v in values:
            a = t[v].astype(np.float64)
            for axis in (0, 1):
                pad = [(r, r) if i == axis else (0, 0) for i in (0, 1)]
                p = np.pad(a, pad, mode="edge")
                n = a.shape[axis]
                a = sum(w * (p[i:i + n] if axis == 0 else p[:, i:i + n]) for i, w in enumerate(kernel))
            a = np.clip(a, 0.0, 1.0)
            out[v] = a if valid is None else np.where(t[valid] == 0, 0.0, a)
        if valid is not None:
            out[valid] = t[valid]
        return out

    ddl = ", ".join(f"{v} double" for v in values) + ("" if valid is None else f", {valid} int")
    return block_map(px, fn, ddl, halo, keys, values + ([valid] if valid else []), block)


def sobel(px: DataFrame, value: str, out: str = "sobel", keys=("raster_id",), block: int = BLOCK) -> DataFrame:
    """sqrt((gx^2 + gy^2) / 2) with the 3 x 3 weights 1-2-1 over 4; edges repeat the border pixel."""

    def fn(t: Tile):
        p = np.pad(t[value].astype(np.float64), 1, mode="edge")
        n = lambda dy, dx: p[1 + dy:p.shape[0] - 1 + dy, 1 + dx:p.shape[1] - 1 + dx]
        gy = sum(w * (n(1, d) - n(-1, d)) for d, w in ((-1, 1), (0, 2), (1, 1))) / 4.0
        gx = sum(w * (n(d, 1) - n(d, -1)) for d, w in ((-1, 1), (0, 2), (1, 1))) / 4.0
        return {out: np.sqrt((gx * gx + gy * gy) / 2.0)}

    return block_map(px, fn, f"{out} double", 1, keys, [value], block)


def near_invalid(px: DataFrame, valid: str, radius: int, out: str = "near", keep: Sequence[str] = (), keys=("raster_id",), block: int = BLOCK) -> DataFrame:
    """1 on valid pixels within ``radius`` 8-neighbour steps of an invalid one."""

    def fn(t: Tile):
        bad = (t.present & (t[valid] == 0)).astype(np.uint8)
        near = A.stencil_max(bad, A.square(radius), 0) if radius > 0 else np.zeros_like(bad)
        return {out: ((t[valid] == 1) & (near > 0)).astype(np.int32), **{k: t[k] for k in keep}}

    types = dict(px.dtypes)
    ddl = f"{out} int" + "".join(f", {k} {types[k]}" for k in keep)
    return block_map(px, fn, ddl, max(0, radius), keys, list(dict.fromkeys([valid, *keep])), block)


def tolerance_marks(px: DataFrame, prob: str, gt: str, thresholds: Sequence[float], radius: int, ignore: int = 2, within: str | None = None,
                    keys=("raster_id",), block: int = BLOCK) -> DataFrame:
    """Per block and threshold: tp, fp, fn of the boundary with a disk tolerance.

    Only block totals leave the task, so all thresholds share one pass over the pixels.
    """
    thresholds = [float(x) for x in thresholds]
    offs = A.disk(radius)

    def fn(t: Tile):
        use = t.present & (t[gt] != ignore)
        if within is not None:
            use &= t[within] == 1
        g = use & (t[gt] == 1)
        near_g = A.stencil_max(g.astype(np.uint8), offs, 0) > 0
        c = t.core
        found = []
        for thr in thresholds:
            p = use & (t[prob] >= thr)
            near_p = A.stencil_max(p.astype(np.uint8), offs, 0) > 0
            found.append([(p & near_g & c).sum(), (p & ~near_g & c).sum(), (g & ~near_p & c).sum()])
        tp, fp, fn_ = np.array(found, dtype=np.int64).T
        return {"ord": np.arange(len(thresholds)), "threshold": np.array(thresholds), "tp": tp, "fp": fp, "fn": fn_}

    cols = list(dict.fromkeys([prob, gt] + ([within] if within else [])))
    b = block_rows(px, fn, "ord int, threshold double, tp bigint, fp bigint, fn bigint", radius, keys, cols, block)
    return b.groupBy(*keys, "ord").agg(F.max("threshold").alias("threshold"), *[F.sum(n).alias(n) for n in ("tp", "fp", "fn")])
