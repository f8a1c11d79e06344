"""Exact top-k by inner product over a pivot-distance index: sorted annuli around pivots, cut off by the triangle inequality."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from acreage.llm.common import stored

SCALE = 256
#: Pivots, and the rows of a fixed sample that they are drawn from.
PIVOTS, SAMPLE = 64, 2048
#: Rows of an annulus piece and of a group of pieces; queries that are compared at a time.
PACK, GROUP, QUERIES = 1024, 16_384, 1024
#: Largest component that is kept in four bytes, and that takes part at all.
SHORT, LARGEST = 2.0**31 - 1, 2.0**63 - 1024
#: Largest squared norm below which floating point is exact, and below which no score can leave a long.
EXACT, LONG = 2.0**53, 2.0**62


def _ints(data: bytes, n: int, width: int) -> np.ndarray:
    """``n`` vectors of four or eight bytes a component."""
    return np.frombuffer(data, "<i4" if len(data) == 4 * n * width else "<i8").reshape(n, width)


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return _ints(b"".join(column.to_pylist()), len(column), width)


def integers(vectors: DataFrame, key: str, vector: str) -> tuple[DataFrame, int, float]:
    """``(id, vec, norm)`` of every vector that takes part, the dimension, and the largest squared norm.

    Components become floor(256 x). Null vectors and those with a null or non-finite component are left out; vectors shorter
    than the longest count as padded with zeros. All vectors have eight bytes a component if one has a component beyond 2^31
    after scaling, else four. A component beyond 2^63 raises an error, as it is no long.
    """
    d = vectors.select(F.col(key).cast("bigint").alias("id"), F.col(vector).cast("array<double>").alias("v"))
    d = d.filter(F.col("v").isNotNull() & F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))))
    width, most = d.agg(F.max(F.size("v")), F.max(F.array_max(F.transform("v", F.abs)))).first()
    width, most = width or 0, SCALE * (most or 0.0) + 1
    if most > LARGEST:
        raise ValueError("a vector component is too large for a long")
    size = 4 if most <= SHORT else 8

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            lists = b.column("v")
            sizes = lists.value_lengths().to_numpy()
            made = np.zeros((len(lists), width))
            made[np.arange(width)[None, :] < sizes[:, None]] = lists.flatten().to_numpy()
            made = np.floor(SCALE * made)
            norm = np.einsum("ij,ij->i", made, made)
            made = made.astype(f"<i{size}")
            yield pa.RecordBatch.from_arrays([b.column("id"), pa.array([r.tobytes() for r in made], pa.binary()), pa.array(norm)], names=["id", "vec", "norm"])

    rows = stored(d.mapInArrow(run, "id bigint, vec binary, norm double"), "vectors")
    return rows, width, rows.agg(F.max("norm")).first()[0] or 0.0


class Space:
    """Vectors lifted by one coordinate so that the nearest lifted vector has the largest inner product.

    A vector v becomes (v, sqrt(m - |v|^2)), with m the largest squared norm, and a query (q, 0); then the inner product is
    (|q|^2 + m - d^2) / 2 for their distance d.
    """

    def __init__(self, sample: np.ndarray, largest: float, pivots: int):
        self.largest = largest
        lifted = self._lift(sample)
        start = np.linspace(0, len(lifted) - 1, min(pivots, len(lifted))).astype(int)
        centres = lifted[start]
        for _ in range(5):
            near = np.argmin(self._squares(lifted, centres), axis=1)
            centres = np.array([lifted[near == i].mean(0) if (near == i).any() else c for i, c in enumerate(centres)])
        self.pivots = centres

    def _lift(self, v: np.ndarray) -> np.ndarray:
        v = v.astype(np.float64)
        return np.column_stack([v, np.sqrt(np.maximum(0, self.largest - (v * v).sum(1)))])

    @staticmethod
    def _squares(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return np.maximum(0, (a * a).sum(1)[:, None] + (b * b).sum(1)[None] - 2 * a @ b.T)

    def of_data(self, v: np.ndarray) -> np.ndarray:
        return np.sqrt(self._squares(self._lift(v), self.pivots))

    def of_queries(self, q: np.ndarray) -> np.ndarray:
        return np.sqrt(self._squares(np.column_stack([q.astype(np.float64), np.zeros(len(q))]), self.pivots))

    def bound(self, norm: np.ndarray, distance: np.ndarray, low, high) -> np.ndarray:
        """Largest score possible in the annulus: the triangle inequality gives the least distance."""
        least = np.maximum(0, np.maximum(distance - high, low - distance) - 1e-6 * np.sqrt(self.largest + 1))
        return (norm + self.largest - least * least) / 2 + 1e-9 * (norm + self.largest) + 1e-6


def scores(q: np.ndarray, v: np.ndarray, largest: float, own: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """Exact inner products, but ``LOW`` for the places ``own`` of rows with themselves: in floating point where every partial sum is below 2^53, else in integers.

    Partial sums of integers may wrap around, as the sum comes back into range if it fits a long. Where that is in doubt it
    is added up without limit, and a score that is no long raises an error.
    """
    if largest < EXACT:
        exact = (q.astype(np.float64) @ v.astype(np.float64).T).astype(np.int64)
    else:
        exact = q.astype(np.int64) @ v.astype(np.int64).T
    exact[own] = LOW
    if largest >= LONG:
        a, b = q.astype(np.float64), v.astype(np.float64)
        size = np.abs(a @ b.T) + a.shape[1] * 2.0**-50 * (np.abs(a) @ np.abs(b).T)
        size[own] = 0
        for i, j in zip(*np.nonzero(size >= 2.0**63)):
            if abs(sum(x * y for x, y in zip(q[i].tolist(), v[j].tolist()))) >= 2**63:
                raise OverflowError("a score is no long")
    return exact


class Best:
    """The k best of each query so far: highest score, then smallest id."""

    def __init__(self, n: int, k: int, floor: np.ndarray):
        self.k, self.floor = k, floor.copy()
        self.query, self.score, self.id = (np.empty(0, np.int64) for _ in range(3))

    def add(self, query: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        q, s, i = np.append(self.query, query), np.append(self.score, score), np.append(self.id, ids)
        order = np.lexsort((i, -s, q))
        q, s, i = q[order], s[order], i[order]
        first = np.searchsorted(q, q, side="left")
        rank = np.arange(len(q)) - first
        keep = rank < self.k
        self.query, self.score, self.id = q[keep], s[keep], i[keep]
        full = rank == self.k - 1
        self.floor[q[full]] = np.maximum(self.floor[q[full]], s[full])


LOW = np.iinfo(np.int64).min


def _packs(space: Space, width: int):
    """Rows in the order of pivot and distance become packs: neighbours of one pivot, at most ``PACK`` of them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Table] = []

        def cut(t: pa.Table, whole: bool) -> Iterator[tuple[pa.Table | None, pa.RecordBatch | None]]:
            pivot = t["pivot"].to_numpy()
            at = 0
            while at < len(pivot):
                stop = min(at + PACK, int(np.searchsorted(pivot, pivot[at], side="right")))
                if stop == len(pivot) and not whole and stop - at < PACK:
                    break
                p = t.slice(at, stop - at)
                d = p["distance"].to_numpy()
                row = [[int(pivot[at])], [float(d.min())], [float(d.max())], [stop - at], [p["id"].to_numpy().astype("<i8").tobytes()], [b"".join(p["vec"].to_pylist())]]
                kinds = (pa.int32(), pa.float64(), pa.float64(), pa.int64(), pa.binary(), pa.binary())
                yield None, pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(row, kinds)], names=["pivot", "low", "high", "n", "ids", "vecs"])
                at = stop
            yield t.slice(at), None

        for b in batches:
            t = pa.concat_tables([*held, pa.Table.from_batches([b])]).combine_chunks()
            for rest, pack in cut(t, False):
                if pack is not None:
                    yield pack
                else:
                    held = [rest]
        if held and held[0].num_rows:
            for _, pack in cut(held[0].combine_chunks(), True):
                if pack is not None:
                    yield pack

    return run


def build_index(rows: DataFrame, space: Space, width: int) -> DataFrame:
    """Packs (pack, grp, pivot, low, high, n, ids, vecs), stored. Rows are ranged by (pivot, distance, hash of the id), so a
    vector that a third of the rows share is split like any other."""

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            d = space.of_data(_matrix(b.column("vec"), width))
            near = d.argmin(1)
            yield pa.RecordBatch.from_arrays([b.column("id"), b.column("vec"), pa.array(near.astype(np.int32)), pa.array(d[np.arange(len(near)), near])], names=["id", "vec", "pivot", "distance"])

    placed = rows.mapInArrow(assign, "id bigint, vec binary, pivot int, distance double").withColumn("h", F.xxhash64("id"))
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = placed.repartitionByRange(n, "pivot", "distance", "h").sortWithinPartitions("pivot", "distance", "h")
    packs = ranged.mapInArrow(_packs(space, width), "pivot int, low double, high double, n bigint, ids binary, vecs binary")
    return stored(packs.withColumn("pack", F.monotonically_increasing_id()), "packs")


def _own_queries(space: Space, width: int, every: int, k: int):
    """The queries among a pack's rows: where they stand, and the k-th score inside their own pack as a first floor."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for row in b.to_pylist():
                ids = np.frombuffer(row["ids"], "<i8")
                at = np.flatnonzero(ids % every == 0)
                if not len(at):
                    continue
                v = _ints(row["vecs"], len(ids), width)
                s = scores(v[at], v, space.largest, (np.arange(len(at)), at))
                floor = np.sort(s, axis=1)[:, -k] if len(ids) > k else np.full(len(at), LOW)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(at), row["pack"])), pa.array(at), pa.array(ids[at]), pa.array([v[i].tobytes() for i in at], pa.binary()), pa.array(floor)],
                    names=["q_pack", "q_pos", "q_id", "q_vec", "floor"],
                )

    return run


def _routes(space: Space, width: int, directory: np.ndarray):
    """Each query goes to the groups of packs whose annuli may hold a score above its floor."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            q = _matrix(b.column("q_vec"), width)
            norm, distance = (q.astype(np.float64) ** 2).sum(1), space.of_queries(q)
            floor = b.column("floor").to_numpy()
            may = np.zeros((len(q), int(directory["grp"].max()) + 1), bool)
            for g, p, low, high in directory.tolist():
                may[:, g] |= space.bound(norm, distance[:, p], low, high) >= floor
            row, group = np.nonzero(may)
            part = b.take(pa.array(row))
            yield pa.RecordBatch.from_arrays([pa.array(group.astype(np.int64)), *part.columns], names=["grp", *b.schema.names])

    return run


def _search(space: Space, width: int, k: int):
    """One group of packs against a block of its queries: packs in the order of their bound, until no bound reaches a floor."""

    def run(key, left: pa.Table, right: pa.Table) -> pa.Table:
        names = pa.schema([("q_pack", pa.int64()), ("q_pos", pa.int64()), ("q_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64())])
        if not left.num_rows or not right.num_rows:
            return pa.Table.from_pylist([], names)
        left, right = left.combine_chunks(), right.combine_chunks()
        q = _matrix(right["q_vec"].chunk(0), width)
        norm, distance = (q.astype(np.float64) ** 2).sum(1), space.of_queries(q)
        q_pack, q_pos = right["q_pack"].to_numpy(), right["q_pos"].to_numpy()
        best = Best(len(q), k, right["floor"].to_numpy())
        packs = left.to_pylist()
        bounds = np.column_stack([space.bound(norm, distance[:, p["pivot"]], p["low"], p["high"]) for p in packs])
        for j in np.argsort(-bounds.max(0), kind="stable"):
            live = np.flatnonzero(bounds[:, j] >= best.floor)
            if not len(live):
                continue
            p = packs[j]
            ids = np.frombuffer(p["ids"], "<i8")
            own = np.flatnonzero(q_pack[live] == p["pack"])
            own = own, q_pos[live[own]]
            s = scores(q[live], _ints(p["vecs"], len(ids), width), space.largest, own)
            hit = s >= best.floor[live][:, None]
            hit[own] = False
            row, col = np.nonzero(hit)
            if len(row):
                best.add(live[row], s[row, col], ids[col])
        return pa.table([q_pack[best.query], q_pos[best.query], right["q_id"].to_numpy()[best.query], best.id, best.score], schema=names)

    return run


def top_k(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", every: int = 50, k: int = 5, pivots: int = PIVOTS) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: for each row whose key ``every`` divides, the k rows of highest inner product but itself.

    Ties go to the smaller key. Rows with a null key take no part. Scores are exact; one of two rows that is met and is no long
    raises an error. With fewer rows than k all are returned, and an empty
    table gives no rows. Pivots come from a fixed sample of ``SAMPLE`` rows; every row is indexed, and results are exact for
    any pivots. The driver holds the sample and one directory line for each ``GROUP`` rows and pivot. A group never has more
    than ``GROUP`` rows or meets more than ``QUERIES`` queries in one task.
    """
    rows, width, largest = integers(vectors.filter(F.col(key).isNotNull()), key, vector)
    spark = vectors.sparkSession
    sample = rows.orderBy(F.xxhash64("id"), "id").limit(SAMPLE).select("vec").collect()
    schema = "query_id bigint, rank int, vec_id bigint, score bigint"
    if not sample or not width:
        return spark.createDataFrame([], schema)
    space = Space(_ints(b"".join(bytes(r[0]) for r in sample), len(sample), width), largest, pivots)
    packs = build_index(rows, space, width)
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    # Packs are numbered by part in the order of the index; parts are few, so only their sizes meet in one task.
    parted = packs.withColumn("part", F.shiftright("pack", 33))
    sizes = parted.groupBy("part").agg(F.sum("n").alias("size")).withColumn("start", F.coalesce(F.sum("size").over(before), F.lit(0))).drop("size")
    inside = Window.partitionBy("part").orderBy("pack").rowsBetween(Window.unboundedPreceding, -1)
    meta = parted.select("pack", "part", "n", "pivot", "low", "high").withColumn("at", F.coalesce(F.sum("n").over(inside), F.lit(0))).join(sizes, "part")
    meta = stored(meta.select("pack", "pivot", "low", "high", F.floor((F.col("start") + F.col("at")) / GROUP).cast("bigint").alias("grp")), "directory")
    lines = meta.groupBy("grp", "pivot").agg(F.min("low").alias("low"), F.max("high").alias("high")).collect()
    directory = np.array([(r["grp"], r["pivot"], r["low"], r["high"]) for r in lines], [("grp", "i8"), ("pivot", "i4"), ("low", "f8"), ("high", "f8")])
    queries = packs.mapInArrow(_own_queries(space, width, every, k), "q_pack bigint, q_pos bigint, q_id bigint, q_vec binary, floor bigint")
    routed = queries.mapInArrow(_routes(space, width, directory), "grp bigint, q_pack bigint, q_pos bigint, q_id bigint, q_vec binary, floor bigint")
    routed = stored(routed, "routes")
    blocks = routed.groupBy("grp").agg(F.ceil(F.count("*") / QUERIES).cast("int").alias("blocks"))
    data = packs.join(meta.select("pack", "grp"), "pack").join(blocks, "grp").withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).drop("blocks")
    asked = routed.join(blocks, "grp").withColumn("block", F.pmod(F.xxhash64("q_pack", "q_pos"), F.col("blocks")).cast("int")).drop("blocks")
    found = data.groupBy("grp", "block").cogroup(asked.groupBy("grp", "block"))
    found = found.applyInArrow(_search(space, width, k), "q_pack bigint, q_pos bigint, q_id bigint, vec_id bigint, score bigint")
    order = Window.partitionBy("q_pack", "q_pos").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select(F.col("q_id").alias("query_id"), F.col("rank").cast("int").alias("rank"), "vec_id", "score")
