"""SimHash near-duplicates: fingerprints, and links found by bit-sliced comparison of blocks."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from acreage.llm.common import slices, stored, whole_text
from acreage.llm.graph import components

SEED = 42
#: Bytes of text that a task holds as words at a time.
TEXT_BYTES = 4 << 20
#: Rows of a bucket that are compared in one piece; larger buckets are cut into pieces and each pair of pieces compared.
PIECE = 4096
#: Small buckets are joined up to so many rows before they are compared.
BLOCK = 256
#: Rows of one block that are compared with the others at a time.
QUERIES = 256


def shingle_hashes(words: list[bytes], shingle: int) -> np.ndarray:
    """XXH64 of every run of ``shingle`` words, repeats included; fewer words make one run, none make none."""
    if not words:
        return np.empty(0, np.uint64)
    text, digest = b" ".join(words), xxhash.xxh64_intdigest
    if len(words) <= shingle:
        return np.array([digest(text, SEED)], np.uint64)
    stop = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    start = np.concatenate([[0], stop[:-shingle] + 1])
    return np.array([digest(text[i:j], SEED) for i, j in zip(start.tolist(), stop[shingle - 1 :].tolist())], np.uint64)


def fold(hashes: np.ndarray) -> np.ndarray:
    """64 bits, most significant first: set where over half the hashes have the bit; all clear without hashes."""
    ones = np.zeros(64, np.int64)
    for i in range(0, len(hashes), 1 << 16):
        ones += np.unpackbits(hashes[i : i + (1 << 16)].astype(">u8").view(np.uint8)).reshape(-1, 64).sum(0, dtype=np.int64)
    return 2 * ones > len(hashes)


def _words(text: bytes | None) -> list[bytes]:
    # Bytes methods know ASCII only: lower() maps A-Z, split() cuts at x20 and x09-x0D.
    return (text or b"").lower().split()


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = 4) -> DataFrame:
    """``(key, fingerprint long)`` for every row. Null and blank texts have fingerprint zero; repeated rows stay."""
    kind = docs.schema[key].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i, j in slices(b, "t", TEXT_BYTES):
                part = b.slice(i, j - i)
                bits = [fold(shingle_hashes(_words(t), shingle)) for t in part.column("t").to_pylist()]
                made = np.packbits(np.array(bits), axis=1).view(">u8").astype(np.uint64).view(np.int64).ravel()
                yield pa.RecordBatch.from_arrays([part.column("k"), pa.array(made)], names=["k", "fingerprint"])

    own = docs.select(F.col(key).alias("k"), whole_text(text).cast("binary").alias("t"))
    return own.mapInArrow(run, f"k {kind.simpleString()}, fingerprint bigint").withColumnRenamed("k", key)


# --- bit-sliced comparison -------------------------------------------------------------------------------------------


def planes(bits: np.ndarray) -> np.ndarray:
    """Rows of bits, stored vertically: plane b holds bit b of 64 rows a word."""
    n, width = bits.shape
    tall = np.zeros((-(-n // 64) * 64, width), np.uint8)
    tall[:n] = bits
    return np.packbits(np.ascontiguousarray(tall.T), axis=1, bitorder="little").view(np.uint64)


def within(queries: np.ndarray, sliced: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows of ``sliced`` at most ``radius`` bits away from each query: (query numbers, their hit masks).

    Vertical counters of 64 distances a word start so that they run over at ``radius`` + 1; a plane is added by carry-save
    steps. Every few planes, queries whose whole block has run over are abandoned.
    """
    digits = max(1, radius.bit_length())
    first = (1 << digits) - 1 - radius
    full = np.uint64(0xFFFFFFFFFFFFFFFF)
    who = np.arange(len(queries))
    shape = (len(queries), sliced.shape[1])
    count = [np.full(shape, full if first >> d & 1 else np.uint64(0)) for d in range(digits)]
    over = np.zeros(shape, np.uint64)
    flip = np.where(queries, full, np.uint64(0))
    for b in range(sliced.shape[0]):
        carry = sliced[b][None, :] ^ flip[:, b][:, None]
        for d in range(digits):
            up = count[d] & carry
            count[d] ^= carry
            carry = up
        over |= carry
        if b % 8 == 7 and b > radius:
            live = ~(over == full).all(axis=1)
            if not live.all():
                who, over, flip, count = who[live], over[live], flip[live], [c[live] for c in count]
                if not len(who):
                    break
    return who, ~over


class Links:
    """Groups of a block's rows; rows are merged as hits come in, so that hits need not be kept."""

    def __init__(self, n: int):
        self.label = np.arange(n)

    def add(self, row: int, hits: np.ndarray) -> None:
        found = np.unique(np.append(self.label[hits], self.label[row]))
        if len(found) > 1:
            self.label[np.isin(self.label, found)] = found[0]

    def stars(self) -> tuple[np.ndarray, np.ndarray]:
        out = np.flatnonzero(self.label != np.arange(len(self.label)))
        return out, self.label[out]


def link_block(bits: np.ndarray, radius: int, split: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """Links that connect a block just as all its pairs within ``radius`` do: (row, row), fewer than rows.

    With ``split``, only rows before it are compared with rows from it on.
    """
    n = len(bits)
    groups = Links(n)
    base = split
    sliced = planes(bits[base:])
    for q in range(0, split or n, QUERIES):
        last = min(split or n, q + QUERIES)
        who, hit = within(bits[q:last], sliced, radius)
        if len(who):
            rows = np.unpackbits(hit.view(np.uint8), axis=1, bitorder="little")[:, : n - base]
            for w in np.flatnonzero(rows.sum(1, dtype=np.int64) > (0 if split else 1)):
                groups.add(q + who[w], np.flatnonzero(rows[w]) + base)
    return groups.stars()


def _links(radius: int):
    """Rows (bucket, piece, other, side, node, bits), sorted by bucket and pieces, become links (a, b) between nodes."""

    def flush(held: list[tuple[np.ndarray, np.ndarray, int]]) -> pa.RecordBatch:
        node, bits, split = (np.concatenate([h[0] for h in held]), np.concatenate([h[1] for h in held]), held[0][2])
        a, b = link_block(np.unpackbits(bits, axis=1), radius, split)
        return pa.RecordBatch.from_arrays([pa.array(node[a]), pa.array(node[b])], names=["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray, int]] = []
        rest: pa.Table | None = None

        def group(t: pa.Table) -> tuple[np.ndarray, np.ndarray, int]:
            node = t["node"].to_numpy()
            bits = np.frombuffer(b"".join(t["bits"].to_pylist()), np.uint8).reshape(len(node), -1)
            cut = t["piece"][0].as_py() != t["other"][0].as_py()
            return node, bits, int(np.sum(t["side"].to_numpy() == 0)) if cut else 0

        def take(t: pa.Table) -> Iterator[pa.RecordBatch]:
            one = group(t)
            if one[2]:
                yield flush([one])
            elif len(one[0]) > 1:
                held.append(one)
                if sum(len(h[0]) for h in held) >= BLOCK:
                    yield flush(held)
                    held.clear()

        for b in batches:
            t = pa.Table.from_batches([b])
            t = t if rest is None else pa.concat_tables([rest, t]).combine_chunks()
            key = np.column_stack([t[c].to_numpy() for c in ("bucket", "piece", "other")])
            cuts = (np.flatnonzero((key[1:] != key[:-1]).any(axis=1)) + 1).tolist() if len(key) else []
            for i, j in zip([0, *cuts[:-1]], cuts):
                yield from take(t.slice(i, j - i))
            rest = t.slice(cuts[-1]) if cuts else t
        if rest is not None and rest.num_rows:
            yield from take(rest)
        if held:
            yield flush(held)

    return run


def linked(rows: DataFrame, radius: int, piece: int = PIECE) -> DataFrame:
    """Links ``(a, b)`` between nodes that share a bucket and differ in at most ``radius`` bits.

    ``rows``: bucket long, node long, bits binary. The links connect what all such pairs would connect, but are fewer than
    the rows. A bucket of more than ``piece`` rows is cut by a hash of the node, and every pair of its pieces is compared by
    a task of its own, so that no bucket has to fit in one task.
    """
    size = rows.groupBy("bucket").agg(F.count("*").alias("_n")).filter(F.col("_n") > piece)
    cut = rows.join(size, "bucket", "left").withColumn("_k", F.coalesce(F.ceil(F.col("_n") / piece), F.lit(1)).cast("int"))
    cut = cut.withColumn("_g", F.pmod(F.xxhash64("node", F.lit(1)), F.col("_k")).cast("int"))
    cut = cut.withColumn("_o", F.explode(F.sequence(F.lit(0), F.col("_k") - 1)))
    cut = cut.select(
        "bucket",
        F.least("_g", "_o").alias("piece"),
        F.greatest("_g", "_o").alias("other"),
        F.when(F.col("_g") <= F.col("_o"), 0).otherwise(1).alias("side"),
        "node",
        "bits",
    )
    dealt = cut.repartition("bucket", "piece", "other").sortWithinPartitions("bucket", "piece", "other", "side")
    return dealt.mapInArrow(_links(radius), "a bigint, b bigint")


# --- fingerprints of 64 bits, all links within a radius --------------------------------------------------------------


def tables(n: int, radius: int) -> list[int]:
    """Bit masks such that two values within ``radius`` agree on all bits of one mask at least.

    The 64 bits are cut into radius + s blocks, of which s stay equal; every s blocks make a mask. s grows with the number
    of values, so that chance alone puts a few thousand values in a bucket at most. Results are the same for any s.
    """
    s = 1
    while s < 4 and n >> (64 * s // (radius + s)) > 2048:
        s += 1
    edges = [64 * i // (radius + s) for i in range(radius + s + 1)]
    blocks = [((1 << j) - 1) ^ ((1 << i) - 1) for i, j in zip(edges, edges[1:])]
    return [sum(c) for c in combinations(blocks, s)]


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def duplicates(prints: DataFrame, key: str = "doc_id", radius: int = 4) -> DataFrame:
    """``prints`` (key, fingerprint) with ``component_id``, the smallest key reachable over links of at most ``radius`` bits.

    Equal fingerprints are one node, so copies cost one row. Rows with a null key take part, but give no component its name
    (a component of such rows only has a null one).
    """
    nodes = stored(prints.groupBy("fingerprint").agg(F.min(key).alias("_least")), "nodes")
    masks = F.array(*[F.lit(_signed(m)).cast("bigint") for m in tables(nodes.count(), radius)])
    packed = F.unhex(F.lpad(F.hex("fingerprint"), 16, "0"))
    rows = nodes.select(F.col("fingerprint").alias("node"), packed.alias("bits"), F.posexplode(masks).alias("_t", "_m"))
    rows = rows.select(F.xxhash64("_t", F.col("node").bitwiseAND(F.col("_m"))).alias("bucket"), "node", "bits")
    roots = components(linked(rows, radius))
    named = nodes.join(roots, nodes["fingerprint"] == roots["node"], "left")
    named = named.select("fingerprint", "_least", F.coalesce("root", "fingerprint").alias("_root"))
    least = named.groupBy("_root").agg(F.min("_least").alias("component_id"))
    named = stored(named.join(least, "_root").select("fingerprint", "component_id"), "classes")
    return prints.join(named, "fingerprint").select(*prints.columns, "component_id")


def hexadecimal(fingerprint: str = "fingerprint") -> Column:
    return F.lpad(F.lower(F.hex(fingerprint)), 16, "0")


# --- near copies by similarity of shingles ---------------------------------------------------------------------------

#: Bits of a sketch, and min-hashes: bands of a few, so that similar texts share a bucket.
SKETCH, BANDS, BAND = 256, 16, 3
_TURNS = (np.arange(1, SKETCH + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)
#: Candidates of small groups meet in lots of about so many bytes of shingle hashes; larger groups are cut into such pieces,
#: of no more than ``PIECE`` rows, and each pair of pieces compared.
LOT_BYTES = 8 << 20


def radius_of(similarity: float, bits: int = SKETCH) -> int:
    """Bits in which sketches of two texts of that similarity differ, and five standard deviations: a bit is that of another
    min-hash with probability 1 - similarity, and then differs half the time, however short the texts are.
    """
    p = (1 - similarity) / 2
    return int(bits * p + 5 * np.sqrt(bits * p * (1 - p)))


def shingle_set(text: bytes | None, shingle: int) -> np.ndarray:
    """The distinct shingle hashes of a text, sorted."""
    return np.unique(shingle_hashes(_words(text), shingle))


def min_hashes(hashes: np.ndarray) -> np.ndarray:
    least = np.full(len(_TURNS), np.iinfo(np.uint64).max)
    with np.errstate(over="ignore"):
        for i in range(0, len(hashes), 1024):
            least = np.minimum(least, (hashes[None, i : i + 1024] * _TURNS[:, None]).min(axis=1))
    return least


def bands(least: np.ndarray) -> list[int]:
    """One value per band of min-hashes; texts of similarity s share a band with probability s cubed."""
    return [xxhash.xxh64_intdigest(b.tobytes(), i) - (1 << 63) for i, b in enumerate(least[: BANDS * BAND].reshape(BANDS, BAND))]


def sketch(least: np.ndarray) -> bytes:
    """One bit of each min-hash."""
    with np.errstate(over="ignore"):
        return np.packbits((((least ^ (least >> np.uint64(32))) * np.uint64(0xBF58476D1CE4E5B9)) >> np.uint64(63)).astype(np.uint8)).tobytes()


#: The name of a row: 128 bits of its key and text.
ROW = "struct<a:bigint,b:bigint>"


def _profiles(docs: DataFrame, row: Column, key: str, text: str, shingle: int) -> DataFrame:
    """Per row: its name, key, node (hash of the words, so that copies are one node), number of shingles, sketch and bands."""
    kind = docs.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i, j in slices(b, "t", TEXT_BYTES):
                part, made = b.slice(i, j - i), []
                for t in part.column("t").to_pylist():
                    h = shingle_set(t, shingle)
                    least = min_hashes(h)
                    made.append((xxhash.xxh64_intdigest(b" ".join(_words(t))) - (1 << 63), len(h), sketch(least), bands(least)))
                columns = [pa.array(c, t) for c, t in zip(zip(*made), (pa.int64(), pa.int64(), pa.binary(), pa.list_(pa.int64())))]
                yield pa.RecordBatch.from_arrays([part.column("row"), part.column("k"), *columns], names=["row", "k", "node", "n", "bits", "bands"])

    own = docs.select(row.alias("row"), F.col(key).alias("k"), whole_text(text).cast("binary").alias("t"))
    return own.mapInArrow(run, f"row {ROW}, k {kind}, node bigint, n bigint, bits binary, bands array<bigint>")


def alike(a: np.ndarray, b: np.ndarray, similarity: float) -> bool:
    """Whether the Jaccard similarity of two sorted sets is ``similarity`` or more."""
    if len(a) > len(b):
        a, b = b, a
    if len(a) < similarity * len(b) * (1 - 1e-9):
        return False
    if not len(b):
        return True
    common = int(np.count_nonzero(b[np.minimum(np.searchsorted(b, a), len(b) - 1)] == a))
    return common / (len(a) + len(b) - common) >= similarity


def exact_links(bits: np.ndarray, sets: list[np.ndarray], similarity: float, split: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """Links that connect rows just as all their pairs of ``similarity`` within reach of the sketches do, see :func:`link_block`.

    Sets are only compared of rows that are not connected yet, so a group of m near copies takes about m comparisons.
    """
    n, groups, sliced = len(bits), Links(len(bits)), planes(bits[split:])
    for q in range(0, split or n, QUERIES):
        last = min(split or n, q + QUERIES)
        who, hit = within(bits[q:last], sliced, radius_of(similarity, bits.shape[1]))
        if not len(who):
            continue
        rows = np.unpackbits(hit.view(np.uint8), axis=1, bitorder="little")[:, : n - split]
        for w in np.flatnonzero(rows.sum(1, dtype=np.int64) > (0 if split else 1)):
            i = q + who[w]
            near = np.flatnonzero(rows[w]) + split
            for j in near[(near > i) & (groups.label[near] != groups.label[i])]:
                if groups.label[j] != groups.label[i] and alike(sets[i], sets[j], similarity):
                    groups.add(i, np.array([j]))
    return groups.stars()


def _exact(similarity: float):
    """Rows (side, node, bits, hashes) of a lot, or of a pair of pieces, become links (a, b) between nodes."""

    def run(key: tuple[pa.Scalar, ...], t: pa.Table) -> pa.Table:
        t = t.sort_by("side")
        node = t["node"].to_numpy()
        bits = np.unpackbits(np.frombuffer(b"".join(t["bits"].to_pylist()), np.uint8).reshape(len(node), -1), axis=1)
        sets = [np.frombuffer(h, "<u8") for h in t["hashes"].to_pylist()]
        split = int(np.sum(t["side"].to_numpy() == 0)) if key[2].as_py() != key[3].as_py() else 0
        a, b = exact_links(bits, sets, similarity, split) if split < len(node) else ([], [])
        return pa.table([pa.array(node[a] if len(a) else [], pa.int64()), pa.array(node[b] if len(b) else [], pa.int64())], names=["a", "b"])

    return run


def confirmed(texts: DataFrame, members: DataFrame, shingle: int, similarity: float) -> DataFrame:
    """Links ``(a, b)`` between nodes of the same root whose sets of shingles are of ``similarity`` or more.

    ``texts`` has names (``_row``) and bytes (``t``), repeated rows too, of which one is compared; ``members``: row, node, root, n (shingles) and bits of each candidate. The links connect
    what all such pairs would connect, but are fewer than the rows. Small groups meet in lots; a large one is cut by a
    hash of the node and every pair of its pieces is a task of its own, so that no group has to fit in one task.
    """
    size = members.groupBy("root").agg(F.count("*").alias("_rows"), (8 * F.sum("n")).alias("_bytes"))
    cut = F.ceil(F.greatest(F.col("_rows") / PIECE, F.col("_bytes") / LOT_BYTES))
    size = stored(size.select("root", "_bytes", cut.cast("int").alias("_k")), "sizes")
    lots = 1 + int(size.filter("_k <= 1").agg(F.coalesce(F.sum("_bytes"), F.lit(0))).first()[0]) // LOT_BYTES
    lots = max(lots, int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    placed = members.join(size, "root").withColumn("_k", F.greatest("_k", F.lit(1)))
    placed = placed.withColumn("_big", F.col("_k") > 1)
    placed = placed.withColumn("lot", F.when(F.col("_big"), F.col("root")).otherwise(F.pmod(F.xxhash64("root"), F.lit(lots))))
    placed = placed.withColumn("_g", F.pmod(F.xxhash64("node", F.lit(1)), F.col("_k")).cast("int"))
    placed = placed.select(F.col("row").alias("_row"), "node", "bits", "_big", "lot", "_g", "_k")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i, j in slices(b, "t", TEXT_BYTES):
                part = b.slice(i, j - i)
                made = [shingle_set(t, shingle).astype("<u8").tobytes() for t in part.column("t").to_pylist()]
                yield pa.RecordBatch.from_arrays([*[part.column(c) for c in names], pa.array(made, pa.binary())], names=[*names, "hashes"])

    names = ["node", "bits", "_big", "lot", "_g", "_k"]
    texts = texts.join(placed, "_row").dropDuplicates(["_row"])
    sets = texts.select(*names, "t").mapInArrow(run, "node bigint, bits binary, _big boolean, lot bigint, _g int, _k int, hashes binary")
    sets = sets.withColumn("_o", F.explode(F.sequence(F.lit(0), F.col("_k") - 1)))
    sets = sets.select(
        "_big",
        "lot",
        F.least("_g", "_o").alias("piece"),
        F.greatest("_g", "_o").alias("other"),
        F.when(F.col("_g") <= F.col("_o"), 0).otherwise(1).alias("side"),
        "node",
        "bits",
        "hashes",
    )
    return sets.groupBy("_big", "lot", "piece", "other").applyInArrow(_exact(similarity), "a bigint, b bigint")


def without_near_copies(docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = 5, similarity: float = 0.8) -> DataFrame:
    """``docs`` with one row of each group of near copies: the one of smallest key, null keys last; repeated rows are copies.

    Texts are linked if the Jaccard similarity of their sets of runs of ``shingle`` words is ``similarity`` or more; groups are
    what links connect. Candidates share a band of min-hashes and have sketches within :func:`radius_of`; what candidates
    connect is then compared by the sets themselves. Texts without words are copies of each other. Names, sketches and
    bands are shuffled to find the candidates; texts move once to be compared, and once to meet the names of those that stay.
    """
    name = F.col(key), whole_text(text)
    row = F.struct(F.xxhash64(*name).alias("a"), F.xxhash64(F.lit(1), *name).alias("b"))
    made = stored(_profiles(docs, row, key, text, shingle), "profiles")
    nodes = made.groupBy("node").agg(F.min("row").alias("row"), F.first("n").alias("n"), F.first("bits").alias("bits"), F.first("bands").alias("bands"))
    nodes = stored(nodes, "nodes")
    spread = nodes.select("node", "bits", F.posexplode("bands").alias("_i", "_b"))
    spread = spread.select(F.xxhash64("_i", "_b").alias("bucket"), "node", "bits")
    members = nodes.drop("bands").join(components(linked(spread, radius_of(similarity))), "node")
    links = confirmed(docs.select(row.alias("_row"), name[1].cast("binary").alias("t")), stored(members, "members"), shingle, similarity)
    roots = components(stored(links, "links"))
    least = made.groupBy("node").agg(F.min(F.struct(F.col("k").isNull().alias("none"), "k", "row")).alias("least"))
    stays = least.join(roots, "node", "left").groupBy(F.coalesce("root", "node")).agg(F.min("least").alias("least"))
    stays = stored(stays.select(F.col("least.row").alias("_row")), "survivors")
    # Input columns travel in a struct, so that none can clash with the names used here.
    return docs.select(F.struct("*").alias("all"), row.alias("_row")).join(stays, "_row", "left_semi").dropDuplicates(["_row"]).select("all.*")
