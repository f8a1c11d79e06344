"""Token ids as flat unsigned integer files with 64-bit document offsets, in the order of the documents' keys.

A folder holds for each shard
  tokens-<name>   ids of its documents end to end, little-endian, 2 bytes each if the vocabulary allows it, else 4
  offsets-<name>  where each document starts, and where the last one ends: unsigned 64-bit, counted over all shards
  keys-<name>     signed 64-bit keys of the documents; those of the first ``n_null`` have no key
and ``index.json``, a list of the shards in order. Shards are cut by a range partitioning, so a shard knows only its own
lengths when it is written; where it begins comes from the prefix sums of the shards before it.
"""

from __future__ import annotations

import bisect
import json
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F

from acreage.llm.common import crc32, slices, stored, whole_text
from acreage.session import running_total, scratch_path

#: Text bytes of a shard (about), of a piece that is encoded at a time, and documents of a batch that is read.
SHARD_BYTES, TEXT_BYTES, DOCUMENTS = 128 << 20, 8 << 20, 4096
SHARDS = "part int, name string, n_docs bigint, n_null bigint, n_tokens bigint"


def _create(folder: str, name: str):
    system, path = fs.FileSystem.from_uri(f"{folder}/{name}")
    system.create_dir(path.rpartition("/")[0], recursive=True)
    return system.open_output_stream(path, compression=None)


class Flat:
    """A flat file of numbers: mapped into memory where it lies in a file system, else read by ranges."""

    def __init__(self, path: str, kind: str):
        self.kind = np.dtype(kind)
        system, place = fs.FileSystem.from_uri(path)
        self.size = system.get_file_info(place).size // self.kind.itemsize
        if isinstance(system, fs.LocalFileSystem):
            self.map, self.file = np.memmap(place, self.kind, "r") if self.size else np.zeros(0, self.kind), None
        else:
            self.map, self.file = None, system.open_input_file(place)

    def read(self, start: int, end: int) -> np.ndarray:
        if self.map is not None:
            return self.map[start:end]
        self.file.seek(start * self.kind.itemsize)
        return np.frombuffer(self.file.read((end - start) * self.kind.itemsize), self.kind)


def write_shards(docs: DataFrame, folder: str, ids_of: Callable, kind: str, key: str = "doc_id", text: str = "text", end: int | None = 0, shards: int | None = None) -> DataFrame:
    """Encode and write: one row of ``SHARDS`` for each shard; offsets are those inside the shard as yet.

    Texts move once, to the shard of their key; a key that many rows share is split by the rows' numbers. A file has a name
    of its own for each attempt of its task, and only names that a finished task gave back are ever read.
    """
    rows = docs.select(F.col(key).cast("bigint").alias("k"), whole_text(text).alias("t")).withColumn("row", F.monotonically_increasing_id())
    if shards is None:
        held = rows.agg(F.sum(F.octet_length("t"))).first()[0] or 0
        shards = max(docs.sparkSession.sparkContext.defaultParallelism, -(-held // SHARD_BYTES))
    order = [F.asc_nulls_first("k"), F.asc("row")]
    last = np.array([] if end is None else [end], kind)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, name, files = ids_of(), uuid.uuid4().hex, {}
        n_docs = n_null = n_tokens = 0
        for b in batches:
            if b.num_rows and not files:
                files = {f: _create(folder, f"{f}-{name}") for f in ("tokens", "local", "keys")}
            n_null += b.column("k").null_count
            for i, j in slices(b, "t", TEXT_BYTES):
                part = b.slice(i, j - i)
                sizes = []
                for t in part.column("t").to_pylist():
                    ids = np.concatenate([encode(t).astype(kind), last])
                    files["tokens"].write(ids.tobytes())
                    sizes.append(len(ids))
                files["local"].write((n_tokens + np.cumsum(sizes)).astype("<u8").tobytes())
                files["keys"].write(part.column("k").fill_null(0).to_numpy().astype("<i8").tobytes())
                n_docs, n_tokens = n_docs + len(sizes), n_tokens + sum(sizes)
        for f in files.values():
            f.close()
        if files:
            yield pa.RecordBatch.from_pylist([{"part": TaskContext.get().partitionId(), "name": name, "n_docs": n_docs, "n_null": n_null, "n_tokens": n_tokens}],
                                             pa.schema([("part", pa.int32()), ("name", pa.string()), ("n_docs", pa.int64()), ("n_null", pa.int64()), ("n_tokens", pa.int64())]))

    ranged = rows.repartitionByRange(shards, *order).sortWithinPartitions(*order).select("k", "t")
    return stored(ranged.mapInArrow(run, SHARDS), "shards")


def place_shards(shards: DataFrame, folder: str) -> DataFrame:
    """Shards with ``first_doc`` and ``first_token``, by prefix sums over the shards, and their offset files made from these."""
    placed = running_total(running_total(shards, ["part"], "n_tokens", "to_token"), ["part"], "n_docs", "to_doc")
    placed = placed.withColumn("first_token", F.col("to_token") - F.col("n_tokens")).withColumn("first_doc", F.col("to_doc") - F.col("n_docs")).drop("to_token", "to_doc")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for s in b.to_pylist():
                local = Flat(f"{folder}/local-{s['name']}", "<u8")
                made = f"{s['name']}-{uuid.uuid4().hex}"
                with _create(folder, f"offsets-{made}") as out:
                    out.write(np.uint64(s["first_token"]).tobytes())
                    for at in range(0, local.size, 1 << 20):
                        out.write((local.read(at, min(local.size, at + (1 << 20))) + np.uint64(s["first_token"])).astype("<u8").tobytes())
                yield pa.RecordBatch.from_pylist([{**s, "offsets": made}], pa.schema([*b.schema, ("offsets", pa.string())]))

    return stored(_each(placed).mapInArrow(run, SHARDS + ", first_token bigint, first_doc bigint, offsets string"), "placed")


def _each(shards: DataFrame) -> DataFrame:
    """A task for each shard, as far as the hash allows."""
    return shards.repartition(max(shards.sparkSession.sparkContext.defaultParallelism, shards.count()), "name").select(*shards.columns)


def write(docs: DataFrame, ids_of: Callable, vocabulary: int, folder: str | None = None, key: str = "doc_id", text: str = "text", end: int | None = 0, shards: int | None = None) -> tuple[DataFrame, str, str]:
    """Write all documents and the index; returns the shards, the folder and the type of an id.

    ``ids_of()`` gives a worker's encoder; ``end`` is added to each document. A null text is empty; null keys come first;
    repeated rows are documents of their own; an empty table has an index without shards; other columns are ignored.
    """
    spark = docs.sparkSession
    folder = folder or scratch_path(spark, "tokens")
    kind = "<u2" if vocabulary <= 1 << 16 else "<u4"
    placed = place_shards(write_shards(docs, folder, ids_of, kind, key, text, end, shards), folder)
    listed = [r.asDict() for r in placed.orderBy("part").toLocalIterator()]
    with _create(folder, "index.json") as out:
        out.write(json.dumps({"kind": kind, "shards": listed}).encode())
    return placed, folder, kind


class TokenFiles:
    """Documents of a folder by their number in key order; maps only the shards that are asked for."""

    def __init__(self, folder: str):
        system, path = fs.FileSystem.from_uri(f"{folder}/index.json")
        with system.open_input_stream(path) as f:
            index = json.loads(f.read())
        self.folder, self.kind, self.shards = folder, index["kind"], index["shards"]
        self.firsts = [s["first_doc"] for s in self.shards]
        self.open: dict[int, tuple[Flat, Flat, Flat]] = {}

    def __len__(self) -> int:
        return self.shards[-1]["first_doc"] + self.shards[-1]["n_docs"] if self.shards else 0

    def __getitem__(self, number: int) -> tuple[int | None, int, np.ndarray]:
        """Key, start among all ids, and ids."""
        if not 0 <= number < len(self):
            raise IndexError(number)
        at = bisect.bisect_right(self.firsts, number) - 1
        s = self.shards[at]
        if at not in self.open:
            self.open[at] = opened(self.folder, s, self.kind)
        tokens, offsets, keys = self.open[at]
        i = number - s["first_doc"]
        start, stop = map(int, offsets.read(i, i + 2))
        return (None if i < s["n_null"] else int(keys.read(i, i + 1)[0])), start, tokens.read(start - s["first_token"], stop - s["first_token"])


def opened(folder: str, shard: dict, kind: str) -> tuple[Flat, Flat, Flat]:
    """Files of a shard; raises if they don't have the sizes that the index says."""
    files = Flat(f"{folder}/tokens-{shard['name']}", kind), Flat(f"{folder}/offsets-{shard['offsets']}", "<u8"), Flat(f"{folder}/keys-{shard['name']}", "<i8")
    if [f.size for f in files] != [shard["n_tokens"], shard["n_docs"] + 1, shard["n_docs"]]:
        raise ValueError(f"files of shard {shard['name']} do not have the sizes that the index says")
    return files


def read(shards: DataFrame, folder: str, kind: str, key: str = "doc_id", ids: bool = False) -> DataFrame:
    """One row for each document of the files: key, start, n_tokens, ids_crc32 of its ids as 32-bit numbers, and ``ids`` if asked for."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for s in b.to_pylist():
                tokens, offsets, keys = opened(folder, s, kind)
                for at in range(0, s["n_docs"], DOCUMENTS):
                    to = min(s["n_docs"], at + DOCUMENTS)
                    edges = offsets.read(at, to + 1).astype(np.int64)
                    found = [tokens.read(i, j).astype("<u4") for i, j in zip(edges[:-1] - s["first_token"], edges[1:] - s["first_token"])]
                    columns = [pa.array(keys.read(at, to), mask=np.arange(at, to) < s["n_null"]), pa.array(edges[:-1]), pa.array(np.diff(edges)), pa.array([crc32(f.tobytes()) for f in found], pa.int64())]
                    names = ["k", "start", "n_tokens", "ids_crc32"]
                    if ids:
                        columns.append(pa.array([f.astype(np.int64) for f in found], pa.list_(pa.int64())))
                        names.append("ids")
                    yield pa.RecordBatch.from_arrays(columns, names=names)

    return _each(shards).mapInArrow(run, "k bigint, start bigint, n_tokens bigint, ids_crc32 bigint" + ", ids array<bigint>" * ids).withColumnRenamed("k", key)


def round_trip(docs: DataFrame, ids_of: Callable, vocabulary: int, key: str = "doc_id", text: str = "text", end: int | None = 0) -> DataFrame:
    """Write all documents and read them back from the files."""
    return read(*write(docs, ids_of, vocabulary, None, key, text, end), key)
