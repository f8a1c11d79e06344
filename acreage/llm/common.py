"""Small helpers shared by the training-data operators."""

from __future__ import annotations

import zlib
from collections.abc import Iterable

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from acreage.session import scratch_path, ship

#: What separates words, in Java and Python regular expressions alike.
BLANK = r"[\x20\x09-\x0D]"


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    """One input table; the package travels to the Python workers with the first one read."""
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write to the shared folder and read back: cuts the lineage, and is still there after an executor is lost."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def whole_text(column: str = "text") -> Column:
    """A text column with null as the empty text."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def slices(batch: pa.RecordBatch, column: str, limit: int) -> Iterable[tuple[int, int]]:
    """Row ranges of about ``limit`` bytes of ``column`` each, one row at least, so that a task holds few texts at once."""
    sizes = batch.column(column).nbytes
    rows = batch.num_rows
    if not rows:
        return
    if sizes <= limit:
        yield 0, rows
        return
    import pyarrow.compute as pc

    start, held = 0, 0
    for i, n in enumerate(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_pylist()):
        if held and held + n > limit:
            yield start, i
            start, held = i, 0
        held += n
    yield start, rows


def crc32_text(column: Column) -> Column:
    return F.crc32(column.cast("string").cast("binary"))


def crc32(data: bytes) -> int:
    return zlib.crc32(data) & 0xFFFFFFFF
