"""Incremental forms of two batch flows as Structured Streaming jobs."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from acreage.operators.splits import assign_records


def _exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def _delete(spark: SparkSession, path: str) -> None:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


STATUS = "raster_id int, status string, error string, at timestamp"


def latest_status(spark: SparkSession, out: str) -> DataFrame:
    """Last status of every raster that was ever met."""
    if not _exists(spark, f"{out}/status"):
        return spark.createDataFrame([], STATUS)
    met = spark.read.schema(STATUS).option("recursiveFileLookup", "true").parquet(f"{out}/status")
    return met.groupBy("raster_id").agg(F.max_by(F.struct("status", "error"), "at").alias("s")).select("raster_id", "s.status", "s.error")


def raster_intake(spark: SparkSession, source: str, schema: str, out: str, checkpoint: str, process: Callable[[DataFrame], DataFrame], stop_on_error: bool = False) -> None:
    """Process rasters that arrived since the last run, and those whose last status is failed or skipped once more.

    All files that wait are one batch, so a raster of several files is whole. If a batch fails, it is halved until the rasters
    that fail stand alone: the others are done, and each raster has a status of its own (ok, failed or, after a failure with
    ``stop_on_error``, skipped). Results lie under the batch number; a batch that is run again replaces them.
    """
    state = {"stop": False}

    def settle(rows: DataFrame, target: str, place: str, depth: int) -> None:
        status, error = "skipped", ""
        if not state["stop"]:
            try:
                process(rows).write.mode("overwrite").parquet(f"{out}/results/{target}/piece={place}")
                status = "ok"
            except Exception as ex:
                status, error = "failed", str(ex)
                if len(rows.select("raster_id").distinct().take(2)) > 1:
                    for half in (0, 1):
                        part = rows.filter(F.pmod(F.xxhash64("raster_id", F.lit(depth)), F.lit(2)) == half)
                        if not part.isEmpty():
                            settle(part, target, f"{place}{half}", depth + 1)
                    return
                state["stop"] = stop_on_error
        named = rows.select("raster_id").distinct()
        named.select("raster_id", F.lit(status).alias("status"), F.lit(error).alias("error"), F.current_timestamp().alias("at")).write.mode("overwrite").parquet(f"{out}/status/{target}/piece={place}")

    def handle(batch: DataFrame, batch_id: int | str) -> None:
        target = f"batch={batch_id}"
        _delete(spark, f"{out}/results/{target}")
        _delete(spark, f"{out}/status/{target}")
        if not batch.isEmpty():
            settle(batch, target, "r", 0)

    again = latest_status(spark, out).filter("status <> 'ok'").select("raster_id")
    if not again.isEmpty():
        handle(spark.read.schema(schema).parquet(source).join(again, "raster_id", "left_semi"), f"retry-{uuid.uuid4().hex}")
    stream = spark.readStream.schema(schema).parquet(source)
    q = stream.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    q.awaitTermination()


def split_intake(spark: SparkSession, source: str, schema: str, table: str, checkpoint: str, ratios: tuple[float, float, float], seed: int) -> None:
    """Assign only new patches (patch_id, gk, ord) and keep every earlier assignment.

    All files that wait are one batch, so that a delivery is balanced as a whole. A group that already has a split keeps it. The assignment table is partitioned by batch number; a retried
    batch ignores its own earlier output and replaces it.
    """
    def handle(batch: DataFrame, batch_id: int) -> None:
        if _exists(spark, table):
            old = spark.read.parquet(table).filter(F.col("batch") != batch_id)
        else:
            old = spark.createDataFrame([], "patch_id string, gk string, ord bigint, split string, batch int")
        known = old.select("patch_id", "gk", "ord")
        records = batch.dropDuplicates(["patch_id"]).select("patch_id", "gk", "ord").unionByName(known.join(batch.select("patch_id"), "patch_id", "left_anti"))
        new = assign_records(records, old.select("patch_id", "split"), ratios, seed)
        new.select("patch_id", "gk", "ord", "split").write.mode("overwrite").parquet(f"{table}/batch={batch_id}")

    stream = spark.readStream.schema(schema).parquet(source)
    q = stream.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    q.awaitTermination()
