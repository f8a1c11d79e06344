"""Session settings and the few distribution helpers every operator shares."""

from __future__ import annotations

import pathlib
import shutil
import tempfile
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

MAX_BROADCAST_BYTES = 64 << 20
#: Bits of the planner's size estimate of a table beyond which :func:`materialize` drops it.
ESTIMATE_BITS = 256


def build_session(master: str = "local[8]", shuffle_partitions: int = 8) -> SparkSession:
    return (
        SparkSession.builder.master(master)
        .appName("acreage")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package to the Python workers, once per application; they may run elsewhere or in another folder."""
    sc = spark.sparkContext
    if sc.applicationId not in _SHIPPED:
        package = pathlib.Path(__file__).resolve().parent
        target = pathlib.Path(tempfile.mkdtemp(prefix="spark-", dir="/tmp")) / package.name
        sc.addPyFile(shutil.make_archive(str(target), "zip", package.parent, package.name))
        _SHIPPED.add(sc.applicationId)


def shared_folder(spark: SparkSession) -> str:
    """The cluster's shared folder. Only local mode, where driver and executor are one process, may do without a configured one."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="spark-", dir="/tmp"))
    return spark.sparkContext.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame) -> DataFrame:
    """Cut the lineage with a reliable checkpoint, so that a lost executor costs no recomputation.

    A checkpoint keeps the planner's size estimate, and a join's estimate is the product of its sides': in a chain of joins of
    a table with what was made of it the digits double each time, until planning takes minutes. Rows of an RDD have the
    default estimate.
    """
    spark = df.sparkSession
    folder = shared_folder(spark)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(folder)
    done = df.checkpoint(eager=True)
    if done._jdf.queryExecution().optimizedPlan().stats().sizeInBytes().bit_length() <= ESTIMATE_BITS:
        return done
    return type(done)(spark._jsparkSession.createDataFrame(done._jdf.toJavaRDD(), done._jdf.schema()), spark)


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Rows dealt to ``spark.sql.shuffle.partitions`` tasks: a small file is one task, however much is made of its rows afterwards."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *keys)


def join_checked(
    big: DataFrame,
    small: DataFrame,
    on: Sequence[str],
    how: str = "left",
    max_bytes: int = MAX_BROADCAST_BYTES,
    salts: int = 16,
) -> DataFrame:
    """Join a lookup (unique per key) onto a large table.

    The lookup is written once and measured. It is broadcast only when its rows as text have at most
    ``max_bytes``; beyond it the large side is salted and the lookup repeated per salt, so one hot key
    never lands in a single task.
    """
    if how not in ("left", "inner", "left_semi", "left_anti"):
        raise ValueError("join_checked keeps the large side: left, inner, left_semi or left_anti")
    small = materialize(small)
    if (small.agg(F.sum(F.length(F.to_json(F.struct("*"))))).first()[0] or 0) <= max_bytes:
        return big.join(F.broadcast(small), list(on), how)
    return salted_join(big, small, on, how, salts)


def salted_join(
    big: DataFrame, small: DataFrame, on: Sequence[str], how: str = "left", salts: int = 16
) -> DataFrame:
    spread = [c for c in big.columns if c not in on] or list(on)
    left = big.withColumn("_salt", F.pmod(F.xxhash64(*spread), F.lit(salts)).cast("int"))
    right = small.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return left.join(right, [*on, "_salt"], how).drop("_salt")


def running_total(
    df: DataFrame,
    order: Sequence[str],
    weight: str | None = None,
    name: str = "total",
    group: Sequence[str] = (),
    partitions: int | None = None,
) -> DataFrame:
    """Cumulative sum of ``weight`` (1 if absent) over a total order, without gathering a group in one task.

    Rows are range-partitioned on (group, order), summed inside their partition, and shifted by what
    earlier partitions hold for the same group. ``order`` must be unique per group.
    """
    spark = df.sparkSession
    parts = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    keys = [*group, *order]
    w = F.col(weight) if weight else F.lit(1)
    tagged = materialize(
        df.repartitionByRange(parts, *keys).withColumn("_p", F.spark_partition_id()).withColumn("_w", w.cast("bigint"))
    )
    sizes = tagged.groupBy(*group, "_p").agg(F.sum("_w").alias("_n"))
    earlier = Window.partitionBy(*group).orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
    before = sizes.withColumn("_before", F.coalesce(F.sum("_n").over(earlier), F.lit(0))).drop("_n")
    inside = Window.partitionBy(*group, "_p").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    # A null group is a group like any other, so the join has to find it.
    own = tagged.withColumn("_l", F.sum("_w").over(inside)).alias("a")
    same = F.col("a._p") == F.col("b._p")
    for g in group:
        same = same & F.col(f"a.{g}").eqNullSafe(F.col(f"b.{g}"))
    joined = own.join(before.alias("b"), same, "inner").select("a.*", "b._before")
    return joined.withColumn(name, (F.col("_l") + F.col("_before")).cast("bigint")).drop("_p", "_l", "_before", "_w")


def number_rows(
    df: DataFrame, order: Sequence[str], name: str = "rn", group: Sequence[str] = (), partitions: int | None = None
) -> DataFrame:
    """``row_number()`` over a total order, see :func:`running_total`."""
    return running_total(df, order, None, name, group, partitions)


def top_per_group(
    df: DataFrame, group: Sequence[str], order: Sequence, n: int, spread: Sequence[str], salts: int = 32
) -> DataFrame:
    """First ``n`` rows per group: cut inside salted sub-groups first, so a hot group is never whole."""
    salt = F.pmod(F.xxhash64(*spread), F.lit(salts)).cast("int")
    first = (
        df.withColumn("_salt", salt)
        .withColumn("_r", F.row_number().over(Window.partitionBy(*group, "_salt").orderBy(*order)))
        .filter(F.col("_r") <= n)
    )
    return (
        first.withColumn("_r", F.row_number().over(Window.partitionBy(*group).orderBy(*order)))
        .filter(F.col("_r") <= n)
        .drop("_r", "_salt")
    )
