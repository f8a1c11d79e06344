"""Resolving inputs from listings and manifests held as tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from acreage.functions.scalars import slug
from acreage.session import materialize, number_rows


def raster_bounds() -> dict[str, Column]:
    """World bounds of a north-up raster from its affine columns."""
    c = F.col
    return {"left": c("c"), "top": c("f"), "right": c("c") + c("a") * c("width"), "bottom": c("f") + c("e") * c("height")}


def list_files(spark: SparkSession, folder: str, pattern: str = "*") -> DataFrame:
    """Path, size and time of every file below a folder; file contents are not read."""
    f = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).load(folder)
    return f.select("path", "length", "modificationTime")


def single_match(listing: DataFrame, keys: Sequence[str], path: str = "path") -> DataFrame:
    """One input per key; anything but exactly one distinct match is reported, not resolved."""
    g = listing.groupBy(*keys).agg(F.countDistinct(path).alias("matches"), F.min(path).alias("_p"))
    return g.select(*keys, "matches", F.when(F.col("matches") == 1, F.col("_p")).alias("resolved"))


def layer_paths(samples: DataFrame, layers: Sequence[str]) -> DataFrame:
    return samples.withColumn("layer", F.explode(F.array(*[F.lit(x) for x in layers]))).withColumn("path", F.concat(F.col("split"), F.lit("/"), F.col("layer"), F.lit("/"), F.col("layer"), F.lit("_"), F.col("patch_id")))


def missing_layers(samples: DataFrame, files: DataFrame, layers: Sequence[str]) -> DataFrame:
    """Layer files a sample should have but the listing lacks."""
    return layer_paths(samples, layers).join(files.select("path").distinct(), "path", "left_anti")


def unique_ids(names: DataFrame, name: str, order: str, ids: str = "sample_id") -> DataFrame:
    """Safe ids in listing order; a taken id gets the next free suffix _2, _3, ...

    Numbering inside equal slugs is done in parallel. Only slugs that could clash with a suffixed one (a slug that
    itself ends in _<number> and whose stem is also a slug) are renamed one group of stems at a time.
    """
    s = names.withColumn("_slug", slug(F.regexp_replace(F.col(name), r"\.[^.]*$", ""))).withColumn("_key", F.lower(name))
    s = materialize(number_rows(s, ["_slug", "_key", order], "_pos").drop("_key"))
    first = s.groupBy("_slug").agg(F.min("_pos").alias("_f"))
    s = s.join(first, "_slug").withColumn("_n", F.col("_pos") - F.col("_f") + 1)
    plain = F.when(F.col("_n") == 1, F.col("_slug")).otherwise(F.concat(F.col("_slug"), F.lit("_"), F.col("_n").cast("string")))
    s = materialize(s.withColumn(ids, plain).drop("_pos", "_f"))
    clash = s.groupBy(ids).agg(F.count("*").alias("_c")).filter("_c > 1")
    if clash.isEmpty():
        return s.drop("_slug", "_n")
    return _settle(s, ids, name, order).drop("_slug", "_n")


def _settle(s: DataFrame, ids: str, name: str, order: str) -> DataFrame:
    """Serial rule for families of clashing slugs (stem without trailing numbers), family by family."""
    from acreage.operators.stencil import stream_groups
    fam = s.withColumn("_fam", F.regexp_replace("_slug", r"(_\d+)+$", "")).withColumn("_k", F.lower(name))
    bad = materialize(fam.groupBy(ids, "_fam").agg(F.count("*").alias("_c")).filter("_c > 1").select("_fam").distinct())
    calm = fam.join(bad, "_fam", "left_anti").drop("_fam", "_k")
    rest = fam.join(bad, "_fam", "left_semi")
    types = dict(rest.dtypes)

    def run(cols):
        order_ = sorted(range(len(cols["_k"])), key=lambda i: (cols["_k"][i], cols[order][i]))
        used, out = set(), [""] * len(order_)
        for i in order_:
            base = cand = cols["_slug"][i]
            n = 2
            while cand in used:
                cand, n = f"{base}_{n}", n + 1
            used.add(cand)
            out[i] = cand
        return {"_fam": cols["_fam"].tolist(), order: cols[order], "_new": out}

    new = stream_groups(rest, ["_fam"], ["_slug", "_k", order], run, f"_fam string, {order} {types[order]}, _new string").drop("_fam")
    fixed = rest.drop("_fam", "_k", ids).join(new, order).withColumnRenamed("_new", ids)
    return calm.unionByName(fixed.select(*calm.columns))


def first_by_priority(candidates: DataFrame, keys: Sequence[str], path: str = "path", priority: str = "priority", extra: Sequence[str] = ()) -> DataFrame:
    """Candidate with the lowest priority number per key; blank paths do not count."""
    ok = candidates.filter(F.col(path).isNotNull() & (F.trim(F.col(path)) != ""))
    return ok.groupBy(*keys).agg(F.min_by(F.struct(path, *extra), F.struct(priority, path)).alias("_b")).select(*keys, "_b.*")


def shortest(candidates: DataFrame, keys: Sequence[str], path: str = "path") -> DataFrame:
    """Shortest, then alphabetically first path per key."""
    return candidates.groupBy(*keys).agg(F.min_by(path, F.struct(F.length(path), F.col(path))).alias(path))


CHECK_MANIFEST = T.StructType([
    T.StructField("dataset", T.StringType(), False), T.StructField("root", T.StringType()), T.StructField("raw_raster_path", T.StringType()),
    T.StructField("raw_vector_path", T.StringType()), T.StructField("prepared_vector_path", T.StringType()), T.StructField("qa_ok", T.BooleanType()),
    T.StructField("errors", T.ArrayType(T.StringType())), T.StructField("warnings", T.ArrayType(T.StringType()))])


def read_manifest(spark: SparkSession, path: str, schema: T.StructType, required: Sequence[str]) -> DataFrame:
    """JSON lines with a fixed schema: malformed rows and missing required keys fail the read, lists default to empty."""
    df = spark.read.schema(schema).json(path, mode="FAILFAST")
    out = []
    for f in schema.fields:
        e = F.col(f.name)
        if f.name in required:
            e = F.when(e.isNull(), F.raise_error(F.lit(f"manifest key is missing: {f.name}")).cast(f.dataType)).otherwise(e)
        elif isinstance(f.dataType, T.ArrayType):
            e = F.coalesce(e, F.array().cast(f.dataType))
        out.append(e.alias(f.name))
    return df.select(*out)


def expectation_checks(meta: DataFrame, min_valid: float = 0.7) -> DataFrame:
    """Errors and warnings per raster against the first raster's band count, type and NoData.

    ``meta`` may carry valid_ratio. The expectation row is one row, joined on a constant.
    """
    exp = meta.agg(F.min_by(F.struct("band_count", "dtype", "nodata"), "raster_id").alias("x")).select(
        F.col("x.band_count").alias("_bc"), F.col("x.dtype").alias("_dt"), F.col("x.nodata").alias("_nd"), F.lit(1).alias("_one"))
    m = meta.withColumn("_one", F.lit(1)).join(F.broadcast(exp), "_one")
    tag = lambda cond, text: F.when(cond, F.lit(text))
    errors = [tag(F.col("epsg").isNull(), "crs_missing"), tag((F.abs("b") > 1e-12) | (F.abs("d") > 1e-12), "rotated"),
              tag(F.col("band_count") != F.col("_bc"), "band_count_mismatch"), tag(F.col("dtype") != F.col("_dt"), "dtype_mismatch")]
    warns = [tag(F.col("_nd").isNotNull() & ~F.col("nodata").eqNullSafe(F.col("_nd")), "nodata_mismatch"), tag(F.col("nodata").isNull(), "nodata_missing")]
    if "valid_ratio" in meta.columns:
        warns.append(tag(F.col("valid_ratio") < min_valid, "low_valid_ratio"))
    return m.select(*meta.columns, F.array_compact(F.array(*errors)).alias("errors"), F.array_compact(F.array(*warns)).alias("warnings"))


def aligned(a: DataFrame, b: DataFrame, key: str, tol: float = 1e-9) -> DataFrame:
    """Do two rasters share size, CRS and affine?"""
    cols = ("width", "height", "epsg", "a", "b", "c", "d", "e", "f")
    r = b.select(key, *[F.col(x).alias(f"o_{x}") for x in cols])
    same = lambda x: F.col(x).eqNullSafe(F.col(f"o_{x}"))
    affine = F.lit(True)
    for x in ("a", "b", "c", "d", "e", "f"):
        affine = affine & (F.abs(F.col(x) - F.col(f"o_{x}")) <= tol)
    return a.join(r, key).select(key, (same("width") & same("height")).alias("same_size"), same("epsg").alias("same_crs"), affine.alias("same_affine"))
