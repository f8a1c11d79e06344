"""Leak-free train/validation/test assignment."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from acreage.session import materialize, running_total

SPLITS = ("train", "validation", "test")


def normalised_ratios(train: Column, val: Column, test: Column) -> tuple[Column, Column, Column]:
    ratios = (train, val, test)
    ok = (train + val + test) > 0
    for r in ratios:
        ok = ok & (r >= 0) & (r <= 1)
    total = F.when(ok, train + val + test).otherwise(F.raise_error(F.lit("split ratios must lie in [0,1] with a positive sum")).cast("double"))
    return tuple(r / total for r in ratios)


def new_records(records: DataFrame, existing: DataFrame) -> DataFrame:
    return records.join(existing.select("patch_id").distinct(), "patch_id", "left_anti")


def conflicts(existing: DataFrame) -> DataFrame:
    """Patches that sit in more than one split."""
    return existing.groupBy("patch_id").agg(F.countDistinct("split").alias("n_splits")).filter("n_splits > 1")


def pins(records: DataFrame, existing: DataFrame) -> DataFrame:
    """Split of the first existing patch (record order ``ord``) of every group that already has one."""
    j = records.join(existing.select("patch_id", "split"), "patch_id")
    return j.groupBy("gk").agg(F.min_by("split", "ord").alias("pinned"))


def assign(groups: DataFrame, targets: dict[str, int], counts: dict[str, int]) -> DataFrame:
    """Split of every group (gk, n, pinned, u).

    Pinned groups keep their split. The others, in the order of ``u``, fill what each split still lacks of its target after
    the existing and pinned patches: first train, then validation, then test. A group goes where its first patch falls in the
    running total, so groups stay whole, and each split misses its share by less than one group at either end. Where a split
    already has more than its target, the others share the groups in the ratio of what they lack.
    """
    free = materialize(running_total(groups.filter("pinned is null"), ["u", "gk"], "n", "upto"))
    held = dict.fromkeys(SPLITS, 0) | {r["pinned"]: int(r["n"]) for r in groups.filter("pinned is not null").groupBy("pinned").agg(F.sum("n").alias("n")).collect()}
    lack = [max(0, targets[s] - int(counts.get(s, 0)) - held[s]) for s in SPLITS]
    whole, rest = sum(lack), int(free.agg(F.sum("n")).first()[0] or 0)
    at = (F.col("upto") - F.col("n")) * F.lit(whole)
    split = F.when(at < lack[0] * rest, SPLITS[0]).when(at < (lack[0] + lack[1]) * rest, SPLITS[1]).otherwise(SPLITS[2])
    placed = free.select("gk", "n", split.alias("split"))
    return placed.unionByName(groups.filter("pinned is not null").select("gk", "n", F.col("pinned").alias("split")))


def assign_records(records: DataFrame, existing: DataFrame, ratios: tuple[float, float, float], seed: int) -> DataFrame:
    """Split of every new record (patch_id, gk, ord): groups stay together, pinned groups keep their split."""
    from acreage.functions.scalars import draw
    total = sum(ratios)
    n_old = {r["split"]: r["n"] for r in existing.groupBy("split").agg(F.count("*").alias("n")).collect()}
    fresh = new_records(records, existing)
    g = fresh.groupBy("gk").agg(F.count("*").alias("n"), F.min("ord").alias("first"))
    g = materialize(g.join(pins(records, existing), "gk", "left").withColumn("u", draw(F.col("first"), 1, seed)).drop("first"))
    n_new = g.agg(F.sum("n")).first()[0] or 0
    after = n_new + sum(n_old.values())
    tr, va = round(after * ratios[0] / total), round(after * ratios[1] / total)
    done = assign(g, {"train": tr, "validation": va, "test": after - tr - va}, n_old)
    return fresh.join(done.select("gk", "split"), "gk")
