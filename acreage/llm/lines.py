"""Line dedup by site spread: lines found on many sites are boilerplate and go, but for their first place."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F

from acreage.llm.common import stored, whole_text

#: Sites from which a line counts as boilerplate.
MIN_SITES = 5
#: Sketches have 2^LOG_K registers; their standard error is 1.04 / 2^(LOG_K / 2).
LOG_K = 12
BLANKS = " \t\n\x0b\x0c\r"


def _hashes(line: Column) -> list[Column]:
    """128 bits of the trimmed line, as two columns."""
    trimmed = F.btrim(line, F.lit(BLANKS))
    return [F.xxhash64(trimmed).alias("h1"), F.xxhash64(F.lit(1), trimmed).alias("h2")]


def _row_key(key: str, text: str) -> list[Column]:
    """Names a row by 128 bits of its content, so that null and repeated keys do no harm."""
    return [F.xxhash64(F.col(key), whole_text(text)).alias("r1"), F.xxhash64(F.lit(1), F.col(key), whole_text(text)).alias("r2")]


def site_lines(docs: DataFrame, key: str = "doc_id", text: str = "text", site: str = "source") -> DataFrame:
    """Every line with a word: row key, doc key, place, site, and the line's hashes."""
    d = docs.select(*_row_key(key, text), F.col(key).alias("doc"), F.col(site).cast("string").alias("site"), F.posexplode(F.split(whole_text(text), "\n")).alias("pos", "line"))
    return d.filter(F.btrim("line", F.lit(BLANKS)) != "").select("r1", "r2", "doc", "pos", "site", *_hashes(F.col("line")))


def boilerplate(lines: DataFrame, min_sites: int = MIN_SITES, log_k: int = LOG_K) -> DataFrame:
    """Line hashes found on ``min_sites`` sites or more, with the smallest (doc, pos) that has the line.

    One sketch of sites per line hash is built where the lines are read and merged by the aggregation. An estimate within
    six standard errors of the threshold, or a site around it, decides nothing: such lines get an exact distinct count, for
    which each (line, site) is first made one row, so that a line on a third of all rows is spread over many tasks.
    """
    margin = max(1, math.ceil(6 * 1.04 / 2 ** (log_k / 2) * min_sites))
    first = F.min(F.struct("doc", "pos")).alias("first")
    spread = lines.groupBy("h1", "h2").agg(F.hll_sketch_agg("site", F.lit(log_k)).alias("sketch"), first)
    spread = spread.select("h1", "h2", "first", F.hll_sketch_estimate("sketch").alias("sites"))
    maybe = stored(spread.filter(F.col("sites") >= min_sites - margin), "spread")
    near = maybe.filter(F.col("sites") <= min_sites + margin)
    exact = lines.join(near.select("h1", "h2"), ["h1", "h2"], "left_semi").select("h1", "h2", "site").distinct()
    exact = exact.groupBy("h1", "h2").agg(F.count("site").alias("sites")).filter(F.col("sites") >= min_sites)
    sure = maybe.filter(F.col("sites") > min_sites + margin)
    return near.drop("sites").join(exact, ["h1", "h2"]).select(*sure.columns).unionByName(sure)


def without_boilerplate(docs: DataFrame, key: str = "doc_id", text: str = "text", site: str = "source", min_sites: int = MIN_SITES) -> DataFrame:
    """``docs`` with boilerplate lines taken out of ``text``, and ``n_lines`` and ``n_removed``.

    Lines are compared without blanks at their ends; blank lines stay. The line remains at the smallest (key, place) that has
    it, so that nothing is lost of what many sites share; repeated rows of that key all keep it. No row is dropped: a text
    may become empty. A null text counts as empty, a null site as none, and input columns with the two new names are replaced; any other name may stand in the input.
    """
    docs = docs.drop("n_lines", "n_removed")
    lines = site_lines(docs, key, text, site)
    known = stored(boilerplate(lines, min_sites), "boilerplate").select("h1", "h2", "first")
    gone = lines.join(known, ["h1", "h2"]).filter(~F.struct("doc", "pos").eqNullSafe(F.col("first")))
    gone = gone.groupBy("r1", "r2").agg(F.collect_set("pos").alias("gone"))
    # Input columns travel in a struct, so that none can clash with the names used here.
    d = docs.select(F.struct("*").alias("all"), *_row_key(key, text), F.split(whole_text(text), "\n").alias("lines"))
    d = d.join(gone, ["r1", "r2"], "left")
    left = F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), F.col("gone"))
    kept = F.array_join(F.transform(F.coalesce(left, F.sequence(F.lit(0), F.size("lines") - 1)), lambda i: F.get("lines", i)), "\n")
    return d.select(
        *[kept.alias(c) if c == text else F.col("all").getField(c).alias(c) for c in docs.columns],
        F.size("lines").cast("long").alias("n_lines"),
        F.coalesce(F.size("gone"), F.lit(0)).cast("long").alias("n_removed"),
    )
