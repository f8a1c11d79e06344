"""Fixtures shared by both engines, and the decorator that pairs a Spark query with its SQL check."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
    "labels conversations"
).split()

# Uniform draw j of key k with seed s; plain BIGINT arithmetic, identical in both engines.
DRAW = (
    "(CAST((((({k} % 1000003) * 7919 + {j} * 104729 + {s}) % 2147483648) * 1103515245 + 12345) "
    "% 2147483648 AS DOUBLE) / CAST(2147483648 AS DOUBLE))"
)


def draw_sql(key: str, j: str, seed: int) -> str:
    return DRAW.format(k=f"CAST({key} AS BIGINT)", j=f"CAST({j} AS BIGINT)", s=f"CAST({seed} AS BIGINT)")


# Width of the derived scene raster in pixels.
SCENE_W = 250

SHARED = {
    "scene_px": """
SELECT CAST(0 AS INT) AS raster_id,
       CAST(floor(o.o_orderkey / 250.0) AS INT) AS row_, CAST(o.o_orderkey % 250 AS INT) AS col_,
       CAST(coalesce(l.q, 65536) AS DOUBLE) AS b1, CAST(coalesce(l.d, 65536) AS DOUBLE) AS b2,
       CAST(coalesce(l.t, 65536) AS DOUBLE) AS b3, CAST(coalesce(l.n, 65536) AS DOUBLE) AS b4,
       CASE WHEN l.l_orderkey IS NULL THEN 0 ELSE 1 END AS valid,
       coalesce(CAST(l.q AS DOUBLE) / (50 * l.n), 0e0) AS extent_prob,
       coalesce(CAST(l.t AS DOUBLE) / (8 * l.n), 0e0) AS boundary_prob,
       CASE o.o_orderstatus WHEN 'F' THEN 1 WHEN 'O' THEN 0 ELSE 255 END AS extent_gt,
       CASE WHEN o.o_orderpriority LIKE '1%' THEN 1 WHEN o.o_orderpriority LIKE '5%' THEN 2 ELSE 0 END AS boundary_gt
FROM {orders} o LEFT JOIN (
  SELECT l_orderkey, CAST(sum(l_quantity) AS BIGINT) AS q, CAST(sum(round(l_discount * 100)) AS BIGINT) AS d,
         CAST(sum(round(l_tax * 100)) AS BIGINT) AS t, count(*) AS n
  FROM {lineitem} GROUP BY l_orderkey) l ON l.l_orderkey = o.o_orderkey""",
    "fields": """
SELECT c_custkey AS feat_index, c_nationkey AS orig_fid,
       CAST((c_custkey * 37) % 240 AS DOUBLE) AS x0, CAST((c_custkey * 53) % 600 AS DOUBLE) AS y0,
       CAST((c_custkey * 37) % 240 + 3 + c_custkey % 9 AS DOUBLE) AS x1,
       CAST((c_custkey * 53) % 600 + 3 + c_nationkey % 7 AS DOUBLE) AS y1,
       c_custkey % 7 = 0 AS has_hole, c_custkey % 11 = 0 AS is_empty, c_custkey % 13 = 0 AS is_multi,
       c_custkey % 17 = 0 AS is_bowtie
FROM {customer}""",
    "fields_pred": """
SELECT c_custkey AS feat_index, c_nationkey AS orig_fid,
       CAST((c_custkey * 37) % 240 + c_custkey % 3 AS DOUBLE) AS x0, CAST((c_custkey * 53) % 600 AS DOUBLE) AS y0,
       CAST((c_custkey * 37) % 240 + 3 + c_custkey % 9 + c_custkey % 3 AS DOUBLE) AS x1,
       CAST((c_custkey * 53) % 600 + 3 + c_nationkey % 7 AS DOUBLE) AS y1,
       c_custkey % 7 = 0 AS has_hole, c_custkey % 11 = 0 AS is_empty, c_custkey % 13 = 0 AS is_multi,
       c_custkey % 17 = 0 AS is_bowtie
FROM {customer}""",
    "field_parts": """
SELECT f.feat_index, f.orig_fid, p.part, x0 + 12 * p.part AS x0, y0, x1 + 12 * p.part AS x1, y1, has_hole AND NOT is_bowtie AS has_hole, is_bowtie
FROM {fields} f CROSS JOIN (VALUES (0), (1)) p(part) WHERE NOT is_empty AND (p.part = 0 OR is_multi)""",
    "pred_parts": """
SELECT f.feat_index, f.orig_fid, p.part, x0 + 12 * p.part AS x0, y0, x1 + 12 * p.part AS x1, y1, has_hole AND NOT is_bowtie AS has_hole, is_bowtie
FROM {fields_pred} f CROSS JOIN (VALUES (0), (1)) p(part) WHERE NOT is_empty AND (p.part = 0 OR is_multi)""",
    "field_edges": """
SELECT feat_index, orig_fid, part, 0 AS ring, e.i, x0 + e.ax * (x1 - x0) AS ax, y0 + e.ay * (y1 - y0) AS ay, x0 + e.bx * (x1 - x0) AS bx, y0 + e.by_ * (y1 - y0) AS by_
FROM {field_parts} f CROSS JOIN (VALUES (false, 0, 0, 0, 1, 0), (false, 1, 1, 0, 1, 1), (false, 2, 1, 1, 0, 1), (false, 3, 0, 1, 0, 0),
  (true, 0, 0, 0, 1, 0), (true, 1, 1, 0, 0, 1), (true, 2, 0, 1, 1, 1), (true, 3, 1, 1, 0, 0)) e(bow, i, ax, ay, bx, by_) WHERE e.bow = f.is_bowtie
UNION ALL
SELECT feat_index, orig_fid, part, 1, e.i, x0 + 1 + e.ax * (x1 - x0 - 2), y0 + 1 + e.ay * (y1 - y0 - 2), x0 + 1 + e.bx * (x1 - x0 - 2), y0 + 1 + e.by_ * (y1 - y0 - 2)
FROM {field_parts} f CROSS JOIN (VALUES (0, 0, 0, 1, 0), (1, 1, 0, 1, 1), (2, 1, 1, 0, 1), (3, 0, 1, 0, 0)) e(i, ax, ay, bx, by_) WHERE f.has_hole""",
    "raster_meta": """
SELECT CAST(s_suppkey AS INT) AS raster_id, concat('ds_', CAST(s_nationkey AS VARCHAR(20))) AS dataset,
       CAST(200 + s_suppkey % 50 AS INT) AS width, CAST(100 + s_suppkey % 30 AS INT) AS height,
       CAST(CASE WHEN s_suppkey % 19 = 5 THEN 3 ELSE 4 END AS INT) AS band_count,
       CASE WHEN s_suppkey % 23 = 7 THEN 'float32' ELSE 'uint16' END AS dtype,
       CASE WHEN s_suppkey % 29 = 3 THEN NULL WHEN s_suppkey % 31 = 4 THEN 0e0 ELSE 65536e0 END AS nodata,
       CAST(CASE WHEN s_suppkey % 37 = 2 THEN NULL WHEN s_suppkey % 5 = 1 THEN 4326 ELSE 32637 END AS INT) AS epsg,
       CASE WHEN s_suppkey % 5 = 1 THEN 0.0001220703125e0 ELSE 10e0 END AS a,
       CASE WHEN s_suppkey % 41 = 6 THEN 0.5e0 ELSE 0e0 END AS b,
       CASE WHEN s_suppkey % 5 = 1 THEN 30e0 + s_suppkey % 10 ELSE 300000e0 + s_suppkey * 16 END AS c,
       0e0 AS d,
       CASE WHEN s_suppkey % 5 = 1 THEN -0.0001220703125e0 ELSE -10e0 END AS e,
       CASE WHEN s_suppkey % 5 = 1 THEN 50e0 + s_suppkey % 7 ELSE 5500000e0 - s_suppkey * 16 END AS f
FROM {supplier}""",
    "history": """
SELECT user_id AS run_id, CAST(row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS INT) AS epoch,
       event_type AS metric, value
FROM {events}""",
    "trials": """
SELECT p_partkey AS trial, CAST(p_size % 10 AS DOUBLE) / 10 AS f1, CAST(p_partkey % 7 AS DOUBLE) / 7 AS mean_iou_matched,
       CAST(p_partkey % 3 AS INT) AS merge_penalty, CAST(p_size % 4 AS INT) AS holes_penalty,
       CAST(p_partkey % 2 AS INT) AS invalid_geometries
FROM {part}""",
    "patch_meta": """
SELECT concat('p', CAST(l_orderkey AS VARCHAR(20)), '_', CAST(l_linenumber AS VARCHAR(20))) AS patch_id,
       concat('ds_', CAST(min(l_orderkey) % 4 AS VARCHAR(20))) AS dataset,
       CASE min(l_returnflag) WHEN 'A' THEN 'center' WHEN 'N' THEN 'boundary' ELSE 'negative' END AS inside_mode,
       CASE WHEN min(l_returnflag) = 'R' THEN NULL ELSE min(l_suppkey) END AS feat_index,
       CASE WHEN min(l_returnflag) = 'R' OR min(l_suppkey) % 10 = 3 THEN NULL
            ELSE concat('ds_', CAST(min(l_orderkey) % 4 AS VARCHAR(20)), '::', CAST(min(l_suppkey) AS VARCHAR(20))) END AS field_id,
       1e0 - CAST(min(round(l_discount * 100)) AS DOUBLE) / 20 AS valid_ratio,
       CAST(min(round(l_tax * 100)) AS DOUBLE) / 8 AS mask_ratio,
       CAST(min(l_quantity) AS DOUBLE) / 64 AS edge_ratio,
       l_orderkey * 8 + l_linenumber AS patch_no
FROM {lineitem} GROUP BY l_orderkey, l_linenumber""",
    "samples": """
SELECT patch_no, patch_id, dataset, inside_mode, field_id, feat_index, valid_ratio, mask_ratio, edge_ratio,
       CASE patch_no % 10 WHEN 8 THEN 'validation' WHEN 9 THEN 'test' ELSE 'train' END AS split
FROM {patch_meta} p""",
    "files": """
SELECT CAST(page_id AS INT) AS page_id,
       concat('/data/pred/run_', CAST(page_id % 3 AS VARCHAR(20)), '/sample_',
              CAST(page_id % 40 AS VARCHAR(20))) AS dir,
       CASE CAST(floor(page_id / 40.0) AS INT) % 5 WHEN 0 THEN 'extent_prob.tif' WHEN 1 THEN 'boundary_prob.tif'
            WHEN 2 THEN 'valid_mask.tif' WHEN 3 THEN 'predict_manifest.json' ELSE 'aoi.tif' END AS name,
       url
FROM {pages}""",
    "gt_bits": """
SELECT raster_id, row_, col_, extent_prob, boundary_prob, valid, extent_gt, boundary_gt FROM {scene_px} s""",
}

CHIP = {
    "spark": """
SELECT vec_id AS chip, label AS dataset_id, CAST(floor(pos / 8.0) AS INT) AS row_, CAST(pos % 8 AS INT) AS col_,
       CAST(v AS DOUBLE) AS v, CASE WHEN v > 0 THEN 1 ELSE 0 END AS fg
FROM {embeddings} LATERAL VIEW posexplode(embedding) e AS pos, v""",
    "duckdb": """
SELECT vec_id AS chip, label AS dataset_id, CAST(floor(pos / 8.0) AS INT) AS row_, CAST(pos % 8 AS INT) AS col_,
       CAST(v AS DOUBLE) AS v, CASE WHEN v > 0 THEN 1 ELSE 0 END AS fg
FROM (SELECT vec_id, label, unnest(embedding) AS v, generate_subscripts(embedding, 1) - 1 AS pos FROM {embeddings})""",
}

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def _text(name: str, engine: str) -> str:
    return CHIP[engine] if name == "chip_px" else SHARED[name]


def _fixture_names() -> tuple[str, ...]:
    return (*SHARED, "chip_px")


def fixture(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One table-derived fixture as a lazy DataFrame."""
    return spark.sql(_inline(name, sf_dir))


def _inline(name: str, sf_dir: str) -> str:
    def fill(match: re.Match) -> str:
        ref = match.group(1)
        if ref in TABLES:
            return f"parquet.`{sf_dir}/{ref}.parquet`"
        return f"({_inline(ref, sf_dir)})"

    return re.sub(r"\{(\w+)\}", fill, _text(name, "spark"))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _with_fixtures(body: str) -> str:
    """Prefix the CTEs of every fixture the check names."""
    needed: list[str] = []

    def visit(text: str) -> None:
        for name in _fixture_names():
            if re.search(rf"\b{name}\b", text) and name not in needed:
                raw = _text(name, "duckdb")
                visit(re.sub(r"\{(\w+)\}", r"\1", raw))
                needed.append(name)

    visit(body)
    ctes = [f"{n} AS ({re.sub(r'\{(\w+)\}', r'\1', _text(n, 'duckdb'))})" for n in needed]
    body = body.strip()
    head = re.match(r"WITH\s+(RECURSIVE\s+)?", body)
    if head:
        return "WITH RECURSIVE " + ",\n".join([*ctes, body[head.end():]])
    return ("WITH RECURSIVE " + ",\n".join(ctes) + "\n" + body) if ctes else body


def query(name: str, sql: str | None = None):
    """Register a Spark query and, where one exists, the SQL that must give the same rows."""

    def wrap(fn: Callable[[SparkSession, str], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"query {name} registered twice")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = _with_fixtures(sql)
        return fn

    return wrap
