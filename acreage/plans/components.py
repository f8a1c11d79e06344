"""Queries on connected regions, distances and labels."""

from __future__ import annotations

from pyspark.sql import functions as F

from acreage.operators import components as C, distance as D, regions as R
from acreage.plans.registry import fixture, query

c = F.col
CHIP = ["chip"]
REACH = """reach(chip, r, k, sr, sk) AS (SELECT chip, row_, col_, row_, col_ FROM {src} WHERE {mask}
 UNION SELECT q.chip, q.row_, q.col_, p.sr, p.sk FROM reach p JOIN {src} q ON q.chip = p.chip AND abs(q.row_ - p.r) + abs(q.col_ - p.k) = 1 WHERE {qmask})"""


def reach(mask="fg = 1", src="chip_px", name="reach"):
    """Pairs (pixel, connected pixel) of a chip mask."""
    import re
    qmask = re.sub(r"\b(fg|v|m|label|z)\b", r"q.\1", mask)
    return REACH.format(src=src, mask=mask, qmask=qmask).replace("reach", name)


COMP = f"{reach()}, root AS (SELECT chip, r AS row_, k AS col_, min(sr * 8 + sk) AS root, count(*) AS n FROM reach GROUP BY chip, r, k)"
LAB = f"{COMP}, lab AS (SELECT p.chip, p.row_, p.col_, p.v, p.fg, coalesce(n, 0) AS n, CASE WHEN root IS NULL THEN 0 ELSE dense_rank() OVER (PARTITION BY p.chip ORDER BY root NULLS LAST) END AS label FROM chip_px p LEFT JOIN root USING (chip, row_, col_))"


def chips(spark, sf):
    return fixture(spark, sf, "chip_px").select("chip", "row_", "col_", "v", "fg")


def labels(spark, sf):
    return C.connected_components(chips(spark, sf), "fg", CHIP)


@query("connected_components", f"WITH RECURSIVE {LAB} SELECT chip, row_, col_, CAST(label AS INT) AS label FROM lab")
def connected_components(spark, sf):
    return labels(spark, sf)


@query("label_sizes", f"WITH RECURSIVE {LAB} SELECT chip, CAST(label AS INT) AS label, count(*) AS n FROM lab WHERE label > 0 GROUP BY chip, label")
def label_sizes(spark, sf):
    return C.label_sizes(labels(spark, sf), CHIP)


@query("label_stats", f"WITH RECURSIVE {LAB} SELECT chip, count(DISTINCT label) FILTER (label > 0) AS num_labels, CAST(max(label) AS INT) AS max_label, count(*) FILTER (label > 0) AS num_pixels_fg FROM lab GROUP BY chip")
def label_stats(spark, sf):
    return C.label_stats(labels(spark, sf), CHIP)


@query("remove_small_objects", f"WITH RECURSIVE {LAB} SELECT chip, row_, col_, CASE WHEN fg = 1 AND n >= 4 THEN 1 ELSE 0 END AS kept FROM lab")
def remove_small_objects(spark, sf):
    return C.remove_small_objects(chips(spark, sf), "fg", 4, keys=CHIP)


@query("remove_small_holes", f"""
WITH RECURSIVE {reach('fg = 0')}, h AS (SELECT chip, r AS row_, k AS col_, count(*) AS n FROM reach GROUP BY chip, r, k)
SELECT p.chip, p.row_, p.col_, CASE WHEN p.fg = 1 OR h.n < 3 THEN 1 ELSE 0 END AS filled FROM chip_px p LEFT JOIN h USING (chip, row_, col_)""")
def remove_small_holes(spark, sf):
    return C.remove_small_holes(chips(spark, sf), "fg", 3, keys=CHIP)


@query("split_components", f"""
WITH RECURSIVE {reach('v > -0.05 AND v < 0.2')}, root AS (SELECT chip, r AS row_, k AS col_, min(sr * 8 + sk) AS root FROM reach GROUP BY chip, r, k)
SELECT p.chip, p.row_, p.col_, CAST(CASE WHEN root IS NULL THEN 0 ELSE dense_rank() OVER (PARTITION BY p.chip ORDER BY root NULLS LAST) END AS INT) AS label FROM chip_px p LEFT JOIN root USING (chip, row_, col_)""")
def split_components(spark, sf):
    px = chips(spark, sf).select("chip", "row_", "col_", (c("v") > -0.05).cast("int").alias("m"), (c("v") >= 0.2).cast("int").alias("b"))
    return R.split_components(px, "m", "b", CHIP)


@query("polygons_from_raster", f"""
WITH RECURSIVE {reach('v > 0.05')}, root AS (SELECT chip, r AS row_, k AS col_, min(sr * 8 + sk) AS root FROM reach GROUP BY chip, r, k)
SELECT chip, CAST(dense_rank() OVER (PARTITION BY chip ORDER BY root) AS INT) AS label_id, CAST(count(*) AS DOUBLE) AS area FROM root GROUP BY chip, root""")
def polygons_from_raster(spark, sf):
    """A float raster read as polygons: threshold, label, outline. The area comes from the rings."""
    from acreage.operators.outline import load_label_polygons
    px = chips(spark, sf).select("chip", "row_", "col_", (c("v") + 0.45).alias("value"))
    polys = load_label_polygons(px, "value", CHIP, is_float=True)
    return polys.groupBy("chip", "label_id").agg(F.sum("area").alias("area"))


@query("relabel_consecutive", """
WITH l AS (SELECT chip, row_, col_, CASE WHEN v > 0 THEN CAST(floor(v * 40) AS INT) * 3 ELSE 0 END AS label FROM chip_px), d AS (SELECT chip, label, dense_rank() OVER (PARTITION BY chip ORDER BY label) AS nl FROM (SELECT DISTINCT chip, label FROM l WHERE label > 0))
SELECT l.chip, row_, col_, CAST(coalesce(nl, 0) AS INT) AS label FROM l LEFT JOIN d ON d.chip = l.chip AND d.label = l.label""")
def relabel_consecutive(spark, sf):
    px = chips(spark, sf).select("chip", "row_", "col_", F.when(c("v") > 0, F.floor(c("v") * 40).cast("int") * 3).otherwise(0).alias("label"))
    return C.relabel(px, CHIP)


@query("edt_row_pass", """
SELECT chip, row_, col_, max(CASE WHEN fg = 0 THEN col_ END) OVER (PARTITION BY chip, row_ ORDER BY col_ ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS left_,
 min(CASE WHEN fg = 0 THEN col_ END) OVER (PARTITION BY chip, row_ ORDER BY col_ ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS right_ FROM chip_px""")
def edt_row_pass(spark, sf):
    px = chips(spark, sf).withColumn("bg", (c("fg") == 0).cast("int"))
    return D.row_pass(px, "bg", CHIP, block=3).select("chip", "row_", "col_", "left_", "right_")


NEAREST = """SELECT p.chip, p.row_, p.col_, min({{'d': (q.row_ - p.row_) * (q.row_ - p.row_) + (q.col_ - p.col_) * (q.col_ - p.col_), 'r': q.row_, 'k': q.col_, 'v': {value}}}) AS b
 FROM {src} p JOIN {src} q ON q.chip = p.chip WHERE {target} GROUP BY p.chip, p.row_, p.col_"""


EDT_SQL = f"""
WITH n AS ({NEAREST.format(src='chip_px', value='0', target='q.fg = 0')}) SELECT p.chip, p.row_, p.col_, CAST(b.d AS BIGINT) AS d2, b.r AS near_row, b.k AS near_col FROM chip_px p LEFT JOIN n USING (chip, row_, col_)"""


@query("edt", EDT_SQL)
def edt(spark, sf):
    px = chips(spark, sf).withColumn("bg", (c("fg") == 0).cast("int"))
    return D.nearest(px, "bg", None, CHIP).select("chip", "row_", "col_", "d2", "near_row", "near_col")


@query("edt_blocks", EDT_SQL)
def edt_blocks(spark, sf):
    """The same in blocks that are smaller than a chip, so that distances cross their borders."""
    px = chips(spark, sf).withColumn("bg", (c("fg") == 0).cast("int"))
    return D.nearest(px, "bg", None, CHIP, block=3).select("chip", "row_", "col_", "d2", "near_row", "near_col")


@query("nearest_label", f"""
WITH l AS (SELECT chip, row_, col_, CASE WHEN v > 0.1 THEN row_ * 8 + col_ + 1 ELSE 0 END AS label FROM chip_px), n AS ({NEAREST.format(src='l', value='q.label', target='q.label > 0')})
SELECT l.chip, l.row_, l.col_, CASE WHEN l.label > 0 THEN l.label ELSE coalesce(b.v, 0) END AS label FROM l LEFT JOIN n USING (chip, row_, col_)""")
def nearest_label(spark, sf):
    lab = F.when(c("v") > 0.1, c("row_") * 8 + c("col_") + 1).otherwise(0)
    px = chips(spark, sf).select("chip", "row_", "col_", lab.alias("label")).withColumn("t", (c("label") > 0).cast("int"))
    n = D.nearest(px, "t", "label", CHIP, keep=["label"])
    return n.select("chip", "row_", "col_", F.when(c("label") > 0, c("label")).otherwise(F.coalesce("near_value", F.lit(0))).alias("label"))


@query("region_adjacency", """
WITH l AS (SELECT chip, row_, col_, CASE WHEN v > 0.1 THEN 3 WHEN v > 0 THEN 2 WHEN v > -0.1 THEN 1 ELSE 0 END AS label FROM chip_px),
 x AS (SELECT DISTINCT p.chip, q.label AS label, p.label AS nbr, p.row_, p.col_ FROM l p JOIN l q ON q.chip = p.chip AND abs(q.row_ - p.row_) <= 1 AND abs(q.col_ - p.col_) <= 1 WHERE p.label > 0 AND q.label > 0 AND p.label <> q.label)
SELECT chip, label, nbr, count(*) AS n FROM x GROUP BY chip, label, nbr""")
def region_adjacency(spark, sf):
    lab = F.when(c("v") > 0.1, 3).when(c("v") > 0, 2).when(c("v") > -0.1, 1).otherwise(0)
    return C.region_adjacency(chips(spark, sf).select("chip", "row_", "col_", lab.alias("label")), CHIP)


@query("local_maxima", """
WITH m AS (SELECT p.chip, p.row_, p.col_, p.v FROM chip_px p JOIN chip_px q ON q.chip = p.chip AND abs(q.row_ - p.row_) <= 2 AND abs(q.col_ - p.col_) <= 2 WHERE p.fg = 1 AND q.fg = 1 GROUP BY p.chip, p.row_, p.col_, p.v HAVING p.v >= max(q.v))
SELECT chip, row_, col_, v FROM m""")
def local_maxima(spark, sf):
    return D.local_maxima(chips(spark, sf), "v", 2, "fg", CHIP)


# A pixel is a maximum of that height if no higher one can be reached without going down by the height.
@query("h_maxima", """
WITH RECURSIVE up(chip, r, k, v, qr, qk, qv) AS (SELECT chip, row_, col_, v, row_, col_, v FROM chip_px
 UNION SELECT p.chip, p.r, p.k, p.v, q.row_, q.col_, q.v FROM up p JOIN chip_px q ON q.chip = p.chip AND abs(q.row_ - p.qr) <= 1 AND abs(q.col_ - p.qk) <= 1 WHERE q.v > p.v - 0.1e0)
SELECT chip, r AS row_, k AS col_, CASE WHEN max(qv) > v THEN 0 ELSE 1 END AS is_max FROM up GROUP BY chip, r, k, v""")
def h_maxima(spark, sf):
    return D.h_maxima(chips(spark, sf), "v", 0.1, CHIP, block=4)


@query("fill_holes_fast", f"""
WITH RECURSIVE {COMP}, z AS (SELECT chip, row_, col_, coalesce(root + 1, 0) AS label FROM chip_px LEFT JOIN root USING (chip, row_, col_)), {reach('fg = 0', name='rh')},
 h AS (SELECT chip, r AS row_, k AS col_, count(*) AS n FROM rh GROUP BY chip, r, k), n AS ({NEAREST.format(src='z', value='q.label', target='q.label > 0')})
SELECT z.chip, z.row_, z.col_, CAST(CASE WHEN z.label = 0 AND h.n < 4 THEN coalesce(b.v, 0) ELSE z.label END AS INT) AS label FROM z LEFT JOIN h USING (chip, row_, col_) LEFT JOIN n USING (chip, row_, col_)""")
def fill_holes_fast(spark, sf):
    return C.fill_holes_fast(root_labels(spark, sf), 4, CHIP)


def root_labels(spark, sf):
    """Component labels by first pixel (not renumbered)."""
    px = chips(spark, sf)
    lab = C.components(px, "fg", CHIP)
    code = F.floor(c("comp") / C.CODE) * 8 + c("comp") % C.CODE + 1
    on = ["chip", "row_", "col_"]
    return px.select(*on).join(lab.select(*on, code.cast("int").alias("label")), on, "left").withColumn("label", F.coalesce("label", F.lit(0)))


@query("fill_holes_exact", f"""
WITH RECURSIVE z AS (SELECT chip, row_, col_, CASE WHEN v > 0.05 THEN 2 WHEN v > -0.05 THEN 1 ELSE 0 END AS label FROM chip_px), y AS (SELECT z.chip * 4 + t.l AS chip, row_, col_, label, t.l FROM z CROSS JOIN (VALUES (1), (2)) t(l)),
 w AS (SELECT chip, row_, col_, CASE WHEN label <> l THEN 1 ELSE 0 END AS m FROM y), {reach('m = 1', 'w', 'rw')}, s AS (SELECT chip, r AS row_, k AS col_, count(*) AS n FROM rw GROUP BY chip, r, k),
 has AS (SELECT DISTINCT chip, label FROM z), f AS (SELECT CAST(floor(s.chip / 4e0) AS BIGINT) AS chip, s.row_, s.col_, min(s.chip % 4) AS l FROM s JOIN has ON has.chip = CAST(floor(s.chip / 4e0) AS BIGINT) AND has.label = s.chip % 4 WHERE n < 5 GROUP BY 1, 2, 3)
SELECT z.chip, z.row_, z.col_, CAST(CASE WHEN z.label = 0 AND f.l IS NOT NULL THEN f.l ELSE z.label END AS INT) AS label FROM z LEFT JOIN f USING (chip, row_, col_)""")
def fill_holes_exact(spark, sf):
    lab = F.when(c("v") > 0.05, 2).when(c("v") > -0.05, 1).otherwise(0)
    return C.fill_holes_exact(chips(spark, sf).select("chip", "row_", "col_", lab.alias("label")), 5, CHIP)


@query("merge_small_fast", f"""
WITH RECURSIVE {LAB}, z AS (SELECT chip, row_, col_, label, CASE WHEN label > 0 AND n > 4 THEN 1 ELSE 0 END AS keep FROM lab), n AS ({NEAREST.format(src='z', value='q.label', target='q.keep = 1')})
SELECT z.chip, z.row_, z.col_, CAST(CASE WHEN label > 0 AND keep = 0 THEN coalesce(b.v, 0) ELSE label END AS INT) AS label FROM z LEFT JOIN n USING (chip, row_, col_)""")
def merge_small_fast(spark, sf):
    return C.merge_small_fast(labels(spark, sf), 4, CHIP)


@query("drop_tiny", f"WITH RECURSIVE {LAB} SELECT chip, row_, col_, CAST(CASE WHEN n < 3 THEN 0 ELSE label END AS INT) AS label FROM lab")
def drop_tiny(spark, sf):
    return C.drop_tiny(labels(spark, sf), 3, CHIP)


@query("dissolve_labels", """
WITH RECURSIVE z AS (SELECT chip, row_, col_, CASE WHEN v > 0.05 THEN 2 WHEN v > -0.05 THEN 1 ELSE 0 END AS label FROM chip_px),
 rz(chip, label, r, k, sr, sk) AS (SELECT chip, label, row_, col_, row_, col_ FROM z WHERE label > 0 UNION SELECT q.chip, q.label, q.row_, q.col_, p.sr, p.sk FROM rz p JOIN z q ON q.chip = p.chip AND q.label = p.label AND abs(q.row_ - p.r) + abs(q.col_ - p.k) = 1),
 t AS (SELECT chip, label, r, k, min(sr * 8 + sk) AS root FROM rz GROUP BY chip, label, r, k)
SELECT chip, label, root AS part, CAST(count(*) AS DOUBLE) AS area FROM t GROUP BY chip, label, root""")
def dissolve_labels(spark, sf):
    """One geometry per label, exploded into its connected parts."""
    from acreage.operators.outline import label_parts
    lab = F.when(c("v") > 0.05, 2).when(c("v") > -0.05, 1).otherwise(0)
    parts = label_parts(chips(spark, sf).select("chip", "row_", "col_", lab.alias("label")), ["chip"])
    return parts.groupBy("chip", "label", "comp").agg(F.count("*").cast("double").alias("area")).select(
        "chip", "label", (F.floor(c("comp") / C.CODE) * 8 + c("comp") % C.CODE).cast("int").alias("part"), "area")


@query("merge_small_exact")
def merge_small_exact(spark, sf):
    lab = F.when(c("v") > 0.15, c("row_") * 8 + c("col_") + 10).when(c("v") > 0, 3).when(c("v") > -0.1, 2).otherwise(1)
    return C.merge_small_exact(chips(spark, sf).select("chip", "row_", "col_", lab.alias("label")), 4, CHIP)


@query("clean_labels")
def clean_labels(spark, sf):
    px = labels(spark, sf).join(chips(spark, sf).select("chip", "row_", "col_", (c("v") > -0.25).cast("int").alias("ok")), ["chip", "row_", "col_"])
    return C.clean_labels(px, 3, 3, 4, "exact", "ok", keys=CHIP)


def marker_sql(src: str) -> str:
    """Seeds of ``src`` (chip, row_, col_, m, b), without erosion and with windows of one pixel, as (chip, row_, col_, marker)."""
    return f"""co0 AS (SELECT chip, row_, col_, m, CASE WHEN m = 1 AND b = 0 THEN 1 ELSE 0 END AS c FROM {src}), co AS (SELECT chip, row_, col_, CASE WHEN max(c) OVER (PARTITION BY chip) = 1 THEN c ELSE m END AS c FROM co0),
 di AS (SELECT p.chip, p.row_, p.col_, p.c, CASE WHEN count(q.chip) = 0 THEN 0e0 ELSE sqrt(CAST(min((q.row_ - p.row_) * (q.row_ - p.row_) + (q.col_ - p.col_) * (q.col_ - p.col_)) AS DOUBLE)) END AS d FROM co p LEFT JOIN co q ON q.chip = p.chip AND q.c = 0 GROUP BY p.chip, p.row_, p.col_, p.c),
 lo AS (SELECT chip, min(d) AS low FROM di GROUP BY chip),
 pk AS (SELECT p.chip, p.row_, p.col_ FROM di p JOIN lo USING (chip) JOIN di q ON q.chip = p.chip AND abs(q.row_ - p.row_) <= 1 AND abs(q.col_ - p.col_) <= 1 AND q.c = 1 WHERE p.c = 1 AND p.d > low GROUP BY p.chip, p.row_, p.col_, p.d HAVING p.d >= max(q.d)),
 sd AS (SELECT chip, row_, col_ FROM pk UNION ALL SELECT chip, row_, col_ FROM co WHERE c = 1 AND chip NOT IN (SELECT chip FROM pk)),
 rs(chip, r, k, sr, sk) AS (SELECT chip, row_, col_, row_, col_ FROM sd UNION SELECT q.chip, q.row_, q.col_, p.sr, p.sk FROM rs p JOIN sd q ON q.chip = p.chip AND abs(q.row_ - p.r) + abs(q.col_ - p.k) = 1),
 mk AS (SELECT chip, r AS row_, k AS col_, dense_rank() OVER (PARTITION BY chip ORDER BY root) AS marker FROM (SELECT chip, r, k, min(sr * 8 + sk) AS root FROM rs GROUP BY chip, r, k))"""


def forest_sql(src: str) -> str:
    """Regions of ``src`` (chip, row_, col_, e, m; pixels of the mask only), edges one after another: ``grown`` (chip, row_, col_, label)."""
    return f"""ed AS (SELECT p.chip, p.row_ * 8 + p.col_ + 1 AS a, q.row_ * 8 + q.col_ + 1 AS b, row_number() OVER (PARTITION BY p.chip ORDER BY greatest(p.e, q.e), least(p.e, q.e), p.row_, p.col_, q.row_) AS i
  FROM {src} p JOIN {src} q ON q.chip = p.chip AND ((q.row_ = p.row_ AND q.col_ = p.col_ + 1) OR (q.row_ = p.row_ + 1 AND q.col_ = p.col_))),
 px AS (SELECT DISTINCT chip FROM {src}), ce AS (SELECT px.chip, t.i FROM px CROSS JOIN generate_series(1, 64) t(i)),
 st AS (SELECT ce.chip, list(CASE WHEN s.chip IS NULL THEN 0 WHEN s.m > 0 THEN -s.m ELSE ce.i END ORDER BY ce.i) AS tree FROM ce LEFT JOIN {src} s ON s.chip = ce.chip AND s.row_ * 8 + s.col_ + 1 = ce.i GROUP BY ce.chip),
 gr(chip, i, tree) AS (SELECT chip, CAST(0 AS BIGINT), tree FROM st
  UNION ALL SELECT g.chip, ed.i, CASE WHEN tree[a] = tree[b] OR (tree[a] < 0 AND tree[b] < 0) THEN tree ELSE list_transform(tree, lambda x: CASE WHEN x = greatest(tree[a], tree[b]) THEN least(tree[a], tree[b]) ELSE x END) END
  FROM gr g JOIN ed ON ed.chip = g.chip AND ed.i = g.i + 1),
 en AS (SELECT chip, unnest(arg_max(tree, i)) AS x, unnest(generate_series(0, 63)) AS pos FROM gr GROUP BY chip),
 grown AS (SELECT chip, CAST(floor(pos / 8e0) AS INT) AS row_, CAST(pos % 8 AS INT) AS col_, CASE WHEN x < 0 THEN -x ELSE 0 END AS label FROM en),
 lined AS (SELECT p.chip, p.row_, p.col_, CASE WHEN EXISTS (SELECT 1 FROM grown q WHERE q.chip = p.chip AND abs(q.row_ - p.row_) + abs(q.col_ - p.col_) = 1 AND q.label > 0 AND q.label < p.label) THEN 0 ELSE p.label END AS label FROM grown p)"""


@query("markers", f"""
WITH RECURSIVE s AS (SELECT chip, row_, col_, CASE WHEN v > -0.12 THEN 1 ELSE 0 END AS m, CASE WHEN v > 0.2 THEN 1 ELSE 0 END AS b FROM chip_px), {marker_sql('s')}
SELECT s.chip, s.row_, s.col_, di.d AS distance, CAST(coalesce(marker, 0) AS INT) AS marker FROM s JOIN di USING (chip, row_, col_) LEFT JOIN mk USING (chip, row_, col_)""")
def markers(spark, sf):
    """Seeds of every chip, in blocks that are smaller than a chip."""
    px = chips(spark, sf).select("chip", "row_", "col_", (c("v") > -0.12).cast("int").alias("m"), (c("v") > 0.2).cast("int").alias("b"))
    return R.markers(px, "m", "b", 0, 1, 0.0, CHIP, block=4)


GROW_SQL = f"""
WITH RECURSIVE s AS (SELECT chip, row_, col_, -v AS e, CASE WHEN v > 0.25 THEN row_ * 8 + col_ + 1 ELSE 0 END AS m FROM chip_px WHERE v > -0.15), {forest_sql('s')}
SELECT p.chip, p.row_, p.col_, CAST(coalesce(label, 0) AS INT) AS label FROM chip_px p LEFT JOIN lined USING (chip, row_, col_)"""


def grown(spark, sf, **how):
    m = F.when(c("v") > 0.25, c("row_") * 8 + c("col_") + 1).otherwise(0)
    px = chips(spark, sf).select("chip", "row_", "col_", (-c("v")).alias("e"), m.alias("m"), (c("v") > -0.15).cast("int").alias("inside"))
    return R.region_grow(px, "e", "m", "inside", keys=CHIP, **how)


@query("region_grow", GROW_SQL)
def region_grow(spark, sf):
    return grown(spark, sf)


@query("region_grow_blocks", GROW_SQL)
def region_grow_blocks(spark, sf):
    """The same in blocks that are smaller than a chip, so that regions meet at their borders."""
    return grown(spark, sf, block=4)
