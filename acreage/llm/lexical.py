"""Ranked lexical search over a term-partitioned index: item bundles go from one term owner to the next and gather integer scores.

The terms of the items are dealt to a few owners by how many documents hold them, rarest first. Documents are dealt to
slices, so an owner is a set of tasks, one for each slice, and no common term meets in one place. A bundle is an item with
its weights and a sparse accumulator (document, score so far) for one slice; it is cogrouped with the postings of one owner
after the other. Between owners an accumulator loses only documents that can't reach the k best any more: what the owners
to come can add at most is known exactly.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window, functions as F

from acreage.llm.common import slices, stored, whole_text
from acreage.session import join_checked, number_rows, top_per_group

#: Owners by document frequency: terms of at most this part of all documents, the last one has the rest.
OWNERS = (1 / 32, 1 / 6, 1.0)
#: Documents and postings of a slice, items of a group.
DOCUMENTS, POSTINGS, ITEMS = 16_384, 2_000_000, 256
#: Bytes of texts that are counted before their rows are handed on; bytes of one text that are taken apart at a time.
TEXT_BYTES, PIECE = 4 << 20, 1 << 20

_TERM = re.compile(rb"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
_GAP = re.compile(rb"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]")


def term_counts(text: bytes) -> Counter[bytes]:
    """Terms of a UTF-8 text and how often each occurs; only A-Z are lowered."""
    found: Counter[bytes] = Counter()
    at = 0
    while at < len(text):
        gap = _GAP.search(text, at + PIECE)
        end = gap.start() if gap else len(text)
        found.update(_TERM.findall(text[at:end].lower()))
        at = end
    return found


def _counted(rows: DataFrame, key: str, text: str, mark: bool) -> DataFrame:
    """``(row, key, n, term, tf)`` for each distinct term of each row; with ``mark`` also a line with an empty term for each row that has terms."""
    kind = rows.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i, j in slices(b, "t", TEXT_BYTES):
                part = b.slice(i, j - i)
                at, n, terms, tf = [], [], [], []
                for r, text in enumerate(part.column("t").to_pylist()):
                    found = term_counts(text)
                    if found:
                        size = len(found) + mark
                        at += [r] * size
                        n += [found.total()] * size
                        if mark:
                            terms.append(b""), tf.append(0)
                        terms += found.keys()
                        tf += found.values()
                at = pa.array(at, pa.int32())
                columns = [part.column("row").take(at), part.column("k").take(at), pa.array(n, pa.int64()), pa.array(terms, pa.binary()), pa.array(tf, pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, names=["row", "k", "n", "term", "tf"])

    own = rows.select("row", F.col(key).alias("k"), whole_text(text).cast("binary").alias("t"))
    return own.mapInArrow(run, f"row bigint, k {kind}, n bigint, term binary, tf bigint")


def _numbers(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    return column.to_numpy() if len(column) else np.zeros(0, np.int64)


def _lists(table: pa.Table, name: str) -> tuple[np.ndarray, np.ndarray]:
    """Values of a list column, end to end, and where each row's begin (and the last end)."""
    column = table.column(name).combine_chunks()
    return _numbers(column.flatten()).astype(np.int64), np.concatenate([[0], np.cumsum(_numbers(column.value_lengths()).astype(np.int64))])


def _visit(stage: int, last: bool, k: int) -> Callable[[pa.Table, pa.Table], pa.Table]:
    """What one owner does for the bundles of one slice."""

    def run(bundles: pa.Table, postings: pa.Table) -> pa.Table:
        term, first = _lists(bundles, "terms")
        weight, bound, owner = (_lists(bundles, c)[0] for c in ("weights", "bounds", "owners"))
        rows, start = _lists(bundles, "rows")
        scores, _ = _lists(bundles, "scores")
        own = postings.filter(pc.greater(postings.column("t"), 0)) if postings.num_rows else postings
        t = _numbers(own.column("t"))
        order = np.argsort(t, kind="stable")
        t, row, gain = t[order], _numbers(own.column("row"))[order], _numbers(own.column("gain"))[order]
        docs = np.unique(np.concatenate([row, rows]))
        row, rows = np.searchsorted(docs, row), np.searchsorted(docs, rows)
        out_rows, out_scores, picked = [], [], []
        for b in range(bundles.num_rows):
            mine = slice(start[b], start[b + 1])
            total = np.zeros(len(docs), np.int64)
            total[rows[mine]] = scores[mine]
            at = slice(first[b], first[b + 1])
            now = owner[at] == stage
            for x, w, lo, hi in zip(term[at][now], weight[at][now], np.searchsorted(t, term[at][now]), np.searchsorted(t, term[at][now], "right")):
                total[row[lo:hi]] += w * gain[lo:hi]
            held = np.flatnonzero(total)
            if len(held) > k:
                best = np.partition(total[held], len(held) - k)[len(held) - k]
                held = held[total[held] + bound[at][owner[at] > stage].sum() >= best]
            out_rows.append(docs[held])
            out_scores.append(total[held])
            picked.append(len(held))
        flat_rows = np.concatenate([np.zeros(0, np.int64), *out_rows])
        flat_scores = np.concatenate([np.zeros(0, np.int64), *out_scores])
        if not last:
            ends = pa.array(np.concatenate([[0], np.cumsum(picked)]).astype(np.int32))
            made = {"rows": pa.ListArray.from_arrays(ends, pa.array(flat_rows)), "scores": pa.ListArray.from_arrays(ends, pa.array(flat_scores))}
            return pa.table({c: made.get(c, bundles.column(c)) for c in bundles.column_names})
        # Equal scores go by the document's key, so the marked lines, which have it, are looked up before the cut to k.
        marked = postings.filter(pc.equal(postings.column("t"), 0)).sort_by("row")
        where = np.searchsorted(_numbers(marked.column("row")), flat_rows)
        q = np.repeat(_numbers(bundles.column("q")), picked)
        all_ = pa.table({"q": pa.array(q, pa.int64()), "row": pa.array(flat_rows), "k": marked.column("k").take(pa.array(where)), "score": pa.array(flat_scores)})
        order = pc.sort_indices(all_, sort_keys=[("q", "ascending"), ("score", "descending"), ("k", "ascending"), ("row", "ascending")], null_placement="at_end")
        all_ = all_.take(order)
        q = _numbers(all_.column("q"))
        return all_.filter(pa.array(np.arange(len(q)) - np.searchsorted(q, q) < k))

    return run


def search(docs: DataFrame, items: DataFrame, k: int = 20, doc: str = "doc_id", item: str = "item_id", text: str = "text", owners: tuple[float, ...] = OWNERS) -> DataFrame:
    """The ``k`` best documents for each row of ``items``: ``item``, rank from 1, ``doc``, score.

    A null text has no terms; documents and items without terms yield nothing. Repeated rows are documents (items) of their
    own; those with a null key take part, and come last among equal scores. Other columns are not needed and ignored. An
    empty table on either side gives no rows.
    """
    items = stored(items.select(F.col(item).alias("item"), F.col(text).alias("text")).withColumn("row", F.monotonically_increasing_id()), "items")
    asked = stored(_counted(items, "item", "text", False).select(F.col("row").alias("q"), "term", F.col("tf").alias("times")), "item_terms")
    empty = docs.select(F.lit(None).cast(items.schema["item"].dataType).alias(item), F.lit(0).alias("rank"), F.col(doc), F.lit(0).cast("bigint").alias("score")).limit(0)

    words = number_rows(asked.select("term").distinct(), ["term"], "t").select("term", F.col("t").cast("int").alias("t"))
    words = words.unionByName(words.sparkSession.range(1).select(F.lit(b"").alias("term"), F.lit(0).alias("t")))
    rows = docs.select(F.col(doc).alias("k"), F.col(text).alias("text")).withColumn("row", F.monotonically_increasing_id())
    index = stored(join_checked(_counted(rows, "k", "text", True), words, ["term"], "inner").select("row", "k", "n", "t", "tf"), "postings")

    size = index.agg(F.count_if(F.col("t") == 0).alias("n"), F.sum(F.when(F.col("t") == 0, F.col("n"))).alias("l"), F.count("*").alias("p")).first()
    if not size["n"]:
        return empty
    index = index.withColumn("m", F.expr(f"75L + (25L * n * {size['n']}L) div {size['l']}L"))
    index = index.withColumn("gain", F.expr("(1000000000L * tf) div (1000L * tf + 12L * m)"))
    count = index.filter("t > 0").groupBy("t").agg(F.count("*").alias("df"), F.max("gain").alias("top"))
    weight = F.floor(F.lit(1000.0) * F.log(F.lit(2.0 * size["n"] + 2.0) / (F.lit(2.0) * F.col("df") + F.lit(1.0)))).cast("bigint")
    band = F.lit(len(owners) - 1)
    for s in range(len(owners) - 2, -1, -1):
        band = F.when(F.col("df") <= F.lit(owners[s] * size["n"]), s).otherwise(band)
    count = stored(count.select("t", weight.alias("w"), "top", band.alias("owner")).filter("w > 0"), "terms")

    n_slices = max(-(-size["n"] // DOCUMENTS), -(-size["p"] // POSTINGS))
    n_groups = -(-items.count() // ITEMS)
    own = join_checked(join_checked(asked, words, ["term"], "inner"), count, ["t"], "inner").withColumn("weight", F.col("times") * F.col("w"))
    line = F.struct("t", "weight", (F.col("weight") * F.col("top")).alias("bound"), "owner")
    own = own.groupBy("q").agg(F.sort_array(F.collect_list(line)).alias("x"))
    none = F.array().cast("array<bigint>")
    bundles = own.select(
        F.explode(F.sequence(F.lit(0), F.lit(n_slices - 1))).alias("slice"), F.pmod(F.xxhash64("q"), F.lit(max(1, n_groups))).cast("int").alias("part"), "q",
        F.col("x.t").alias("terms"), F.col("x.weight").alias("weights"), F.col("x.bound").alias("bounds"), F.col("x.owner").alias("owners"),
        none.alias("rows"), none.alias("scores"))
    carried = "slice int, part int, q bigint, terms array<int>, weights array<bigint>, bounds array<bigint>, owners array<int>, rows array<bigint>, scores array<bigint>"

    index = index.withColumn("slice", F.pmod(F.xxhash64("row"), F.lit(n_slices)).cast("int"))
    index = index.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(max(1, n_groups) - 1)))) if n_groups > 1 else index.withColumn("part", F.lit(0))
    kind = docs.schema[doc].dataType.simpleString()
    for s in range(len(owners)):
        last = s == len(owners) - 1
        held = join_checked(index, count.filter(F.col("owner") == s).select("t"), ["t"], "inner").select("slice", "part", "row", "t", "gain", "k")
        if last:
            held = held.unionByName(index.filter("t = 0").select("slice", "part", "row", "t", "gain", "k"))
        else:
            held = held.drop("k")
        pair = bundles.groupBy("slice", "part").cogroup(held.groupBy("slice", "part"))
        bundles = pair.applyInArrow(_visit(s, last, k), f"q bigint, row bigint, k {kind}, score bigint" if last else carried)
    order = [F.desc("score"), F.asc_nulls_last("k"), F.asc("row")]
    best = top_per_group(bundles, ["q"], order, k, ["row"])
    best = best.withColumn("rank", F.row_number().over(Window.partitionBy("q").orderBy(*order)))
    named = items.select(F.col("row").alias("q"), F.col("item").alias(item))
    return best.join(named, "q").select(item, "rank", F.col("k").alias(doc), "score")
