"""Best-fit packing by patterns: a few lengths that fill a sequence, repeated as often as the histogram of lengths wants."""

from __future__ import annotations

import heapq
import os
from collections import Counter, defaultdict
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from acreage.llm.common import crc32, slices, stored, whole_text
from acreage.session import number_rows

TEXT_BYTES = 8 << 20
CAPACITY = 2048
#: Lengths are binned for the first fit. Patterns hold any number of documents of any length.
BINS = 64
#: Patterns taken into the fit at a time, and the use below which none is: times are rounded, so it would not be used once.
AT_ONCE, LEAST_USE = 32, 0.5

_READY: dict[tuple[str, str, str], object] = {}


def encoder(json_path: str, ranks_path: str, pattern: str):
    """Text to ids as the JSON tokenizer gives them.

    The rank file holds the same vocabulary and its library is five times as fast; only texts in which the name of a special
    token stands, which the JSON tokenizer treats as that token, go through the JSON tokenizer itself.
    """
    key = (json_path, ranks_path, pattern)
    if key not in _READY:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import tiktoken
        from tokenizers import Tokenizer

        from acreage.llm.bpe import load_ranks

        full = Tokenizer.from_file(json_path)
        special = [t.content for t in full.get_added_tokens_decoder().values()]
        fast = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=load_ranks(ranks_path), special_tokens={})

        def ids(text: str) -> np.ndarray:
            if any(s in text for s in special):
                return np.array(full.encode(text, add_special_tokens=False).ids, "<u4")
            return np.array(fast.encode_ordinary(text), "<u4")

        _READY[key] = ids
    return _READY[key]


def vocabulary(json_path: str) -> int:
    """Number of ids of a JSON tokenizer, special tokens included."""
    from tokenizers import Tokenizer

    return Tokenizer.from_file(json_path).get_vocab_size()


def cut(length: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces: all full but the first, which takes what is over."""
    first = length % capacity or min(length, capacity)
    return [(0, first), *[(s, capacity) for s in range(first, length, capacity)]]


def pieces(docs: DataFrame, ids_of, key: str = "doc_id", text: str = "text", capacity: int = CAPACITY, end: int = 0) -> DataFrame:
    """One row per piece of each document: key, piece, start, length, ids_crc32. ``ids_of()`` gives the worker's encoder."""
    kind = docs.schema[key].dataType
    last = np.array([end], "<u4")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = ids_of()
        for b in batches:
            for i, j in slices(b, "t", TEXT_BYTES):
                part = b.slice(i, j - i)
                rows, made = [], []
                for n, t in enumerate(part.column("t").to_pylist()):
                    ids = np.concatenate([encode(t), last])
                    for p, (s, size) in enumerate(cut(len(ids), capacity)):
                        rows.append(n)
                        made.append((p, s, size, crc32(ids[s : s + size].tobytes())))
                columns = [part.column("k").take(pa.array(rows, pa.int32()))]
                columns += [pa.array(c, t) for c, t in zip(zip(*made), (pa.int32(), pa.int64(), pa.int64(), pa.int64()))]
                yield pa.RecordBatch.from_arrays(columns, names=["k", "piece", "start", "length", "ids_crc32"])

    own = docs.select(F.col(key).alias("k"), whole_text(text).alias("t"))
    schema = f"k {kind.simpleString()}, piece int, start bigint, length bigint, ids_crc32 bigint"
    return own.mapInArrow(run, schema).withColumnRenamed("k", key)


# --- the plan, made from the histogram alone --------------------------------------------------------------------------


def best_patterns(gain: np.ndarray, depth: int | None = None, at_once: int = 1) -> list[tuple[int, ...]]:
    """Multisets of sizes that fill ``len(gain) - 1`` exactly, largest first, by falling sum of gains: the best of all there are, then the best with another size.

    All multisets compete, of any number of sizes (at most ``depth``, if given); sizes with a gain of -inf have no part.
    """
    full = len(gain) - 1
    sizes = np.flatnonzero(np.isfinite(gain))
    sizes, layers = sizes[sizes > 0], depth or 1
    # best[k, c]: largest sum of gains of a multiset that fills c, of at most k sizes; without ``depth`` a layer rests on itself.
    best, last = np.full((layers + 1, full + 1), -np.inf), np.zeros((layers + 1, full + 1), np.int64)
    best[:, 0] = 0
    upto = np.searchsorted(sizes, np.arange(full + 1), side="right")
    for k in range(1, layers + 1):
        below = best[k - 1] if depth else best[k]
        for c in range(1, full + 1):
            own = sizes[: upto[c]]
            if len(own):
                total = below[c - own] + gain[own]
                at = int(total.argmax())
                best[k, c], last[k, c] = total[at], own[at]
    with_size = (best[layers - 1] if depth else best[layers])[full - sizes] + gain[sizes]
    out: dict[tuple[int, ...], None] = {}
    for i in np.argsort(-with_size, kind="stable"):
        if not np.isfinite(with_size[i]) or len(out) == at_once:
            break
        found, k, c = [int(sizes[i])], layers - 1 if depth else layers, full - int(sizes[i])
        while c:
            n = int(last[k, c])
            found.append(n)
            k, c = k - 1 if depth else k, c - n
        out[tuple(sorted(found, reverse=True))] = None
    return list(out)


def non_negative_fit(a: np.ndarray, y: np.ndarray, rounds: int = 2000) -> np.ndarray:
    """x >= 0 with the least squares of a x - y, by an active set that only ever holds independent columns."""
    x, held = np.zeros(a.shape[1]), np.zeros(a.shape[1], bool)
    tall = 1e-9 * max(1.0, float(np.abs(a.T @ y).max(initial=0.0)))
    for _ in range(rounds):
        gain = a.T @ (y - a @ x)
        gain[held] = -np.inf
        best = int(np.argmax(gain))
        if gain[best] <= tall:
            break
        held[best] = True
        while True:
            want = np.zeros_like(x)
            want[held] = np.linalg.lstsq(a[:, held], y, rcond=None)[0]
            low = held & (want <= 0)
            if not low.any():
                x = want
                break
            step = np.min(x[low] / np.maximum(x[low] - want[low], 1e-300))
            x = x + step * (want - x)
            held &= x > 1e-9
            x[~held] = 0
    return x


class Plan:
    """Sequences by kind: each kind has the lengths of its slots and how often it is used."""

    def __init__(self, capacity: int):
        self.capacity, self.kinds = capacity, defaultdict(int)

    def add(self, lengths: tuple[int, ...], times: int) -> None:
        if times:
            self.kinds[tuple(sorted(lengths, reverse=True))] += times

    def slots(self) -> list[tuple[int, int, int, int, int]]:
        """(length, first rank, times, first sequence, offset): ranks of a length, from 0, in the order of the kinds."""
        out, used, sequence = [], defaultdict(int), 0
        for lengths, times in sorted(self.kinds.items(), reverse=True):
            offset = 0
            for n in lengths:
                out.append((n, used[n], times, sequence, offset))
                used[n] += times
                offset += n
            sequence += times
        return out

    @property
    def sequences(self) -> int:
        return sum(self.kinds.values())


def pattern_fits(y: np.ndarray, depth: int | None = None) -> Iterator[tuple[list[tuple[int, ...]], np.ndarray]]:
    """Patterns of sizes with y > 0 and how often each, not below zero, with the least squares of what they hold less ``y``.

    The active set of :func:`non_negative_fit` over all patterns there are: those of the largest gain are made when they are wanted. The fit so far
    comes whenever its patterns have doubled, and the last one is that of all patterns.
    """
    # One row of ``a`` for each pattern, and ``square`` is a times its transpose.
    found, a, x, square = [], np.zeros((0, len(y))), np.zeros(0), np.zeros((0, 0))
    at_once, error, shown = AT_ONCE, np.inf, AT_ONCE
    while True:
        rest = y - x @ a
        gain = np.where(y > 0, rest, -np.inf)
        held = set(found)
        new = [p for p in best_patterns(gain, depth, at_once) if p not in held and rest[list(p)].sum() > LEAST_USE * sum(k * k for k in Counter(p).values())]
        now = float(rest @ rest)
        if not new or (now >= error and at_once == 1):
            yield found, x
            return
        if len(found) >= shown:
            yield found, x
            shown = 2 * len(found)
        # Patterns taken together may all have to leave again; then the best alone, which never has to.
        at_once, error = 1 if now >= error else AT_ONCE, now
        more = np.zeros((len(new), len(y)))
        for row, p in zip(more, new):
            np.add.at(row, list(p), 1)
        cross = a @ more.T
        square = np.block([[square, cross], [cross.T, more @ more.T]])
        found, a, x = found + new, np.vstack([a, more]), np.append(x, np.zeros(len(new)))
        right, at = a @ y, np.arange(len(x))
        while True:
            want = _solved(square, right[at])
            low = np.flatnonzero(want <= 0)
            if not len(low):
                x = want
                break
            reach = x[low] / np.maximum(x[low] - want[low], 1e-300)
            x = x + reach.min() * (want - x)
            keep = np.ones(len(x), bool)
            keep[low] = (x[low] > LEAST_USE / 100) & (reach > reach.min())
            at, x, square = at[keep], x[keep], square[np.ix_(keep, keep)]
        found, a = [found[i] for i in at], a[at]


def _solved(square: np.ndarray, right: np.ndarray) -> np.ndarray:
    try:
        return np.linalg.solve(square, right)
    except np.linalg.LinAlgError:
        return np.linalg.lstsq(square, right, rcond=None)[0]


def fitted(histogram: dict[int, int], capacity: int, bins: int, depth: int | None = None) -> Iterator[list[tuple[list[range], int]]]:
    """Fits to the binned histogram, see :func:`pattern_fits`: the lengths of each place of a pattern, longest first, and how often the pattern."""
    width = -(-capacity // bins)
    bins = capacity // width
    y = np.zeros(bins + 1)
    for n, c in histogram.items():
        if n <= bins * width:
            y[-(-n // width)] += c
    for fit in _fit(y, depth):
        yield [([range(b * width, (b - 1) * width, -1) for b in p], times) for p, times in fit]


def _fit(y: np.ndarray, depth: int | None = None) -> Iterator[list[tuple[tuple[int, ...], int]]]:
    """Patterns and their repeat counts: rounded, and never beyond what is there. What the last fit leaves is fitted again, until no pattern is used."""
    rest, before = y.astype(np.int64), []
    while True:
        for found, x in pattern_fits(rest.astype(float), depth):
            left, out = rest.copy(), []
            for j in np.argsort(-x, kind="stable"):
                p = found[j]
                need = Counter(p)
                times = min(int(round(x[j])), *[int(left[b]) // k for b, k in need.items()])
                if times > 0:
                    out.append((p, times))
                    for b, k in need.items():
                        left[b] -= k * times
            yield before + out
        if not out:
            return
        rest, before = left, before + out


def make_plan(histogram: dict[int, int], capacity: int = CAPACITY, bins: int = BINS, depth: int | None = None) -> Plan:
    """The plan of fewest sequences among those by patterns of bins, by patterns of the lengths themselves, and by best fit alone; in this order if equal.

    The first with as few sequences as all tokens need is final: none can have fewer. Work depends on the number of distinct lengths and patterns,
    not on the number of documents. ``depth`` limits the documents of a pattern, if given.
    """
    least, best = -(-sum(n * c for n, c in histogram.items()) // capacity), None
    for fit in chain(fitted(histogram, capacity, bins, depth), fitted(histogram, capacity, capacity, depth), [[]]):
        plan = _filled(histogram, capacity, fit)
        best = plan if best is None or plan.sequences < best.sequences else best
        if best.sequences <= least:
            break
    return best


def _filled(histogram: dict[int, int], capacity: int, fit: list[tuple[list[range], int]]) -> Plan:
    """Fill patterns (the lengths of each place, longest first, and how often) with lengths, then pack what is left best-fit into the gaps and new sequences.

    Bins are upper bounds, so a pattern never overflows; what its documents fall short of their bins is a gap for others.
    """
    left = {n: c for n, c in histogram.items() if c > 0}
    plan = Plan(capacity)
    gaps: dict[int, dict[tuple[int, ...], int]] = defaultdict(lambda: defaultdict(int))

    def open_sequence(lengths: tuple[int, ...], times: int) -> None:
        gap = capacity - sum(lengths)
        if gap:
            gaps[gap][lengths] += times
        else:
            plan.add(lengths, times)

    if capacity in left:
        plan.add((capacity,), left.pop(capacity))
    for places, times in fit:
        while times:
            chosen: list[int] = []
            for i, reach in enumerate(places):
                room = capacity - sum(chosen)
                if i and i == len(places) - 1:
                    # What others fall short of their bins lengthens the last document, within a bin more.
                    reach = range(min(room, reach.start + len(reach) * i), reach.stop, -1)
                n = next((n for n in reach if left.get(n, 0) > chosen.count(n)), None)
                if n is not None:
                    chosen.append(n)
            if not chosen:
                break
            times_now = min(times, *[left[n] // chosen.count(n) for n in set(chosen)])
            for n in chosen:
                left[n] -= times_now
            open_sequence(tuple(chosen), times_now)
            times -= times_now
    for n in sorted((n for n, c in left.items() if c), reverse=True):
        _best_fit(n, left[n], gaps, open_sequence, capacity)
    for kinds in gaps.values():
        for lengths, times in kinds.items():
            plan.add(lengths, times)
    return plan


def _best_fit(n: int, count: int, gaps, open_sequence, capacity: int) -> None:
    """Put ``count`` documents of length ``n`` into the tightest gaps, as many of a gap at once as there are; the rest start sequences."""
    ready = [g for g in gaps if g >= n and gaps[g]]
    heapq.heapify(ready)
    while count and ready:
        gap = heapq.heappop(ready)
        kinds = gaps[gap]
        while kinds and count:
            lengths, times = kinds.popitem()
            if times > count:
                kinds[lengths] = times - count
                times = count
            fresh = not gaps.get(gap - n)
            open_sequence((*lengths, n), times)
            count -= times
            if fresh and gap - n >= n:
                heapq.heappush(ready, gap - n)
    while count:
        each = min(capacity // n, count)
        times = count // each
        open_sequence((n,) * each, times)
        count -= each * times


def pack(parts: DataFrame, key: str = "doc_id", capacity: int = CAPACITY, bins: int = BINS, depth: int | None = None) -> DataFrame:
    """``parts`` (key, piece, length, ids_crc32, and more) with ``sequence_id`` and ``offset``.

    Only the histogram, at most ``capacity`` numbers, comes to the driver. The plan says for each length which ranks go
    where, so a piece finds its place from its length and its rank among pieces of that length. Ranks come from a range
    partitioning, which splits a length that most pieces share.
    """
    counts = {r["length"]: r["n"] for r in parts.groupBy("length").agg(F.count("*").alias("n")).collect()}
    if not counts:
        return parts.withColumns({"sequence_id": F.lit(0).cast("bigint"), "offset": F.lit(0).cast("bigint")})
    slots = make_plan(counts, capacity, bins, depth).slots()
    by_length = {n: np.array([s[1:] for s in slots if s[0] == n], np.int64) for n in counts}
    ranked = number_rows(parts, [key, "piece", "ids_crc32"], "rank", ["length"])
    names = parts.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            length, rank = b.column("length").to_numpy(), b.column("rank").to_numpy() - 1
            sequence, offset = np.empty(len(rank), np.int64), np.empty(len(rank), np.int64)
            for n in np.unique(length):
                at = length == n
                table = by_length[int(n)]
                row = table[np.searchsorted(table[:, 0], rank[at], side="right") - 1]
                sequence[at], offset[at] = row[:, 2] + rank[at] - row[:, 0], row[:, 3]
            yield pa.RecordBatch.from_arrays([*[b.column(c) for c in names], pa.array(sequence), pa.array(offset)], names=[*names, "sequence_id", "offset"])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in parts.schema.fields)
    return ranked.select(*names, "rank").mapInArrow(run, f"{fields}, sequence_id bigint, offset bigint")


def pack_documents(docs: DataFrame, json_path: str, ranks_path: str, pattern: str, key: str = "doc_id", text: str = "text", capacity: int = CAPACITY) -> DataFrame:
    """Every document's pieces and their places. A null text is empty and still has its end token; repeated rows each get a
    place; an empty table gives no rows; other columns are not needed and ignored."""
    return pack(stored(pieces(docs, lambda: encoder(json_path, ranks_path, pattern), key, text, capacity), "pieces"), key, capacity)
