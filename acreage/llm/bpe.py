"""Byte-level BPE by prefix dynamic programming: every byte prefix has one valid last token."""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Callable, Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, functions as F

from acreage.llm.common import slices, whole_text

TEXT_BYTES = 8 << 20
#: Entries of each kind that a worker keeps of its work; then it starts anew. Longer segments are not kept.
KEEP, LONG = 600_000, 64


def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


class Vocabulary:
    """Tokens by bytes and by id, and which two tokens can stand side by side."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.longest = max(map(len, ranks))
        self.bytes_of: list[bytes] = [b""] * (max(ranks.values()) + 1)
        for b, i in ranks.items():
            self.bytes_of[i] = b
        self.known: dict[int, bool] = {}

    def merge(self, data: bytes) -> list[int]:
        """BPE by its definition, for the short strings of two tokens: merge the lowest-ranked pair, leftmost first."""
        parts = [data[i : i + 1] for i in range(len(data))]
        while len(parts) > 1:
            rank, at = min((self.ranks.get(a + b, len(self.bytes_of)), i) for i, (a, b) in enumerate(zip(parts, parts[1:])))
            if rank == len(self.bytes_of):
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return [self.ranks[p] for p in parts]

    def beside(self, left: int, right: int) -> bool:
        """True if the bytes of both tokens are encoded as just these two."""
        key = left * len(self.bytes_of) + right
        found = self.known.get(key)
        if found is None:
            if len(self.known) >= KEEP:
                self.known.clear()
            found = self.known[key] = self.merge(self.bytes_of[left] + self.bytes_of[right]) == [left, right]
        return found

    def last_token(self, data: bytes, end: int, before: Callable[[int], int]) -> int:
        """The one token that ends the encoding of ``data[:end]``; ``before(i)`` is that of ``data[:i]``.

        A token sequence is the encoding of its bytes if and only if each neighbouring pair can stand side by side, so the
        first candidate that fits the last token before it is the only one.
        """
        for size in range(min(self.longest, end), 0, -1):
            token = self.ranks.get(data[end - size : end])
            if token is not None and (size == end or self.beside(before(end - size), token)):
                return token
        raise ValueError("the vocabulary lacks a single byte")


class PrefixEncoder:
    """Encoding of a growing or edited byte string. ``last[i]`` is the last token of the first i + 1 bytes."""

    def __init__(self, vocabulary: Vocabulary, data: bytes = b""):
        self.vocabulary, self.data, self.last = vocabulary, bytearray(), []
        self.append(data)

    def _extend(self) -> None:
        data = bytes(self.data)
        for end in range(len(self.last) + 1, len(data) + 1):
            self.last.append(self.vocabulary.last_token(data, end, lambda i: self.last[i - 1]))

    def append(self, data: bytes) -> None:
        """Add bytes; nothing before them is encoded again."""
        self.data += data
        self._extend()

    def replace(self, start: int, end: int, data: bytes) -> int:
        """Put ``data`` in place of bytes start to end; returns how many prefixes were encoded again.

        Behind the edit, work stops once as many prefixes in a row as the longest token has bytes have their old last token:
        all later ones depend on these alone.
        """
        tail = self.last[end:]
        self.data[start:end] = data
        whole, shift, calm = bytes(self.data), start + len(data), 0
        self.last = self.last[:start]
        for stop in range(start + 1, len(whole) + 1):
            token = self.vocabulary.last_token(whole, stop, lambda i: self.last[i - 1])
            self.last.append(token)
            i = stop - shift - 1
            # A token that reaches into the edit must not count as calm, as it rests on changed bytes.
            same = i >= 0 and tail[i] == token and len(self.vocabulary.bytes_of[token]) <= i + 1
            calm = calm + 1 if same else 0
            if calm >= self.vocabulary.longest:
                self.last += tail[i + 1 :]
                return stop - start
        return len(whole) - start

    def tokens(self) -> list[int]:
        out, end = [], len(self.last)
        while end:
            out.append(self.last[end - 1])
            end -= len(self.vocabulary.bytes_of[out[-1]])
        return out[::-1]


class PieceEncoder:
    """Pieces of text to ids, prefix by prefix. An automaton over all tokens names those that end at each byte."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary
        self.ends = ahocorasick.Automaton()
        for token, i in vocabulary.ranks.items():
            self.ends.add_word(token.decode("latin-1"), (len(token), i))
        self.ends.make_automaton()

    def __call__(self, piece: bytes) -> list[int]:
        v = self.vocabulary
        whole = v.ranks.get(piece)
        if whole is not None:
            return [whole]
        known, beside, span = v.known.get, v.beside, len(v.bytes_of)
        last: list[int] = [-1] * len(piece)
        for at, (size, token) in self.ends.iter(piece.decode("latin-1")):
            if last[at] >= 0:
                continue
            before = at - size
            if before < 0:
                last[at] = token
            else:
                left = last[before]
                fits = known(left * span + token)
                if fits or fits is None and beside(left, token):
                    last[at] = token
        out, at = [], len(piece) - 1
        while at >= 0:
            token = last[at]
            out.append(token)
            at -= len(v.bytes_of[token])
        return out[::-1]


#: A space between two blanks, or at the end behind one: there a run of blanks must stay whole.
_RUN = re.compile(r"\s (?:\s|\Z)")


def segments(text: str) -> list[str]:
    """Cuts before spaces where no piece of the splitting pattern can cross; joined again they are the text."""
    if _RUN.search(text):
        return [text]
    first, *rest = text.split(" ")
    return [first, *[" " + s for s in rest]]


class Packed(dict):
    """Segments to ids as little-endian unsigned 32-bit integers, filled as they are met."""

    def __init__(self, encode: Callable[[str], list[int]]):
        super().__init__()
        self.encode = encode

    def __missing__(self, segment: str) -> bytes:
        packed = np.array(self.encode(segment), "<u4").tobytes()
        if len(segment) <= LONG:
            if len(self) >= KEEP:
                self.clear()
            self[segment] = packed
        return packed

    def text(self, text: str) -> bytes:
        return b"".join(map(self.__getitem__, segments(text)))


_READY: dict[tuple[str, str], tuple[Packed, Vocabulary]] = {}


def tokenizer(ranks_path: str, pattern: str) -> tuple[Packed, Vocabulary]:
    """One encoder and vocabulary for a worker."""
    key = (ranks_path, pattern)
    if key not in _READY:
        vocabulary = Vocabulary(load_ranks(ranks_path))
        pieces, split = PieceEncoder(vocabulary), regex.compile(pattern)
        _READY[key] = Packed(lambda s: [i for p in split.findall(s) for i in pieces(p.encode())]), vocabulary
    return _READY[key]


def decode(ids: bytes, vocabulary: Vocabulary) -> bytes:
    return b"".join(map(vocabulary.bytes_of.__getitem__, np.frombuffer(ids, "<u4").tolist()))


def encode(docs: DataFrame, ranks_path: str, pattern: str, text: str = "text") -> DataFrame:
    """``docs`` with ``token_ids``. A null text has no ids; rows stay where they are; a column of that name is replaced."""
    docs = docs.drop("token_ids")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packed, _ = tokenizer(ranks_path, pattern)
        for b in batches:
            for i, j in slices(b, text, TEXT_BYTES):
                part = b.slice(i, j - i)
                ids = [np.frombuffer(packed.text(t or ""), "<u4").astype(np.int32) for t in part.column(text).to_pylist()]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(ids, pa.list_(pa.int32()))], names=[*b.schema.names, "token_ids"])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields)
    return docs.mapInArrow(run, f"{fields}, token_ids array<int>")


def round_trip(docs: DataFrame, ranks_path: str, pattern: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Each text encoded, then its ids decoded: key, ``n_tokens``, and SHA-256 of the ids and of the decoded bytes."""
    kind = docs.schema[key].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packed, vocabulary = tokenizer(ranks_path, pattern)
        for b in batches:
            for i, j in slices(b, "t", TEXT_BYTES):
                part = b.slice(i, j - i)
                rows = [packed.text(t) for t in part.column("t").to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("k"),
                        pa.array([len(r) // 4 for r in rows], pa.int64()),
                        pa.array([hashlib.sha256(r).hexdigest() for r in rows], pa.string()),
                        pa.array([hashlib.sha256(decode(r, vocabulary)).hexdigest() for r in rows], pa.string()),
                    ],
                    names=["k", "n_tokens", "ids_sha256", "decoded_sha256"],
                )

    own = docs.select(F.col(key).alias("k"), whole_text(text).alias("t"))
    schema = f"k {kind.simpleString()}, n_tokens bigint, ids_sha256 string, decoded_sha256 string"
    return own.mapInArrow(run, schema).withColumnRenamed("k", key)
