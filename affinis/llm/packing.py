"""Harmonic packing of tokenised documents into training sequences.

Lengths fall into reciprocal-capacity classes: class j holds lengths from capacity / (j + 1), exclusive, to capacity / j,
and a bin of class j takes exactly j of them, so a class is filled by counting alone and every worker packs its own
documents: no shuffle, no shared state. A document gives full sequences and one tail, whose length has a class. Documents
may be cut, so the room that j tails leave in their bin is filled with the start of the worker's next documents: bins
are full, and a document is cut at most once more than its length asks for. What a worker has left at its end (fewer than
j tails of each class) is packed end to end, and its last sequence is cut at powers of two, which need no padding either.

A worker holds at most capacity tokens per class. Sequence ids hold the task's number, so they are unique without
coordination; a task that runs again packs the same rows the same way.

Nulls and edge cases: a null text is empty; an empty text is the end token alone; repeated rows are packed again each;
a null id stays null; an empty table gives an empty result; other input columns are ignored.
"""

from __future__ import annotations

import base64
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .textops import sliced, trim

#: Chunks of text whose ids each worker keeps; when full, it starts afresh.
KEPT = 100_000


class ByteBpe:
    """Ids of a byte-level BPE, by chunk.

    A chunk starts at a space that follows no white space; the vocabulary's pattern never joins what stands before and
    after such a place, so chunks have the same ids anywhere and each distinct one is tokenised once. Texts with white
    space before a space are tokenised whole, texts with the name of a special token by the reference tokenizer.
    """

    def __init__(self, json_file: str = "byte_bpe_50k.json", ranks_file: str = "byte_bpe_50k.tiktoken"):
        import public_tokenizers as public
        import regex
        import tiktoken
        from tokenizers import Tokenizer

        at = lambda name: name if "/" in name else public.path(name)
        with open(at(ranks_file), "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.fast = tiktoken.Encoding("ranks", pat_str=public.PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.full = Tokenizer.from_file(at(json_file))
        self.special = [t.content for t in self.full.get_added_tokens_decoder().values()]
        self.mixed_space = regex.compile(r"\s ").search
        self.known: dict[str, bytes] = {}

    def _new(self, chunk: str) -> bytes:
        ids = np.array(self.fast.encode_ordinary(chunk), "<u4").tobytes()
        if len(chunk) <= 64:
            if len(self.known) >= KEPT:
                self.known.clear()
            self.known[chunk] = ids
        return ids

    def __call__(self, text: str) -> bytes:
        """Little-endian unsigned 32-bit ids."""
        if any(s in text for s in self.special):
            return np.array(self.full.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        if self.mixed_space(text):
            return np.array(self.fast.encode_ordinary(text), "<u4").tobytes()
        head, *rest = text.split(" ")
        known, new = self.known.get, self._new
        out = [known(head) or new(head)] if head else []
        out += [known(c) or new(c) for c in [" " + x for x in rest]]
        return b"".join(out)


_TOKENIZERS: dict[tuple, ByteBpe] = {}


def tokenizer(*files: str) -> ByteBpe:
    if files not in _TOKENIZERS:
        _TOKENIZERS[files] = ByteBpe(*files)
    return _TOKENIZERS[files]


class Packer:
    """Bins of one worker. A piece is (document, start, length, ids, tokens of the document)."""

    def __init__(self, capacity: int, name: int):
        self.capacity, self.next = capacity, name << 40
        self.open: dict[int, list[tuple]] = {}
        self.waiting: list[tuple] = []  # j tails of class j
        self.room = 0  # what they leave

    def _bin(self, pieces: list[tuple]) -> Iterator[tuple]:
        at = 0
        for p in pieces:
            yield (*p, self.next, at)
            at += p[2]
        self.next += 1

    def _piece(self, doc, ids: bytes, at: int, size: int) -> tuple:
        return (doc, at, size, ids[4 * at : 4 * (at + size)], len(ids) // 4)

    def add(self, doc, ids: bytes) -> Iterator[tuple]:
        n, at = len(ids) // 4, 0
        if self.room:
            at = min(self.room, n)
            self.waiting.append(self._piece(doc, ids, 0, at))
            self.room -= at
            if not self.room:
                yield from self._bin(self.waiting)
                self.waiting = []
        while n - at >= self.capacity:
            yield from self._bin([self._piece(doc, ids, at, self.capacity)])
            at += self.capacity
        if at < n:
            j = self.capacity // (n - at)
            tails = self.open.setdefault(j, [])
            tails.append(self._piece(doc, ids, at, n - at))
            if len(tails) == j:
                del self.open[j]
                self.room = self.capacity - sum(p[2] for p in tails)
                if self.room:
                    self.waiting = tails
                else:
                    yield from self._bin(tails)

    def close(self) -> Iterator[tuple]:
        """What is left, end to end, in full sequences and then powers of two."""
        rest = [*self.waiting, *(p for j in sorted(self.open) for p in self.open[j])]
        self.open, self.waiting, self.room = {}, [], 0
        left, now, room = sum(p[2] for p in rest), [], 0
        for doc, start, size, ids, n in rest:
            at = 0
            while at < size:
                if not room:
                    room = min(self.capacity, 1 << (left.bit_length() - 1))
                take = min(room, size - at)
                now.append((doc, start + at, take, ids[4 * at : 4 * (at + take)], n))
                at, room, left = at + take, room - take, left - take
                if not room:
                    yield from self._bin(now)
                    now = []


PIECES = pa.schema([("doc", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids", pa.binary()), ("doc_tokens", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64())])


def _batches(rows: Iterator[tuple], most: int = 1 << 23) -> Iterator[pa.RecordBatch]:
    held, size = [], 0
    for r in rows:
        held.append(r)
        size += len(r[3]) + 64
        if size >= most:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held, strict=True), PIECES.types, strict=True)], schema=PIECES)
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held, strict=True), PIECES.types, strict=True)], schema=PIECES)


def _worker(files: tuple[str, ...], capacity: int, end: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        encode, packer = tokenizer(*files), Packer(capacity, TaskContext.get().partitionId())
        tail = np.array([end], "<u4").tobytes()

        def rows() -> Iterator[tuple]:
            for b in sliced(batches):
                for doc, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                    yield from packer.add(doc, encode(text or "") + tail)
            yield from packer.close()
            tokenizer(*files).known.clear()
            trim()

        return _batches(rows())

    return pack


def pack(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", capacity: int = 1024, end: int = 0, files: tuple[str, ...] = ("byte_bpe_50k.json", "byte_bpe_50k.tiktoken")) -> DataFrame:
    """One row per piece: doc, start, length, ids (little-endian unsigned 32-bit), doc_tokens, sequence_id, offset.

    capacity is a power of two; end is the id that closes each document.
    """
    if capacity & (capacity - 1):
        raise ValueError("capacity must be a power of two")
    slim = df.select(F.col(id_col).cast("long").alias("doc"), F.col(text_col).alias("text"))
    return slim.mapInArrow(_worker(tuple(files), capacity, end), "doc long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long")


def digest(pieces: DataFrame) -> DataFrame:
    """The contract's columns."""
    return pieces.select(F.col("doc").alias("doc_id"), "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")
