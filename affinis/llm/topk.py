"""Exact top-k search by integer inner product on a bit-sliced index.

Components are quantised to integers. A block of rows keeps, for each attribute, one bitmap per binary digit of its
values. A query's score is a sum of attributes times constants: with the constant written in signed digits it is a sum
of shifted slices, which carry-save adders reduce, bitmap by bitmap, to the slices of the score. The best rows are
selected from the most significant slice downward; rows that tie at the boundary are resolved exactly by their id.

Every (block of rows, group of queries) is one task: the block's index is built once and the group's queries stream past
it, so memory is that of a block. Each task sends its k best rows per query, and those are merged. Queries times rows is
the job's inherent work; a block's rows are sent once per group, of which there are few. Vectors with a component beyond
NARROW have blocks of their own, as a block has as many slices as its widest value needs.

Nulls and edge cases: vectors that are null, or hold null or non-finite components (or such that scale * x is not finite
as a double), or with a null id, take no part; all other vectors do, however large, and are ranked by their exact
scores; a score beyond a long is given as the nearest long. Missing components at the end count as 0; rows that repeat
an id count once, with the smallest vector; ties go to the smaller id; an empty table gives an empty result; other input
columns are ignored.
"""

from __future__ import annotations

import bisect
import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import stored

#: Rows of an index block and queries of a group: the size of a task's work.
BLOCK, GROUP = 4096, 1 << 16
#: Quantised components up to this size share blocks.
NARROW = 2.0**28


def quantised(vector: Column, scale: int = 1024) -> Column:
    """floor(scale * x) of each component, as doubles (which hold it exactly), or null where the vector takes no part."""
    y = lambda x: x.cast("double") * float(scale)
    whole = lambda v: F.when(F.abs(v) < 2.0**53, F.floor(F.when(F.abs(v) < 2.0**53, v)).cast("double")).otherwise(v)  # noqa: E731  # larger doubles are whole
    fine = F.forall(vector, lambda x: F.coalesce(F.abs(y(x)) < math.inf, F.lit(False)))
    return F.when(vector.isNotNull() & fine, F.transform(F.when(fine, vector), lambda x: whole(y(x))))


def sortable(n: int) -> bytes:
    """Bytes that order as the integers do."""
    size = (abs(n).bit_length() + 7) // 8
    return (0x8000 + size).to_bytes(2) + n.to_bytes(size) if n >= 0 else (0x8000 - size).to_bytes(2) + (256**size + n).to_bytes(size)


def signed_digits(q: int) -> Iterator[tuple[int, int]]:
    """(place, digit) with digits 1 and -1, no two adjacent, that sum to q."""
    place = 0
    while q:
        if q & 1:
            d = 2 - (q & 3)
            yield place, d
            q -= d
        q >>= 1
        place += 1


class BitSliced:
    """Bit slices of a matrix of integers of any size; bitmaps are 64-bit words over its rows."""

    def __init__(self, values: np.ndarray):
        n, dims = values.shape
        self.rows, self.low = n, values.min(0)
        up = values - self.low
        self.bits = max(1, int(up.max()).bit_length()) if up.size else 1
        words = -(-n // 64)
        planes = np.zeros((dims * self.bits, words * 8), np.uint8)
        for b in range(self.bits):
            packed = np.packbits(((up >> b) & 1).astype(np.uint8).T, axis=1, bitorder="little")
            planes[b :: self.bits, : packed.shape[1]] = packed
        planes = planes.view(np.uint64)
        self.planes = np.concatenate([planes, ~planes])  # complements serve negative digits
        self.dims = dims
        self.all = np.zeros(words * 8, np.uint8)
        ones = np.packbits(np.ones(n, np.uint8), bitorder="little")
        self.all[: len(ones)] = ones
        self.all = self.all.view(np.uint64)

    def scores(self, query: np.ndarray) -> tuple[np.ndarray, int]:
        """(slices of the score minus a constant, that constant): carry-save addition of all shifted slices."""
        at: dict[int, list[int]] = {}
        constant = 0
        for d, q in enumerate(query.tolist()):
            constant += q * int(self.low[d])
            for place, digit in signed_digits(q):
                first = d * self.bits + (0 if digit > 0 else self.dims * self.bits)
                if digit < 0:
                    constant -= ((1 << self.bits) - 1) << place
                for b in range(self.bits):
                    at.setdefault(place + b, []).append(first + b)
        out, carried, place = [], [], 0
        last = max(at, default=-1)
        while place <= last or carried:
            p = np.concatenate([*([self.planes[at[place]]] if place in at else []), *carried]) if place in at or carried else None
            carried = []
            if p is None:
                out.append(np.zeros_like(self.all))
                place += 1
                continue
            while len(p) > 1:
                k = len(p) // 3
                if k:
                    a, b, c = p[:k], p[k : 2 * k], p[2 * k : 3 * k]
                    x = a ^ b
                    carried.append((a & b) | (x & c))
                    p = np.concatenate([x ^ c, p[3 * k :]])
                else:
                    carried.append(p[:1] & p[1:])
                    p = p[:1] ^ p[1:]
            out.append(p[0])
            place += 1
        return np.array(out).reshape(len(out), len(self.all)), constant

    def top(self, query: np.ndarray, k: int, without: int | None = None) -> list[tuple[int, int]]:
        """(row, score) of the k best rows, ties to the smaller row; without: a row to leave out."""
        slices, constant = self.scores(query)
        sure, tied = np.zeros_like(self.all), self.all.copy()
        if without is not None:
            tied[without >> 6] &= ~(np.uint64(1) << np.uint64(without & 63))
        have = 0
        for s in slices[::-1]:
            up = tied & s
            n = have + int(np.bitwise_count(up).sum())
            if n > k:
                tied = up
            else:
                sure, tied, have = sure | up, tied & ~s, n
                if n == k:
                    break
        places = lambda m: np.flatnonzero(np.unpackbits(m.view(np.uint8), bitorder="little"))
        rows = places(sure)
        if have < k:
            rows = np.concatenate([rows, places(tied)[: k - have]])
        bit = (slices[:, rows >> 6] >> (rows & 63).astype(np.uint64)) & np.uint64(1)
        score = [constant + sum(int(x) << i for i, x in enumerate(col)) for col in bit.T]
        return sorted(zip(rows.tolist(), score, strict=True), key=lambda x: (-x[1], x[0]))


def _matrix(vectors: list[list[float]], dims: int) -> np.ndarray:
    """The vectors as integers, filled up with zeros: 64-bit ones, or Python's where these are too small."""
    widest = max((abs(x) for v in vectors for x in v), default=0)
    out = np.zeros((len(vectors), dims), np.int64 if widest < 2.0**61 else object)
    for row, v in zip(out, vectors, strict=True):
        row[: len(v)] = list(map(int, v))
    return out


def _searcher(k: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """The k best rows for each query; rows (task, query, vec_id, v) come by task, those of its index before its queries."""

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, ids, vectors, index, dims = None, [], [], None, 0
        for b in batches:
            out: list[tuple[int, int, int, bytes]] = []
            for at, query, own, v in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if at != task:
                    task, ids, vectors, index = at, [], [], None
                if not query:
                    ids.append(own)
                    vectors.append(v)
                    continue
                if not ids:
                    continue
                if index is None:
                    dims = max(map(len, vectors))
                    index, vectors = BitSliced(_matrix(vectors, dims)), []
                place = bisect.bisect_left(ids, own)
                for row, score in index.top(_matrix([v[:dims]], dims)[0], k, place if place < len(ids) and ids[place] == own else None):
                    out.append((own, ids[row], max(-(2**63), min(2**63 - 1, score)), sortable(score)))
            cols = zip(*out, strict=True) if out else [[]] * 4
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (*[pa.int64()] * 3, pa.binary()), strict=True)], ["query_id", "vec_id", "score", "exact"])

    return search


def top_k(df: DataFrame, query: Column, id_col: str = "vec_id", vector_col: str = "embedding", k: int = 10, scale: int = 1024, block: int = BLOCK, group: int = GROUP) -> DataFrame:
    """query_id, rank, vec_id, score: for each row for which query holds (a predicate on column vec_id), its k best others."""
    valid = df.select(F.col(id_col).cast("long").alias("vec_id"), quantised(F.col(vector_col), scale).alias("v")).where("vec_id is not null and v is not null")
    rows = stored(valid.groupBy("vec_id").agg(F.min("v").alias("v")))
    wide = F.exists("v", lambda x: F.abs(x) >= NARROW)
    n, w, m = rows.agg(F.count("*"), F.count_if(wide), F.count_if(query)).first()
    narrow, wider, groups = -(-(n - w) // block), -(-w // block), max(1, -(-m // group))
    blocks = max(1, narrow + wider)
    place = lambda salt, count: F.pmod(F.xxhash64(F.lit(salt), "vec_id"), F.lit(max(1, count)).cast("long"))
    each = lambda count: F.explode(F.sequence(F.lit(0).cast("long"), F.lit(count - 1).cast("long")))
    own = F.when(wide, narrow + place("w", wider)).otherwise(place("b", narrow))
    index = rows.select(own.alias("b"), each(groups).alias("g"), F.lit(0).alias("query"), "vec_id", "v")
    asked = rows.where(query).select(each(blocks).alias("b"), place("g", groups).alias("g"), F.lit(1).alias("query"), "vec_id", "v")
    tasks = index.unionByName(asked).select((F.col("b") * groups + F.col("g")).alias("task"), "query", "vec_id", "v")
    dealt = tasks.repartitionById(blocks * groups, F.col("task").cast("int")).sortWithinPartitions("task", "query", "vec_id")
    best = dealt.mapInArrow(_searcher(k), "query_id long, vec_id long, score long, exact binary")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("exact"), "vec_id"))
    return best.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
