"""Exact top-k of all queries by cosine, block by block: pairs of records never leave the task that scores them.

Tokens travel as postings packed by task, first to their token (which gives its weight), then to the blocks of the records.
A block is bounded by its number of postings. Where a block of the pool and a group of the queries of one country meet, a
task adds up a query's scores over the block's inverted lists; it keeps the query's k best rows of all its blocks and sends
only these. The products are the job's inherent work, and grow with the square of the input. Tasks read blocks and groups
where they are stored, so no copy of them enters an exchange: what is shuffled and on disk grows with the input and not with
its square. Pairs meet in rounds, each of at most about as many pairs as there are blocks. Numbers travel in as few bytes as
they need.

Weights are integers, so sums are exact: as doubles below 2^53, else as longs. Null countries meet nothing.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..storage import dropped, stored, together

#: Postings that a task packs at once, those it deals at once, and postings of a block; pairs of blocks of a round, at least.
PACK, DEAL, BLOCK, MEET = 1 << 21, 1 << 20, 1 << 22, 32
#: Tasks of a round for each core, and best rows that one holds at most before it sends them.
SPREAD, HELD = 4, 1 << 22
#: Folders of the blocks of the pool, and of countries with one block and one group; groups are in their round's.
POOL, ALONE = -1, -2
#: Stands for a null id.
NO_ID = -(2**63)
_PACKED = "country string, asked boolean, tok string, n long, base long, ids binary"
_DEALT = "country string, asked boolean, block long, alone boolean, tid long, base long, lists long, n long, tids binary, qs binary, uses binary, sizes binary, ids binary"
_BLOCK = "country string, asked boolean, block long, alone boolean, raw array<long>, ids binary, norms binary, tids binary, qs binary, starts binary, entries binary"
_ARRAYS = ("ids", "norms", "tids", "qs", "starts", "entries")
_FOUND = "s1_row long, pool_row long, country string, score double"


def _bytes(values: np.ndarray, starts: np.ndarray) -> pa.Array:
    """Lists of whole numbers from 0 up that begin at starts and fill everything; each in as few bytes as the largest needs."""
    small = values.astype(np.min_scalar_type(int(values.max(initial=0))))
    edges = (np.append(starts, len(values)) * small.itemsize).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(edges), pa.py_buffer(small)])


def _numbers(lists: pa.Array, n: np.ndarray) -> np.ndarray:
    """All numbers of lists of _bytes, which have n of them each; their bytes may differ."""
    raw = lists.cast(pa.binary())
    if not len(raw):
        return np.zeros(0, np.int64)
    edges = np.frombuffer(raw.buffers()[1], np.int32)[raw.offset : raw.offset + len(raw) + 1]
    data, size = np.frombuffer(raw.buffers()[2], np.uint8)[edges[0] : edges[-1]], np.diff(edges)
    widths = size // n
    if (widths == widths[0]).all():
        return data.view(f"u{widths[0]}").astype(np.int64)
    out, own = np.empty(n.sum(), np.int64), np.repeat(widths, n)
    for w in np.unique(widths):
        out[own == w] = data[np.repeat(widths == w, size)].view(f"u{w}").astype(np.int64)
    return out


def _based(ids: np.ndarray) -> tuple[int, np.ndarray]:
    """(the smallest id, what each has above it)."""
    base = ids.min()
    return int(base), ids.view(np.uint64) - np.array([base]).view(np.uint64)


def _runs(*keys: np.ndarray) -> np.ndarray:
    """Where runs of equal keys begin."""
    n = len(keys[0])
    new = np.zeros(n, bool)
    new[:1] = True
    for k in keys:
        new[1:] |= k[1:] != k[:-1]
    return np.flatnonzero(new)


def _pack(t: pa.Table) -> Iterator[pa.RecordBatch]:
    """Postings of the records (id, country, asked, toks); the empty token holds the pool's records that have tokens."""
    toks = t["toks"].combine_chunks()
    sizes = pc.fill_null(pc.list_value_length(toks), 0).to_numpy(zero_copy_only=False)
    words = pc.dictionary_encode(toks.flatten())
    some = np.flatnonzero(sizes > 0)
    at = np.concatenate([np.repeat(np.arange(len(sizes), dtype=np.int32), sizes), some.astype(np.int32)])
    if not len(at):
        return
    places = pc.dictionary_encode(t["country"].combine_chunks())
    country, asked = places.indices.to_numpy(zero_copy_only=False), t["asked"].to_numpy()
    tok = np.concatenate([words.indices.to_numpy(zero_copy_only=False), np.full(len(some), -1, np.int32)])
    span = len(words.dictionary) + 1
    key = (country * 2 + asked).astype(np.int32 if 2 * len(places.dictionary) * span < 2**31 else np.int64)[at]
    key *= span
    key += tok + 1
    order = np.argsort(key, kind="stable")
    key, at, tok = key[order], at[order], tok[order]
    first = _runs(key)
    names = pc.take(pa.concat_arrays([pa.array([""], words.dictionary.type), words.dictionary]), pa.array(tok[first] + 1))
    cols = [pc.take(places.dictionary, pa.array(country[at[first]])), pa.array(asked[at[first]]), names]
    base, ids = _based(t["id"].to_numpy())
    out = pa.table([*cols, pa.array(np.diff(np.append(first, len(at)))), pa.array(np.full(len(first), base)), _bytes(ids[at], first)], ["country", "asked", "tok", "n", "base", "ids"])
    yield from out.to_batches(max_chunksize=1 << 16)


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held, n = [], 0
    for b in (batch.slice(i, 1024) for batch in batches for i in range(0, batch.num_rows, 1024)):
        held.append(b)
        n += pc.sum(pc.list_value_length(b["toks"])).as_py() or 0
        if n >= PACK:
            yield from _pack(pa.Table.from_batches(held))
            held, n = [], 0
    if held:
        yield from _pack(pa.Table.from_batches(held))


def _place(ids: np.ndarray, count: np.ndarray) -> np.ndarray:
    """A block below count for each id."""
    x = ids.astype(np.uint64)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
    return (x >> np.uint64(33)).astype(np.int64) % count


def _steps(b: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Pieces of b of about DEAL postings."""
    edge = _runs(np.cumsum(b["n"].to_numpy()) // DEAL) if b.num_rows else []
    for x, y in zip(edge, [*edge[1:], b.num_rows], strict=True):
        yield b.slice(x, y - x)


def _dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Postings by block; rows come with equal tokens together, and each (country, token) gets a number of its own."""
    from pyspark import TaskContext

    tid, last = TaskContext.get().partitionId() << 40, None
    for b in (x for batch in batches for x in _steps(batch)):
        words, places = pc.dictionary_encode(b["tok"]), pc.dictionary_encode(b["country"])
        tok, country = words.indices.to_numpy(), places.indices.to_numpy()
        new = np.zeros(len(tok), np.int64)
        new[_runs(tok, country)] = 1
        if last == (b["country"][0].as_py(), b["tok"][0].as_py()):
            new[0] = 0
        step = np.cumsum(new)
        asked, count = b["asked"].to_numpy(zero_copy_only=False), b["blocks"].to_numpy()
        sizes = b["n"].to_numpy()
        row = np.repeat(np.arange(len(sizes)), sizes)
        ids = b["base"].to_numpy()[row] + _numbers(b["ids"], sizes)
        block = _place(ids, count[row])
        order = np.lexsort((row, block, (country * 2 + asked)[row]))
        row, block, ids = row[order], block[order], ids[order]
        lists = _runs(row, block)  # one token of one block
        r, sizes = row[lists], np.diff(np.append(lists, len(ids)))
        groups = _runs(country[r], asked[r], block[lists])
        head, (base, above) = r[groups], _based(ids)
        same = lambda x, n=len(groups): pa.array(np.full(n, x))
        count = np.diff(np.append(lists[groups], len(ids)))
        cols = [pc.take(places.dictionary, pa.array(country[head])), pa.array(asked[head]), pa.array(block[lists][groups]), pc.take(b["alone"], pa.array(head)), same(tid), same(base)]
        cols += [pa.array(np.diff(np.append(groups, len(r)))), pa.array(count)]
        cols += [_bytes(x, groups) for x in (step[r], b["q"].to_numpy()[r], b["use"].to_numpy(zero_copy_only=False)[r].astype(np.uint8), sizes)]
        yield pa.RecordBatch.from_arrays([*cols, _bytes(above, lists[groups])], [c.split()[0] for c in _DEALT.split(", ")])
        tid, last = tid + int(step[-1]), (b["country"][-1].as_py(), b["tok"][-1].as_py())


def _sum(values: np.ndarray, at: np.ndarray, n: int, big: bool) -> np.ndarray:
    """Sums of integers by place: as doubles, or as longs where these could round."""
    if not big:
        return np.bincount(at, weights=values, minlength=n)
    out = np.zeros(n, np.int64)
    np.add.at(out, at, values)
    return out


def _built(t: pa.Table) -> pa.Table:
    """One block: its records, the square of their norms over all words, and the entries of the words in use.

    In a block of the pool, entries are records by word; in one of the queries, words by record.
    """
    t = t.combine_chunks()
    flat = lambda c, n: _numbers(t[c].combine_chunks(), t[n].to_numpy())
    asked, sizes = t["asked"][0].as_py(), flat("sizes", "lists")
    ids, row = np.unique(np.repeat(t["base"].to_numpy(), t["n"].to_numpy()) + flat("ids", "n"), return_inverse=True)
    row = row.astype(np.int32)
    q, use = flat("qs", "lists"), np.repeat(flat("uses", "lists") > 0, sizes)
    tid = np.repeat(t["tid"].to_numpy(), t["lists"].to_numpy()) + flat("tids", "lists")
    square = np.repeat(q * q, sizes)
    norms = _sum(square, row, len(ids), float(square.sum(dtype=float)) >= 2.0**53).astype(np.int64)
    del square
    tids, first, word = np.unique(tid, return_index=True, return_inverse=True)
    row, word = row[use], np.repeat(word.astype(np.int32), sizes)[use]
    by, entry, n = (row, word, len(ids)) if asked else (word, row, len(tids))
    order = np.argsort(by, kind="stable")
    starts = np.concatenate([[0], np.cumsum(np.bincount(by, minlength=n))])
    kept = entry[order].astype(np.min_scalar_type(max(len(ids), len(tids))) if asked else np.min_scalar_type(len(ids)))
    cols = [np.diff(ids, prepend=0), norms, np.diff(tids, prepend=0), q[first], np.diff(starts, prepend=0).astype(np.int64), kept]
    packed = [pa.array([pa.compress(c.tobytes(), "zstd", asbytes=True)], pa.binary()) for c in cols]
    return pa.table([t["country"][:1], t["asked"][:1], t["block"][:1], t["alone"][:1], pa.array([[c.nbytes for c in cols]]), *packed], [c.split()[0] for c in _BLOCK.split(", ")])


def _arrays(t: pa.Table, own: str) -> list[np.ndarray]:
    sizes = t[f"{own}_raw"][0].as_py()
    *cols, raw = (pa.decompress(t[f"{own}_{c}"][0].as_py(), n, "zstd", asbytes=True) for c, n in zip(_ARRAYS, sizes, strict=True))
    ids, norms, tids, q, starts = (np.frombuffer(c, np.int64) for c in cols)
    ids, tids, starts = (np.cumsum(c) for c in (ids, tids, starts))
    kind = np.dtype(f"u{len(raw) // int(starts[-1])}") if starts[-1] else np.dtype("u1")
    return [ids, norms, tids, q, starts, np.frombuffer(raw, kind).astype(np.int64)]


def _best(k: int) -> Callable[[pa.Table, pa.Table], pa.Table]:
    """The k best rows of a block of the pool for each query of a group."""

    def search(a: pa.Table, b: pa.Table) -> pa.Table:
        found: list[tuple[np.ndarray, ...]] = []
        if a.num_rows and b.num_rows:
            asked, a_norms, a_tids, _, a_starts, words = _arrays(a, "g")
            ids, norms, tids, q, starts, rows = _arrays(b, "b")
            at = np.minimum(np.searchsorted(tids, a_tids), len(tids) - 1)
            at[tids[at] != a_tids] = -1
            n, square, sizes = len(ids), q * q, np.diff(starts)
            root, chunks = np.sqrt(norms.astype(float)), np.arange(0, len(ids), 64)
            big, plain = max(norms.max(), a_norms.max()) >= 2**53, bool((q > 0).all())
            for i, x in enumerate(np.sqrt(a_norms.astype(float))):
                w = at[words[a_starts[i] : a_starts[i + 1]]]
                w = w[w >= 0]
                if not len(w) or not x:
                    continue
                some = np.concatenate([rows[s:e] for s, e in zip(starts[w].tolist(), starts[w + 1].tolist(), strict=True)])
                dot = _sum(np.repeat(square[w], sizes[w]), some, n, big)
                met = dot > 0 if plain else np.bincount(some, minlength=n) > 0
                score = np.full(n, -np.inf)
                np.divide(dot, x * root, out=score, where=met & (root > 0))
                least = -np.inf
                if len(chunks) > k:  # as many chunks have a row of at least this score
                    least = np.partition(np.maximum.reduceat(score, chunks), -k)[-k]
                hit = np.flatnonzero((score >= least) & (score > -np.inf))
                hit = hit[np.lexsort((ids[hit], -score[hit]))[:k]]
                found.append((np.full(len(hit), asked[i]), ids[hit], score[hit]))
        cols = [np.concatenate(c) for c in zip(*found, strict=True)] if found else [np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)]
        country = pa.array([a["g_country"][0].as_py()] * len(cols[0]) if len(cols[0]) else [], pa.string())
        return pa.table([cols[0], cols[1], country, cols[2]], ["s1_row", "pool_row", "country", "score"])

    return search


def _kept(found: pa.Table, k: int) -> pa.Table:
    """The k best rows of each query."""
    row, pool, score = (found[c].to_numpy() for c in ("s1_row", "pool_row", "score"))
    order = np.lexsort((pool, -score, row))
    first = _runs(row[order])
    place = np.arange(len(order)) - np.repeat(first, np.diff(np.append(first, len(order))))
    return found.take(pa.array(order[place < k]))


def _met(k: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """The k best rows for each query of the groups of a task, in all the blocks that they meet there; one pair in a batch."""
    search = _best(k)

    def meet(pairs: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: dict[tuple[str, int], pa.Table] = {}
        for pair in (b.slice(i, 1) for b in pairs for i in range(b.num_rows)):
            t = pa.Table.from_batches([pair])
            found, own = search(t, t), (t["g_country"][0].as_py(), t["g"][0].as_py())
            best[own] = _kept(pa.concat_tables([best[own], found]), k) if own in best else found
            if sum(x.num_rows for x in best.values()) > HELD:
                for x in best.values():
                    yield from x.to_batches()
                best = {}
        for x in best.values():
            yield from x.to_batches()

    return meet


@contextmanager
def _one_by_one(spark: SparkSession) -> Iterator[None]:
    """Rows of whole blocks go to Python one at a time."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    was = spark.conf.get(key)
    spark.conf.set(key, "1")
    try:
        yield
    finally:
        spark.conf.set(key, was)


def _rounds(sizes: DataFrame) -> int:
    """In how many rounds blocks and groups meet: a round has at most as many pairs as there are blocks and groups, or MEET, and once as many blocks."""
    pairs, blocks = sizes.agg(F.sum(F.col("blocks") * F.col("groups")), F.sum(F.col("blocks") + F.col("groups"))).first()
    return max(1, -(-(pairs or 0) // max(blocks or 0, MEET)))


def top_k(listed: DataFrame, k: int, cap: float, block: int = BLOCK) -> DataFrame:
    """(s1_row, pool_row, country, score, rank) of records (id, country, src, toks): as blocking.search of their weights, in a stored table."""
    kind = listed.schema["id"].dataType
    rows = listed.where("country is not null").select(F.coalesce(F.col("id").cast("long"), F.lit(NO_ID)).alias("id"), "country", (F.col("src") == "S1").alias("asked"), "toks").where("asked is not null")
    packed = stored(rows.mapInArrow(_packed, _PACKED), "zstd")
    real, pool = F.col("tok") != "", ~F.col("asked")
    total = lambda c: F.coalesce(F.sum(F.when(c, F.col("n"))), F.lit(0))
    sizes = packed.groupBy("country").agg(total(pool & ~real).alias("records"), total(pool & real).alias("held"), total(F.col("asked") & real).alias("sought"))
    count = lambda c: F.greatest(F.ceil(F.col(c) / block), F.lit(1)).cast("long")
    sizes = stored(sizes.select("country", "records", count("held").alias("blocks"), count("sought").alias("groups")))
    of = lambda c: F.sum(F.when(c, F.col("n"))).over(Window.partitionBy("country", "tok"))
    known = packed.where(real).withColumns({"df": of(pool), "wanted": of(F.col("asked"))}).where("df is not null").join(sizes, "country")
    q = F.round((F.ln(F.col("records").cast("double")) - F.ln(F.col("df").cast("double"))) * 10000).cast("long")
    use = (F.col("df") <= cap * F.col("records")) & F.col("wanted").isNotNull()
    dealt = known.select("country", "asked", "tok", q.alias("q"), use.alias("use"), F.when(F.col("asked"), F.col("groups")).otherwise(F.col("blocks")).alias("blocks"), (F.col("groups") * F.col("blocks") == 1).alias("alone"), "n", "base", "ids")
    dealt = stored(dealt.mapInArrow(_dealt, _DEALT), "zstd")  # the first exchange's files go before the second one's come
    dropped(packed)
    rounds = _rounds(sizes)
    turn = F.when(F.col("alone"), ALONE).when(F.col("asked"), F.col("block") % rounds).otherwise(POOL)
    built = stored(dealt.groupBy("country", "asked", "block").applyInArrow(_built, _BLOCK).withColumn("turn", turn.cast("int")), "snappy", "turn")
    dropped(dealt)
    spark = listed.sparkSession
    side = lambda where, own, at: built.where(where).select(F.col("country").alias(f"{own}_country"), F.col("block").alias(at), *[F.col(c).alias(f"{own}_{c}") for c in ("raw", *_ARRAYS)])

    def near(i: int) -> DataFrame:
        """What the pairs of blocks of round i find; every task reads its own pairs, by groups."""
        a, b = side(F.col("turn") == i, "g", "g"), side(F.col("turn") == POOL, "b", "b")
        pairs = a.join(b.hint("shuffle_replicate_nl"), F.col("g_country") == F.col("b_country"))
        return pairs.coalesce(SPREAD * spark.sparkContext.defaultParallelism).mapInArrow(_met(k), _FOUND)

    def alone() -> DataFrame:
        """What the pairs of countries with one block and one group find."""
        a, b = (side((F.col("turn") == ALONE) & (F.col("asked") == asked), own, own) for asked, own in ((True, "g"), (False, "b")))
        return a.groupBy("g_country").cogroup(b.groupBy("b_country")).applyInArrow(_best(k), _FOUND)

    order = Window.partitionBy("s1_row").orderBy(F.desc("score"), "pool_row")
    own = lambda c: F.nullif(c, F.lit(NO_ID)).cast(kind).alias(c)
    ranked = lambda found: found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select(own("s1_row"), own("pool_row"), "country", "score", "rank")
    with _one_by_one(spark):
        best = [stored(ranked(near(i))) for i in range(rounds)]
    best = together([*best, stored(ranked(alone()))])
    dropped(built)
    dropped(sizes)
    return best
