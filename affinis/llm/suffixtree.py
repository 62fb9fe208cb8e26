"""Language-model scores from a probabilistic suffix tree over words.

Tokens are words with A-Z lower-cased, and one end per document. A context is the last d tokens, up to DEPTH. The tree
is grown breadth first: every context and every next symbol that came LEAST times or more, however large the corpus, is a
candidate. A context becomes a state if its next-symbol distribution diverges from that of its longest suffix by more
than its parameters cost (a BIC test). A state mixes its counts with that distribution, down to add-one counts of all
words at the root; other contexts have their suffix's distribution. A text is scored by the longest state before each
token.

The tree grows with the corpus, so it is a table and is looked up by join. The log-probability of a token is a sum with
one term per sequence of tokens that ends there or at the token before: what its state adds to the suffix's probability
of it, and the state's back-off weight. The terms of a sequence, known by a 64-bit hash, are added up into one number, so
a text's score is the sum of the numbers of all sequences of up to DEPTH + 1 tokens in it. Parts of the documents
send the hashes, by bucket, to where the table's share of the bucket is, and get sums back. Three things of fixed size
are broadcast, and only save work: the sequences above a share of the corpus (at most 1 / share of them; the others
occur too seldom to fill a bucket), a bitmap of the table's hashes, and one of the sequences that came LEAST times.

Nulls and edge cases: a null text is empty, whose only token is the end; a null id is hashed as the empty string; repeated
rows are documents of their own; without training documents every probability is 1; an empty table gives an empty
result; other input columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import dropped, stored
from .textops import mixed, sliced, trim, word_hashes

#: Tokens of the longest context; occurrences from which a context and a next symbol of it count.
DEPTH, LEAST = 2, 2
#: Shares of the training tokens from which a word, or a longer sequence, is broadcast.
MIN_WORD, MIN_PAIR = 5e-7, 5e-7
#: log2 of the bits of a bitmap, at most.
BITMAP = 27
END = int(np.uint64(0x454E445F4F465F5F).astype(np.int64))
#: Distinct keys that a task sums up before it sends them; requests and documents that make a part; bytes of text per bucket.
HELD, SENT, ROWS, BUCKET = 1 << 20, 1 << 19, 1 << 16, 1 << 25
#: Bytes of text per bucket where sequences are counted.
COUNTED = 1 << 23
#: With many buckets a part has so many requests for each, up to a limit, so that rows don't get small.
EACH, MOST_SENT = 32, 1 << 22
#: Context of the words that are counted beside the sequences.
NONE = 0
_NEXT = np.uint64(0xD6E8FEB86659FD93)


class Lookup:
    """Places of 64-bit keys in a sorted array, -1 for others; a direct table answers most of them."""

    def __init__(self, keys: np.ndarray, bits: int = 20):
        self.keys, self.shift = keys, np.uint64(64 - bits)
        self.table = np.full(1 << bits, -1, np.int32)
        self.table[self._slot(keys)] = np.arange(len(keys))

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return (mixed(keys.view(np.uint64)) >> self.shift).astype(np.int64)

    def __call__(self, keys: np.ndarray) -> np.ndarray:
        if not len(self.keys):
            return np.full(len(keys), -1, np.int64)
        out = self.table[self._slot(keys)].astype(np.int64)
        odd = np.flatnonzero((out >= 0) & (self.keys[out] != keys))
        if len(odd):
            at = np.minimum(np.searchsorted(self.keys, keys[odd]), len(self.keys) - 1)
            out[odd] = np.where(self.keys[at] == keys[odd], at, -1)
        return out


@dataclass
class Bitmap:
    """Whether a key may be in a set; bits: of its slots' number."""

    words: np.ndarray
    bits: int

    def __call__(self, keys: np.ndarray) -> np.ndarray:
        slot = keys.view(np.uint64) >> np.uint64(64 - self.bits)
        return (self.words[slot >> np.uint64(6)] >> (slot & np.uint64(63)) & np.uint64(1)).astype(bool)


@dataclass
class Tree:
    """total, distinct: tokens and words of the training documents; model: the table (k, base, gain) of the terms of all sequences.

    base: log10(count + 1) of a word; gain: what else a sequence adds to a score. The rest is the part that is broadcast.
    """

    total: int
    distinct: int
    model: DataFrame | None
    keys: np.ndarray
    base: np.ndarray
    gain: np.ndarray
    others: Bitmap
    depth: int
    find: Lookup = field(init=False)

    def local(self) -> Tree:
        return Tree(self.total, self.distinct, None, self.keys, self.base, self.gain, self.others, self.depth)

    def prepare(self) -> Tree:
        """Build the direct table, once per worker."""
        if not hasattr(self, "find"):
            self.find = Lookup(self.keys)
        return self

    @property
    def log_total(self) -> float:
        return math.log10(self.total + self.distinct + 1)


def _tokens(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(hash of every token, first token of each document), the end of each document included."""
    h, first = word_hashes(texts)
    starts = first + np.arange(len(first))
    out = np.full(starts[-1], END, np.int64)
    inner = np.ones(len(out), bool)
    inner[starts[1:] - 1] = False
    out[inner] = h.view(np.int64)
    return out, starts


def sequence_key(context: np.ndarray, event: np.ndarray) -> np.ndarray:
    """Key of a sequence from those of itself without its last and without its first token."""
    return mixed(context.view(np.uint64) * _NEXT + event.view(np.uint64)).view(np.int64)


def sequences(tokens: np.ndarray, starts: np.ndarray, most: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(places where they end, keys) of all sequences of 1, 2, ... most tokens that stay within a document."""
    begin = np.repeat(starts[:-1], np.diff(starts))
    at, keys = np.arange(len(tokens)), tokens
    yield at, keys
    for n in range(2, most + 1):
        whole = np.zeros(len(tokens), np.int64)
        whole[at] = keys
        at = at[at - begin[at] >= n - 1]
        keys = sequence_key(whole[at - 1], whole[at])
        yield at, keys


def _grouped(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(an order that brings equal keys together, where each key begins in it)."""
    order = np.argsort(keys)
    return order, _begins(keys[order])


def _begins(keys: np.ndarray) -> np.ndarray:
    """Where runs of equal keys begin."""
    return np.flatnonzero(np.append(True, keys[1:] != keys[:-1])[: len(keys)])


def _narrow(values: np.ndarray, below: int) -> np.ndarray:
    """values as 16-bit numbers, which numpy sorts by digits, if below allows it."""
    return values.astype(np.uint16) if below <= 1 << 16 else values


def _summed(parts: Iterator[tuple[np.ndarray, ...]], names: list[str]) -> Iterator[pa.RecordBatch]:
    """Rows of the parts' columns with n, how often each came (the first column tells them apart).

    They are summed within the task as far as memory of fixed size allows.
    """
    held: list[tuple[np.ndarray, ...]] = []

    def merge() -> list[tuple[np.ndarray, ...]]:
        *cols, n = (np.concatenate(c) for c in zip(*held, strict=True))
        order, first = _grouped(cols[0])
        return [(*(c[order[first]] for c in cols), np.add.reduceat(n[order], first) if len(n) else n)]

    def rows() -> pa.RecordBatch:
        cols = held[0] if len(names) == len(held[0]) else held[0][1:]
        return pa.RecordBatch.from_arrays([pa.array(c) for c in cols], names)

    size = 0
    for part in parts:
        order, first = _grouped(part[0])
        at = order[first]
        held.append((*(c[at] for c in part), np.diff(np.append(first, len(order)))))
        size += len(at)
        if size > HELD:
            held = merge()
            size = len(held[0][0])
            if size > HELD // 2:
                yield rows()
                held, size = [], 0
    if held:
        held = merge()
        yield rows()
    trim()


def word_counts(train: DataFrame) -> DataFrame:
    """(k, n): every token's count in column text, by the token's hash."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _summed(((_tokens(b.column(0))[0],) for b in sliced(batches)), ["k", "n"])

    return stored(train.select("text").mapInArrow(run, "k long, n long").groupBy("k").agg(F.sum("n").alias("n")))


def _bitmap(keys: DataFrame, count: int, bits: int) -> Bitmap:
    """A bitmap of keys (k): about eight slots a key, at most 2 ** bits."""
    bits = max(6, min(bits, (8 * max(count, 1)).bit_length()))
    cut = bits - min(6, bits - 6)  # a piece holds so many of a slot's lower bits

    def slots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []

        def flush() -> pa.RecordBatch:
            own = np.unique(np.concatenate(held))
            piece = own >> np.uint32(cut)
            begin = _begins(piece)
            own &= np.uint32((1 << cut) - 1)
            return pa.RecordBatch.from_arrays([pa.array(piece[begin].astype(np.int64)), pa.array([x.tobytes() for x in np.split(own, begin[1:])], pa.binary())], ["piece", "slots"])

        for b in batches:
            if b.num_rows:
                held.append((b.column(0).to_numpy().view(np.uint64) >> np.uint64(64 - bits)).astype(np.uint32))
            if sum(map(len, held)) >= HELD:
                yield flush()
                held.clear()
        if held:
            yield flush()

    def filled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, marks = None, np.zeros(1 << cut, bool)
        done = lambda: pa.RecordBatch.from_arrays([pa.array([last]), pa.array([np.packbits(marks, bitorder="little").tobytes()], pa.binary())], ["piece", "slots"])
        for b in batches:
            for piece, raw in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if last not in (None, piece):
                    yield done()
                    marks[:] = False
                last = piece
                marks[np.frombuffer(raw, np.uint32)] = True
        if last is not None:
            yield done()

    dealt = keys.select("k").mapInArrow(slots, "piece long, slots binary").repartition("piece").sortWithinPartitions("piece")
    rows = dealt.mapInArrow(filled, "piece long, slots binary").toArrow()  # at most 2 ** bits bits
    raw = np.zeros(1 << (bits - 3), np.uint8)
    for piece, part in zip(*(rows.column(c).to_pylist() for c in ("piece", "slots")), strict=True):
        raw[piece << (cut - 3) : (piece + 1) << (cut - 3)] = np.frombuffer(part, np.uint8)
    words = raw.view(np.uint64)
    return Bitmap(words, bits)


def _followers(train: DataFrame, order: int, seen: Bitmap | None, words: bool = False) -> DataFrame:
    """(k, g, e, n) of the sequences of order + 1 tokens that came LEAST times: context g, event e (without the first token).

    seen: what the sequences of order tokens that came LEAST times may be; others cannot be part of these.
    words: with all tokens, as events of the context NONE.
    """
    held = train.sparkSession.sparkContext.broadcast(seen)

    def found(b: pa.RecordBatch) -> tuple[np.ndarray, ...]:
        tokens, starts = _tokens(b.column(0))
        *_, (at, keys), (to, longer) = sequences(tokens, starts, order + 1)
        whole = np.zeros(len(tokens), np.int64)
        whole[at] = keys
        g, e = whole[to - 1], whole[to]
        if held.value is not None:
            use = held.value(g) & held.value(e)
            longer, g, e = longer[use], g[use], e[use]
        if words:
            longer, g, e = (np.concatenate(c) for c in ((longer, tokens), (g, np.full(len(tokens), NONE)), (e, tokens)))
        return longer, g, e

    buckets = _buckets(train, "text", COUNTED)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in _summed((found(b) for b in sliced(batches)), ["g", "e", "n"]):
            g, e, n = (c.to_numpy() for c in b.columns)
            order, kinds, edge = _by_bucket(sequence_key(g, e), buckets)
            parts = [order[x:y] for x, y in zip(edge[:-1], edge[1:], strict=True)]
            cols = [[np.concatenate([g[p], e[p]]).tobytes() for p in parts], [_small(n[p]) for p in parts]]
            yield pa.RecordBatch.from_arrays([pa.array(kinds), *(pa.array(c, pa.binary()) for c in cols)], ["bucket", "pairs", "counts"])

    dealt = train.select("text").mapInArrow(count, "bucket long, pairs binary, counts binary").repartition(buckets, "bucket").sortWithinPartitions("bucket")
    return stored(dealt.mapInArrow(_frequent, "k long, g long, e long, n long"))


def _small(values: np.ndarray) -> bytes:
    """Whole numbers from 0 up, in as many bytes each as the largest needs."""
    return values.astype(np.min_scalar_type(int(values.max(initial=0)))).tobytes()


def _whole(raw: bytes, count: int) -> np.ndarray:
    """The count numbers of _small."""
    return np.frombuffer(raw, f"u{len(raw) // max(count, 1) or 1}").astype(np.int64)


def _buckets(df: DataFrame, text_col: str, text_bytes: int) -> int:
    """As many as have text_bytes of text each, and enough to keep all cores at work."""
    size = df.agg(F.sum(F.octet_length(text_col))).first()[0] or 0
    return max(2, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-size // text_bytes))


def _frequent(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(k, g, e, n) of the sequences that came LEAST times; blocks of (g, e) and their counts come by bucket."""
    bucket, held = None, []

    def totals() -> Iterator[pa.RecordBatch]:
        g, e, n = (np.concatenate(c) for c in zip(*held, strict=True))
        k = sequence_key(g, e)
        order, first = _grouped(k)
        n = np.add.reduceat(n[order], first)
        often = (n >= LEAST) | (g[order[first]] == NONE)
        at = order[first[often]]
        t = pa.table([k[at], g[at], e[at], n[often]], ["k", "g", "e", "n"])
        yield from t.to_batches(max_chunksize=1 << 16)

    for b in batches:
        for at, pairs, counts in zip(*(c.to_pylist() for c in b.columns), strict=True):
            if at != bucket and held:
                yield from totals()
                held = []
            bucket, both = at, np.frombuffer(pairs, np.int64).reshape(2, -1)
            held.append((both[0], both[1], _whole(counts, both.shape[1])))
    if held:
        yield from totals()
    trim()


def _level(pairs: DataFrame, below: DataFrame, corpus: int, last: bool) -> tuple[DataFrame, DataFrame, list[DataFrame]]:
    """(table (k, n, p, x) of the sequences, terms (k, n, x) of the states, stored tables behind both).

    pairs: (k, g, e, n); below: (k, n, p) of the sequences one token shorter: count, and probability of the last token.
    x: the sequence's own term. last: only sequences whose context is a state are wanted.
    """
    near = stored(pairs.join(below.select(F.col("k").alias("e"), F.col("p").alias("was")), "e").select("k", "g", "n", "was"))
    sums = near.groupBy("g").agg(F.count("*").alias("kinds"), F.sum("n").alias("seen"), F.sum(F.col("n") * F.log(F.col("n") / F.col("was"))).alias("gain"), F.sum("was").alias("mass"))
    ctx = sums.join(below.select(F.col("k").alias("g"), F.col("n").alias("total")), "g")
    rest, total = F.col("total") - F.col("seen"), F.col("total").cast("double")
    other = F.when(rest > 0, rest * F.log(rest / total / F.greatest(1 - F.col("mass"), F.lit(1e-12)))).otherwise(0.0)
    ctx = ctx.where(F.col("gain") - F.col("seen") * F.log(total) + other > 0.5 * math.log(max(corpus, 2)) * F.col("kinds"))
    states = stored(ctx.select("g", "total", (F.col("total") + F.col("kinds") + 1).cast("double").alias("all"), ((rest + F.col("kinds") + 1) / (F.col("total") + F.col("kinds") + 1)).alias("back")))
    mixture = F.col("n") / F.col("all") + F.col("back") * F.col("was")
    p = F.when(F.col("back").isNull(), F.col("was")).otherwise(mixture)
    x = F.when(F.col("back").isNull(), F.lit(0.0)).otherwise(F.log10(mixture) - F.log10(F.col("back") * F.col("was")))
    table = near.join(states, "g", "inner" if last else "left").select("k", "n", p.alias("p"), x.alias("x"))
    if not last:
        table = stored(table)
        dropped(near)
    return table, states.select(F.col("g").alias("k"), F.col("total").alias("n"), F.log10("back").alias("x")), [near if last else table, states]


@contextmanager
def _hashed(spark: SparkSession) -> Iterator[None]:
    """Joins whose partitions are no larger than Spark's own advice need no sort in this block."""
    key = "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold"
    was = spark.conf.get(key)
    spark.conf.set(key, spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes"))
    try:
        yield
    finally:
        spark.conf.set(key, was)


def grow(train: DataFrame, counts: DataFrame | None = None, depth: int = DEPTH, min_word: float = MIN_WORD, min_pair: float = MIN_PAIR, bits: int = BITMAP) -> Tree:
    """The tree of the documents in train (column text). One pass over them per depth.

    counts: their word_counts, if these are known; else words are counted in the first pass.
    """
    with _hashed(train.sparkSession):
        return _grown(train, counts, depth, min_word, min_pair, bits)


def _grown(train: DataFrame, counts: DataFrame | None, depth: int, min_word: float, min_pair: float, bits: int) -> Tree:
    first = None
    if counts is None:
        both = _followers(train, 1, None, words=True)
        counts = stored(both.where(F.col("g") == NONE).select(F.col("e").alias("k"), "n"))
        first = both.where(F.col("g") != NONE)
    total, distinct = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    zero = F.lit(0.0)
    below = counts.select("k", "n", ((F.col("n") + 1) / F.lit(float(total + distinct + 1))).alias("p"))
    terms = counts.select("k", F.log10(F.col("n") + 1.0).alias("base"), zero.alias("gain"), "n", F.lit(1).alias("order"))
    seen, behind = None, []
    for order in range(1, depth + 1):
        pairs = _followers(train, order, seen) if first is None or order > 1 else first
        kinds = pairs.count()
        if not kinds:
            break
        below, states, tables = _level(pairs, below, total, order == depth)
        behind += tables
        for rows, size in ((below.where("x <> 0"), 2), (states, min(order, 2))):
            terms = terms.unionByName(rows.select("k", zero.alias("base"), F.col("x").alias("gain"), "n", F.lit(size).alias("order")))
        if order < depth:
            seen = _bitmap(pairs, kinds, bits)
        dropped(pairs)
    often = F.col("n") >= F.when(F.col("order") == 1, min_word).otherwise(min_pair) * F.lit(float(total))
    model = stored(terms.select("k", "base", "gain", often.alias("often")))  # all terms of a key are often or none; the others are added up where they are looked up
    for t in behind:
        dropped(t)
    top = model.where("often").groupBy("k").agg(F.sum("base").alias("base"), F.sum("gain").alias("gain")).toArrow()  # at most 1 / min_word + depth / min_pair rows
    order = np.argsort(top.column("k").to_numpy())
    rest = model.where("not often")
    k, base, gain = (top.column(c).to_numpy()[order] for c in ("k", "base", "gain"))
    return Tree(total, distinct, rest.select("k", "base", "gain"), k, base, gain, _bitmap(rest, rest.count(), bits), depth)


def _requests(tree: Tree, tokens: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, tuple[np.ndarray, np.ndarray]]:
    """(documents' known words and sums of base and gain as far as the broadcast part has them, ..., rows and keys to look up)."""
    n = len(starts) - 1
    row = np.repeat(np.arange(n), np.diff(starts))
    known, sums = np.zeros(n, np.int64), np.zeros((2, n))
    ask: list[tuple[np.ndarray, np.ndarray]] = []
    for order, (at, keys) in enumerate(sequences(tokens, starts, tree.depth + 1)):
        place = tree.find(keys)
        have = place >= 0
        r, p = row[at[have]], place[have]
        if order == 0:
            known += np.bincount(r, minlength=n)
            sums[0] += np.bincount(r, tree.base[p], minlength=n)
        sums[1] += np.bincount(r, tree.gain[p], minlength=n)
        rest = ~have & tree.others(keys)
        ask.append((row[at[rest]], keys[rest]))
    return known, sums, tuple(np.concatenate(c) for c in zip(*ask, strict=True))


_FIELDS = [("bucket", "long"), ("kind", "int"), ("part", "long"), ("row", "long"), ("n_tokens", "long"), ("known", "long"), ("base", "double"), ("gain", "double"), ("keys", "binary"), ("more", "binary")]
_TYPES = {"long": pa.int64(), "int": pa.int32(), "double": pa.float64(), "binary": pa.binary()}


def _packed(**cols) -> pa.RecordBatch:
    """A batch of _FIELDS; fields not given are null."""
    n = len(next(iter(cols.values())))
    return pa.RecordBatch.from_arrays([pa.array(cols[c], _TYPES[t]) if c in cols else pa.nulls(n, _TYPES[t]) for c, t in _FIELDS], [c for c, _ in _FIELDS])


def _by_bucket(keys: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(order that sorts keys by bucket, the buckets, where each begins and ends in it)."""
    bucket = _narrow((mixed(keys.view(np.uint64)) % np.uint64(buckets)).astype(np.int64), buckets)
    order = np.argsort(bucket, kind="stable")
    bucket = bucket[order]
    begin = _begins(bucket)
    return order, bucket[begin].astype(np.int64), np.append(begin, len(keys))


def _steps(rows: np.ndarray) -> bytes:
    """Ascending row numbers as steps from one to the next, which are small."""
    return _small(np.diff(rows, prepend=0))


def _rows(raw: bytes, count: int) -> np.ndarray:
    return np.cumsum(_whole(raw, count))


def _shelved(buckets: int):
    """The table's rows (k, base, gain) in binary blocks by bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def flush() -> pa.RecordBatch:
            k, base, gain = (np.concatenate([b.column(c).to_numpy(zero_copy_only=False) for b in held]) for c in range(3))
            order, kinds, edge = _by_bucket(k, buckets)
            value = np.stack([base, gain], 1)
            parts = [order[a:b] for a, b in zip(edge[:-1], edge[1:], strict=True)]
            return _packed(bucket=kinds, kind=np.zeros(len(kinds), np.int32), keys=[k[p].tobytes() for p in parts], more=[value[p].tobytes() for p in parts])

        for b in batches:
            held.append(b)
            if sum(x.num_rows for x in held) >= SENT:
                yield flush()
                held = []
        if held:
            yield flush()

    return run


def _answered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums per row for each block of requests; blocks come by bucket, the table's first. Documents' rows pass."""
    bucket, shelf, keys, value = None, [], np.zeros(0, np.int64), np.zeros((0, 2))
    for b in batches:
        kind = b.column(1).to_numpy()
        part, rows, sums = [], [], []
        for i in np.flatnonzero(kind < 2).tolist():
            at, k, more = b.column(0)[i].as_py(), np.frombuffer(b.column(8)[i].as_py(), np.int64), b.column(9)[i].as_py()
            if at != bucket:
                bucket, shelf, keys, value = at, [], np.zeros(0, np.int64), np.zeros((0, 2))
            if kind[i] == 0:
                shelf.append((k, np.frombuffer(more, np.float64).reshape(-1, 2)))
                continue
            if shelf:
                keys, value = (np.concatenate([own, *c]) for own, c in zip((keys, value), zip(*shelf, strict=True), strict=True))
                order, begin = _grouped(keys)
                keys, value, shelf = keys[order[begin]], np.add.reduceat(value[order], begin), []
            if not len(keys):
                continue
            place = np.minimum(np.searchsorted(keys, k), len(keys) - 1)
            hit = keys[place] == k
            row = _rows(more, len(k))[hit]
            begin = _begins(row)
            local, row = np.repeat(np.arange(len(begin)), np.diff(np.append(begin, len(row)))), row[begin]
            found = value[place[hit]]
            known, base, gain = (np.bincount(local, c, minlength=len(row)) for c in (found[:, 0] > 0, found[:, 0], found[:, 1]))
            part.append(b.column(2)[i].as_py())
            words = np.flatnonzero(known)  # few of the sequences are words
            rows.append(np.uint32(len(row)).tobytes() + _steps(row))
            sums.append(np.uint32(len(words)).tobytes() + gain.tobytes() + base[words].tobytes() + known[words].astype(np.uint32).tobytes() + _steps(words))
        if part:
            yield _with_id(_packed(kind=np.full(len(part), 3, np.int32), part=part, keys=rows, more=sums), b.schema)
        own = np.flatnonzero(kind == 2)
        if len(own):
            yield b.take(pa.array(own))
    trim()


def _answer(rows: bytes, sums: bytes) -> tuple[np.ndarray, ...]:
    """(rows, gains, which of the rows have known words, their number, their base) of an answer."""
    n, w = (int(np.frombuffer(x, np.uint32, 1)[0]) for x in (rows, sums))
    gain, base, known = (np.frombuffer(sums, t, c, at) for t, c, at in ((float, n, 4), (float, w, 4 + 8 * n), (np.uint32, w, 4 + 8 * (n + w))))
    return _rows(rows[4:], n), gain, _rows(sums[4 + 8 * n + 12 * w :], w), known, base


def _added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The documents' rows with the answers to their requests added; rows come by part."""
    held: list[pa.RecordBatch] = []

    def totals(b: pa.RecordBatch) -> pa.RecordBatch:
        own = b.filter(pa.array(b.column(1).to_numpy() == 2))
        row = own.column(3).to_numpy()
        sums = np.zeros((3, int(row.max(initial=-1)) + 1))
        answers = b.filter(pa.array(b.column(1).to_numpy() == 3))
        for keys, more in zip(answers.column(8).to_pylist(), answers.column(9).to_pylist(), strict=True):
            at, gain, words, known, base = _answer(keys, more)
            sums[2, at] += gain
            sums[0, at[words]] += known
            sums[1, at[words]] += base
        cols = dict(zip(own.schema.names, own.columns, strict=True))
        cols["known"] = pa.array(own.column(5).to_numpy() + sums[0, row].astype(np.int64))
        cols["base"], cols["gain"] = (pa.array(own.column(c).to_numpy() + sums[c - 5, row]) for c in (6, 7))
        names = ["id", "held_out", "n_tokens", "known", "base", "gain"]
        return pa.RecordBatch.from_arrays([cols[c] for c in names], ["id", "held_out", "n_tokens", "n_known", "base", "gain"])

    for b in batches:
        part = b.column(2).to_numpy()
        edge = [0, *(np.flatnonzero(part[1:] != part[:-1]) + 1).tolist(), len(part)]
        for x, y in zip(edge[:-1], edge[1:], strict=True):
            if x == y:
                continue
            if held and held[-1].column(2)[0].as_py() != part[x]:
                yield totals(pa.concat_batches(held))
                held = []
            held.append(b.slice(x, y - x))
    if held:
        yield totals(pa.concat_batches(held))


def _with_id(b: pa.RecordBatch, schema: pa.Schema) -> pa.RecordBatch:
    """b with the two columns of documents that the schema ends with, as nulls."""
    more = [pa.nulls(b.num_rows, schema.field(c).type) for c in ("id", "held_out")]
    return pa.RecordBatch.from_arrays([*b.columns, *more], [*b.schema.names, "id", "held_out"])


def score(docs: DataFrame, tree: Tree, id_col: str = "doc_id", text_col: str = "text", held_out: Column | None = None) -> DataFrame:
    """One row per input row: id, held_out, n_tokens, n_known, train_tokens, base_score, score."""
    spark = docs.sparkSession
    slim = docs.select(F.col(id_col).alias("id"), (F.lit(False) if held_out is None else held_out).alias("held_out"), F.col(text_col).alias("text"))
    buckets = _buckets(slim, "text", BUCKET)
    enough = max(SENT, min(MOST_SENT, EACH * buckets))
    held = spark.sparkContext.broadcast(tree.local())

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        own, part, rows, asked = held.value.prepare(), TaskContext.get().partitionId() << 32, 0, []

        def flush() -> pa.RecordBatch:
            row, keys = (np.concatenate(c) for c in zip(*asked, strict=True))
            order = np.argsort(_narrow(row, rows), kind="stable")
            row, keys = row[order], keys[order]
            order, kinds, edge = _by_bucket(keys, buckets)
            parts = [order[a:b] for a, b in zip(edge[:-1], edge[1:], strict=True)]
            n = len(kinds)
            return _packed(bucket=kinds, kind=np.ones(n, np.int32), part=np.full(n, part), keys=[keys[p].tobytes() for p in parts], more=[_steps(row[p]) for p in parts])

        schema = None
        for b in sliced(batches):
            schema = b.schema
            tokens, starts = _tokens(b.column(2))
            known, sums, (row, keys) = _requests(own, tokens, starts)
            n = b.num_rows
            place = np.arange(rows, rows + n)
            own_rows = _packed(bucket=(place + part) % buckets, kind=np.full(n, 2, np.int32), part=np.full(n, part), row=place, n_tokens=np.diff(starts), known=known, base=sums[0], gain=sums[1])
            yield pa.RecordBatch.from_arrays([*own_rows.columns, b.column(0), b.column(1)], [*own_rows.schema.names, "id", "held_out"])
            asked.append((row + rows, keys))
            rows += n
            if rows >= ROWS or sum(len(k) for _, k in asked) >= enough:
                yield _with_id(flush(), schema)
                part, rows, asked = part + 1, 0, []
        if asked:
            yield _with_id(flush(), schema)
        trim()

    names = ", ".join(f"{c} {t}" for c, t in _FIELDS)
    whole = f"{names}, id {docs.schema[id_col].dataType.simpleString()}, held_out boolean"
    shelf = tree.model.mapInArrow(_shelved(buckets), names)
    rows = slim.mapInArrow(ask, whole).unionByName(shelf, allowMissingColumns=True)
    dealt = rows.repartition(buckets, "bucket").sortWithinPartitions("bucket", "kind").mapInArrow(_answered, whole)
    kind = docs.schema[id_col].dataType.simpleString()
    sums = dealt.repartition("part").sortWithinPartitions("part").mapInArrow(_added, f"id {kind}, held_out boolean, n_tokens long, n_known long, base double, gain double")
    base = F.col("base") - F.col("n_tokens") * F.lit(tree.log_total)
    return sums.select("id", "held_out", "n_tokens", "n_known", F.lit(tree.total).cast("long").alias("train_tokens"), base.alias("base_score"), (base + F.col("gain")).alias("score"))


def crc_fold(id_col: str, folds: int = 7) -> Column:
    """crc32 of the id as text, modulo folds."""
    return F.pmod(F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")), F.lit(folds))
