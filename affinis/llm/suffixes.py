"""Suffix-array dedup: remove every byte that a WIDTH-byte string covers which also starts anywhere else.

Suffixes are sorted in two stages: only those smaller than their successors are compared; the others are induced by
scanning the buckets of first bytes in order, as each follows its successor. Adjacent suffixes with a common prefix of
WIDTH bytes are repeats.

So that no suffix array has to span the corpus, its suffixes are first dealt into buckets that hold all their repeats.
In each WIDTH-byte string the smallest hash of a GRAM-byte string is its anchor; equal strings have equal anchors at
equal places. The strings of one anchor stand side by side in its text and form a context (about 280 bytes). Contexts
whose anchor occurs once hold no repeat; contexts that occur twice hold nothing else. What remains, the rims of
repeated passages, goes to the suffix array of its anchor's bucket. A bucket with more than HOT different contexts, as
of a passage that a third of the corpus quotes, isn't gathered in a task: its strings are counted by a hash of
all their bytes, with partial sums, first STRIDE neighbours at once and one by one where these differ.

Texts are known by 128 bits of their hash, so copies are handled once. Nulls and edge cases: a null text is empty; texts
shorter than WIDTH lose nothing; repeated rows are repeats of each other; a null id stays null; an empty table gives an
empty result; other input columns are ignored (clashing names are safe).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored
from .textops import gram_hash, mixed, prefix_hash, raw, sliced, trimmed

WIDTH, GRAM = 200, 32
#: Different contexts of one anchor that one task sorts; beyond it their strings are counted by hash.
HOT = 1024
#: Neighbouring strings of hot buckets that are counted at once.
STRIDE = 16
#: Bytes of contexts in one suffix array.
BLOCK = 1 << 19


def suffix_order(text: np.ndarray, active: np.ndarray, depth: int) -> np.ndarray:
    """The active places of text in the order of their suffixes, exact to depth bytes at least.

    text: bytes, 0 ends each of its strings and comes nowhere else; active: flags; each run of active places that ends
    before a string's end must end with a suffix smaller than its successor.
    """
    n = len(text)
    padded = np.concatenate([text, np.zeros(16, np.uint8)])
    differs = np.flatnonzero(padded[: n + 1][:-1] != padded[1 : n + 1])
    if not len(differs):
        differs = np.array([n - 1])
    to = np.minimum(np.searchsorted(differs, np.arange(n)), len(differs) - 1)
    smaller = padded[differs[to]] < padded[differs[to] + 1]
    smaller[text == 0] = True  # an end is sorted directly, before all else
    word = padded[:n].astype(np.uint64)
    wide = np.concatenate([word, np.zeros(8, np.uint64)])
    for step in (1, 2, 4):
        wide[:-step] = (wide[:-step] << np.uint64(8 * step)) | wide[step:]
    # First stage: compare eight bytes at a time, only where all before were equal.
    places = np.flatnonzero(active & smaller)
    order = places[np.argsort(wide[places], kind="stable")]
    key = wide[order]
    same = np.concatenate([[False], key[1:] == key[:-1]])
    at, ends = 8, _ended(wide[order])
    while at < depth + 8:
        tied = same.copy()
        tied[:-1] |= same[1:]
        live = np.flatnonzero(tied & ~ends)
        if not len(live):
            break
        group = np.cumsum(~same[live] | (np.concatenate([[True], live[1:] != live[:-1] + 1])))
        deep = wide[np.minimum(order[live] + at, n + 7)]
        by = np.lexsort((deep, group))
        order[live] = order[live][by]
        deep, group = deep[by], group[by]
        same[live] &= np.concatenate([[False], (deep[1:] == deep[:-1]) & (group[1:] == group[:-1])])
        ends[live] = _ended(deep)
        at += 8
    # Second stage: a larger suffix comes right after the others of its first byte that its successor's order puts first.
    induced: list[list[np.ndarray]] = [[] for _ in range(256)]
    direct = np.searchsorted(text[order], np.arange(257))
    out = []
    larger = active & ~smaller

    def hand(found: np.ndarray) -> None:
        before = found[found > 0] - 1
        before = before[larger[before]]
        first = text[before]
        by = np.argsort(first, kind="stable")
        cut = np.searchsorted(first[by], np.arange(257))
        for c in np.unique(first):
            induced[c].append(before[by[cut[c] : cut[c + 1]]])

    for c in range(256):
        while induced[c]:
            found = np.concatenate(induced[c])
            induced[c] = []
            out.append(found)
            hand(found)
        found = order[direct[c] : direct[c + 1]]
        out.append(found)
        hand(found)
    return np.concatenate(out)


def _ended(words: np.ndarray) -> np.ndarray:
    """Which eight-byte words hold an end: what follows it doesn't count."""
    low, high = np.uint64(0x0101010101010101), np.uint64(0x8080808080808080)
    return ((words - low) & ~words & high) != 0


def repeats(contexts: list[bytes], strings: np.ndarray, width: int = WIDTH) -> list[np.ndarray]:
    """For each context flags of its first strings[i] places: whether their width bytes come again at another place."""
    size = np.array([len(c) for c in contexts])
    begin = np.concatenate([[0], np.cumsum(size + 1)])
    text = np.zeros(begin[-1], np.uint8)
    for at, c in zip(begin, contexts, strict=False):
        text[at : at + len(c)] = np.frombuffer(c, np.uint8)
    text[text > 0] += 1  # UTF-8 has no byte 255
    zero = np.zeros(len(text), bool)
    zero[begin[1:] - 1] = True
    text[~zero & (text == 0)] = 1
    step = np.zeros(len(text) + 1, np.int64)
    np.add.at(step, begin[:-1], 1)
    np.add.at(step, begin[:-1] + strings, -1)
    wanted = np.cumsum(step[:-1]) > 0
    active = wanted.copy()
    last = begin[:-1] + strings  # go on from the last wanted place to where a suffix is smaller than its successor
    while len(last):
        p = last - 1
        larger = (text[p] > text[p + 1]) | (text[p] == text[p + 1])
        last = last[larger & (text[p] != 0)]
        active[last] = True
        last = last + 1
        last = last[last < len(text)] if len(last) else last
    order = suffix_order(text, active, width)
    order = order[wanted[order]]
    padded = np.concatenate([text, np.zeros(8, np.uint8)]).astype(np.uint64)
    for by in (1, 2, 4):
        padded[:-by] = (padded[:-by] << np.uint64(8 * by)) | padded[by:]
    pair = np.arange(1, len(order))
    for at in [*range(0, width - 8, 8), width - 8]:  # adjacent common prefixes, as far as they decide
        pair = pair[padded[order[pair] + at] == padded[order[pair - 1] + at]]
    flag = np.zeros(len(text), bool)
    flag[order[pair]] = flag[order[pair - 1]] = True
    return [flag[b : b + s] for b, s in zip(begin, strings, strict=False)]


def contexts_of(data: np.ndarray, off: np.ndarray, width: int = WIDTH, gram: int = GRAM) -> tuple[np.ndarray, ...]:
    """(text's index, first and last string's start and the anchor in its text, hashes of anchor and context) of each context."""
    empty = tuple(np.zeros(0, t) for t in (np.int64, np.int64, np.int64, np.int64, np.uint64, np.uint64))
    grams = len(data) - gram + 1
    span = width - gram + 1
    if len(data) < width:
        return empty
    h = prefix_hash(data)
    start = np.arange(grams)
    hashed = gram_hash(h, start, start + gram)
    key = (hashed >> np.uint64(32) << np.uint64(32)) | start.astype(np.uint64)
    blocks = -(-grams // span)
    grid = np.full(blocks * span, np.uint64(2**64 - 1))
    grid[:grams] = key
    grid = grid.reshape(blocks, span)
    fore = np.minimum.accumulate(grid, 1).ravel()
    aft = np.minimum.accumulate(grid[:, ::-1], 1)[:, ::-1].ravel()
    starts = len(data) - width + 1
    anchor = (np.minimum(aft[:starts], fore[span - 1 : span - 1 + starts]) & np.uint64(0xFFFFFFFF)).astype(np.int64)
    room = np.zeros(len(data) + 1, np.int64)
    long = np.flatnonzero(np.diff(off) >= width)
    np.add.at(room, off[long], 1)
    np.add.at(room, off[long + 1] - width + 1, -1)
    fits = np.cumsum(room)[:starts] > 0
    fresh = fits.copy()
    fresh[1:] &= (anchor[1:] != anchor[:-1]) | ~fits[:-1]
    if not fresh.any():
        return empty
    done = fits.copy()
    done[:-1] &= (anchor[1:] != anchor[:-1]) | ~fits[1:]
    lo, hi = np.flatnonzero(fresh), np.flatnonzero(done)
    row = np.searchsorted(off, lo, "right") - 1
    at = anchor[lo]
    whole = mixed(gram_hash(h, lo, hi + width) + (at - lo).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    return row, lo - off[row], hi - off[row], at - off[row], hashed[at], whole


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64))


def _anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in sliced(batches):
        row, lo, hi, at, fp, ctx = contexts_of(*raw(b.column(2)))
        yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(row)), b.column(1).take(pa.array(row)), _signed(fp), _signed(ctx), pa.array(lo << 16 | (hi - lo) << 8 | (at - lo))], ["h1", "h2", "fp", "ctx", "at"])


def _clipped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Contexts' bytes from (text, members)."""
    for b in sliced(batches):
        out: list[list] = [[] for _ in range(8)]
        for text, h1, h2, members in zip(*(b.column(k).to_pylist() for k in range(4)), strict=True):
            data = text.encode()
            for m in members:
                lo, n = m["at"] >> 16, m["at"] >> 8 & 0xFF
                for c, x in zip(out, (m["fp"], h1, h2, lo, n + 1, m["n"], data[lo : lo + n + WIDTH], m["at"] & 0xFF), strict=True):
                    c.append(x)
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, [pa.int64()] * 6 + [pa.binary(), pa.int64()], strict=True)], ["fp", "h1", "h2", "lo", "strings", "n", "bytes", "shift"])


def _runs(h1: list[int], h2: list[int], lo: list[int], flags: list[np.ndarray]) -> pa.RecordBatch:
    out: list[list[int]] = [[], [], [], []]
    for a, b, at, flag in zip(h1, h2, lo, flags, strict=True):
        edge = np.flatnonzero(np.diff(np.concatenate([[0], flag.view(np.int8), [0]])))
        for s, e in edge.reshape(-1, 2).tolist():
            for c, x in zip(out, (a, b, at + s, at + e - 1), strict=True):
                c.append(x)
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in out], ["h1", "h2", "lo", "hi"])


def _sorted_buckets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Repeated strings of the contexts, which come sorted by anchor; whole buckets fill a suffix array."""
    held: list[tuple] = []

    def flush(rows: list[tuple]) -> pa.RecordBatch:
        flags = repeats([r[6] for r in rows], np.array([r[4] for r in rows]))
        own = [k for k, r in enumerate(rows) if r[5] == 1]  # others are known to be repeats
        return _runs([rows[k][1] for k in own], [rows[k][2] for k in own], [rows[k][3] for k in own], [flags[k] for k in own])

    size = 0
    for b in batches:
        for r in zip(*(c.to_pylist() for c in b.columns), strict=True):
            if size >= BLOCK and r[0] != held[-1][0]:
                yield flush(held)
                held, size = [], 0
            held.append(r)
            size += len(r[6])
    if held:
        yield flush(held)


def _gathered(part: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(prefix hash of all contexts, where each begins, its number of strings)."""
    n = np.array(part.column(4).to_pylist(), np.int64)
    return prefix_hash(np.frombuffer(b"".join(part.column(6).to_pylist()), np.uint8)), np.concatenate([[0], np.cumsum(n + WIDTH - 1)])[:-1], n


def _rows(row: np.ndarray, part: pa.RecordBatch, **more: np.ndarray) -> pa.RecordBatch:
    take = pa.array(row)
    cols = [part.column(c).take(take) for c in (0, 1, 2, 5)]
    return pa.RecordBatch.from_arrays([*(pa.array(x.view(np.int64) if x.dtype == np.uint64 else x) for x in more.values()), *cols], [*more, "fp", "h1", "h2", "n"])


def _hashed_groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Groups of up to STRIDE strings of hot buckets: the hash of what all of them share, and of what they cover.

    Groups begin at multiples of STRIDE from the anchor, so equal strings stand in equal groups.
    """
    for b in batches:
        for k in range(0, b.num_rows, 2000):
            part = b.slice(k, 2000)
            h, begin, n = _gathered(part)
            shift = np.array(part.column(7).to_pylist(), np.int64)
            first, last = -((shift + STRIDE - 1) // STRIDE), (n - 1 - shift) // STRIDE
            count = last - first + 1
            row = np.repeat(np.arange(len(n)), count)
            at = np.repeat(first, count) + np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
            lo = np.maximum(at * STRIDE + shift[row], 0)
            hi = np.minimum(at * STRIDE + shift[row] + STRIDE - 1, n[row] - 1)
            shared = begin[row] + at * STRIDE + shift[row]  # what every string of the group holds, however the context cuts it
            core = gram_hash(h, shared + STRIDE - 1, shared + WIDTH)
            whole = mixed(gram_hash(h, begin[row] + lo, begin[row] + hi + WIDTH) + (lo - shift[row]).astype(np.uint64))
            base = np.array(part.column(3).to_pylist(), np.int64)[row]
            yield _rows(row, part, at=at, core=core, whole=whole, c=base, lo=base + lo, hi=base + hi)


def _hashed_strings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each string of a group by a hash of its bytes."""
    for b in batches:
        for k in range(0, b.num_rows, 2000):
            part = b.slice(k, 2000)
            h, begin, n = _gathered(part)
            row = np.repeat(np.arange(len(n)), n)
            place = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
            start = begin[row] + place
            yield _rows(row, part, w=gram_hash(h, start, start + WIDTH), s=np.array(part.column(3).to_pylist(), np.int64)[row] + place)


def _keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts without the bytes of their ranges."""
    for b in sliced(batches):
        out: list[list] = [[], [], [], [], []]
        for h1, h2, text, ranges in zip(*(c.to_pylist() for c in b.columns), strict=True):
            data = np.frombuffer(text.encode(), np.uint8)
            step = np.zeros(len(data) + 1, np.int64)
            np.add.at(step, [r["lo"] for r in ranges], 1)
            np.add.at(step, [r["hi"] + WIDTH for r in ranges], -1)
            gone = np.cumsum(step[:-1]) > 0
            spans = int(gone[:1].sum() + (gone[1:] & ~gone[:-1]).sum())
            for c, x in zip(out, (h1, h2, int(gone.sum()), spans, data[~gone].tobytes()), strict=True):
                c.append(x)
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, [pa.int64()] * 4 + [pa.binary()], strict=True)], ["h1", "h2", "n_removed", "n_spans", "kept"])


def hashes(text) -> list:
    """128 bits that stand for a text."""
    return [F.xxhash64(text).alias("h1"), F.xxhash64(F.lit("second"), text).alias("h2")]


def _counted(contexts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(h1, h2, lo, hi) of repeated strings in hot buckets, found in groups and one by one."""
    tail = "fp long, h1 long, h2 long, n long"
    groups = stored(contexts.mapInArrow(trimmed(_hashed_groups), f"at long, core long, whole long, c long, lo long, hi long, {tail}"))
    kinds = stored(groups.groupBy("fp", "at", "core", "whole").agg(F.sum("n").alias("uses"), F.min(F.struct("h1", "h2", "c", "lo", "hi")).alias("own")))
    sure = groups.where("n = 1").join(kinds.where("uses > 1").select("fp", "at", "core", "whole"), ["fp", "at", "core", "whole"]).select("h1", "h2", "lo", "hi")
    rims = stored(kinds.groupBy("fp", "at", "core").agg(F.count("*").alias("kinds"), F.min("uses").alias("least")).where("kinds > 1 and least = 1").select("fp", "at", "core"))
    few = kinds.join(rims, ["fp", "at", "core"]).select("fp", "uses", "own.*")
    text = contexts.select("fp", "h1", "h2", F.col("lo").alias("c"), "bytes")
    size = F.col("hi") - F.col("lo")
    part = few.join(text, ["fp", "h1", "h2", "c"]).select("fp", "h1", "h2", "lo", (size + 1).alias("strings"), F.col("uses").alias("n"), F.substr("bytes", (F.col("lo") - F.col("c") + 1).cast("int"), (size + WIDTH).cast("int")).alias("bytes"))
    strings = stored(part.mapInArrow(trimmed(_hashed_strings), f"w long, s long, {tail}"))
    twice = stored(strings.groupBy("w", "fp").agg(F.sum("n").alias("uses")).where("uses > 1").select("w", "fp"))
    return sure, strings.where("n = 1").join(twice, ["w", "fp"]).select("h1", "h2", F.col("s").alias("lo"), F.col("s").alias("hi"))


def cut_repeats(texts: DataFrame) -> DataFrame:
    """(h1, h2, n_removed, n_spans, kept) of each different text that loses something; texts: a column text, not null."""
    slim = texts.select(*hashes(F.col("text")), "text").where(F.octet_length("text") >= WIDTH)
    anchors = stored(slim.mapInArrow(_anchors, "h1 long, h2 long, fp long, ctx long, at long"))
    often = stored(anchors.groupBy("fp").agg(F.count("*").alias("total")).where("total > 1").select("fp"))  # stored, so that a hot key's rows can be split
    again = stored(anchors.join(often, "fp"))
    kinds = again.groupBy("fp", "ctx").agg(F.count("*").alias("n"), F.min(F.struct("h1", "h2", "at")).alias("own"))
    kinds = stored(kinds)
    sure = again.join(kinds.where("n > 1").select("fp", "ctx"), ["fp", "ctx"]).groupBy("h1", "h2", "at").agg(F.first("fp").alias("fp"))
    sure = sure.select("h1", "h2", F.expr("at >> 16").alias("lo"), F.expr("(at >> 16) + ((at >> 8) & 255)").alias("hi"))
    open_ = kinds.groupBy("fp").agg(F.count("*").alias("kinds"), F.min("n").alias("least")).where("kinds > 1 and least = 1").select("fp", (F.col("kinds") > HOT).alias("hot"))
    open_ = stored(open_)
    members = kinds.join(open_, "fp").select("own.h1", "own.h2", F.struct("fp", "own.at", "n", "hot").alias("m"))
    keys = again.groupBy("h1", "h2").agg(F.first("fp").alias("any")).select("h1", "h2")
    found = stored(slim.join(keys, ["h1", "h2"], "left_semi").dropDuplicates(["h1", "h2"]))
    listed = found.join(members.groupBy("h1", "h2").agg(F.collect_list("m").alias("m")), ["h1", "h2"])
    clip = "fp long, h1 long, h2 long, lo long, strings long, n long, bytes binary, shift long"
    pick = lambda hot: F.filter("m", lambda x: x["hot"] == hot)
    clipped = [listed.select("text", "h1", "h2", pick(hot).alias("m")).where(F.size("m") > 0).mapInArrow(trimmed(_clipped), clip) for hot in (False, True)]
    count = max(2, int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    by_sort = clipped[0].repartition(count, "fp").sortWithinPartitions("fp").mapInArrow(trimmed(_sorted_buckets), "h1 long, h2 long, lo long, hi long")
    by_group, by_hash = _counted(stored(clipped[1]))
    spans = sure.unionByName(by_sort).unionByName(by_group).unionByName(by_hash).groupBy("h1", "h2").agg(F.collect_list(F.struct("lo", "hi")).alias("r"))
    return found.join(spans, ["h1", "h2"]).select("h1", "h2", "text", "r").mapInArrow(trimmed(_keep), "h1 long, h2 long, n_removed long, n_spans long, kept binary")


def dedup(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id, n_bytes, n_removed, n_spans, kept_sha256."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = df.select(F.col(id_col).alias("id"), *hashes(text), F.octet_length(text).cast("long").alias("n_bytes"), F.sha2(text, 256).alias("whole"))
    cut = cut_repeats(df.select(text.alias("text"))).select("h1", "h2", "n_removed", "n_spans", F.sha2("kept", 256).alias("sha"))
    zero = F.lit(0).cast("long")
    return rows.join(cut, ["h1", "h2"], "left").select("id", "n_bytes", F.coalesce("n_removed", zero).alias("n_removed"), F.coalesce("n_spans", zero).alias("n_spans"), F.coalesce("sha", "whole").alias("kept_sha256"))


def _readable(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array([x.decode(errors="ignore") for x in b.column(2).to_pylist()], pa.string())], ["_cut_1", "_cut_2", "_cut_text"])


def dedup_texts(df: DataFrame, text_col: str = "text") -> DataFrame:
    """df with the repeats cut out of its texts (characters that a cut splits go whole); no row is dropped."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    cut = cut_repeats(df.select(text.alias("text"))).select("h1", "h2", "kept").mapInArrow(trimmed(_readable), "_cut_1 long, _cut_2 long, _cut_text string")
    h = hashes(text)
    out = df.withColumns({"_cut_1": h[0], "_cut_2": h[1]}).join(stored(cut), ["_cut_1", "_cut_2"], "left")
    cols = {text_col: F.coalesce("_cut_text", F.col(text_col))}
    if "n_chars" in df.columns:
        cols["n_chars"] = F.when(F.col("_cut_text").isNotNull(), F.length("_cut_text").cast(df.schema["n_chars"].dataType)).otherwise(F.col("n_chars"))
    return out.select(*[cols[c].alias(c) if c in cols else F.col(f"`{c}`") for c in df.columns])
