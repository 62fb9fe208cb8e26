"""Near-duplicate detection by a chosen-path set similarity join.

Documents are sets of five-word shingles, and equal sets are one vertex. In each of several independent trees a node's documents
branch by the minwise token of a coordinate that the path to the node chooses; nodes of up to SMALL documents are
compared exhaustively, larger ones branch on, to DEPTH. Two documents of similarity s share a node of depth d with
probability s**d in one tree, so with depth 3 and the trees that the threshold asks for (8 at 0.85, 11 at 0.80) 99.95 % of
links are met, and nearly all where nodes are small after one step. Nodes that are large even then hold groups of near copies: their documents meet in blocks,
each with the node's pivots, and when the links so found have been joined up, every document outside a node's largest
component is compared with the whole node, tile by tile. Signatures choose what is compared, and sets travel only for what
they choose; every link is confirmed on full sets. Within a block, pairs that are connected already are not compared again, so work and output stay linear.

Components come from minimum labels with pointer jumping. Nulls and edge cases: a text without words (or null) has no
shingles and is linked with nothing; a text of fewer than five words is one shingle; rows that repeat an id are one
document, linked by any of its texts; a row with a null id is linked with nothing, its component is null and it is kept;
an empty table gives an empty result; other input columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import dropped, stacked, stored
from .textops import mixed, sliced, trimmed, word_hashes

WORDS, PERCENT = 5, 85
DEPTH, SMALL, PIVOTS = 3, 24, 2
#: Documents on each side of a tile, in which only documents of different components are compared.
TILE = 512
#: Coordinates of a signature, and the share of links at the threshold that no tree may meet.
COORDINATES, UNMET = 128, 5e-4

_RNG = np.random.default_rng(77)
_MULTIPLY = _RNG.integers(0, 2**63, COORDINATES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_FLIP = _RNG.integers(0, 2**63, COORDINATES, dtype=np.uint64)
_PLACE = _RNG.integers(0, 2**63, WORDS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def trees_for(percent: int) -> int:
    """Trees that leave at most UNMET of the links at the threshold unmet where all nodes are large."""
    return math.ceil(math.log(UNMET) / math.log1p(-((percent / 100) ** DEPTH)))


def least_equal(percent: int) -> float:
    """The share of equal coordinates from which a pair is compared in full: four standard deviations below the threshold."""
    s = percent / 100
    return s - 4 * math.sqrt(s * (1 - s) / COORDINATES)


def shingle_sets(texts: pa.Array, size: int = WORDS) -> Iterator[np.ndarray]:
    """Sorted distinct 64-bit hashes of each text's shingles."""
    w, first = word_hashes(texts)
    whole = np.zeros(max(len(w) - size + 1, 0), np.uint64)
    for k in range(size):
        whole += w[k : k + len(whole)] * _PLACE[k]
    whole = mixed(whole)
    for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
        if b - a >= size:
            yield np.unique(whole[a : b - size + 1])
        elif b > a:
            yield mixed((w[a:b] * _PLACE[: b - a]).sum(keepdims=True) + np.uint64(b - a))
        else:
            yield np.zeros(0, np.uint64)


def set_key(s: np.ndarray) -> tuple[int, int]:
    """128 bits that stand for a set."""
    return int(mixed(s).sum().astype(np.int64)), int(mixed(s ^ np.uint64(0x5BF03635)).sum().astype(np.int64))


def signature(s: np.ndarray) -> np.ndarray:
    """The minwise token of each coordinate, as 32-bit numbers."""
    out = np.full(COORDINATES, np.uint64(2**64 - 1))
    for k in range(0, len(s), 2048):
        np.minimum(out, ((s[k : k + 2048, None] ^ _FLIP) * _MULTIPLY).min(0), out=out)
    return (out >> np.uint64(32)).astype(np.uint32).view(np.int32)


def _profiles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in sliced(batches):
        sets = list(shingle_sets(b.column(1)))
        keys = [set_key(s) for s in sets]
        sig = np.concatenate([signature(s) for s in sets]).reshape(-1)
        lists = pa.ListArray.from_arrays(pa.array(np.arange(len(sets) + 1, dtype=np.int32) * COORDINATES), pa.array(sig))
        yield pa.RecordBatch.from_arrays([b.column(0), pa.array([len(s) for s in sets], pa.int64()), pa.array([k for k, _ in keys], pa.int64()), pa.array([k for _, k in keys], pa.int64()), lists], ["id", "n", "k1", "k2", "sig"])


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in sliced(batches):
        sets = list(shingle_sets(b.column(0)))
        keys = [set_key(s) for s in sets]
        yield pa.RecordBatch.from_arrays([pa.array([k for k, _ in keys], pa.int64()), pa.array([k for _, k in keys], pa.int64()), pa.array([s.tobytes() for s in sets], pa.binary())], ["k1", "k2", "set"])


class Union:
    """Joined-up members of one block."""

    def __init__(self, n: int):
        self.up = list(range(n))

    def root(self, i: int) -> int:
        while self.up[i] != i:
            self.up[i] = self.up[self.up[i]]
            i = self.up[i]
        return i

    def join(self, i: int, j: int) -> None:
        self.up[max(i, j)] = min(i, j)


def hopeful(sig: np.ndarray, percent: int = PERCENT) -> list[list[int]]:
    """Groups of rows of sig that chains of hopeful pairs connect; single rows left out."""
    u, least = Union(len(sig)), least_equal(percent)
    for i in range(len(sig) - 1):
        for j in (np.flatnonzero((sig[i + 1 :] == sig[i]).mean(1) >= least) + i + 1).tolist():
            a, b = u.root(i), u.root(j)
            if a != b:
                u.join(a, b)
    groups: dict[int, list[int]] = {}
    for i in range(len(sig)):
        groups.setdefault(u.root(i), []).append(i)
    return [g for g in groups.values() if len(g) > 1]


def _blocks(percent: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Members to compare in full, from the signatures of a block's documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for block in b.column(0).to_pylist():
                v = [x["v"] for x in block]
                sig = np.array([x["sig"] for x in block], np.int32)
                out += [sorted({v[i] for i in g}) for g in hopeful(sig, percent)]
            yield pa.RecordBatch.from_arrays([pa.array([x for x in out if len(x) > 1], pa.list_(pa.int64()))], ["members"])

    return run


def linked(a: np.ndarray, b: np.ndarray, percent: int = PERCENT) -> bool:
    """Whether 100 * |a & b| >= percent * |a | b|, for sorted sets."""
    if 100 * min(len(a), len(b)) < percent * max(len(a), len(b)):
        return False
    both = np.concatenate([a, b])
    both.sort(kind="stable")
    shared = int((both[1:] == both[:-1]).sum())
    return 100 * shared >= percent * (len(both) - shared)


def _confirmed(percent: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Links (a, b), a spanning forest of each block; rows (block, v, set) come sorted by block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def flush(v: list[int], sets: list[bytes], out: list[list[int]]) -> None:
            own = [np.frombuffer(s, np.uint64) for s in sets]
            u = Union(len(v))
            for i in range(len(v)):
                for j in range(i + 1, len(v)):
                    a, b = u.root(i), u.root(j)
                    if a != b and linked(own[i], own[j], percent):
                        u.join(a, b)
                        out[0].append(v[i])
                        out[1].append(v[j])

        now, v, sets = None, [], []
        for b in batches:
            out: list[list[int]] = [[], []]
            for block, x, s in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if block != now and v:
                    flush(v, sets, out)
                    v, sets = [], []
                now = block
                v.append(x)
                sets.append(s)
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in out], ["a", "b"])
        if v:
            out = [[], []]
            flush(v, sets, out)
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in out], ["a", "b"])

    return run


def _tiled(batches: Iterator[pa.RecordBatch], judge: Callable[[list[tuple]], list[tuple[int, int]]], names: list[str]) -> Iterator[pa.RecordBatch]:
    """What judge says of each tile; rows (block, v, label, sig, ...) come sorted by block."""
    held: dict[int, tuple] = {}
    now = None

    def judged() -> pa.RecordBatch:
        found = judge(list(held.values()))
        return pa.RecordBatch.from_arrays([pa.array([x[k] for x in found], pa.int64()) for k in (0, 1)], names)

    for b in batches:
        for r in zip(*(c.to_pylist() for c in b.columns), strict=True):
            if r[0] != now and held:
                yield judged()
                held = {}
            now = r[0]
            held[r[1]] = r
    if held:
        yield judged()


def _across_labels(rows: list[tuple], percent: int) -> Iterator[tuple[int, np.ndarray]]:
    """For each row the later ones with another label that are hopeful, by signatures."""
    sig, label, least = np.array([r[3] for r in rows], np.int32), np.array([r[2] for r in rows]), least_equal(percent)
    for i in range(len(rows) - 1):
        other = np.flatnonzero(label[i + 1 :] != label[i]) + i + 1
        yield i, other[(sig[other] == sig[i]).mean(1) >= least]


def _wanted(percent: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """(block, v) of the rows (block, v, label, sig) that have a hopeful partner of another component in their tile."""

    def judge(rows: list[tuple]) -> list[tuple[int, int]]:
        use = {k for i, others in _across_labels(rows, percent) for k in ([i, *others.tolist()] if len(others) else ())}
        return [(rows[k][0], rows[k][1]) for k in sorted(use)]

    return lambda batches: _tiled(batches, judge, ["block", "v"])


def _tiles(percent: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Links (a, b) across components in each tile, from rows (block, v, label, sig, set).

    Only hopeful pairs of components that are still apart are compared in full.
    """

    def judge(rows: list[tuple]) -> list[tuple[int, int]]:
        found, lead, u = [], {}, Union(len(rows))
        for i, r in enumerate(rows):
            u.join(i, lead.setdefault(r[2], i))
        sets = [np.frombuffer(r[4], np.uint64) for r in rows]
        for i, others in _across_labels(rows, percent):
            for j in others.tolist():
                a, b = u.root(i), u.root(j)
                if a != b and linked(sets[i], sets[j], percent):
                    u.join(a, b)
                    found.append((rows[i][1], rows[j][1]))
        return found

    return lambda batches: _tiled(batches, judge, ["a", "b"])


def components(links: DataFrame) -> DataFrame:
    """(v, label) of each end of links (a, b): the smallest vertex that it is connected with."""
    both = stored(links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct())
    labels = stored(both.groupBy(F.col("a").alias("v")).agg(F.least(F.min("b"), F.first("a")).alias("label")))
    while True:
        near = both.join(labels, both.a == labels.v).groupBy("b").agg(F.min("label").alias("near"))
        fresh = labels.join(near, labels.v == near.b, "left").select("v", F.col("label").alias("was"), F.least("label", "near").alias("label"))
        up = labels.select(F.col("v").alias("up_v"), F.col("label").alias("up"))
        moved = stored(fresh.join(up, fresh.label == up.up_v, "left").select("v", "was", F.least("label", "up").alias("label")))
        dropped(labels)
        labels = moved.select("v", "label")
        if moved.where("label <> was").isEmpty():
            return labels


def _nodes(vertices: DataFrame, trees: int) -> tuple[DataFrame, DataFrame]:
    """(node, v) of small nodes of all trees, and (node, v, size) of those that are large at the last level."""
    token = lambda: F.get("sig", F.pmod(F.xxhash64(F.col("node")), F.lit(COORDINATES)).cast("int"))
    apart = COORDINATES // trees  # the first branch of each tree has a coordinate of its own
    rows = vertices.select("v", "sig", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(trees - 1).cast("long"))).alias("tree"))
    rows = rows.select("v", F.xxhash64("tree", F.get("sig", (F.col("tree") * apart).cast("int"))).alias("node"))
    small, large = [], None
    for _ in range(DEPTH):
        if large is not None:
            rows = large.select("v", "node").join(vertices, "v").select("v", F.xxhash64("node", token()).alias("node"))
        sizes = stored(rows.groupBy("node").agg(F.count("*").alias("size")).where("size > 1"))  # stored, so that a hot node's rows can be split
        sized = stored(rows.join(sizes, "node"))
        small.append(sized.where(F.col("size") <= SMALL).select("node", "v"))
        large = sized.where(F.col("size") > SMALL)
    return stacked(small), large


def _compared(blocks: DataFrame, vertices: DataFrame, percent: int) -> DataFrame:
    """(members) to confirm, from (block, v)."""
    full = blocks.join(vertices, "v").groupBy("block").agg(F.collect_list(F.struct("v", "sig")).alias("m"))
    return full.select("m").mapInArrow(trimmed(_blocks(percent)), "members array<long>").distinct()


def _in_blocks(large: DataFrame) -> DataFrame:
    """(node, v, part): documents of large nodes in parts of about SMALL."""
    parts = F.ceil(F.col("size") / SMALL).cast("long")
    return large.select("node", "v", "size", F.pmod(F.xxhash64("v", "node"), parts).alias("part"), parts.alias("parts"))


def links(texts: DataFrame, vertices: DataFrame, percent: int = PERCENT) -> DataFrame:
    """(a, b) links that connect every component; vertices: (v, id, k1, k2, sig); texts: (id, text)."""
    small, large = _nodes(vertices.select("v", "sig"), trees_for(percent))
    parted = _in_blocks(large)
    lead = large.groupBy("node", "size").agg(*[F.min(F.struct(F.xxhash64(F.lit(k), "v"), "v")).alias(f"p{k}") for k in range(PIVOTS)])
    lead = lead.select("node", F.ceil(F.col("size") / SMALL).cast("long").alias("parts"), F.explode(F.array(*[F.col(f"p{k}.v") for k in range(PIVOTS)])).alias("v"))
    lead = lead.select("node", "v", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)).alias("part"))
    block = F.xxhash64("node", "part").alias("block")
    first = small.select(F.xxhash64("node", F.lit("small")).alias("block"), "v").union(parted.select(block, "v")).union(lead.select(block, "v"))
    members = stored(_compared(first, vertices.select("v", "sig"), percent))
    found, sets = _confirm(members, texts, vertices, percent)
    more = _across(large, components(found), texts, vertices, sets, percent)
    return found if more is None else found.union(more)


def _across(large: DataFrame, labels: DataFrame, texts: DataFrame, vertices: DataFrame, sets: DataFrame, percent: int) -> DataFrame | None:
    """(a, b) links in large nodes of several components: documents outside the largest against the whole node."""
    named = stored(large.join(labels, "v", "left").select("node", "v", "size", F.coalesce("label", "v").alias("label")))
    counts = named.groupBy("node", "label").agg(F.count("*").alias("n"))
    main = counts.groupBy("node").agg(F.count("*").alias("kinds"), F.sum("n").alias("size"), F.max(F.struct("n", "label")).alias("top")).where("kinds > 1")
    main = stored(main.select("node", F.col("top.label").alias("main"), F.ceil((F.col("size") - F.col("top.n")) / TILE).cast("long").alias("strips"), F.ceil(F.col("size") / TILE).cast("long").alias("parts")))
    if main.isEmpty():
        return None
    whole = named.select("node", "v", "label").join(main, "node")
    count = lambda c: F.explode(F.sequence(F.lit(0).cast("long"), F.col(c) - 1))
    deal = lambda salt, c: F.pmod(F.xxhash64("v", F.lit(salt)), F.col(c))
    minor = whole.where("label <> main").select("node", "v", "label", deal("strip", "strips").alias("strip"), count("parts").alias("part"))
    every = whole.select("node", "v", "label", count("strips").alias("strip"), deal("part", "parts").alias("part"))
    tile = F.xxhash64("node", "part", "strip").alias("block")
    tiles = minor.select(tile, "v", "label").union(every.select(tile, "v", "label"))
    rows = tiles.join(vertices.select("v", "sig"), "v").select("block", "v", "label", "sig")
    wanted = stored(_gathered(rows).mapInArrow(trimmed(_wanted(percent)), "block long, v long").distinct())  # sets travel for these only
    if wanted.isEmpty():
        return None
    full = _fetched(wanted.select("v").distinct(), texts, vertices, sets).join(vertices.select("v", "sig"), "v")
    label = whole.select("v", "label").distinct()
    rows = wanted.join(label, "v").join(full, "v").select("block", "v", "label", "sig", "set")
    return stored(_gathered(rows).mapInArrow(trimmed(_tiles(percent)), "a long, b long").distinct())


def _gathered(rows: DataFrame) -> DataFrame:
    parts = max(2, int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    return rows.repartition(parts, "block").sortWithinPartitions("block", "v")


def _fetched(wanted: DataFrame, texts: DataFrame, vertices: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """(v, set) of the wanted vertices (v) from their whole texts; known: sets made before."""
    if known is not None:
        wanted = wanted.join(known.select("v"), "v", "left_anti")
    ids = wanted.join(vertices, "v").select("v", "id", "k1", "k2")
    read = texts.join(ids.select("id").distinct(), "id", "left_semi").select("text").mapInArrow(_sets, "k1 long, k2 long, set binary")
    sets = stored(read.join(ids.drop("id"), ["k1", "k2"]).select("v", "set").dropDuplicates(["v"]))
    return sets if known is None else sets.union(known)


def _confirm(members: DataFrame, texts: DataFrame, vertices: DataFrame, percent: int) -> tuple[DataFrame, DataFrame]:
    """(links confirmed on full sets, the sets used)."""
    each = members.select(F.xxhash64("members").alias("block"), F.explode("members").alias("v"))
    sets = _fetched(each.select("v").distinct(), texts, vertices)
    rows = _gathered(each.join(sets, "v").select("block", "v", "set"))
    return stored(rows.mapInArrow(trimmed(_confirmed(percent)), "a long, b long").distinct()), sets


def near_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = PERCENT) -> DataFrame:
    """One row per input row: id, n_shingles, component_id, kept; links are pairs of a similarity of at least percent."""
    texts = df.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    rows = stored(texts.mapInArrow(_profiles, "id long, n long, k1 long, k2 long, sig array<int>"))
    real = rows.where("n > 0 and id is not null")
    classes = real.groupBy("k1", "k2").agg(F.min("id").alias("id"))
    lead = classes.groupBy("id").agg(F.min(F.struct("k1", "k2")).alias("lead"))  # a repeated id may lead several classes
    classes = stored(classes.join(lead, "id").select("k1", "k2", "id", F.when(F.col("lead") == F.struct("k1", "k2"), F.col("id")).otherwise(F.xxhash64("id", "k1", "k2")).alias("v")))
    vertices = stored(real.join(classes, ["k1", "k2", "id"]).select("v", "id", "k1", "k2", "sig").dropDuplicates(["v"]))
    member = real.select("id", "k1", "k2").join(classes.select("k1", "k2", "v"), ["k1", "k2"])
    ends = member.groupBy("id").agg(F.min("v").alias("least"), F.max("v").alias("most")).where("least < most").select("id", "least")
    same = member.join(ends, "id").where("v <> least").select(F.col("least").alias("a"), F.col("v").alias("b"))
    labels = components(links(texts, vertices, percent).union(same))
    smallest = labels.join(classes.select("v", "id"), "v").groupBy("label").agg(F.min("id").alias("component"))
    labels = labels.join(smallest, "label").select("v", "component")
    own = classes.select("k1", "k2", "v", F.col("id").alias("first")).join(labels, "v", "left").select("k1", "k2", F.coalesce("component", "first").alias("component"))
    named = rows.select("id", "n", "k1", "k2").join(own, ["k1", "k2"], "left")
    label = F.when((F.col("n") > 0) & F.col("id").isNotNull(), F.col("component")).otherwise(F.col("id"))
    return named.select("id", F.col("n").alias("n_shingles"), label.alias("component_id"), F.coalesce(F.col("id") == label, F.lit(True)).alias("kept"))


def without_copies(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = PERCENT) -> DataFrame:
    """df with one document of each group of near duplicates: that of the smallest id, and of its rows the smallest one.

    Rows without an id are kept.
    """
    kept = near_duplicates(df, id_col, text_col, percent).where("kept and id is not null").groupBy(F.col("id").alias("_kept_id")).agg(F.count("*").alias("_rows"))
    kept = stored(kept)
    of = lambda ids: df.join(ids.select("_kept_id"), df[id_col] == F.col("_kept_id"), "left_semi")
    out = of(kept.where("_rows = 1")).unionByName(df.where(F.col(id_col).isNull()))
    again = kept.where("_rows > 1")
    if again.isEmpty():
        return out
    least = of(again).groupBy(F.col(id_col).alias("_kept_id")).agg(F.min(F.struct(*[F.col(f"`{c}`") for c in df.columns])).alias("_row"))
    return out.unionByName(least.select("_row.*"))
