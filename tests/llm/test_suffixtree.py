"""Suffix-tree scores against plain Python: the base score, and the model grown and applied without Spark or hashes."""

import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from affinis.llm import suffixtree as st

TEXTS = ["the cat sat on the mat the cat ran", "The dog sat on a log", None, "", "new york is big new york is old", "new york new york", "a b c d " * 40, "the cat sat " * 30, "rare words only here", "x" * 50_000, "\n\n ", "new york is far"] * 3


def words(t):
    return re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or "")) + [None]


def frame(spark):
    rows = [(i if i != 7 else 6, t, 1, 2) for i, t in enumerate(TEXTS)] + [(None, "the cat", 1, 2)]
    return rows, spark.createDataFrame(rows, "doc_id long, text string, n long, k long")


def held(i):
    return zlib.crc32(b"" if i is None else str(i).encode()) % 7 == 2


class Plain:
    """The tree in plain Python."""

    def __init__(self, texts, depth):
        docs = [words(t) for t in texts]
        self.c = Counter(w for d in docs for w in d)
        self.n, self.v = sum(self.c.values()), len(self.c)
        self.next, self.states = defaultdict(Counter), {}
        seq = Counter(tuple(d[i : i + k]) for d in docs for k in range(1, depth + 2) for i in range(len(d) - k + 1))
        for s, n in seq.items():
            if len(s) > 1 and n >= st.LEAST:
                self.next[s[:-1]][s[-1]] = n
        for ctx in sorted(self.next, key=len):
            follow, total = self.next[ctx], seq[ctx]
            was = {w: self.p(ctx[1:], w) for w in follow}
            rest = total - sum(follow.values())
            gain = sum(n * math.log(n / total / was[w]) for w, n in follow.items())
            if rest:
                gain += rest * math.log(rest / total / max(1 - sum(was.values()), 1e-12))
            if gain > 0.5 * math.log(max(self.n, 2)) * len(follow):
                self.states[ctx] = (total + len(follow) + 1, (rest + len(follow) + 1) / (total + len(follow) + 1))

    def p(self, ctx, w):
        """Probability of w after ctx, from the longest state that ends it."""
        if not ctx:
            return (self.c[w] + 1) / (self.n + self.v + 1)
        below = self.p(ctx[1:], w)
        if ctx not in self.states:
            return below
        size, back = self.states[ctx]
        return self.next[ctx][w] / size + back * below

    def score(self, text, depth):
        d = words(text)
        return sum(math.log10(self.p(tuple(d[max(0, i - depth) : i]), w)) for i, w in enumerate(d))


@pytest.mark.parametrize("depth,limits", [(2, {}), (3, {}), (2, {"min_word": 0.05, "min_pair": 0.02}), (2, {"min_word": 9.0, "min_pair": 9.0, "bits": 6})])
def test_scores_by_brute_force(spark, depth, limits):
    rows, df = frame(spark)
    out = st.crc_fold("doc_id") == 2
    tree = st.grow(df.where(~out), st.word_counts(df.where(~out)), depth, **limits)
    got = st.score(df, tree, held_out=out).collect()
    model = Plain([t for i, t, *_ in rows if not held(i)], depth)
    c, n, v = model.c, model.n, model.v
    want = Counter((i, held(i), len(words(t)), sum(c[w] > 0 for w in words(t)), n, round(sum(math.log10((c[w] + 1) / (n + v + 1)) for w in words(t)), 6), round(model.score(t, depth), 6)) for i, t, *_ in rows)
    assert Counter((*tuple(r)[:5], round(r.base_score, 6), round(r.score, 6)) for r in got) == want
    assert len(model.states) > 10 and {len(s) for s in model.states} == set(range(1, depth + 1))
    for ctx in [(), *model.states, ("zzz",)]:
        assert abs(sum(model.p(ctx, w) for w in [*c, "unknown"]) - 1) < 1e-9
    assert (len(tree.keys) == 0) == (limits.get("min_word") == 9.0)


def test_scores_on_documents_by_brute_force(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    out = st.crc_fold("doc_id") == 2
    got = {r.id: r.score for r in st.score(df, st.grow(df.where(~out), st.word_counts(df.where(~out))), held_out=out).collect()}
    rows = [(r.doc_id, r.text) for r in df.collect()]
    model = Plain([t for i, t in rows if not held(i)], st.DEPTH)
    assert len(got) == len(rows)
    for i, t in rows:
        assert abs(got[i] - model.score(t, st.DEPTH)) < 1e-6 * max(1, abs(got[i]))


def test_held_out_likelihood_is_better_than_base(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    out = st.crc_fold("doc_id") == 2
    counts = st.word_counts(df.where(~out))
    rows = [r for r in st.score(df, st.grow(df.where(~out), counts), held_out=out).collect() if r.held_out]
    assert sum(r.score for r in rows) > sum(r.base_score for r in rows)


def test_what_the_tree_keeps_grows_with_the_corpus(spark):
    """Contexts that occur twice are states however many other tokens there are."""
    twice = "alpha beta gamma delta epsilon zeta eta theta"
    for other in (50, 5000):
        df = spark.createDataFrame([(1, twice), (2, twice)] + [(10 + i, f"w{i} v{i} u{i}") for i in range(other)], "doc_id long, text string")
        r = st.score(df, st.grow(df, st.word_counts(df))).where("id = 1").first()
        assert r.score > r.base_score + 5


def test_nothing_to_train_on(spark):
    _, df = frame(spark)
    tree = st.grow(df.limit(0), st.word_counts(df.limit(0)))
    assert {(r.base_score, r.score, r.n_known) for r in st.score(df, tree).collect()} == {(0.0, 0.0, 0)}
    assert st.score(df.limit(0), tree).count() == 0


def test_bitmap_holds_every_key(spark):
    keys = np.random.default_rng(1).integers(-(2**63), 2**63 - 1, 5000)
    df = spark.createDataFrame([(int(k),) for k in keys], "k long")
    for bits in (6, 12, 27):
        assert st._bitmap(df, len(keys), bits)(keys).all()
    assert st._bitmap(df, len(keys), 27)(np.random.default_rng(2).integers(-(2**63), 2**63 - 1, 5000)).mean() < 0.3


def test_counted_pairs_and_answers_travel_in_blocks(spark):
    """Counts come from few rows of blocks, not one row a sequence; what blocks hold is read back exactly."""
    rows = np.array([0, 0, 3, 3, 300, 70000], np.int64)
    assert st._rows(st._steps(rows), len(rows)).tolist() == rows.tolist()
    for values in ([], [0, 255], [256, 1], [2**40, 7]):
        assert st._whole(st._small(np.array(values, np.int64)), len(values)).tolist() == values
    texts = [(" ".join(f"w{(i * j) % 17}" for j in range(60)),) for i in range(300)]
    pairs = st._followers(spark.createDataFrame(texts, "text string").repartition(5), 1, None)
    want = Counter()
    for (t,) in texts:
        tokens = [*t.split(), None]
        want.update(zip(tokens, tokens[1:], strict=False))
    assert sorted(r.n for r in pairs.collect()) == sorted(n for n in want.values() if n > 1)
    assert pairs.select("k").distinct().count() == pairs.count()


def test_terms_of_a_sequence_are_added_where_they_are_looked_up(spark, monkeypatch):
    """All terms went through an exchange to be added up, and every slot of a bitmap was a row."""
    rows, df = frame(spark)
    plans, stored = {}, st.stored

    def spied(table, *codec):
        plans[tuple(table.columns)] = table._jdf.queryExecution().optimizedPlan().toString()
        return stored(table, *codec)

    monkeypatch.setattr(st, "stored", spied)
    tree = st.grow(df, st.word_counts(df), min_word=9.0, min_pair=9.0)
    assert "Aggregate" not in plans["k", "base", "gain", "often"]
    terms = Counter(r.k for r in tree.model.collect())
    assert max(terms.values()) == 2
    model = Plain([t for _, t, *_ in rows], st.DEPTH)
    got = Counter((r.id, round(r.score, 6)) for r in st.score(df, tree).collect())
    assert got == Counter((i, round(model.score(t, st.DEPTH), 6)) for i, t, *_ in rows)


def test_words_are_counted_in_the_first_pass(spark, monkeypatch):
    """A pass of its own over all texts counted the words."""
    _, df = frame(spark)
    plans, stored = [], st.stored

    def spied(table, *codec):
        plans.append(table._jdf.queryExecution().optimizedPlan().toString())
        return stored(table, *codec)

    known = st.grow(df, st.word_counts(df))
    monkeypatch.setattr(st, "stored", spied)
    tree = st.grow(df)
    assert sum("text" in p for p in plans) == st.DEPTH
    assert (tree.total, tree.distinct) == (known.total, known.distinct)
    got, want = ([(r.id, r.n_known, round(r.base_score, 6), round(r.score, 6)) for r in st.score(df, t).collect()] for t in (tree, known))
    assert Counter(got) == Counter(want)
    empty = st.grow(df.limit(0))
    assert (empty.total, empty.distinct) == (0, 0)
