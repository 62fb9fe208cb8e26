"""Near-duplicate components against the full join of all pairs."""

import random
import re

import numpy as np
import pyarrow as pa
import pytest

from affinis.llm import neardup


def sets(t):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def brute(rows):
    own = [(i, sets(t)) for i, t in rows]
    up = {i: i for i, _ in own}

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    for k, (i, a) in enumerate(own):
        for j, b in own[:k]:
            if a and b and 100 * len(a & b) >= 85 * len(a | b):
                x, y = root(i), root(j)
                up[max(x, y)] = min(x, y)
    return sorted((i, len(s), root(i), root(i) == i) for i, s in own)


def corpus():
    rng = random.Random(8)
    word = lambda: "".join(rng.choices("abcdefgh", k=rng.randrange(2, 8)))
    prose = lambda n: [word() for _ in range(n)]
    texts = [None, "", " \n", "one", "One", "a b c d", "a b c d e", "x" * 20_000, "y " * 3000, "Y " * 3001]
    for size, copies, edits in ((120, 130, 6), (400, 40, 10), (60, 9, 1), (200, 30, 30), (1000, 4, 3)):
        base = prose(size)
        for _ in range(copies):
            w = list(base)
            for _ in range(rng.randrange(edits)):
                w[rng.randrange(len(w))] = word()
            texts.append(" ".join(w))
    texts += [" ".join(prose(rng.randrange(5, 100)) + ["under", "the", "same", "license", "as", "all", "of", "them"]) for _ in range(80)]
    return texts + texts[20:30] * 2


@pytest.mark.parametrize("small", [24, 4])
def test_components_are_those_of_the_full_join(spark, monkeypatch, small):
    monkeypatch.setattr(neardup, "SMALL", small)
    rows = list(enumerate(corpus()))
    random.Random(1).shuffle(rows)
    rows = [(i * 3 - 50, t) for i, t in rows]
    df = spark.createDataFrame([(i, t, 1, 2, 3) for i, t in rows], "doc_id long, text string, v long, sig int, label int")
    got = sorted(tuple(r) for r in neardup.near_duplicates(df).collect())
    assert got == brute(rows)
    kept = neardup.without_copies(df)
    assert kept.columns == df.columns and kept.count() == sum(r[3] for r in got)


def test_repeated_and_null_ids(spark):
    texts = [(1, "a b c d e f"), (5, "a b c d e f"), (5, "g h i j k l"), (7, "g h i j k l"), (9, "m n o p q"), (9, "m n o p q"), (9, "r s t u v"), (None, "a b c d e f"), (None, None), (11, "r s t u v")]
    df = spark.createDataFrame(texts, "doc_id long, text string")
    got = neardup.near_duplicates(df).collect()
    assert {(r.id, r.component_id) for r in got} == {(1, 1), (5, 1), (7, 1), (9, 9), (11, 9), (None, None)} and len(got) == len(texts)
    assert all(r.kept for r in got if r.id is None)
    assert neardup.near_duplicates(df.limit(0)).count() == 0


def test_one_row_of_each_group_stays(spark):
    rows = [(1, "a b c d e f", "x"), (1, "a b c d e f", "x"), (1, "a b c d e f", None), (2, "A b c d e f", "y"), (3, "other words of a text here", "z"), (None, None, "n"), (None, None, "n")]
    df = spark.createDataFrame(rows, "doc_id long, text string, _rows string")
    got = sorted((tuple(r) for r in neardup.without_copies(df).collect()), key=str)
    assert got == sorted([(1, "a b c d e f", None), (3, "other words of a text here", "z"), (None, None, "n"), (None, None, "n")], key=str)


def test_pages_of_one_template(spark):
    """Nodes of many components: pages that share a template but are no copies, and copies among them."""
    rng = random.Random(3)
    template = " ".join(f"t{i}" for i in range(300))
    rows = [(i, template + " " + " ".join(f"p{i}x{rng.randrange(10**6)}" for _ in range(60))) for i in range(700)]
    rows += [(1000 + i, rows[7 * i][1] + " more") for i in range(60)]
    got = neardup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    want = {i: i for i, _ in rows} | {1000 + i: 7 * i for i in range(60)}
    assert {r.id: r.component_id for r in got} == want


def test_signatures_estimate_similarity():
    rng = np.random.default_rng(1)
    a = np.unique(rng.integers(0, 2**63, 1000, dtype=np.uint64))
    b = np.concatenate([a[: int(len(a) * 0.9)], np.unique(rng.integers(0, 2**63, 100, dtype=np.uint64))])
    same = np.mean([(neardup.signature(np.unique(a)) == neardup.signature(np.unique(b))).mean()])
    assert 0.65 < same < 0.97
    x, y = neardup.shingle_sets(pa.array(["A b C d e f", "a B c\nd e f"]))
    assert x.tolist() == y.tolist() and len(x) == 2


def test_linked_threshold():
    a = np.arange(100, dtype=np.uint64)
    assert neardup.linked(a, a[:85]) and not neardup.linked(a, a[:84])
