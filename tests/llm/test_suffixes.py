"""Suffix sorting and the removal of repeats against brute force."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from affinis.llm import suffixes as sx


def test_two_stage_order_is_the_suffix_order():
    rng = random.Random(2)
    for _ in range(60):
        parts = [bytes(rng.choices(b"ab" if rng.random() < 0.5 else b"abcd", k=rng.randrange(1, 40))) for _ in range(rng.randrange(1, 6))]
        text = np.frombuffer(b"".join(p + b"\0" for p in parts), np.uint8)
        whole = text.tobytes()
        order = sx.suffix_order(text, np.ones(len(text), bool), 64)
        suffix = [whole[i : whole.index(b"\0", i)] for i in order.tolist()]
        assert suffix == sorted(suffix) and sorted(order.tolist()) == list(range(len(text)))


@pytest.mark.parametrize("alphabet", [b"ab", b"abcdefgh"])
def test_repeats(alphabet):
    rng = random.Random(4)
    for _ in range(80):
        width = rng.randrange(8, 20)
        contexts = [bytes(rng.choices(alphabet, k=rng.randrange(width, 60))) for _ in range(rng.randrange(1, 8))]
        contexts += [contexts[0][3:] + b"zz" * 10] if len(contexts[0]) > width + 3 else []
        strings = np.array([len(c) - width + 1 - (rng.randrange(3) if len(c) > width + 3 else 0) for c in contexts])
        all_ = Counter(c[i : i + width] for c, n in zip(contexts, strings) for i in range(n))
        want = [[all_[c[i : i + width]] > 1 for i in range(n)] for c, n in zip(contexts, strings)]
        assert [f.tolist() for f in sx.repeats(contexts, strings, width)] == want


def brute(texts):
    data = [(t or "").encode() for t in texts]
    seen = Counter(hash(d[i : i + 200]) for d in data for i in range(len(d) - 199))
    out = []
    for d in data:
        gone = np.zeros(len(d), bool)
        for i in range(len(d) - 199):
            if seen[hash(d[i : i + 200])] > 1:
                gone[i : i + 200] = True
        kept = np.frombuffer(d, np.uint8)[~gone].tobytes()
        out.append((len(d), int(gone.sum()), int(gone[:1].sum() + (gone[1:] & ~gone[:-1]).sum()), hashlib.sha256(kept).hexdigest(), kept.decode(errors="ignore")))
    return out


def corpus():
    rng = random.Random(9)
    word = lambda: "".join(rng.choices("abcdeéïo", k=rng.randrange(1, 9)))
    prose = lambda n: " ".join(word() for _ in range(n))
    shared = [prose(60) for _ in range(4)]
    texts = [None, "", "x", "a" * 199, "a" * 200, "a" * 900, "ab" * 400, prose(40)]
    texts += [prose(rng.randrange(0, 120)) + rng.choice(shared)[rng.randrange(30) : rng.randrange(150, 330)] + prose(rng.randrange(0, 120)) for _ in range(60)]
    base = prose(400)
    for _ in range(12):
        w = base.split(" ")
        for _ in range(rng.randrange(4)):
            w[rng.randrange(len(w))] = word()
        texts.append(" ".join(w))
    return texts + [texts[9]] * 3 + [prose(300) + base[400:700] + prose(20) + base[400:700]]


@pytest.mark.parametrize("hot", [256, 3])
def test_dedup_against_brute_force(spark, monkeypatch, hot):
    monkeypatch.setattr(sx, "HOT", hot)
    texts = corpus()
    df = spark.createDataFrame([(i, t, 1, 2, 3) for i, t in enumerate(texts)] + [(9, texts[9], 1, 2, 3), (None, texts[8], 1, 2, 3)], "doc_id long, text string, h1 int, lo int, n int")
    rows = texts + [texts[9], texts[8]]
    want = brute(rows)
    ids = [*range(len(texts)), 9, None]
    got = sx.dedup(df).collect()
    assert Counter(tuple(r) for r in got) == Counter((i, *w[:4]) for i, w in zip(ids, want))
    assert sum(w[1] > 0 for w in want) > 40
    if hot == 3:
        out = sx.dedup_texts(df.withColumnRenamed("n", "n_chars"))
        assert out.columns == ["doc_id", "text", "h1", "lo", "n_chars"]
        assert Counter(r.text for r in out.collect()) == Counter(t if not w[1] else w[4] for t, w in zip(rows, want))


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert sx.dedup(df).count() == 0 and sx.dedup_texts(df).count() == 0
