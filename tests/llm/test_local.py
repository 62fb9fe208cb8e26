"""Top-k search, toxicity, pieces and packing against brute force, exact round trips and held-out accuracy."""

import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from affinis.llm import packing, pieces, topk, toxicity

SF = "/root/testdata/sf0.01"
ODD = ["", None, " ", "a  b", "x\n y", "\x1c!!\x1c x  ", "end <|endoftext|> of", "▁ ▁▁x", "\U0001f600́ 漢", "z" * 5000, "tab\there", "it's we'll ok", "a 　 b", "0 " * 3000]


def brute_top(rows, k):
    rows = {i: [math.floor(1024 * float(x)) for x in v] for i, v in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)}
    out = {}
    for q in rows:
        if q % 3 == 0:
            s = sorted((-sum(a * b for a, b in zip(rows[q], v)), i) for i, v in rows.items() if i != q)
            out[q] = [(i, -x) for x, i in s[:k]]
    return out


@pytest.mark.parametrize("block,group", [(4096, 1024), (17, 5)])
def test_top_k(spark, block, group):
    rng = random.Random(5)
    rows = [(i, [rng.choice([-1.5, -0.25, 0.0, 0.1, 0.7]) for _ in range(6)]) for i in range(120)]
    rows += [(130, None), (131, [0.1, None, 0.0, 0.0, 0.0, 0.0]), (132, [math.nan] * 6), (133, [math.inf] + [0.0] * 5), rows[3], rows[3]]
    df = spark.createDataFrame([(i, v, 1, 2) for i, v in rows], "vec_id long, embedding array<float>, rank int, score int")
    got = defaultdict(list)
    for r in topk.top_k(df, F.expr("vec_id % 3 = 0"), k=7, block=block, group=group).orderBy("query_id", "rank").collect():
        got[r.query_id].append((r.vec_id, r.score))
    rows = [(i, v if v is None else [x if x is None else float(np.float32(x)) for x in v]) for i, v in rows]
    assert got == brute_top(rows, 7)


def test_top_k_of_large_components(spark):
    rng = random.Random(8)
    rows = [(0, [1.0, 2.0]), (1, [300000.0, 1.0]), (2, [1.0, 1.0]), (3, [1e30, -1e30]), (4, [1e30, 1e30]), (5, [-3e38, 1.0]), (6, [3e38, 1e-30]), (7, [2.0**28, -(2.0**28)])]
    rows += [(i, [rng.choice([-1, 1]) * 10 ** rng.uniform(-3, 38) for _ in range(2)]) for i in range(8, 40)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = defaultdict(list)
    for r in topk.top_k(df, F.expr("vec_id % 3 = 0"), k=7, block=8).orderBy("query_id", "rank").collect():
        got[r.query_id].append((r.vec_id, r.score))
    want = brute_top([(i, [float(np.float32(x)) for x in v]) for i, v in rows], 7)
    assert got == {q: [(i, max(-(2**63), min(2**63 - 1, s))) for i, s in best] for q, best in want.items()}
    assert topk.top_k(df.where("vec_id < 3"), F.expr("vec_id = 0")).first().vec_id == 1
    wide = sorted([rng.randrange(-(10**k), 10**k) for k in range(1, 90)] + [0, 1, -1, 255, 256, -256, -255])
    assert sorted(wide, key=topk.sortable) == wide


def test_top_k_few_and_none(spark):
    df = spark.createDataFrame([(0, [1.0]), (5, [2.0])], "vec_id long, embedding array<float>")
    assert [tuple(r) for r in topk.top_k(df, F.expr("vec_id = 0")).collect()] == [(0, 1, 5, 1024 * 2048)]
    assert topk.top_k(df.limit(0), F.expr("vec_id = 0")).count() == 0


def test_toxicity_held_out(spark):
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    fit = labels.where("doc_id % 3 <> 0")
    model = toxicity.train(docs, fit, "doc_id", "text", F.col("toxic"))
    assert all(np.diff(model.thresholds) > 0)
    got = {r.id: r.p_toxic > 0.5 for r in toxicity.score(docs, model).collect()}
    held = [(got[r.doc_id], bool(r.toxic)) for r in labels.where("doc_id % 3 = 0").collect() if r.doc_id in got]
    assert sum(a == b for a, b in held) / len(held) > 0.93  # two in five toxic labels have no sign in the text


def test_toxicity_edge_cases(spark):
    docs = spark.createDataFrame([(1, None, 0.5), (1, "", 0.5), (2, "idiot " * 100_000, 0.5)], "id long, text string, severity double")
    labels = spark.createDataFrame([(1, None, None), (2, None, 0)], "id long, toxic int, quality int")
    assert toxicity.train(docs, labels, "id", "text", F.col("toxic")) is None
    assert [r.p_toxic for r in toxicity.score(docs, None, "id").collect()] == [0.0] * 3
    assert toxicity.score(docs.limit(0), None, "id").count() == 0


def test_ordinal_fit_orders_grades():
    rng = np.random.default_rng(3)
    words = rng.integers(0, 40, (600, 8))
    true = np.linspace(-2, 2, 40)
    eta = true[words].sum(1) + rng.logistic(size=600)
    grades = np.digitize(eta, [-2, 2])
    rows = np.repeat(np.arange(600), 8)
    model = toxicity.fit(rows, words.ravel(), grades, common=1.0)
    assert np.corrcoef(model.weights[:40], true)[0, 1] > 0.85 and len(model.thresholds) == 2


def test_ordinal_fit_is_the_likeliest():
    """Three grades: the likelihood in plain Python, whose slopes vanish where the fit ends."""
    rng = np.random.default_rng(9)
    n, width = 400, 6
    x = [sorted(set(rng.integers(0, width, 3).tolist())) for _ in range(n)]
    true = [-2.0, -1.0, 0.0, 1.0, 2.0, 3.0]
    grades = np.digitize([sum(true[j] for j in row) + rng.logistic() for row in x], [-1.0, 2.5])
    rows = np.repeat(np.arange(n), [len(r) for r in x])
    model = toxicity.fit(rows, np.concatenate(x), grades, bits=4, epochs=400, common=1.0)

    def loss(w, edges):
        out = 0.0
        for row, g in zip(x, grades.tolist()):
            eta = sum(w[j] for j in row)
            below = [0.0, *(1 / (1 + math.exp(eta - e)) for e in edges), 1.0]
            out -= math.log(below[g + 1] - below[g])
        return out / n

    w, edges = model.weights.tolist(), model.thresholds.tolist()
    below = model.below(np.array([0.3]))[0].tolist()
    assert below == pytest.approx([1 / (1 + math.exp(0.3 - e)) for e in edges]) and len(edges) == 2 and edges[0] < edges[1]
    for part, k in [(w, j) for j in range(width) if w[j]] + [(edges, 0), (edges, 1)]:
        at, h = part[k], 1e-4
        part[k] = at + h
        up = loss(w, edges)
        part[k] = at - h
        down = loss(w, edges)
        part[k] = at
        assert abs(up - down) / (2 * h) < 2e-3
    assert sum(v != 0 for v in w[:width]) >= 4 and not any(w[width:])


def test_three_grades_and_repeated_ids(spark):
    words = ["fine", "rude", "vile"]
    docs = spark.createDataFrame([(i, f"{words[i % 3]} words{i % 7} here{i % 5}") for i in range(300)] + [(0, "zzz"), (1, "zzz")], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 3) for i in range(300)], "doc_id long, grade int")
    fits = [toxicity.train(d, labels, "doc_id", "text", F.col("grade")) for d in (docs, docs.repartition(5))]
    assert len(fits[0].thresholds) == 2 and np.allclose(fits[0].weights, fits[1].weights, atol=1e-6)
    got = {r.id: r for r in toxicity.score(docs.limit(300), fits[0]).collect()}
    assert all(got[i].grade == i % 3 for i in range(300)) and got[0].severity < got[1].severity < got[2].severity


def brute_best(v, text):
    best = [0.0] + [-math.inf] * len(text)
    for j in range(1, len(text) + 1):
        for i in range(j):
            if text[i:j] in v.pieces:
                best[j] = max(best[j], best[i] + v.pieces[text[i:j]][1])
        if text[j - 1] not in v.pieces:
            best[j] = max(best[j], best[j - 1] + v.byte_score * len(text[j - 1].encode()))
    return best[-1]


def test_pieces_are_those_of_the_model_and_round_trip(spark):
    import public_tokenizers as public
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=public.path(pieces.MODEL))
    v = pieces.vocabulary()
    rng = random.Random(1)
    texts = [t for t in ODD if t] + ["".join(rng.choice("aeiou thns  é漢²=.0") for _ in range(rng.randrange(1, 90))) for _ in range(1500)]
    texts += ["=" * 3000, "z" * 3001, "aaaaaaaab" * 300, " " * 50 + "x"] + [r.text for r in spark.read.parquet(f"{SF}/documents.parquet").where("doc_id < 150").collect() if r.text]
    for t in texts:
        ids = v.encode(t)
        assert v.decode(ids) == t
        if "▁" not in t:  # which the model takes for a space
            assert ids == model.encode(t)
            assert [i for part in v.stream(" " + t) for i in part] == ids
    assert v.encode("") == [] and v.decode([]) == ""


def test_best_path_under_scores():
    rng = random.Random(4)
    own = {"a": -1.0, "b": -2.0, "ab": -2.5, "ba": -2.9, "aab": -2.7, "bbb": -3.0, "abab": -4.1, " a": -1.1}
    v = pieces.Vocabulary({p: (k, s) for k, (p, s) in enumerate(own.items())}, list(range(100, 356)), -3.0)
    score = {i: s for i, s in v.pieces.values()} | {i: v.byte_score for i in v.byte_ids}
    for _ in range(300):
        t = "".join(rng.choice("aab bé") for _ in range(rng.randrange(1, 40)))
        ids = v.encode(t)
        assert v.decode(ids) == t and abs(sum(score[i] for i in ids) - brute_best(v, " " + t)) < 1e-9


@pytest.mark.parametrize("text", ["=" * 100_000, "z" * 100_000, "aaaaaaaab" * 11_000, "漢" * 100_000])
def test_pieces_of_text_without_spaces_take_linear_time(text):
    import time

    v = pieces.vocabulary()
    v.encode(text[:1000])
    began = time.process_time()
    parts = list(v.stream(" " + text))
    assert time.process_time() - began < 6 and len(parts) > 1000  # commits all along
    assert v.decode([i for p in parts for i in p]) == text


def test_streaming_commits_early():
    v = pieces.Vocabulary({"a": (1, -1.0), "aa": (2, -1.5), "b": (3, -1.0), "aab": (4, -1.2)}, list(range(10, 266)), -5.0)
    seen, parts = 0, []

    def source():
        nonlocal seen
        for c in "aab" * 500:
            seen += 1
            yield c

    for ids in v.stream(source()):
        parts.append((seen, len(ids)))
    assert len(parts) > 50 and max(n for _, n in parts) < 20 and sum(n for _, n in parts) == 500


def test_pieces_query(spark):
    df = spark.createDataFrame([(i, t, "clash") for i, t in enumerate(ODD)] + [(1, None, "clash")], "doc_id long, text string, ids string")
    got = pieces.decode(pieces.encode(df)).collect()
    assert Counter((r.id, r.text) for r in got) == Counter([(i, t or "") for i, t in enumerate(ODD)] + [(1, "")])
    assert pieces.decode(pieces.encode(df.limit(0))).count() == 0


def test_classes_and_cuts():
    """Bins hold j tails of class j and the start of a later document; nothing is padded, few documents are cut."""
    rng = random.Random(12)
    packer, sizes = packing.Packer(1024, 3), [rng.choice([rng.randrange(1, 40), rng.randrange(40, 1500), 1024, 512, 341]) for _ in range(3000)]
    rows, made = [], 0
    for i, n in enumerate(sizes):
        rows += packer.add(i, np.arange(n, dtype="<u4").tobytes())
        made = len(rows)
    rows += packer.close()
    bins, docs = defaultdict(list), defaultdict(list)
    for doc, start, size, ids, n, seq, at in rows:
        assert n == sizes[doc] and ids == np.arange(start, start + size, dtype="<u4").tobytes()
        bins[seq].append((at, size, doc, start))
        docs[doc].append((start, size))
    assert {d: sum(n for _, n in x) for d, x in docs.items()} == dict(enumerate(sizes))
    late = {r[5] for r in rows[made:]}
    for seq, x in bins.items():
        assert [a for a, *_ in x] == [sum(n for _, n, *_ in x[:k]) for k in range(len(x))]
        total = sum(n for _, n, *_ in x)
        assert total & (total - 1) == 0 and total <= 1024
        if seq not in late:
            tails = [n for _, n, d, s in x if s + n == sizes[d]]
            j = 1024 // tails[0] if tails else 0
            assert total == 1024 and (len(x) == 1 or [1024 // n for n in tails[:j]] == [j] * j)
    assert sum(len(x) for x in docs.values()) < sum(n // 1024 + 2 for n in sizes) + 1024


def test_packing(spark):
    import public_tokenizers as public
    from tokenizers import Tokenizer

    full = Tokenizer.from_file(public.path("byte_bpe_50k.json"))
    texts = ODD + [r.text for r in spark.read.parquet(f"{SF}/documents.parquet").where("doc_id < 60").collect()]
    df = spark.createDataFrame([(i, t, 7) for i, t in enumerate(texts)], "doc_id long, text string, length int").repartition(3)
    ids = {i: full.encode(t or "", add_special_tokens=False).ids + [0] for i, t in enumerate(texts)}
    rows = packing.digest(packing.pack(df)).collect()
    docs, seqs = defaultdict(list), defaultdict(list)
    for r in rows:
        docs[r.doc_id].append((r.start, r.length))
        seqs[r.sequence_id].append((r.offset, r.length))
        part = ids[r.doc_id][r.start : r.start + r.length]
        assert len(part) == r.length and r.doc_tokens == len(ids[r.doc_id])
        assert r.ids_crc32 == zlib.crc32(np.array(part, "<u4").tobytes())
    for i, parts in docs.items():
        ends = [0] + [s + n for s, n in sorted(parts)]
        assert [s for s, _ in sorted(parts)] == ends[:-1] and ends[-1] == len(ids[i])
    assert set(docs) == set(ids)
    for parts in seqs.values():
        ends = [0] + [s + n for s, n in sorted(parts)]
        assert [s for s, _ in sorted(parts)] == ends[:-1]
        assert ends[-1] <= 1024 and ends[-1] & (ends[-1] - 1) == 0  # no padding at all
    assert packing.pack(df.limit(0)).count() == 0


def test_a_finished_task_gives_memory_back(monkeypatch):
    """Workers live on beside the next stage's; Arrow's pool kept what a task had freed."""
    import pyarrow as pa

    from affinis.llm import textops

    calls = []
    monkeypatch.setattr(textops, "trim", lambda was=textops.trim: calls.append(was()))
    batch = pa.record_batch([pa.array([1])], ["x"])
    task = textops.trimmed(lambda batches: (b for b in batches))
    out = task(iter([batch]))
    assert next(out) is batch and not calls
    assert list(out) == [] and calls == [None]
