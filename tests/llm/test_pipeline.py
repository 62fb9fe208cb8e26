"""The pipeline's stages: columns, what goes, what stays."""

from collections import Counter, defaultdict

import pytest

import corpus_pipeline
from affinis.llm import neardup, packing

SF = "/root/testdata/sf0.001"
TOXIC = "You idiot clown. Pathetic worthless trash, stupid moron loser scum. "


@pytest.fixture(scope="module")
def stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(200)
    passage = " ".join(f"passage{i}" for i in range(70))
    body = lambda k: " ".join(f"t{k}w{i}" for i in range(150))
    more = [(9000 + k, f"{body(k)}\n{passage}\n{body(k + 50)}", "en", "own", 0) for k in range(2)]
    more += [(9100, body(7), "en", "own", 0), (9101, body(7) + " changed", "en", "own", 0), (9102, None, None, None, None), (9103, "", "en", "own", 0)]
    more += [(9200, body(8) + " password = hunter2hunter2 end", "en", "own", 0)]
    docs = docs.unionByName(spark.createDataFrame(more, docs.schema))
    out = [docs]
    for _, stage in corpus_pipeline.STAGES:
        out.append(stage(spark, out[-1], SF).cache())
    return out


def test_columns_and_order(stages):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "near_duplicates", "suffix_array", "secrets", "packing"]
    assert all(df.columns == stages[0].columns and [t for _, t in df.dtypes] == [t for _, t in stages[0].dtypes] for df in stages[:-1])


def test_decisions_take_effect(stages):
    ids = [Counter(r.doc_id for r in df.select("doc_id").collect()) for df in stages]
    assert not ids[1] - ids[0] and not ids[2] - ids[1] and ids[3] == ids[2] and ids[4] == ids[3]
    assert {9000, 9001, 9100, 9102, 9103, 9200} <= set(ids[2]) and 9101 not in ids[2]
    cut = {r.doc_id: r for r in stages[3].where("doc_id >= 9000").collect()}
    assert "passage5" not in cut[9000].text and "passage5" not in cut[9001].text and "t0w148" in cut[9000].text and cut[9102].text is None
    assert cut[9000].n_chars == len(cut[9000].text)
    clean = {r.doc_id: r.text for r in stages[4].where("doc_id >= 9000").collect()}
    assert "hunter2" not in clean[9200] and clean[9200].endswith("[SECRET] end") and clean[9102] is None
    pieces = defaultdict(int)
    for r in stages[5].collect():
        pieces[r.doc_id] += r.length
    encode = packing.tokenizer("byte_bpe_50k.json", "byte_bpe_50k.tiktoken")
    assert pieces == {r.doc_id: len(encode(r.text or "")) // 4 + 1 for r in stages[4].collect()}


def test_odd_rows_and_columns(spark):
    """Repeated rows, nulls everywhere, a very long text and columns whose names the stages use themselves."""
    clash = "id long, row int, h1 string, kept boolean, label string, v int, base string, severity double"
    long = " ".join(f"long{i}" for i in range(60_000))
    body = lambda k: " ".join(f"b{k}w{i}" for i in range(90))
    rows = [(1, body(1)), (1, body(1)), (2, body(1)), (3, long), (4, ""), (5, None), (None, body(6)), (None, body(6)), (7, body(7) + " token=abcdef123 end"), (7, body(8))]
    docs = spark.createDataFrame([(i, t, "en" if k % 2 else None, None if k % 3 else "src", None, 9, 8, "h", None, "l", 7, "b", 0.5) for k, (i, t) in enumerate(rows)], "doc_id long, text string, lang string, source string, n_chars long, " + clash)
    kept = [docs]
    for _, stage in corpus_pipeline.STAGES:
        kept.append(stage(spark, kept[-1], SF).cache())
    assert all(df.dtypes == docs.dtypes for df in kept[:-1])
    counts = [Counter(r.doc_id for r in df.collect()) for df in kept[:-1]]
    assert counts[0] == counts[1] and counts[2] == counts[3] == counts[4] == Counter({1: 1, 3: 1, 4: 1, 5: 1, 7: 1, None: 2})
    texts = {r.doc_id: r for r in kept[4].collect()}
    assert texts[3].text == long and texts[5].text is None and texts[4].text == "" and texts[3].severity == 0.5 and texts[3].kept is None
    assert texts[None].text != body(6)  # its two rows repeat each other's passage
    sums = Counter()
    for r in kept[5].collect():
        sums[r.doc_id] += r.length
    assert set(sums) == {1, 3, 4, 5, 7, None} and sums[4] == sums[5] == 1


def test_empty_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF)
        assert docs.count() == 0


def test_near_copies_from_80_percent_on_go(spark):
    rows = []
    for k in range(40):  # two scattered edits in 120 words: 106 of 126 shingles, 0.84; four in 180: 156 of 196, 0.796
        for base, size, edits in ((10_000, 120, (30, 80)), (20_000, 180, (20, 60, 100, 140))):
            words = [f"d{k}s{size}w{i}" for i in range(size)]
            copy = [f"edit{i}" if i in edits else w for i, w in enumerate(words)]
            rows += [(base + 2 * k, " ".join(words)), (base + 2 * k + 1, " ".join(copy))]
    kept = {r.doc_id for r in corpus_pipeline.one_of_each_group(spark, spark.createDataFrame(rows, "doc_id long, text string"), SF).collect()}
    assert kept == {10_000 + 2 * k for k in range(40)} | {20_000 + k for k in range(80)}


def test_search_follows_the_threshold():
    assert [neardup.trees_for(p) for p in (85, 80)] == [8, 11]
    assert all(round(s, 3) == t for s, t in ((neardup.least_equal(85), 0.724), (neardup.least_equal(80), 0.659)))
