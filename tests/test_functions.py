"""Text and similarity functions on known pairs and against textbook forms."""

import random

import pytest
from pyspark.sql import functions as F

from affinis.functions import fuzzy, text
from affinis.sources import tsv


def test_romanisation_and_scripts(spark):
    assert text.latin("आदित्य प्रोडक्ट्स") == "adity prodakts" and text.latin("ಹರಿ ಲಾಜಿಸ್ಟಿಕ್ಸ್") == "hari lajistiks" and text.latin("Léarning Çoncept") == "Learning Concept"
    assert text.latin("कंपनी हिंदी फ़िल्म ज़रा १२ राम।") == "kampani hindi film zara 12 rama " and text.latin("ਪੰਜਾਬ தமிழ் മലയാളം") == "panjab tamil malayalan"
    kinds = [r.k for r in spark.createDataFrame([("abc",), ("Él",), ("E\u0301l",), ("हरि a",), ("漢",), ("é漢",), ("ｆ",), (None,)], "x string").select(text.script_class(F.col("x")).alias("k")).collect()]
    assert kinds == ["ascii", "latin_accented", "latin_accented", "indic", "other", "other", "other", "ascii"]


def test_skeleton_and_normalisation(spark):
    words = ["PRODUCTS", "PRODAKTS", "LOGISTICS", "LAJISTIKS"]
    got = [r.s for r in spark.createDataFrame([(w,) for w in words], "w string").select(text.skeleton(F.col("w")).alias("s")).collect()]
    assert got == ["PRDKTS", "PRDKTS", "LJSTKS", "LJSTKS"]
    df = spark.createDataFrame([("Acme  L.L.P.", "NO:107/2 Main Street, New York 003544"), ("Ltd", None), ("Café d’Or SARL", "0")], "business_name string, business_address string")
    a, b, c = text.normalized(df).collect()
    assert a.name_s == "ACME" and a.addr_n == "NO 107 2 MAIN ST NY 003544" and a.addr_nums == ["107", "2", "3544"]
    assert b.name_s == "LTD" and b.addr_n == "" and c.name_s == "CAFE DOR" and c.name_script == "other" and c.addr_nums == ["0"]


def plain_lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        new = [0]
        for j, y in enumerate(b):
            new.append(row[j] + 1 if x == y else max(new[-1], row[j + 1]))
        row = new
    return row[-1]


def test_ratios():
    rng = random.Random(6)
    for _ in range(300):
        a, b = ("".join(rng.choices("abcd ", k=rng.randrange(12))) for _ in "xy")
        assert fuzzy.lcs(a, b) == plain_lcs(a, b)
    assert fuzzy.ratio_of("", "") == 100 and fuzzy.ratio_of("abc", "") == 0 and fuzzy.partial_of("bcd", "abcde") == 100
    assert round(fuzzy.jaro_winkler_of("MARTHA", "MARHTA"), 2) == 96.11 and round(fuzzy.jaro_winkler_of("DIXON", "DICKSONX"), 2) == 81.33


def plain_ratio(a, b):
    return 200 * plain_lcs(a, b) / (len(a) + len(b)) if a or b else 100.0


def plain_partial(a, b):
    """Every stretch of the longer text that is as long as the shorter, or cut by an end."""
    if not a or not b:
        return 100.0 if a == b else 0.0
    pairs = [(a, b)] if len(a) < len(b) else [(b, a)] if len(b) < len(a) else [(a, b), (b, a)]
    return max(plain_ratio(s, t[max(i, 0) : i + len(s)]) for s, t in pairs for i in range(1 - len(s), len(t)))


def plain_token_set(a, b):
    x, y = set(a.split()), set(b.split())
    if not x or not y:
        return 0.0
    line = lambda *sets: " ".join(t for s in sets for t in sorted(s))
    s, sx, sy = line(x & y), line(x & y, x - y), line(x & y, y - x)
    return max([plain_ratio(sx, sy)] + ([plain_ratio(s, sx), plain_ratio(s, sy)] if s else []))


def test_ratios_by_brute_force(spark):
    rng = random.Random(16)
    rows = [("".join(rng.choices("abc ", k=rng.randrange(14))), "".join(rng.choices("abc ", k=rng.randrange(14)))) for _ in range(400)]
    rows += [("".join(rng.choices("abcdé ", k=rng.randrange(60, 68))), "".join(rng.choices("abcdé ", k=rng.randrange(55, 90)))) for _ in range(20)]
    rows += [("a" * 64, "a" * 63 + "b"), ("a" * 64, "ba" * 40), ("ab\0", "a\0b"), ("", "")]
    rows += [("new york mets", "mets york new"), ("a b", "a b c d"), ("", "x"), ("a", "b"), ("漢字 é", "é 漢"), (None, "a")]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, a string, b string")
    got = df.withColumn("s", fuzzy.similarities({n: (n, F.col("a"), F.col("b")) for n in fuzzy.SCORERS})).orderBy("i").collect()
    for r in got[:-1]:
        want = (plain_ratio(r.a, r.b), plain_ratio(" ".join(sorted(r.a.split())), " ".join(sorted(r.b.split()))), plain_token_set(r.a, r.b), plain_partial(r.a, r.b))
        assert [round(x, 9) for x in want] == [round(x, 9) for x in (r.s.ratio, r.s.tsort, r.s.tset, r.s.partial)], r
    assert got[-1].s.ratio is None and got[-1].s.jw is None


def test_tsv_round_trip(spark, tmp_path):
    (tmp_path / "in.tsv").write_text('entity_id\tcountry\tbusiness_name\tbusiness_address\n1\tUS\tA "quoted\tx\n2\tIN\t\ty\n')
    (tmp_path / "in2.tsv").write_text("entity_id\tcountry\tbusiness_name\tbusiness_address\r\n3\tFR\tÉ\tz\r\n")
    assert [tuple(r) for r in tsv.read(spark, str(tmp_path / "in*.tsv")).orderBy("entity_id").collect()][2] == ("3", "É", "z", "FR")
    (tmp_path / "bad.tsv").write_text("entity_id\tcountry\n1\tUS\n2\n")
    with pytest.raises(Exception, match="not 2 fields"):
        tsv.read(spark, str(tmp_path / "bad.tsv")).collect()
    rows = tsv.read(spark, str(tmp_path / "in.tsv")).orderBy("entity_id").collect()
    assert rows[0].business_name == 'A "quoted' and rows[1].country == "IN"
    tsv.write_lists(spark.createDataFrame([(1, "5,6"), (2, "")], "id long, ids string"), str(tmp_path / "out"))
    assert "1\t5,6" in "".join(p.read_text() for p in (tmp_path / "out").glob("part*"))


def test_sinks(spark, tmp_path):
    tsv.write_report(spark, {"f05": 0.5, "n": 3}, f"{tmp_path}/report")
    assert tsv.read_report(spark, f"{tmp_path}/report") == {"f05": 0.5, "n": 3}
    tsv.write_table(spark.createDataFrame([("a", 1.5), ("b", None)], "k string, v double").coalesce(1), f"{tmp_path}/curve")
    assert "".join(p.read_text() for p in (tmp_path / "curve").glob("part*")) == "k\tv\na\t1.5\nb\t\n"
    tsv.write_records(spark.createDataFrame([(1, "A/B"), (2, "A B"), (3, None)], "id long, country string"), f"{tmp_path}/records")
    assert sorted((r.id, r.country) for r in spark.read.parquet(f"{tmp_path}/records").collect()) == [(1, "A/B"), (2, "A B"), (3, None)]


def test_second_stage_by_brute_force(spark):
    from affinis.operators import reports

    names = {10: ("red ring", "x street"), 11: ("red ring", ""), 12: ("old bolt", "x street"), 13: (None, None)}
    rows = [(0, 10, 0.9), (0, 11, 0.8), (0, 12, 0.3), (1, 13, 0.4), (2, 12, 0.5), (2, 10, 0.5)]
    pairs = spark.createDataFrame([(s, p, q, 0.0, 1, q) for s, p, q in rows], "s1_row long, pool_row long, p1 double, xenc double, inb int, pf double")
    texts = spark.createDataFrame([(k, *v) for k, v in names.items()], "pool_row long, name string, addr string")
    got = {(r.s1_row, r.pool_row): r for r in reports.second_stage(pairs, texts, 0.5).collect()}
    assert len(got) == len(rows) and len(got[0, 10]) == 20
    for s, p, q in rows:
        order = sorted((-x, r) for t, r, x in rows if t == s)
        ref = next((r for _, r in order if r != order[0][1]), None) if p == order[0][1] else order[0][1]
        f, (name, addr) = got[s, p], (v or "" for v in names[p])
        assert f.pf_rank == 1 + [r for _, r in order].index(p) and f.pf_n_t == sum(x >= 0.5 for t, _, x in rows if t == s)
        assert f.n_same_name == sum((names[r][0] or "") == name for t, r, _ in rows if t == s)
        assert f.n_same_addr == (sum((names[r][1] or "") == addr for t, r, _ in rows if t == s) if addr else None)
        other = (names[ref][0] or "", names[ref][1] or "") if ref is not None else None
        assert f.sib_n_ratio == (None if other is None else pytest.approx(plain_ratio(name, other[0])))
        assert f.sib_n_tset == (None if other is None else pytest.approx(plain_token_set(name, other[0])))
        assert f.sib_a_tset == (pytest.approx(plain_token_set(addr, other[1])) if other and addr and other[1] else None)
        assert f.sib_same_addr == int(bool(other) and addr != "" and addr == other[1])


def test_recall_grid_by_brute_force(spark):
    from affinis.operators import reports

    rng = random.Random(2)
    views = {}
    for v in ("a", "b"):
        rows = []
        for s in range(12):
            picks = rng.sample(range(100, 130), 8)
            rows += [(s, p, "x", 1.0 - k / 10, k + 1) for k, p in enumerate(picks)]
        views[v] = rows
    truth = [(s, p, "xy"[s % 2]) for s in range(12) for p in rng.sample(range(100, 130), 6)]
    frames = {v: spark.createDataFrame(r, "s1_row long, pool_row long, country string, score double, rank int") for v, r in views.items()}
    mixes, caps = [{"a": 8}, {"a": 3, "b": 5}], (2, 6)
    got = {(r.mix, r.cap, r.land): (r.n_true, r.n_found) for r in reports.recall_grid(spark.createDataFrame(truth, "s1_row long, pool_row long, land string"), frames, mixes, caps, "land").collect()}
    for n, mix in enumerate(mixes):
        for cap in caps:
            found = dict.fromkeys("xy", 0)
            for s in range(12):
                seen = {}
                for v, k in mix.items():
                    for t, p, _, score, rank in views[v]:
                        if t == s and rank <= k:
                            seen.setdefault(p, []).append((rank, score))
                best = sorted(seen, key=lambda p: (min(r for r, _ in seen[p]), -len(seen[p]), -max(x for _, x in seen[p]), p))[:cap]
                for t, p, land in truth:
                    found[land] += t == s and p in best
            assert all(got[n, cap, c] == (36, found[c]) for c in "xy")
