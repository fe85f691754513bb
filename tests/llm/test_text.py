"""Canonical text, leaked items and mixtures: plain versions on fixtures, and odd tables."""

import random
import unicodedata

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from factorloom.llm.canonical import canonical_text, look_alike_classes, look_alike_pairs
from factorloom.llm.canonical import canonical_from, run_sql
from factorloom.llm.leakage import WORDS, leaked_items, matches, tile, windows
from factorloom.llm.mixing import mix_sources, pivotal, source_key, token_sizes
from factorloom.llm.queries import p9_found

DOCS = "doc_id long, text string, canonical string, source string, tokens string"


def docs(spark, rows):
    return spark.createDataFrame([(i, t, "clash", "s", "clash") for i, t in rows], DOCS)


# canonical form
SAME = [
    ("Café no. 1", "Café no. 1"),
    ("price of oil", "рrісе оf оil"),
    ("full width 42", "ｆｕｌｌ　ｗｉｄｔｈ　４２"),
    ("office fluff", "oﬃce ﬂuﬀ"),
    ("zero width", "ze​ro⁠ wi﻿dth­"),
    ("a b", "a b"),
    ("a b", "a b"),
    ("line\nbreak", "line\r\nbreak"),
    ("ΑΒΕ ABE", "ABE ABE"),
    ("ёлка", "ёлка"),
    ("é", "e‍́"),
]
OTHER = [("Case", "case"), ("a b", "a  b"), ("resume", "résumé"), ("a\nb", "a b"), ("1", "l"), ("x2", "x²"), ("и", "n")]


def test_canonical_pairs(spark):
    flat = [t for pair in SAME + OTHER for t in pair]
    got = {r.doc_id: r.canonical for r in canonical_text(docs(spark, enumerate(flat))).collect()}
    for k, (a, b) in enumerate(SAME + OTHER):
        assert (got[2 * k] == got[2 * k + 1]) == (k < len(SAME)), (a, b)
    again = {r.doc_id: r.canonical for r in canonical_text(docs(spark, got.items())).collect()}
    assert again == got


def test_canonical_of_odd_texts(spark):
    long = "а́ long text " * 20_000
    rows = [(1, None), (2, ""), (3, "​"), (4, long), (4, long), (5, "'quote' \\x")]
    got = [(r.doc_id, r.canonical) for r in canonical_text(docs(spark, rows)).orderBy("doc_id").collect()]
    assert got[:3] == [(1, None), (2, ""), (3, "")] and got[3] == got[4] == (4, unicodedata.normalize("NFC", "á long text ") * 20_000) and got[5] == (5, "'quote' \\x")
    assert canonical_text(docs(spark, [])).count() == 0


def test_look_alike_pairs_and_classes(spark):
    rows = [(1, "abc"), (2, "аbc"), (3, "abc"), (4, "a​bc"), (5, "ABC"), (6, None), (7, " "), (8, " "), (9, ""), (10, "x"), (11, "x"), (None, "аbс")]
    for piece in (100, 1):
        got = sorted(map(tuple, look_alike_pairs(docs(spark, rows), every_pair=True, piece_rows=piece).collect()))
        assert got == [(1, 2), (1, 4), (2, 3), (2, 4), (3, 4)]
    assert sorted(map(tuple, look_alike_pairs(docs(spark, rows)).collect())) == [(1, 2), (1, 4)]
    classes = {r.doc_id: (r.class_id, r.variants, r.links) for r in look_alike_classes(docs(spark, rows)).collect()}
    assert classes == {1: (1, 3, 2), 2: (1, 3, 3), 3: (1, 3, 2), 4: (1, 3, 3), 5: (5, 1, 0), 10: (10, 1, 0), 11: (10, 1, 0)}
    many = [(i, "abc") for i in range(40)] + [(100 + i, "аbc") for i in range(40)]
    assert look_alike_pairs(docs(spark, many), every_pair=True).count() == 1600
    assert look_alike_pairs(docs(spark, many)).count() == 1
    assert look_alike_pairs(docs(spark, [])).count() == 0 and look_alike_classes(docs(spark, [])).count() == 0


def test_variants_of_one_text_in_linear_rows(spark):
    n = 100_000
    text = F.concat(F.lit("a"), F.array_join(F.transform(F.sequence(F.lit(0), F.lit(16)), lambda k: F.when(F.getbit("id", k) == 1, "\u200b").otherwise("\u200c")), ""), F.lit("b"))
    df = spark.range(n).select(F.col("id").alias("doc_id"), text.alias("text"))
    assert look_alike_pairs(df).count() == n - 1
    assert look_alike_classes(df).filter(f"variants = {n} and links = {n - 1} and class_id = 0").count() == n


def test_every_pair_of_many_copies(spark, tmp_path):
    texts = {"abc": range(101), "аbc": range(200, 300), "a​bc": range(400, 403), "other": range(500, 620)}
    rows = [(i, t) for t, ids in texts.items() for i in ids]
    alike = [set(ids) for t, ids in texts.items() if t != "other"]
    want = {(a, b) for x in alike for y in alike if x is not y for a in x for b in y if a < b}
    for piece in (100, 7):
        got = list(map(tuple, look_alike_pairs(docs(spark, rows), piece_rows=piece, every_pair=True).collect()))
        assert len(got) == len(want) and set(got) == want
    docs(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    assert set(map(tuple, p9_found(spark, str(tmp_path)).collect())) == want


# leakage
def brute_tiles(a, b, n):
    """Greedy string tiling by definition: the longest unmarked match, marked, until none of n words is left."""
    ma, mb, out = [False] * len(a), [False] * len(b), []
    while True:
        best = 0
        for i in range(len(a)):
            for j in range(len(b)):
                k = 0
                while i + k < len(a) and j + k < len(b) and a[i + k] == b[j + k] and not ma[i + k] and not mb[j + k]:
                    k += 1
                if k > best:
                    best, at = k, (i, j)
        if best < n:
            return out
        out.append(best)
        for k in range(best):
            ma[at[0] + k] = mb[at[1] + k] = True


def places(text, n):
    """Positions of each window of n words."""
    out = {}
    for i in range(len(text) - n + 1):
        out.setdefault(tuple(text[i : i + n]), []).append(i)
    return {k: np.array(v) for k, v in out.items()}


def test_tiling_against_brute_force():
    rng = random.Random(7)
    for k in range(400):
        letters = "abcdefgh" if k % 2 else "ab"  # the latter repeats itself
        item = [rng.choice(letters) for _ in range(rng.randrange(4, 25))]
        doc = [rng.choice(letters + "xyz") for _ in range(rng.randrange(0, 30))]
        cut = rng.randrange(len(item))
        doc[3:3] = item[cut:] + item[:cut]
        found = matches(places(doc, 3), places(item, 3), 3)
        for length, d, i in found:
            assert doc[d : d + length] == item[i : i + length]
        got, want = tile(found, 3), brute_tiles(doc, item, 3)
        assert got[:1] == want[:1] and sorted(got, reverse=True) == got and sum(got) <= len(item)


def test_matches_of_repetitive_texts():
    doc, item = ["w"] * 8000, ["w"] * 200
    found = matches(places(doc, 12), places(item, 12), 12)
    assert len(found) < 8300 and tile(found, 12) == [200]


def test_windows_by_hash():
    words = np.array([1, 2, 3, 1, 2, 3, 9, 1, 2, 3], np.uint64)
    text, at, h1, h2 = windows(words, np.array([4, 0, 6]), 3)
    assert text.tolist() == [0, 0, 2, 2, 2, 2] and at.tolist() == [0, 1, 0, 1, 2, 3]
    assert h1[0] == h1[5] and h2[0] == h2[5] and len({*h1.tolist()}) == 5
    assert len(windows(words, np.array([10]), 11)[0]) == 0


def test_recall_of_reordered_passages(spark):
    """Items cut into passages that come in another order, with other words between them."""
    rng = random.Random(11)
    items = [r.text for r in spark.read.parquet("/root/testdata/sf0.01/eval_items.parquet").orderBy("item_id").select("text").collect()]
    planted, rows = [], []
    for k, text in enumerate(items):
        w = text.split()
        cuts = [w[i : i + 9] for i in range(0, len(w) // 9 * 9, 9)]
        if len(cuts) < 2:
            continue
        rng.shuffle(cuts)
        planted.append(k)
        rows.append((k, " ".join(" ".join([*c, f"between{rng.random()}"]) for c in cuts)))
    table = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    got = {(r.doc_id, r.item_id) for r in leaked_items(docs(spark, rows), table, shortest_tile=5, least_run=12, least_coverage=0.5).collect()}
    recall = sum((k, k) in got for k in planted) / len(planted)
    assert len(planted) > 100 and recall >= 0.9, recall


ITEM = " ".join(f"w{i}" for i in range(30))


def test_leaked_items(spark):
    part = " ".join(f"W{i}" for i in range(5, 17))
    moved = " ".join([*(f"w{i}" for i in range(20, 30)), "x", *(f"w{i}" for i in range(10))])
    rows = [(1, f"before {part}, after"), (2, part.rsplit(" ", 1)[0]), (3, part.replace("W", "ｗ")), (4, moved), (5, None), (6, ""), (7, "..."), (8, "y " * 100_000 + part), (1, f"before {part}, after")]
    items = spark.createDataFrame([(1, ITEM, 0), (2, None, 0), (3, "too short", 0), (4, f"q {part} q", 0)], "item_id int, text string, doc_id int")
    got = sorted((r.doc_id, r.item_id) for r in leaked_items(docs(spark, rows), items).collect())
    assert got == [(d, i) for d in (1, 3, 8) for i in (1, 4)]
    salted = sorted((r.doc_id, r.item_id) for r in leaked_items(docs(spark, rows), items, hot_rows=1).collect())
    assert salted == got
    more = {(r.doc_id, r.item_id): r for r in leaked_items(docs(spark, rows), items, shortest_tile=5, least_run=12, least_coverage=0.6).collect()}
    assert more[4, 1].tiles == 2 and more[4, 1].matched_words == 20 and more[4, 1].coverage == pytest.approx(2 / 3)
    assert leaked_items(docs(spark, []), items).count() == 0 and leaked_items(docs(spark, rows), items.limit(0)).count() == 0


def test_words():
    batch = pa.table({"text": ["It's A_b, 中文2 é!", "...", ""]})
    assert run_sql(batch, f"SELECT {WORDS} AS w FROM {canonical_from('batch', 'text')}")["w"].to_pylist() == [["it", "s", "a", "b", "中文2", "é"], [], []]


# mixing
def test_pivotal_keeps_mass_and_expectation():
    size = np.array([5.0, 1.0, 9.0, 3.0, 7.0, 2.0])
    p = np.array([0.3, 0.3, 0.3, 0.9, 0.0, 1.0])
    total = np.zeros(6)
    for seed in range(4000):
        q = pivotal(p, size, np.random.default_rng(seed))
        assert (q * size).sum() == pytest.approx((p * size).sum())
        assert ((q > 1e-9) & (q < 1 - 1e-9)).sum() <= 1
        total += q
    assert np.abs(total / 4000 - p).max() < 0.03


def mixture(spark, rows, targets, **kw):
    d = spark.createDataFrame(rows, "doc_id long, text string, source string, tokens int, copies int")
    t = spark.createDataFrame(targets, "source string, target_share double, max_repeats int")
    copies, shares = mix_sources(d, t, **kw)
    return copies, {r.source: r for r in shares.collect()}


def test_mixture_reaches_shares(spark):
    rng = random.Random(1)
    rows = [(i, "word " * rng.randrange(5, 60), ["big", "Small-One", " small one", None, "other"][0 if i % 4 else 1 + i % 3], 0, 0) for i in range(3000)]
    rows += [(5000, None, "big", 0, 0), (5001, "", "big", 0, 0), (None, "no id", "big", 0, 0)]
    targets = [("big", 0.5, 1), ("small_one", 0.4, 4), ("absent", 0.1, 9)]
    copies, shares = mixture(spark, rows, targets)
    assert shares["big"].actual_share == pytest.approx(0.5 / 0.9, abs=0.002) and shares["small_one"].actual_share == pytest.approx(0.4 / 0.9, abs=0.002)
    assert shares["absent"].actual_share == 0 and shares["absent"].tokens == 0
    got = {r.doc_id: r.copies for r in copies.collect()}
    assert max(got.values()) <= 4 and all(v == 1 for k, v in got.items() if rows[k][2] == "big")
    assert {r.doc_id: r.copies for r in mixture(spark, rows, targets)[0].collect()} == got
    half = mixture(spark, rows, targets, total_tokens=20_000)[1]
    assert sum(r.used_tokens for r in half.values()) == pytest.approx(20_000, rel=0.01)
    with pytest.raises(ValueError):
        mixture(spark, rows, targets, total_tokens=10**9)


def test_mixture_in_chunks(spark, monkeypatch):
    monkeypatch.setattr("factorloom.llm.mixing.CHUNK", 50)
    monkeypatch.setattr("factorloom.llm.mixing.FAN", 3)
    rows = [(i, "word " * (1 + i % 37), "a" if i % 3 else "b", 0, 0) for i in range(2000)]
    _, shares = mixture(spark, rows, [("a", 0.3, 2), ("b", 0.7, 3)])
    assert shares["a"].actual_share == pytest.approx(0.3, abs=0.002)


def test_mixture_of_nothing(spark):
    copies, shares = mixture(spark, [], [("a", 1.0, 1)])
    assert copies.count() == 0 and shares["a"].actual_share == 0
    copies, shares = mixture(spark, [(1, "x", "a", 0, 0)], [])
    assert copies.count() == 0 and shares == {}


def test_token_sizes_are_of_whole_texts(spark):
    d = spark.createDataFrame([(1, "hello world", " News "), (2, None, "risk-factors"), (3, "a" * 200_000, None)], "doc_id long, text string, source string")
    got = {r.doc_id: (r.source, r.tokens) for r in token_sizes(d).collect()}
    assert got[1] == ("news", 2) and got[2] == ("risk_factors", 0) and got[3][0] is None and got[3][1] > 10_000
    assert source_key("x") is not None
