"""Decontamination, ranked search and spelling variants on Spark, against brute force."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from hubflow.llm import lexical_search, spelling_variants, winnowing
from hubflow.llm.common import written

DOC = "doc_id long, text string, key string, words int, size long, item_id string, n long"
ITEM = "item_id long, text string, doc_id long, words string, window string"
UP = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def documents(spark, rows):
    """Documents with columns whose names clash with the operators' own."""
    return spark.createDataFrame([(k, t, "k", 1, 2, "i", 3) for k, t in rows], DOC)


def benchmark(spark, rows):
    return spark.createDataFrame([(k, t, 1, "w", "x") for k, t in rows], ITEM)


def prose(n, seed, kinds=40):
    rnd = random.Random(seed)
    return " ".join(f"W{rnd.randrange(kinds)}é" for _ in range(n))


def hits(docs, items):
    ws = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate(UP))
    windows = defaultdict(set)
    for k, t in items:
        w = ws(t)
        for i in range(len(w) - min(10, len(w)) + 1 if w else 0):
            windows[tuple(w[i:i + min(10, len(w))])].add("" if k is None else str(k))
    out = []
    for k, t in docs:
        w, at, ids = ws(t), set(), set()
        for size in {len(x) for x in windows}:
            for i in range(len(w) - size + 1):
                if found := windows.get(tuple(w[i:i + size])):
                    at |= set(range(i, i + size))
                    ids |= found
        out.append((k, len(w), len(at), len(ids), hashlib.sha256(",".join(sorted(ids)).encode()).hexdigest(), bool(at)))
    return out


def same(got, want):
    assert Counter(map(tuple, got)) == Counter(want)


ITEMS = [(1, prose(30, 1)), (2, prose(14, 2)), (2, prose(12, 3)), (None, prose(11, 4)), (5, "Lone"), (6, "two WORDS"), (7, None), (8, "!?"), (9, prose(30, 1)),
         (10, "rep rep rep rep rep rep rep rep rep rep rep rep")]


def test_winnowing_finds_every_window(spark):
    item = prose(30, 1)
    w = item.split()
    rows = [(1, None), (2, ""), (3, "..."), (None, "a " + item), (4, "x, " + " ".join(w[3:13]) + " y"), (5, " ".join(w[:9]) + " y " + " ".join(w[10:20])),
            (6, "a lone wolf; two words. Two-Words"), (7, prose(14, 2) + "\n" + prose(12, 3).upper().replace("É", "é")), (8, "rep " * 500), (9, prose(30_000, 7, 9)),
            (9, prose(30_000, 7, 9)), (11, " ".join(w[20:30]) + " " + " ".join(w[0:10])), (12, prose(11, 4)[:-3])]
    rows += [(100 + i, " ".join(w[i % 20:i % 20 + 10 + i % 4])) for i in range(40)] + [(None, item)] * 30
    same(winnowing.contaminated_documents(documents(spark, rows), benchmark(spark, ITEMS)).collect(), hits(rows, ITEMS))


def test_winnowing_of_random_texts_with_few_words(spark):
    items = [(i, prose(random.Random(i).randrange(1, 25), i, 3)) for i in range(40)]
    rows = [(i, prose(random.Random(i).randrange(0, 80), 1000 + i, 3)) for i in range(80)]
    same(winnowing.contaminated_documents(documents(spark, rows), benchmark(spark, items)).collect(), hits(rows, items))


def test_winnowing_of_empty_tables(spark):
    df, items = documents(spark, [(1, prose(20, 1))]), benchmark(spark, ITEMS)
    assert winnowing.contaminated_documents(df.limit(0), items).count() == 0
    same(winnowing.contaminated_documents(df, items.limit(0)).collect(), hits([(1, prose(20, 1))], []))


def test_winnowing_needs_no_python_worker(spark):
    plan = winnowing.contaminated_documents(documents(spark, [(1, "a b")]), benchmark(spark, ITEMS))._jdf.queryExecution().toString()
    assert "Python" not in plan and "MapInArrow" not in plan and "CartesianProduct" not in plan


def ranking(docs, items, k):
    ts = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", (t or "").translate(UP))
    counted = [(d, Counter(ts(t))) for d, t in docs]
    counted = [(d, c) for d, c in counted if c]
    n_docs, length = len(counted), sum(sum(c.values()) for _, c in counted)
    df = Counter(t for _, c in counted for t in c)
    asked = defaultdict(set)
    for i, t in items:
        asked[i] |= set(ts(t))
    out = []
    for i, terms in asked.items():
        scores = []
        for d, c in counted:
            m = 100 - 90 + 90 * sum(c.values()) * n_docs // length
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (1000000000 * c[t] // (1000 * c[t] + 8 * m)) for t in terms if c[t])
            if s > 0:
                scores.append((-s, d is None, d or 0))
        out += [(i, rank, None if none else d, -s) for rank, (s, none, d) in enumerate(sorted(scores)[:k], 1)]
    return out


def test_lexical_search(spark, monkeypatch):
    rows = [(i, prose(random.Random(i).randrange(0, 120), i, 60)) for i in range(150)] + [(7, None), (8, ""), (None, prose(50, 3, 60)), (9, prose(9000, 5, 80)), (151, "..")]
    rows += [(500 + i, prose(40, 77, 60)) for i in range(60)] + [(3, prose(40, 78, 60))] * 5
    items = [(i, prose(random.Random(i).randrange(0, 30), 900 + i, 70)) for i in range(25)] + [(None, "w1é W2É w2é"), (99, None), (98, "unseen"), (97, prose(500, 1, 80)), (97, "w3é")]
    want = ranking(rows, items, 10)
    for per_shard, per_block in ((10**6, 10**6), (700, 60)):
        monkeypatch.setattr(lexical_search, "POSTINGS_PER_SHARD", per_shard)
        monkeypatch.setattr(lexical_search, "PAIRS_PER_BLOCK", per_block)
        same(lexical_search.rank_documents(documents(spark, rows), benchmark(spark, items), 10).collect(), want)
    assert lexical_search.rank_documents(documents(spark, rows).limit(0), benchmark(spark, items)).count() == 0
    assert lexical_search.rank_documents(documents(spark, rows), benchmark(spark, items).limit(0)).count() == 0


def one_edit(words):
    cut = defaultdict(set)
    for w in words:
        for i in range(len(w)):
            cut[w[:i] + w[i + 1:], i].add(w)
    near = set()
    for (x, _), ws in cut.items():
        near |= {(a, b) for a in ws for b in ws if a != b}
        if x in words:
            near |= {(a, x) for a in ws} | {(x, a) for a in ws}
    return near


@pytest.mark.parametrize("max_depth", [64, 8])
def test_one_edit_pairs(spark, max_depth):
    rnd = random.Random(5)
    words = {"".join(rnd.choice("abé") for _ in range(rnd.randrange(6, 11))) for _ in range(400)}
    words |= {"aaaaaa", "aaaaaaa", "aaaaaaaa", "aaaaaaaaa", "bananas", "banana", "ananas", "banjana", "ç" * 7, "ç" * 8, "abababab", "babababa"}
    df = written(spark.createDataFrame([(w,) for w in sorted(words)], "word string"), "test-words")
    got = spelling_variants.one_edit_pairs(df, max_depth).collect()
    assert len(got) == len(set(map(tuple, got))) and set(map(tuple, got)) == one_edit(words)


def test_spelling_variants(spark):
    base = ["receive", "beautiful", "éclair", "straße", "x" * 200]
    rows = [(i, " ".join([*base, "beautifull"][:5 + i % 7 // 6]) + (" recieve RECEIVE\n" if i % 2 else " receivé ")) for i in range(60)]
    rows += [(None, "beautifull receives receives receives receives receives " + "x" * 199), (70, None), (71, ""), (72, "short a1b2"), (73, ("x" * 199 + " ") * 9)]
    rows += [(80, "hot word hotwords " * 2000)] + [(5, "copies copies")] * 20
    counts = Counter()
    for k, t in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            run = run.translate(UP)
            h = zlib.crc32(f"{'' if k is None else k}:{run}".encode())
            counts[run if h % 199 else run[:h % len(run)] + run[h % len(run) + 1:]] += 1
    counts = {w: n for w, n in counts.items() if n >= 5 and len(w) >= 6}
    near = defaultdict(set)
    for a, b in one_edit(set(counts)):
        near[a].add(b)
    form = {}
    for w, n in counts.items():
        best = min(near[w], key=lambda x: (-counts[x], x), default=None)
        if best and counts[best] >= 5 * n:
            form[w] = best

    def root(w):
        return root(form[w]) if w in form else w
    want = [(w, n, len(near[w]), form.get(w), counts.get(form.get(w)), root(w)) for w, n in counts.items()]
    same(spelling_variants.group_variants(documents(spark, rows)).select("word", "n", "n_near", "form", "form_n", "root").collect(), want)
    assert form and spelling_variants.group_variants(documents(spark, rows).limit(0)).count() == 0


def test_roots_follow_long_chains(spark):
    chain = written(spark.range(40).select(F.concat(F.lit("w"), F.col("id")).alias("word"), F.concat(F.lit("w"), F.col("id") + 1).alias("form")), "test-chain")
    assert {r["root"] for r in spelling_variants._roots(chain).collect()} == {"w40"}
