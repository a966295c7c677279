"""Ranked search against plain scoring of every document, and odd input."""

import math
import random
import re
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from martloom.llm import ranked_search as search

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
DOC, ITEM = "doc_id long, text string", "item_id long, text string"


def words(text):
    small = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return TERM.findall(small)


def plain(docs, items, k):
    """Scores every document for every item, one after the other."""
    held = [(i, Counter(words(t))) for i, t in docs if i is not None]
    held = [(i, c) for i, c in held if c]
    n, total = len(held), sum(c.total() for _, c in held)
    df = Counter(t for _, c in held for t in c)
    rows = []
    for item, text in items:
        scored = []
        for doc, count in held:
            m = 100 - 25 + 25 * count.total() * n // total
            score = 0
            for term in words(text):
                if term in count:
                    w = math.floor(1000 * math.log((2 * n + 2) / (2 * df[term] + 1)))
                    score += w * (10**9 * count[term] // (1000 * count[term] + 12 * m))
            if score > 0:
                scored.append((-score, doc))
        rows += [(item, rank, doc, -s) for rank, (s, doc) in enumerate(sorted(scored)[:k], 1)]
    return sorted(rows)


def found(spark, docs, items, k):
    given = spark.createDataFrame(docs, DOC).repartition(3)
    result = search.ranked_search(given, spark.createDataFrame(items, ITEM), k)
    return sorted(tuple(r) for r in result.collect())


def test_equals_plain_scoring(spark):
    rng = random.Random(5)
    terms = [f"w{i}" for i in range(60)]
    weights = [1 / (i + 1) for i in range(60)]
    docs = [(i, " ".join(rng.choices(terms, weights, k=rng.randint(0, 40)))) for i in range(900)]
    items = [(i, " ".join(rng.choices(terms, weights if i % 2 else None, k=rng.randint(1, 30)))) for i in range(25)]
    assert found(spark, docs, items, 7) == plain(docs, items, 7)


def test_skipping_returns_the_same(monkeypatch):
    """Small steps and blocks, ties, and lists short and long in one block."""
    monkeypatch.setattr(search, "STEP", 3)
    rng = np.random.default_rng(3)
    for _ in range(60):
        size, ids = 200, rng.permutation(1000)[:200]
        lists = []
        for _ in range(rng.integers(1, 9)):
            places = np.sort(rng.choice(size, rng.integers(1, size), replace=False)).astype(np.int32)
            lists.append((places, rng.integers(1, 5, len(places)) * rng.choice([1, 50])))
        total = np.zeros(size, np.int64)
        for places, scores in lists:
            total[places] += scores
        best = search._Best(6)
        search._answer(lists, ids, 12, best)
        wanted = sorted((-s, i) for s, i in zip(total, ids) if s > 0)[:6]
        assert list(zip(-best.scores, best.ids)) == wanted


def test_odd_rows(spark):
    docs = [(1, None), (2, ""), (3, " .,; "), (4, "Äpfel apfel ÄPFEL"), (5, "äpfel x" * 3), (5, "äpfel x" * 3), (None, "apfel"),
            (6, "apfel" + " y" * 50_000), (7, "Apfel-apfel apfel")]
    items = [(1, "APFEL"), (2, None), (3, "?!"), (4, "unseen"), (5, "Ä äpfel Äpfel x x"), (None, "apfel")]
    assert found(spark, docs, items, 20) == plain(docs, [i for i in items if i[0] is not None and i[1]], 20)
    again = spark.createDataFrame([*items, (1, "x")], ITEM)  # of two texts of an item the smallest asks
    given = spark.createDataFrame(docs, DOC).withColumns({"terms": F.lit(1), "id": F.lit(-1), "score": F.lit("x")})
    rows = search.ranked_search(given, again).filter("item_id = 1").collect()
    assert [(r["doc_id"]) for r in rows] == [d for i, _, d, _ in plain(docs, [(1, "APFEL")], 20)]
    for few, asked in ((docs[:0], items), (docs, items[:0])):
        assert found(spark, few, asked, 20) == []


def test_long_texts_are_split_between_words(monkeypatch):
    monkeypatch.setattr(search, "STRETCH", 4)
    text = "Alpha beta gamma, delta epsilon" * 20
    assert search.terms_of(text.encode()) == Counter(w.encode() for w in words(text))
