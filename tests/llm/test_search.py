"""Ranked lexical search against a scan of all documents."""

import math
import random
import re
from collections import Counter

import pytest

from cabinlens.llm import lexical_search

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")


def words(text):
    return TERM.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items, k):
    bags = [(d, Counter(words(t)), len(words(t))) for d, t in docs if d is not None]
    n_docs, n_terms = sum(n > 0 for _, _, n in bags), sum(n for _, _, n in bags)
    df = Counter(t for _, b, _ in bags for t in b)
    out = []
    for item, text in set(items):
        scores = []
        for d, bag, n in bags:
            total = 0
            for t, c in Counter(words(text)).items():
                if bag[t]:
                    m = 25 + 75 * n * n_docs // n_terms
                    total += c * math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * bag[t] // (1000 * bag[t] + 8 * m))
            if total > 0:
                scores.append((-total, d))
        out += [(item, r, d, -s) for r, (s, d) in enumerate(sorted(scores)[:k], 1)]
    return sorted(out, key=str)


def run(spark, docs, items, **more):
    d = spark.createDataFrame([(*x, 1, 2) for x in docs], "doc_id long, text string, rank int, item_id long")
    i = spark.createDataFrame([(*x, "y") for x in items], "item_id long, text string, score string")
    return sorted((tuple(r) for r in lexical_search.rank(d, i, **more).collect()), key=str)


@pytest.mark.parametrize("blocks", [(1 << 18, 1 << 14), (40, 7), (1, 1)])
def test_equals_scan(spark, blocks):
    rng = random.Random(3)
    pool = [f"w{int(rng.paretovariate(0.7)) % 60}" for _ in range(400)] + ["Été", "ÀB", "x1"]
    docs = [(rng.randrange(500), " ".join(rng.choices(pool, k=rng.randrange(0, 60)))) for _ in range(150)]
    docs += [(900 + i, "w1 w2 same text") for i in range(30)]  # ties
    docs += [docs[0], docs[0], (None, "w1 w1"), (7, None), (8, ""), (9, "... !"), (10, "w1 " * 30000)]
    items = [(i, " ".join(rng.choices(pool, k=rng.randrange(1, 12)))) for i in range(12)]
    items += [(90, None), (91, ""), (92, "unknown"), (93, "w1 w1 W1 same"), (93, "w1 w1 W1 same"), (94, "SAME text"), (None, "w3"), (93, "w2")]
    for k in (1, 10):
        assert run(spark, docs, items, k=k, block_postings=blocks[0], block_docs=blocks[1]) == brute(docs, items, k)


def test_parts_of_items(spark):
    docs = [(i, f"a{i % 3} b{i % 5} c") for i in range(40)]
    items = [(i, f"a{i % 3} b{i % 7}") for i in range(30)]
    assert run(spark, docs, items, part_terms=20) == brute(docs, items, 10)


def test_empty_tables(spark):
    assert run(spark, [], [(1, "a")]) == []
    assert run(spark, [(1, "a")], []) == []
