"""The n-gram Jaccard join against all pairs of documents."""

import random
import re

import pytest

from cabinlens.llm import jaccard_join

WORD = re.compile("[^\x20\x09-\x0d]+")


def shingles(text, words=4):
    found = WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    return {tuple(found[i:i + words]) for i in range(max(1, len(found) - words + 1))} if found else set()


def brute(rows, percent=85):
    """(doc_id, n_shingles, component_id), by every pair of rows."""
    sets = [shingles(t) for _, t in rows]
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, (d, _) in enumerate(rows):
        for j in range(i):
            both = len(sets[i] & sets[j])
            linked = d == rows[j][0] or 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both)
            if d is not None and rows[j][0] is not None and sets[i] and sets[j] and linked:
                parent[root(i)] = root(j)
    out = []
    for i, (d, _) in enumerate(rows):
        same = [rows[j][0] for j in range(len(rows)) if root(j) == root(i) and rows[j][0] is not None]
        out.append((d, len(sets[i]), min(same) if d is not None else None))
    return sorted(out, key=str)


def run(spark, rows, **more):
    docs = spark.createDataFrame([(*r, 3, ["x"], 1) for r in rows], "doc_id long, text string, size int, bits array<string>, component_id int")
    return sorted((tuple(r) for r in jaccard_join.jaccard_components(docs, **more).collect()), key=str)


def edited(rng, words, edits):
    out = list(words)
    for _ in range(edits):
        i = rng.randrange(len(out))
        kind = rng.randrange(3)
        if kind == 0:
            out[i] = f"e{rng.randrange(10**6)}"
        elif kind == 1 and len(out) > 5:
            del out[i]
        else:
            out.insert(i, rng.choice(words))
    return out


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_equals_all_pairs(spark, seed):
    rng = random.Random(seed)
    pool = [f"w{i}" for i in range(300)]
    passage = [f"p{i}" for i in range(40)]
    rows = []
    for _ in range(12):  # groups around the threshold, chains of edits among them
        words = rng.choices(pool, k=rng.choice([6, 20, 60, 150, 400]))
        for _ in range(rng.randrange(2, 14)):
            words = edited(rng, words, rng.randrange(0, 1 + len(words) // 25)) if rng.random() < 0.5 else words
            rows.append(" ".join(edited(rng, words, rng.randrange(0, 2 + len(words) // 30))))
    rows += [" ".join(passage + rng.choices(pool, k=rng.randrange(1, 12))) for _ in range(40)]  # one passage, other ends
    rng.shuffle(rows)
    rows = [(i * 3 % 1009, t) for i, t in enumerate(rows)]
    assert run(spark, rows) == brute(rows)


def test_odd_rows(spark):
    long = " ".join(f"v{i % 5000}" for i in range(30000))
    rows = [
        (5, None), (6, ""), (7, " \t\n"), (8, "One Two"), (2, "one  two"), (9, "two one"), (None, "one two"), (None, None),
        (10, "a b c d e f g h"), (11, "A B C\u0085D e f g h"), (12, "a b c d e f g h"), (12, "a b c d e f g h"), (13, "a b c d E F G H"),
        (14, long), (15, long + " tail"), (16, "zz yy xx ww"), (16, "one two three four"), (17, "ONE two three\vfour"), (18, "Été x"),
        (19, "été x"), (20, "x"), (21, "x x x x x x x"), (22, "x x x x"), (12, "q r s t"), (12, ""),
    ]
    assert run(spark, rows) == brute(rows)


def test_pairs_grow_with_the_group(spark, monkeypatch):
    """Near copies of one text make about as many pairs as there are copies."""
    made = []
    real = jaccard_join.materialize

    def counted(df, name):
        out = real(df, name)
        if name == "pairs":
            made.append(out.count())
        return out

    monkeypatch.setattr(jaccard_join, "materialize", counted)
    base = [f"w{i}" for i in range(200)]
    sums = []
    for n in (100, 200, 400):
        rng = random.Random(n)
        rows = [(i, " ".join(edited(rng, base, 1))) for i in range(n)]
        made.clear()
        assert {c for _, _, c in run(spark, rows)} == {0}
        sums.append(sum(made))
    assert sums[2] < 3 * sums[1] < 9 * sums[0] and sums[2] < 10 * 400


def test_empty_table(spark):
    assert run(spark, [(1, "a")][:0]) == []
