"""Decontamination, line dedup, near-duplicates and substring dedup against brute force."""

import collections
import hashlib
import random
import re

import numpy as np
import pytest

from cabinlens.llm import components, dart_minhash, decontaminate, line_dedup, substring_dedup

SCHEMA = "doc_id long, text string, n_words string, hash int, md string"


def frame(spark, rows):
    """Documents with further columns whose names the operators use inside."""
    return spark.createDataFrame([(i, t, "x", 1, "y") for i, t in rows], SCHEMA)


def words10(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


ITEMS = [(1, "a b c d e f g h i j k l"), (2, "Short One, here"), (3, "w w w w w w w w w w w w"), (4, None), (5, ""), (6, "É b c d e f g h i j"),
         (10, "c d e f g h i j k l m"), (None, "a b c d e f g h i j"), (1, "a b c d e f g h i j k l")]
DOCS = [(1, "x A b c d e f g h i j k y"), (2, "short one here SHORT one"), (3, " ".join("w" * 15)), (4, None), (5, ""), (6, "é b c d e f g h i j"),
        (7, "É b c d e f g h i j!"), (8, "z c d e f g h i j k l m n"), (None, "short one here"), (8, "z c d e f g h i j k l m n"), (9, "... !!!")]


def test_decontaminate_matches_brute_force(spark):
    wins = collections.defaultdict(set)
    for i, t in ITEMS:
        w = words10(t)
        for a in range(max(len(w) - 10, 0) + 1 if w and i is not None else 0):
            wins[tuple(w[a:a + 10])].add(str(i))
    want = []
    for d, t in DOCS:
        w, hit, items = words10(t), set(), set()
        for a in range(len(w)):
            for n in range(1, 11):
                key = tuple(w[a:a + n])
                if len(key) == n and key in wins:
                    hit.update(range(a, a + n))
                    items |= wins[key]
        sha = hashlib.sha256(",".join(sorted(items)).encode()).hexdigest()
        want.append((d, len(w), len(hit), len(items), sha, bool(hit)))
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    got = decontaminate.digest(decontaminate.contamination(frame(spark, DOCS), items)).collect()
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, want))
    kept = decontaminate.drop_contaminated(frame(spark, DOCS), items)
    assert kept.columns == SCHEMA.replace(" long", "").replace(" string", "").replace(" int", "").split(", ")
    assert sorted(map(str, ((r.doc_id, r.text) for r in kept.collect()))) == sorted(
        str((d, t)) for (d, t), w in zip(DOCS, want) if not w[5])


def test_decontaminate_item_without_id(spark):
    items = spark.createDataFrame([(None, "q r s t"), (1, "u v")], "item_id long, text string")
    docs = frame(spark, [(1, "p q r s t"), (2, "u v q r s t"), (3, "q r s")])
    got = {r.doc_id: (r.n_hit, r.n_items, r["items"], r.contaminated) for r in decontaminate.contamination(docs, items).collect()}
    assert got == {1: (4, 0, [], True), 2: (6, 1, ["1"], True), 3: (0, 0, [], False)}
    assert [r.doc_id for r in decontaminate.drop_contaminated(docs, items).collect()] == [3]


def test_decontaminate_empty_tables(spark):
    none = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.contamination(frame(spark, []), none).count() == 0
    got = decontaminate.contamination(frame(spark, DOCS), none).collect()
    assert len(got) == len(DOCS) and not any(r.contaminated for r in got)


def test_decontaminate_without_broadcast(spark, monkeypatch):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    want = sorted(map(str, decontaminate.digest(decontaminate.contamination(frame(spark, DOCS), items)).collect()))
    monkeypatch.setattr(decontaminate, "BROADCAST_WINDOWS", -1)
    monkeypatch.setattr(decontaminate, "BROADCAST_KEYS", -1)
    assert sorted(map(str, decontaminate.digest(decontaminate.contamination(frame(spark, DOCS), items)).collect())) == want


def passages(seed=5):
    rng = random.Random(seed)
    vocab = [f"w{i}" for i in range(300)]
    base = [rng.choice(vocab) for _ in range(130)]
    rows = []
    for d in range(14):
        own = [rng.choice(vocab) for _ in range(rng.randrange(0, 90))]
        a = rng.randrange(0, 60)
        rows.append((d, " ".join(own[:30] + base[a:a + rng.choice([20, 49, 50, 51, 70])] + own[30:])))
    return rows + [(20, rows[3][1]), (3, rows[3][1]), (21, "z " * 300), (22, "z\t" * 80), (23, None), (24, ""), (None, rows[2][1]), (25, "short text"), (26, "short text")]


def test_substring_dedup_matches_brute_force(spark):
    rows = passages()
    split = [(d, [w for w in re.split(r"[\x20\x09-\x0D]+", t or "") if w]) for d, t in rows]
    first = {}
    for d, w in split:
        for a in range(len(w) - 49 if d is not None else 0):
            key = tuple(w[a:a + 50])
            first[key] = min(first.get(key, d), d)
    want = []
    for d, w in split:
        gone = set()
        for a in range(len(w) - 49 if d is not None else 0):
            if first[tuple(w[a:a + 50])] < d:
                gone.update(range(a, a + 50))
        kept = " ".join(x for i, x in enumerate(w) if i not in gone)
        want.append((d, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    got = substring_dedup.substring_dedup(frame(spark, rows)).collect()
    assert sum(w[2] for w in want) > 300
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, want))


def test_substring_dedup_empty_and_cover(spark):
    assert substring_dedup.substring_dedup(frame(spark, [])).count() == 0
    cover, p = substring_dedup.COVER, substring_dedup.PERIOD
    assert {(a - b) % p for a in cover for b in cover} == set(range(p))


def test_patience_and_blocks():
    pairs = [(0, 5), (1, 0), (2, 1), (3, 9), (4, 2)]
    assert line_dedup.ascending(pairs) == [(1, 0), (2, 1), (4, 2)]
    assert line_dedup.ascending([]) == []
    match = lambda pos, hpos, df=2, chars=40, holder=1: dict(pos=pos, hpos=hpos, raw=pos * 2, df=df, chars=chars, holder=holder)
    assert line_dedup.deleted([match(0, 3), match(1, 4), match(5, 5, df=900)], 9) == [0, 2]  # a lone frequent line stays
    assert line_dedup.deleted([match(0, 0, df=900)], 1) == [0]  # unless it is all of the document
    assert line_dedup.deleted([match(0, 0, chars=4)], 9) == []  # too short


def test_line_blocks_do_not_depend_on_frequency():
    match = lambda pos, hpos, df, chars: dict(pos=pos, hpos=hpos, raw=pos, df=df, chars=chars, holder=1)
    assert line_dedup.deleted([match(4, 0, 900, 300)], 9) == [4]  # a passage on one line, however often it occurs
    assert line_dedup.deleted([match(4, 0, 2, 30)], 9) == line_dedup.deleted([match(4, 0, 900, 30)], 9) == []
    assert line_dedup.deleted([match(4, 0, 900, 5), match(5, 1, 900, 4)], 9) == [4, 5]  # several short lines


def test_line_dedup(spark):
    a = "first long line of the document\nsecond long line of the document\n\nthird long line of it"
    rows = [(1, a), (2, "own words in front of it all\n" + a), (3, a), (None, a), (4, None), (5, ""), (1, a), (6, "\n\n"), (7, "only here, a line of its own")]
    got = line_dedup.line_dedup(frame(spark, rows))
    assert got.columns[:5] == ["doc_id", "text", "n_words", "hash", "md"]
    out = sorted(map(str, ((r.doc_id, r.text) for r in got.select("doc_id", "text").collect())))
    want = [(1, a), (1, a), (2, "own words in front of it all\n"), (3, ""), (None, a), (4, None), (5, ""), (6, "\n\n"), (7, rows[8][1])]
    assert out == sorted(str((d, t)) for d, t in want)
    assert line_dedup.line_dedup(frame(spark, [])).count() == 0


def brute_lines(rows):
    """Every pair of documents aligned: kept text by (id, text)."""
    split = []
    for d, t in sorted({r for r in rows if r[0] is not None and r[1] is not None}):
        seen, lines = collections.Counter(), []
        for raw, x in enumerate(t.split("\n")):
            if x.strip(" "):
                lines.append(((x.strip(" "), seen[x.strip(" ")]), raw))
                seen[x.strip(" ")] += 1
        split.append((d, t, lines))
    out = {}
    for d, t, lines in split:
        gone = set()
        for e, _, other in split:
            at = {k: i for i, (k, _) in enumerate(other)}
            match = [dict(pos=i, hpos=at[k], raw=raw, holder=0, chars=len(k[0])) for i, (k, raw) in enumerate(lines) if k in at]
            gone.update(line_dedup.deleted(match, len(lines)) if e < d else ())
        out[d, t] = "\n".join(x for i, x in enumerate(t.split("\n")) if i not in gone)
    return out


def test_line_dedup_matches_all_pairs(spark):
    block = [f"line {i} of the block" for i in range(5)]
    # the lines' first holders are unrelated, scattered or in another order; (8, 9) cross with the first holder of their run
    rows = [(1, "other\n" + block[2] + "\nwords"), (2, "\n".join(block[::-1])), (3, "\n".join(["b"] + block)), (4, "\n".join(["c"] + block + ["d"])),
            (5, "\n".join(block)), (6, "x\ny\np\nq\nr"), (7, "k\nx\ny"), (8, "p\nq\nr\nx\ny"), (9, "m\nx\ny\nn"), (10, "k"), (11, "L" * 120 + "\nz"), (12, "w\n" + "L" * 120)]
    rng = random.Random(4)
    vocab = [f"line {i}" for i in range(12)] + ["long " * 30 + str(i) for i in range(4)]
    for d in range(20, 70):
        rows.append((d, "\n".join(rng.choice(vocab) if rng.random() < 0.7 else f" own {d} {i} " for i in range(rng.randrange(1, 9)))))
    rows += [(70, rows[30][1]), (70, rows[31][1]), (71, rows[30][1] + "\n" + rows[31][1]), (None, rows[30][1]), (30, rows[35][1])]
    want = brute_lines(rows)
    assert want[5, rows[4][1]] == "" and want[4, rows[3][1]] == "c\nd" and want[8, rows[7][1]] == "" and want[10, "k"] == ""
    got = line_dedup.line_dedup(frame(spark, rows).select("doc_id", "text", "n_words")).collect()
    assert len(got) == len(rows)
    new = {}
    for d, t in rows:
        new.setdefault(d, []).append(want.get((d, t), t))
    kept = {d: sorted(r.text for r in got if r.doc_id == d) for d in new}
    assert kept == {d: sorted(x) for d, x in new.items()}


def test_signatures_estimate_weighted_similarity():
    rng = np.random.default_rng(3)
    e = rng.integers(0, 1 << 63, 900).astype(np.uint64)
    sets = [e[:600], e[60:660], np.concatenate([e[:600], e[:150]]), e[:2]]
    off = np.append(0, np.cumsum([len(s) for s in sets]))
    sign = dart_minhash.signatures(np.concatenate(sets), off)
    assert abs((sign[0] == sign[1]).mean() - 540 / 660) < 0.09
    assert abs((sign[0] == sign[2]).mean() - 600 / 750) < 0.09
    alone = dart_minhash.signatures(sets[1], np.array([0, 600]))
    assert (alone[0] == sign[1]).all()  # a row's signature does not depend on its batch


def brute_groups(rows, threshold=0.8):
    sets = []
    for d, t in rows:
        w = [x for x in re.split(r"[\W_]+", (t or "").lower()) if x]
        sets.append((d, collections.Counter([tuple(w[i:i + 5]) for i in range(len(w) - 4)] or ([tuple(w)] if w else []))))
    root = {d: d for d, _ in rows if d is not None}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, (d, m) in enumerate(sets):
        for e, n in sets[i + 1:]:
            if d is None or e is None or not m or not n:
                continue
            both = sum((m & n).values())
            if both >= threshold * (sum(m.values()) + sum(n.values()) - both):
                a, b = find(d), find(e)
                root[max(a, b)] = min(a, b)
    return {d: find(d) for d in root}


@pytest.mark.parametrize("rounds", [0, 1, 3])
def test_near_duplicates_match_brute_force(spark, monkeypatch, rounds):
    monkeypatch.setattr(dart_minhash, "ROUNDS", rounds)
    rng = random.Random(9)
    vocab = ["".join(rng.choices("abcdefgh", k=5)) for _ in range(400)]
    rows = []
    for g in range(4):
        base = [rng.choice(vocab) for _ in range(160)]
        for c in range(5):
            copy = list(base)
            for _ in range(c * 2):
                copy[rng.randrange(len(copy))] = rng.choice(vocab)
            rows.append((g * 10 + c, " ".join(copy)))
    rows += [(50, rows[0][1].upper()), (51, "two words"), (52, "Two, words!"), (53, None), (54, ""), (55, "..."), (None, rows[0][1]), (0, rows[0][1])]
    want = brute_groups(rows)
    got = dart_minhash.near_duplicates(frame(spark, rows)).collect()
    assert len(got) == len(rows)
    assert {r.doc_id: r.class_id for r in got if r.doc_id is not None} == want
    assert dart_minhash.near_duplicates(frame(spark, [])).count() == 0


@pytest.mark.parametrize("rounds", [0, 1, 3])
def test_near_duplicates_of_a_member_that_matched_the_head(spark, monkeypatch, rounds):
    monkeypatch.setattr(dart_minhash, "ROUNDS", rounds)
    rng = random.Random(12)
    new = lambda n: ["".join(rng.choices("abcdefgh", k=9)) for _ in range(n)]
    rows = []
    for g in range(0, 160, 10):
        x = new(400)
        rows += [(g, " ".join(new(43) + x[43:])), (g + 1, " ".join(x))]  # 0.804 of each other, 0.796 or less of the rest
        rows += [(g + 2 + i, " ".join(x[:-2 - i] + new(2 + i))) for i in range(6)]
    want = brute_groups(rows)
    assert len(set(want.values())) == 16 and len(set(brute_groups([r for r in rows if r[0] % 10 != 1]).values())) == 32
    got = dart_minhash.near_duplicates(frame(spark, rows)).collect()
    assert {r.doc_id: r.class_id for r in got} == want


def test_components(spark):
    rng = random.Random(2)
    edges = [(rng.randrange(60), rng.randrange(60)) for _ in range(45)] + [(100 + i, 101 + i) for i in range(12)] + [(7, 7)]
    root = {}

    def find(x):
        root.setdefault(x, x)
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        if a != b:
            x, y = find(a), find(b)
            root[max(x, y)] = min(x, y)
    got = components.components(spark.createDataFrame(edges, "a long, b long")).collect()
    assert {r.node: r.root for r in got} == {x: find(x) for x in root}


def test_near_duplicate_pairs_grow_with_the_group(spark, monkeypatch):
    """Near copies of one text, and texts that only share a passage: about n pairs are fetched."""
    fetched = []
    real = dart_minhash.materialize

    def counted(df, name):
        out = real(df, name)
        if name == "pairs":
            fetched.append(out.count())
        return out

    monkeypatch.setattr(dart_minhash, "materialize", counted)
    sums = []
    for n in (100, 200, 400):
        rng = random.Random(n)
        word = lambda: "".join(rng.choices("abcdefgh", k=7))
        base, passage = [word() for _ in range(150)], [word() for _ in range(60)]
        rows = [(i, " ".join([*base[:i % 140], word(), *base[i % 140 + 1:]])) for i in range(n)]
        rows += [(5000 + i, " ".join(passage + [word() for _ in range(40)])) for i in range(n)]
        fetched.clear()
        got = {r.doc_id: r.class_id for r in dart_minhash.near_duplicates(frame(spark, rows)).collect()}
        assert got == {i: 0 if i < 5000 else i for i, _ in rows}
        sums.append(sum(fetched))
    assert sums[2] < 2.6 * sums[1] and sums[2] < 4 * 800  # documents
