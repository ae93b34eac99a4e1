"""Language, toxicity, PII, tokens and neighbours: held-out accuracy, round trips, brute force."""

import hashlib
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from cabinlens.llm import ann_forest, byte_bpe, language_id, pii, token_counts, toxicity

tokenizers = pytest.importorskip("public_tokenizers")
tiktoken = pytest.importorskip("tiktoken")
RANKS, PATTERN = tokenizers.path("byte_bpe_50k.tiktoken"), tokenizers.PATTERN
TEXTS = ["", None, " ", "a" * 900, "héllo wörld's don't  I'LL", "日本語 🎉🎉 x", "1234 ½\r\n\t a", "!!" * 150 + "  ", "plain words, plain words\n\n", "ab" * 300 + " z"]


def docs(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string, ids int, score string")


def test_bpe_equals_tiktoken_and_round_trips(spark):
    enc = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=byte_bpe.load_ranks(RANKS), special_tokens={})
    rows = [(i, t, 1, "s") for i, t in enumerate(TEXTS)] + [(None, "null id", 1, "s"), (8, TEXTS[8], 1, "s")]
    got = byte_bpe.round_trip(docs(spark, rows), RANKS, PATTERN, with_ids=True).collect()
    assert len(got) == len(rows)
    for r in got:
        text = "null id" if r.doc_id is None else TEXTS[r.doc_id] or ""
        ids = enc.encode_ordinary(text)
        assert (r.token_ids, r.n_tokens) == (ids, len(ids))
        assert r.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()
    back = byte_bpe.decode(byte_bpe.encode(docs(spark, rows), RANKS, PATTERN), RANKS).collect()
    assert sorted(bytes(r.data) for r in back) == sorted((t or "").encode() for _, t, _, _ in rows)
    assert byte_bpe.round_trip(docs(spark, []), RANKS, PATTERN).count() == 0


def test_fold_in_higher_order_functions(spark):
    ranks = byte_bpe.load_ranks(RANKS)
    enc = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
    words = [" thention", "Éouelleré", "a", "", " qzxqj", "日本"]
    got = byte_bpe.fold_words(spark.createDataFrame([(w,) for w in words], "word string"), ranks).collect()
    assert {r.word: r.ids for r in got} == {w: enc.encode_ordinary(w) for w in words}


def test_token_report_and_limits(spark):
    counted = byte_bpe.encode(docs(spark, [(i, t, 1, "s") for i, t in enumerate(TEXTS * 2)]), RANKS, PATTERN)
    n = np.array([len(r.ids) for r in counted.collect()])
    report = token_counts.length_report(token_counts.lengths(docs(spark, [(i, t, 1, "s") for i, t in enumerate(TEXTS * 2)]), RANKS, PATTERN))
    for r in report.collect():
        length = r.n_tokens
        assert (r.n_docs, r.docs_at_least, r.docs_longer) == ((n == length).sum(), (n >= length).sum(), (n > length).sum())
        assert (r.tokens_at_most, r.kept_tokens, r.total_tokens) == (n[n <= length].sum(), np.minimum(n, length).sum(), n.sum())
        assert abs(r.quantile - (n <= length).mean()) < 1e-12
    for r in token_counts.at_limit(report, [0, 1, 7, 5000]).collect():
        assert (r.kept_tokens, r.docs_cut) == (np.minimum(n, r.context).sum(), (n > r.context).sum())
    none = token_counts.length_report(spark.createDataFrame([], "n_tokens long"))
    assert none.count() == 0
    far = token_counts.length_report(spark.range(5000).select((F.col("id") * 3).alias("n_tokens")))  # several blocks
    r = far.where("n_tokens = 6000").first()
    assert (r.docs_longer, r.kept_tokens) == (2999, sum(min(3 * i, 6000) for i in range(5000)))


PII = ["mail a.b+c@mail.example.com, or x@y", "10.0.0.255 and 1.2.3.256 and 1.2.3.4.5", "4111 1111 1111 1111 or 4111-1111-1111-1112",
       "call +1 (528) 555-3435 now", "IBAN GB82 WEST 1234 5698 7654 32", "ssn 123-45-6789 and 123-45-67890", "a@b.c_d@e.ff", None, "",
       "1" * 5000 + ".." + "2" * 40, "@" * 3000 + "+" * 3000, "é 4111111111111111 日 x@é.com z@z.co"]


def reference_spans(text):
    patterns = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
                "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}
    out = []
    for i, (kind, p) in enumerate(patterns.items()):
        for m in re.finditer(p, text):
            d = re.sub("[^0-9]", "", m[0])
            fine = {"email": True, "ip": kind == "ip" and all(int(x) <= 255 for x in m[0].split(".")),
                    "card": 12 <= len(d) <= 19 and pii.luhn(d), "phone": 9 <= len(d) <= 15}
            if fine[kind]:
                out.append((m.start(), i, f"{kind}:{m.start()}:{m.end()}"))
    return [s for _, _, s in sorted(out)]


def test_pii(spark):
    got = pii.digest(pii.personal_data(docs(spark, [(i, t, 1, "s") for i, t in enumerate(PII)]))).collect()
    for r in got:
        want = reference_spans(PII[r.doc_id] or "")
        assert r.base_sha256 == hashlib.sha256(",".join(want).encode()).hexdigest(), PII[r.doc_id][:60]
        assert r.n_email + r.n_ip + r.n_card + r.n_phone == len(want)
        assert set(want) <= set(r.spans.split(",")) | {""}
    spans = {r.doc_id: r.spans for r in got}
    assert spans[4] == "iban:5:32" and spans[5] == "ssn:4:15"
    assert pii.luhn("4111111111111111") and not pii.luhn("4111111111111112")
    assert pii.mod97("GB82WEST12345698765432") and not pii.mod97("GB82WEST12345698765433")
    assert pii.digest(pii.personal_data(docs(spark, []))).count() == 0


def test_pii_long_and_crowded_texts(spark):
    zeros = "0" * 5000
    crowd = " ".join(f"call {200 + i % 700}-{100 + i % 900}-{1000 + i}" for i in range(3000)) + " 1.2.3.4 a@b.cd"
    rows = [(1, f"{zeros}.1.2.3 ip", 1, "s"), (2, f"1.{zeros}256.2.3", 1, "s"), (3, f"{zeros}.{zeros}.{zeros}.{zeros}255", 1, "s"), (4, crowd, 1, "s")]
    got = {r.doc_id: r for r in pii.digest(pii.personal_data(docs(spark, rows))).collect()}
    assert [got[i].n_ip for i in (1, 2, 3, 4)] == [1, 0, 1, 1]
    spans = got[4].spans.split(",")
    assert len(spans) == 3002 and len(got[4].scores.split(",")) == 3002 and got[4].n_email == 1
    # spans of the added kinds are what a comparison with every other span leaves
    base = pii.base_spans(crowd)
    added = [(a, b) for a, b, _, _ in pii.added_spans(crowd, base)]
    assert all(b <= c or d <= a for a, b in added for c, d, _ in base)
    assert all(x[1] <= y[0] for x, y in zip(sorted(added), sorted(added)[1:]))


def test_context_moves_the_score():
    plain, phone, serial = ("555-123-4567", "phone 555-123-4567", "serial phone 555-123-4567")
    scores = [pii.score(t, t.index("555"), len(t), "local_phone") for t in (plain, phone, serial)]
    assert scores == [0.4, 0.7, 0.4]


def test_language_held_out(spark, sf):
    table = spark.read.parquet(f"{sf}/documents.parquet")
    odd = spark.createDataFrame([(10**6, None, "en", "s", 0), (10**6 + 1, "123 !", "en", "s", 0), (None, "the of and", None, "s", 0)], table.schema)
    got = language_id.identify(table.unionAll(odd)).join(table.select("doc_id", "lang"), "doc_id", "left").collect()
    assert len(got) == table.count() + 3
    assert {r.lang_pred for r in got if r.doc_id and r.doc_id >= 10**6} == {"und"}
    held = [r for r in got if r.held_out and r.lang]
    assert {r.held_out for r in got if r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 5 == 0} == {True}
    assert np.mean([r.lang == r.lang_pred for r in held]) > 0.95
    assert all(0 <= r.score <= 1 for r in got)
    assert language_id.identify(table.limit(0)).count() == 0
    kept = language_id.keep_known(table.unionAll(odd))
    assert kept.columns == table.columns and kept.where("doc_id >= 1000000").count() == 0


def test_toxicity(spark):
    rng = np.random.default_rng(0)
    clean = ["".join(rng.choice(list("aeioutnrs"), 5)) for _ in range(200)]
    rows, labels = [], []
    for i in range(400):
        words = list(rng.choice(clean, 60))
        if i % 2:
            words[int(rng.integers(60))] = str(rng.choice(["zqwubb", "zqwubbly", "gkpfhd"]))
        rows.append((i, " ".join(words), 1, "s"))
        labels.append((i, 1, i % 2))
    table, known = docs(spark, rows + [(900, None, 1, "s"), (901, "", 1, "s"), (None, "x y", 1, "s")]), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    got = toxicity.score(table, known).collect()
    held = [r for r in got if r.held_out and r.doc_id is not None and r.doc_id < 400]
    assert len(got) == 403 and len(held) > 50
    assert np.mean([r.predicted == r.doc_id % 2 for r in held]) > 0.9
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in got)
    model = toxicity.fit(table, known)
    assert model.score(["aeiou zqwubbx tnrsa"])[0] > model.score(["aeiou tnrsa"])[0]  # an unseen spelling
    assert toxicity.score(docs(spark, []), known.limit(0)).count() == 0


def test_neighbours(spark):
    rng = np.random.default_rng(4)
    x = np.round(rng.normal(size=(600, 16)), 3)
    x[100:300] = x[100]  # a third of all rows are one vector
    rows = [(i, [float(v) for v in r]) for i, r in enumerate(x)]
    rows += [(700, None), (701, []), (702, [0.0] * 16), (703, [float("nan")] * 16), (704, [None] * 16), (None, rows[0][1]), (705, [1.0, 2.0]), (7, rows[7][1])]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = ann_forest.nearest(table, F.col("vec_id") % 50 == 0, block_rows=150).collect()
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    hit = 0
    for q in range(0, 600, 50):
        score = unit @ unit[q]
        score[q] = -9
        best = sorted(range(600), key=lambda i: (-round(score[i], 12), i))[:5]
        mine = sorted((r for r in got if r.query_id == q), key=lambda r: r.rank)
        assert [r.rank for r in mine] == [1, 2, 3, 4, 5]
        assert all(abs(r.score - score[r.vec_id]) < 1e-9 for r in mine)
        hit += len({r.vec_id for r in mine} & set(best))
        if 100 <= q < 300:
            assert [r.vec_id for r in mine] == best
    assert hit >= 0.9 * 60 and len(got) == 60
    assert ann_forest.nearest(table.limit(0), F.col("vec_id") % 50 == 0).count() == 0


def test_neighbours_of_multiples_are_the_smallest_ids(spark):
    """More positive multiples of one vector than are asked for, in any order of ids."""
    rng = np.random.default_rng(5)
    ids = rng.permutation(60).tolist()
    one, other = rng.normal(size=8), rng.normal(size=8)
    rows = [(i, [float(x) for x in (one if i % 3 else other) * 2.0 ** (i % 7 - 3)], "x", 1.0, 2) for i in ids]
    rows += [(100 + i, [float(x) for x in rng.normal(size=8)], "x", 1.0, 2) for i in range(50)] + [rows[0]]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>, entry string, score double, rank int")
    vectors = {r[0]: np.array(r[1]) for r in rows}
    for block in (16384, 16):
        got = sorted(tuple(r)[:3] for r in ann_forest.nearest(table, F.col("vec_id") % 50 == 0, breadth=1e9, block_rows=block).collect())
        want = []
        for q in sorted(i for i in vectors if i % 50 == 0):
            score = {i: float(ann_forest.exact_cosine(v[None], vectors[q])[0]) for i, v in vectors.items() if i != q}
            want += [(q, r, i) for r, i in enumerate(sorted(score, key=lambda i: (-score[i], i))[:5], 1)]
        assert got == sorted(want)


def test_forest_reads_less_than_its_share_of_a_larger_index(spark, sf):
    """Recall of 0.9 or more, from candidates that grow less than the index."""
    table = spark.read.parquet(f"{sf}/embeddings.parquet")
    rows = {r.vec_id: np.array(r.embedding, float) for r in table.collect() if r.embedding is not None and len(r.embedding)}
    got = ann_forest.nearest(table, F.col("vec_id") % 50 == 0).collect()
    hits = total = 0
    for q in (i for i in rows if i % 50 == 0):
        best = sorted((-float(ann_forest.exact_cosine(v[None], rows[q])[0]) for i, v in rows.items() if i != q))[:5]
        found = sorted(-r.score for r in got if r.query_id == q)
        hits += sum(s <= best[-1] + 1e-12 for s in found)
        total += 5
    assert hits / total >= 0.9
    rng = np.random.default_rng(0)
    x, q = rng.normal(size=(4000, 32)), rng.normal(size=(20, 32))
    q /= np.linalg.norm(q, axis=1, keepdims=True)
    few, many = (np.mean([len(c) for c in ann_forest.Forest(x[:n]).candidates(q, int(5 * n ** ann_forest.POWER))]) for n in (500, 4000))
    assert many < 6 * few
