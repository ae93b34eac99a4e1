"""Cross-tokenizer alignment against a plain loop over all shared ends."""

import hashlib
from collections import Counter

import public_tokenizers as P
import pytest
from pyspark.sql import functions as F

from cabinlens.llm import queries, token_alignment

FILES = (P.path("byte_bpe_50k.json"), P.PATTERN, P.path("piece_bpe_32k.model"))


def loop(rows):
    """The contract's columns of (doc_id, text) rows, by the two libraries."""
    import sentencepiece
    from tokenizers import Tokenizer

    first = Tokenizer.from_file(FILES[0])
    first.encode_special_tokens = True
    second = sentencepiece.SentencePieceProcessor(model_file=FILES[2])
    byte = token_alignment.byte_of_character()
    seen = []
    for doc_id, text in rows:
        a = first.encode(" " + text, add_special_tokens=False).ids if text else []
        b = second.encode(text) if text else []
        bytes_a = [bytes(byte[c] for c in first.id_to_token(i)) for i in a]
        names_b = [second.id_to_piece(i) for i in b]
        bytes_b = [bytes([int(p[3:5], 16)]) if second.is_byte(i) else p.replace("▁", " ").encode() for i, p in zip(b, names_b)]
        if not text or not b"".join(bytes_a) == b"".join(bytes_b) == (" " + text).encode():
            seen.append((doc_id, 0, 0, [], Counter()))
            continue
        ends = [{sum(map(len, x[:i + 1])) for i in range(len(x))} if len(x) < 300 else _ends(x) for x in (bytes_a, bytes_b)]
        groups, pairs, p, q, end_a, end_b, j = [], Counter(), 0, 0, 0, 0, 0
        for i in range(len(a)):
            end_a += len(bytes_a[i])
            if end_a in ends[1]:
                while end_b < end_a:
                    end_b += len(bytes_b[j])
                    j += 1
                groups.append((a[p:i + 1], b[q:j]))
                pairs.update((x, y) for x in a[p:i + 1] for y in b[q:j])
                p, q = i + 1, j
        seen.append((doc_id, len(a), len(b), groups, pairs))
    count = Counter(k for *_, pairs in seen for k in pairs)
    most = Counter()
    for (x, _), n in count.items():
        most[x] = max(most[x], n)
    out = []
    for doc_id, n_a, n_b, groups, pairs in seen:
        text = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        out.append((doc_id, n_a, n_b, len(groups), sum(pairs.values()), hashlib.sha256(text.encode()).hexdigest() if groups else "",
                    sum(t for k, t in pairs.items() if count[k] == most[k[0]]), sum(t * count[k] for k, t in pairs.items())))
    return sorted(out, key=str)


def _ends(pieces):
    out, at = set(), 0
    for p in pieces:
        at += len(p)
        out.add(at)
    return out


ODD = [
    (1, "plain words, twice: plain words."), (2, ""), (3, None), (4, " "), (5, "a  b\n\tc éè\U0001F600 你好！"), (6, "under▁bar"),
    (7, "<s>x</s><unk><0x41>[PAD]<|endoftext|> end"), (8, "=" * 3000), (9, "ab" * 2000 + " " + "ß" * 500), (10, "\x00\x01 nul \x7f"),
    (None, "plain words, twice: plain words."), (1, "plain words, twice: plain words."), (11, "don't I'LL x y　z  "),
    (12, "\U0001F468‍\U0001F469‍\U0001F467 12345.678e-9 ١٢٣"), (13, "tail space "), (14, "\n\n\n  \n"),
]


@pytest.mark.parametrize("most", [0, 4_000_000])
def test_odd_texts(spark, most):
    docs = spark.createDataFrame([(*r, 5, [1]) for r in ODD], "doc_id long, text string, n_a long, pairs array<int>")
    out = token_alignment.alignment(docs, *FILES, broadcast_pairs=most)
    assert out.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "n_best", "count_sum"]
    assert sorted((tuple(r) for r in out.collect()), key=str) == loop(ODD)


def test_documents(spark, sf):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    got = queries.QUERIES["op13_token_alignment"](spark, sf)
    assert sorted((tuple(r) for r in got.collect()), key=str) == loop(rows)


def test_windows_are_forgotten_and_wide_groups_counted(monkeypatch, sf, spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").limit(30).collect()]
    with open(FILES[0], encoding="utf-8") as f, open(FILES[2], "rb") as g:
        parts = token_alignment.ByteLevel(f.read(), FILES[1]), token_alignment.Pieces(g.read())

    def whole(texts, step):
        aligner = token_alignment.Aligner(*parts)
        runs = [aligner.align(texts[i:i + step]) for i in range(0, len(texts), step)]
        return [x for r in runs for x in r["text"]], [int(x) for r in runs for x in r["pairs"]], [int(x) for r in runs for x in r["times"]]

    texts = [t for _, t in rows] + ["=" * 500, "x y z"]
    want = whole(texts, len(texts))
    monkeypatch.setattr(token_alignment, "MEMO_IDS", 0)
    monkeypatch.setattr(token_alignment, "WIDE", 1)
    assert whole(texts, 3) == want


def test_groups_and_empty_table(spark):
    docs = spark.createDataFrame([(1, "one two")], "doc_id string, text string")
    aligned, size_a, size_b = token_alignment.align(docs, *FILES, with_groups=True)
    assert (size_a, size_b) == (50256, 32000)
    row = aligned.first()
    assert hashlib.sha256(row.groups.encode()).hexdigest() == row.groups_sha256 and row.groups.count(";") == row.n_groups - 1
    assert token_alignment.alignment(docs.limit(0), *FILES).where(F.lit(True)).count() == 0
