"""Cross-tokenizer alignment (operator 13).

Each text is encoded whole by two vocabularies: A, byte-level BPE, of a space
and the text, and B, SentencePiece, which adds that space itself.  A token's
bytes tile the text in both, so a byte offset where tokens of both end is a
shared end.  Consecutive shared ends cut the tokens into groups, and within a
group every A token is linked to every B token.

Whitespace-token anchors: a shared end that lies before a token of A and a token
of B which both begin with a space splits the document into windows of token
ids.  A window's groups depend on its ids alone, so they are worked out once per
worker for each pair of id tuples and remembered (at most ``MEMO_IDS`` ids).

Links are counted over the corpus in a second step: an id pair's count is the
number of documents that hold it linked.  Pairs of a single document need no
entry; if the table of the others has at most ``BROADCAST_PAIRS`` rows (16 bytes
each) it is sent to all tasks, else the documents' pairs are joined to it by
shuffle; both give the same result.

Byte-level BPE runs in the tiktoken library on the vocabulary of the JSON file
(its ids are merge ranks), several times as fast as the tokenizers library and
equal to it.

Defined cases: a null or empty text, and one whose joined A or B bytes differ
from a space and the text (as where the text holds U+2581), has no tokens:
zeros, and an empty groups_sha256; strings of special tokens are plain text;
repeated rows and rows with a null ``doc_id`` are documents of their own, also
in the counts; texts of any length are encoded whole; other columns are not read.
"""

from __future__ import annotations

import hashlib
import json
from array import array
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cabinlens.llm.common import flat_lists, list_array, materialize, ragged, text_slices

#: Token ids held in a worker's remembered windows.
MEMO_IDS = 6_000_000
#: Links of a group from which its ids are counted before they are paired.
WIDE = 4096
#: Bytes of text that are aligned at a time.
SLICE_BYTES = 1 << 20
#: Most pairs of two or more documents (16 bytes each) that are broadcast.
BROADCAST_PAIRS = 4_000_000


def byte_of_character() -> dict[str, int]:
    """The characters that stand for bytes in byte-level vocabularies: printable
    Latin-1 characters for themselves, the others moved behind U+0100."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    moved = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(moved)}


class ByteLevel:
    """Vocabulary A, read from a tokenizer's JSON text."""

    def __init__(self, text: str, pattern: str):
        import tiktoken

        spec = json.loads(text)
        of = byte_of_character()
        special = {t["id"] for t in spec["added_tokens"]}
        self.pieces = [b""] * (1 + max(spec["model"]["vocab"].values()))
        for word, i in spec["model"]["vocab"].items():
            if i not in special:
                self.pieces[i] = bytes(of[c] for c in word)
        ranks = {p: i for i, p in enumerate(self.pieces) if p}
        self.encoding = tiktoken.Encoding("a", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})

    def encode(self, texts: list[str]) -> list[list[int]]:
        return [self.encoding.encode_ordinary(" " + t) for t in texts]


class Pieces:
    """Vocabulary B, read from a SentencePiece model's bytes."""

    def __init__(self, model: bytes):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.pieces = [b""] * self.model.get_piece_size()
        for i in range(len(self.pieces)):
            piece = self.model.id_to_piece(i)
            if self.model.is_byte(i):
                self.pieces[i] = bytes([int(piece[3:5], 16)])
            elif not (self.model.is_control(i) or self.model.is_unknown(i)):
                self.pieces[i] = piece.replace("▁", " ").encode()

    def encode(self, texts: list[str]) -> list[list[int]]:
        return self.model.encode(texts, num_threads=1)


class Windows:
    """Remembered windows, by the bytes of both id tuples with -1 between them:
    the number of groups and links, the groups' text, and the pairs with their
    multiplicity, one window's after the other's."""

    def __init__(self, size_a: np.ndarray, size_b: np.ndarray):
        self.size_a, self.size_b = size_a, size_b
        self.ids = max(len(size_a), len(size_b))
        self.names = [f"{i}{mark}" for mark in ",|;" for i in range(self.ids)]
        self.forget()

    def forget(self) -> None:
        self.number: dict[bytes, int] = {}
        self.text: list[str] = []
        self.groups, self.links, self.ends, self.pairs, self.times = (array("q") for _ in range(5))
        self.held = 0

    def add(self, keys: list[bytes]) -> None:
        """Work out the groups of new windows, all together."""
        flat = np.frombuffer(b"".join(keys), np.int32).astype(np.int64)
        window = np.repeat(np.arange(len(keys)), [len(k) // 4 for k in keys])
        middle = flat < 0
        right = np.cumsum(middle) > window  # behind its window's -1
        a, b = flat[~right], flat[right & ~middle]
        # the windows' bytes follow each other, so that their ends are shared ends
        _, i, j = np.intersect1d(np.cumsum(self.size_a[a]), np.cumsum(self.size_b[b]), assume_unique=True, return_indices=True)
        n, m = np.diff(i, prepend=-1), np.diff(j, prepend=-1)
        of = window[~right][i]
        firsts = np.flatnonzero(np.append(True, of[1:] != of[:-1]))
        pairs, times, sizes = self._pairs(a, b, i + 1 - n, j + 1 - m, n, m)
        self.groups.extend(np.bincount(of).tolist())
        self.links.extend(np.add.reduceat(n * m, firsts).tolist())
        self.ends.extend((len(self.pairs) + np.cumsum(np.add.reduceat(sizes, firsts))).tolist())
        self.pairs.frombytes(pairs.tobytes())
        self.times.frombytes(times.tobytes())
        # the groups' text: A ids, a bar, B ids, a semicolon
        start = np.cumsum(n + m) - (n + m)
        code = np.empty(len(a) + len(b), np.int64)
        code[ragged(start, n)], code[ragged(start + n, m)] = a, b
        code[start + n - 1] += self.ids
        code[start + n + m - 1] += 2 * self.ids
        words = list(map(self.names.__getitem__, code.tolist()))
        ends = (start + n + m)[np.append(firsts[1:], len(of)) - 1].tolist()
        self.text += ["".join(words[x:y])[:-1] for x, y in zip([0, *ends], ends)]
        for k in keys:
            self.number[k] = len(self.number)
        self.held += len(flat) + len(pairs)

    def _pairs(self, a, b, from_a, from_b, n, m) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(pairs, times, sizes): the id pairs of each group; those of a group with
        more than ``WIDE`` links are counted, in others they may repeat."""
        wide = n * m > WIDE
        counted = {g: [np.unique(x[p:p + k], return_counts=True) for x, p, k in ((a, from_a[g], n[g]), (b, from_b[g], m[g]))]
                   for g in np.flatnonzero(wide).tolist()}
        sizes = n * m
        for g, ((u, _), (v, _)) in counted.items():
            sizes[g] = len(u) * len(v)
        start = np.cumsum(sizes) - sizes
        pairs, times = np.empty(int(sizes.sum()), np.int64), np.ones(int(sizes.sum()), np.int64)
        k = ragged(np.zeros(int((~wide).sum()), np.int64), sizes[~wide])
        x, y, across = (np.repeat(z[~wide], sizes[~wide]) for z in (from_a, from_b, m))
        pairs[ragged(start[~wide], sizes[~wide])] = a[x + k // across] * len(self.size_b) + b[y + k % across]
        for g, ((u, c), (v, d)) in counted.items():
            span = slice(start[g], start[g] + sizes[g])
            pairs[span], times[span] = (u[:, None] * len(self.size_b) + v).ravel(), (c[:, None] * d).ravel()
        return pairs, times, sizes


class Aligner:
    def __init__(self, a: ByteLevel, b: Pieces):
        self.a, self.b = a, b
        self.size_a, self.size_b = (np.array([len(p) for p in x.pieces], np.int64) for x in (a, b))
        self.space_a, self.space_b = (np.array([p[:1] == b" " for p in x.pieces], bool) for x in (a, b))
        self.windows = Windows(self.size_a, self.size_b)

    def _encoded(self, texts: list[str | None]) -> tuple[list[list[int]], list[list[int]]]:
        """Both id lists of each text; empty where the bytes do not give the text back."""
        some = [t or "" for t in texts]
        a, b = self.a.encode(some), self.b.encode(some)
        at_a, at_b = self.a.pieces.__getitem__, self.b.pieces.__getitem__
        for i, t in enumerate(some):
            own = b" " + t.encode("utf-8", "surrogatepass")
            if not t or b"".join(map(at_a, a[i])) != own or b"".join(map(at_b, b[i])) != own:
                a[i], b[i] = [], []
        return a, b

    def align(self, texts: list[str | None]) -> dict[str, np.ndarray | list]:
        """Per text: n_a, n_b, n_groups, n_links, the groups' text, and its
        distinct pairs (A id times the size of B, plus B id) with their times."""
        if self.windows.held > MEMO_IDS:
            self.windows.forget()
        lists_a, lists_b = self._encoded(texts)
        n_a, n_b = (np.array([len(x) for x in y], np.int64) for y in (lists_a, lists_b))
        a, b = (np.fromiter(chain.from_iterable(y), np.int32) for y in (lists_a, lists_b))
        del lists_a, lists_b
        end_a, end_b = np.cumsum(self.size_a[a]), np.cumsum(self.size_b[b])
        from_a, from_b = end_a - self.size_a[a], end_b - self.size_b[b]
        first_a = np.cumsum(n_a) - n_a
        anchor = np.zeros(int(end_a[-1]) + 1 if len(end_a) else 1, np.int8)
        anchor[from_a[self.space_a[a]]] = 1
        anchor[from_b[self.space_b[b]]] += 1
        anchor[from_a[first_a[n_a > 0]]] = 2
        cut_a, cut_b = np.flatnonzero(anchor[from_a] == 2), np.flatnonzero(anchor[from_b] == 2)
        per_a, per_b = np.diff(np.append(cut_a, len(a))), np.diff(np.append(cut_b, len(b)))
        ends = np.cumsum(per_a + per_b + 1)
        starts = ends - (per_a + per_b + 1)
        joined = np.full(len(a) + len(b) + len(starts), -1, np.int32)
        joined[ragged(starts, per_a)] = a
        joined[ragged(starts + per_a + 1, per_b)] = b
        whole, windows = joined.tobytes(), self.windows
        number = windows.number.get
        keys = [whole[i:j] for i, j in zip((starts * 4).tolist(), (ends * 4).tolist())]
        which = [number(k) for k in keys]
        new = [k for k, w in zip(keys, which) if w is None]
        if new:
            windows.add(list(dict.fromkeys(new)))
            which = [number(k) if w is None else w for k, w in zip(keys, which)]
        bounds = np.searchsorted(cut_a, np.append(first_a, len(a)))
        text = [";".join([windows.text[w] for w in which[i:j]]) for i, j in zip(bounds[:-1].tolist(), bounds[1:].tolist())]
        return {"n_a": n_a, "n_b": n_b, "text": text, **self._links(np.array(which, np.int64), np.diff(bounds))}

    def _links(self, which: np.ndarray, per_row: np.ndarray) -> dict[str, np.ndarray]:
        w = self.windows
        groups, links, ends, pairs, times = (np.array(x, np.int64) for x in (w.groups, w.links, w.ends, w.pairs, w.times))
        sizes = np.diff(ends, prepend=0)
        row = np.repeat(np.arange(len(per_row)), per_row)
        places = ragged(ends[which] - sizes[which], sizes[which])
        key = np.repeat(row, sizes[which]) * (len(self.size_a) * len(self.size_b)) + pairs[places]
        order = np.argsort(key)
        key, times = key[order], times[places][order]
        new = np.flatnonzero(np.append(True, key[1:] != key[:-1])) if len(key) else np.empty(0, np.int64)
        times = np.add.reduceat(times, new) if len(key) else times
        key = key[new]
        row_of = key // (len(self.size_a) * len(self.size_b))
        n = len(per_row)
        return {
            "n_groups": _sums(groups[which], per_row), "n_links": _sums(links[which], per_row),
            "pairs": key % (len(self.size_a) * len(self.size_b)), "times": times, "n_pairs": np.bincount(row_of, minlength=n)}


def _sums(values: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Sum of each row's values."""
    total, ends = np.append(0, np.cumsum(values)), np.cumsum(sizes)
    return total[ends] - total[ends - sizes]


def _align(shared, kind: pa.DataType, with_text: bool):
    state: list[Aligner] = []

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if not state:
            state.append(Aligner(ByteLevel(*shared.value[:2]), Pieces(shared.value[2])))
        for batch in batches:
            for start, stop in text_slices(batch["text"], SLICE_BYTES):
                part = batch.slice(start, stop - start)
                r = state[0].align(part["text"].to_pylist())
                sha = [hashlib.sha256(t.encode()).hexdigest() if t else "" for t in r["text"]]
                columns = [part["doc_id"], *[pa.array(r[c], pa.int64()) for c in ("n_a", "n_b", "n_groups", "n_links")],
                           pa.array(sha, pa.string()), list_array(r["pairs"], r["n_pairs"], kind),
                           list_array(r["times"], r["n_pairs"], pa.int32())]
                names = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "pairs", "times"]
                if with_text:
                    columns, names = [*columns, pa.array(r["text"], pa.string())], [*names, "groups"]
                yield pa.RecordBatch.from_arrays(columns, names=names)

    return run


def align(docs: DataFrame, a_json: str, pattern: str, b_model: str, doc_id: str = "doc_id", text: str = "text",
          with_groups: bool = False) -> tuple[DataFrame, int, int]:
    """(aligned, sizes of A and B): per row doc_id, n_a, n_b, n_groups, n_links,
    groups_sha256, pairs (A id times the size of B, plus B id) and times, and
    the groups' text if asked for.  The vocabularies are read on the driver."""
    with open(a_json, encoding="utf-8") as f:
        a_text = f.read()
    with open(b_model, "rb") as f:
        b_bytes = f.read()
    size_a, size_b = len(ByteLevel(a_text, pattern).pieces), len(Pieces(b_bytes).pieces)
    small = size_a * size_b < 1 << 31
    shared = docs.sparkSession.sparkContext.broadcast((a_text, pattern, b_bytes))  # bounded by the files
    own = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    schema = (f"doc_id {own.schema['doc_id'].dataType.simpleString()}, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
              f"pairs array<{'int' if small else 'long'}>, times array<int>" + (", groups string" if with_groups else ""))
    return own.mapInArrow(_align(shared, pa.int32() if small else pa.int64(), with_groups), schema), size_a, size_b


def _lookup(shared, size_b: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, count, most = shared.value
        for batch in batches:
            pairs, offsets = flat_lists(batch["pairs"])
            times, _ = flat_lists(batch["times"])
            n = np.ones(len(pairs), np.int64)
            if len(known):
                at = np.minimum(np.searchsorted(known, pairs), len(known) - 1)
                n = np.where(known[at] == pairs, count[at], 1)
            times = times.astype(np.int64)
            best = np.where(n == most[pairs // size_b], times, 0)
            sums = [np.append(0, np.cumsum(x)) for x in (best, n * times)]
            yield pa.RecordBatch.from_arrays(
                [*[batch[c] for c in KEPT], *[pa.array(s[offsets[1:]] - s[offsets[:-1]]) for s in sums]], names=[*KEPT, "n_best", "count_sum"])

    return run


KEPT = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256"]


def counted(aligned: DataFrame, size_a: int, size_b: int, broadcast_pairs: int = BROADCAST_PAIRS) -> DataFrame:
    """The aligned rows with n_best and count_sum instead of the pairs."""
    spark = aligned.sparkSession
    rows = materialize(aligned.withColumn("r", F.monotonically_increasing_id()), "aligned")
    counts = rows.select(F.explode("pairs").alias("pair")).groupBy("pair").agg(F.count("*").alias("n"))
    several = materialize(counts.where("n > 1"), "pair-counts")
    # the highest count of an A id: one row per id of the vocabulary
    most = several.groupBy(F.expr(f"CAST(pair DIV {size_b} AS INT)").alias("a")).agg(F.max("n").alias("most"))
    if several.count() <= broadcast_pairs:
        table = several.sort("pair").toPandas()
        top = most.toPandas()
        highest = np.ones(size_a, np.int64)
        highest[top["a"].to_numpy(np.int64)] = top["most"].to_numpy(np.int64)
        shared = spark.sparkContext.broadcast((table["pair"].to_numpy(np.int64), table["n"].to_numpy(np.int64), highest))
        kind = rows.schema["doc_id"].dataType.simpleString()
        return rows.select(*KEPT, "pairs", "times").mapInArrow(
            _lookup(shared, size_b), f"doc_id {kind}, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, n_best long, count_sum long")
    links = rows.select("r", F.expr("inline(arrays_zip(pairs, times))"))
    found = links.join(several, links["pairs"] == several["pair"], "left").select(
        "r", "times", F.coalesce("n", F.lit(1)).alias("n"), F.expr(f"CAST(pairs DIV {size_b} AS INT)").alias("own"))
    found = found.join(most, F.col("own") == F.col("a"), "left")
    sums = found.groupBy("r").agg(
        F.sum(F.when(F.col("n") == F.coalesce("most", F.lit(1)), F.col("times")).otherwise(0)).alias("n_best"),
        F.sum(F.col("n") * F.col("times")).alias("count_sum"))
    zero = F.lit(0).cast("long")
    return rows.join(sums, "r", "left").select(
        *KEPT, F.coalesce("n_best", zero).alias("n_best"), F.coalesce("count_sum", zero).alias("count_sum"))


def alignment(docs: DataFrame, a_json: str, pattern: str, b_model: str, doc_id: str = "doc_id", text: str = "text",
              broadcast_pairs: int = BROADCAST_PAIRS) -> DataFrame:
    """One row per document: doc_id, n_a, n_b, n_groups, n_links, groups_sha256,
    n_best (links whose count is the highest of their A id) and count_sum."""
    return counted(*align(docs, a_json, pattern, b_model, doc_id, text), broadcast_pairs)
