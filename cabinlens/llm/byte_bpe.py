"""Byte-level BPE encoding and decoding (operator 8).

A text is cut by the vocabulary's pattern; every piece is a word of bytes.  A
piece that is in the vocabulary is one token; in any other the neighbouring
parts whose joined bytes have the lowest rank are merged (the leftmost on a
tie) until no neighbours join, as the public tiktoken library does.

The fold of ranked merges runs over the distinct words of a batch of texts: all
words advance together, one merge a step, on flat arrays of part ids, and a
pair of ids is looked up in a rank table of fixed size that every task gets
(some 200,000 pairs, bounded by the vocabulary).  Decoding concatenates the
byte strings of the tokens.  ``fold_words`` is the same fold in Spark's
higher-order functions over a literal rank map; README has the figures that
made the batch form the one in use.

Defined cases: null text is encoded as empty; texts of any length are encoded
whole (pieces above ``LONG_WORD`` bytes by a heap, in n log n); any Unicode
text decodes to its own bytes; a null ``doc_id`` and repeated rows are returned
as they are; other columns are not read.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cabinlens.llm.common import list_array, ragged, text_slices

#: Pieces of more bytes are merged one by one with a heap.
LONG_WORD = 200
#: Bytes of text that are encoded at a time; each slice is handed on before the next.
SLICE_BYTES = 1 << 19
#: White space as the pattern's engine defines it (the Unicode property).
_SPACES = r"\t-\r\x20\x85\xa0  -     　"


def load_ranks(path: str) -> dict[bytes, int]:
    """Ranks of a vocabulary file: a base64 byte string and its rank in each line."""
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}


def compile_pattern(pattern: str) -> regex.Pattern:
    """The cutting pattern with its white-space classes written out."""
    out = pattern.replace(r"[^\s", "[^" + _SPACES).replace(r"\s", f"[{_SPACES}]").replace(r"\S", f"[^{_SPACES}]")
    return regex.compile(out)


class Merges:
    """Rank table of the pairs of parts that join, as an open hash table."""

    BITS = 18

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.bytes_of = np.array([ranks[bytes([b])] for b in range(256)], np.int64)
        keys, values = [], []
        for word, rank in ranks.items():
            for i in range(1, len(word)):
                a, b = ranks.get(word[:i]), ranks.get(word[i:])
                if a is not None and b is not None:
                    keys.append((a << 32) | b)
                    values.append(rank)
        self.keys = np.full((1 << self.BITS) + 64, -1, np.int64)
        self.values = np.full((1 << self.BITS) + 64, NONE, np.int64)
        for k, v, s in zip(keys, values, self._slot(np.array(keys, np.int64)).tolist()):
            while self.keys[s] != -1:
                s += 1
            self.keys[s], self.values[s] = k, v
        size = max(ranks.values()) + 1
        pieces = [b""] * size
        for word, rank in ranks.items():
            pieces[rank] = word
        self.piece_sizes = np.array([len(p) for p in pieces], np.int64)
        self.piece_starts = np.cumsum(self.piece_sizes) - self.piece_sizes
        self.piece_bytes = np.frombuffer(b"".join(pieces), np.uint8)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.BITS)).astype(np.int64)

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each joined pair, NONE where the pair does not join."""
        key = (left << 32) | right
        slot = self._slot(key)
        out = np.full(len(key), NONE, np.int64)
        open_ = np.arange(len(key))
        while len(open_):
            at = slot[open_]
            found = self.keys[at]
            same = found == key[open_]
            out[open_[same]] = self.values[at[same]]
            open_ = open_[~same & (found != -1)]
            slot[open_] += 1
        return out

    def decode(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(bytes, size of each token)."""
        sizes = self.piece_sizes[ids]
        return self.piece_bytes[ragged(self.piece_starts[ids], sizes)], sizes

    def fold(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(ids, sizes): tokens of the words, one after the other."""
        known = [self.ranks.get(w) for w in words]
        sizes = np.ones(len(words), np.int64)
        done: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []  # word, position, id
        single = np.array([i for i, k in enumerate(known) if k is not None], np.int64)
        done.append((single, np.zeros(len(single), np.int64), np.array([k for k in known if k is not None], np.int64)))
        rest = [i for i, k in enumerate(known) if k is None]
        for i in [i for i in rest if len(words[i]) > LONG_WORD]:
            ids = self._by_heap(words[i])
            done.append((np.full(len(ids), i), np.arange(len(ids)), ids))
        rest = [i for i in rest if len(words[i]) <= LONG_WORD]
        flat = np.frombuffer(b"".join([words[i] for i in rest]), np.uint8)
        part = self.bytes_of[flat]
        word = np.repeat(np.array(rest, np.int64), [len(words[i]) for i in rest])
        rank = self._neighbours(part, word)
        while len(part):
            starts = np.flatnonzero(np.append(True, word[1:] != word[:-1]))
            counts = np.diff(np.append(starts, len(word)))
            least = np.minimum.reduceat(rank, starts)
            over = np.repeat(least == NONE, counts)
            if over.any():
                own = np.arange(len(word)) - np.repeat(starts, counts)
                done.append((word[over], own[over], part[over]))
                part, word, rank, least = part[~over], word[~over], rank[~over], np.repeat(least, counts)[~over]
            else:
                least = np.repeat(least, counts)
            if not len(part):
                break
            hits = np.flatnonzero(rank == least)
            hits = hits[np.append(True, word[hits[1:]] != word[hits[:-1]])]  # leftmost of each word
            part[hits] = rank[hits]
            keep = np.ones(len(part), bool)
            keep[hits + 1] = False
            moved = hits - np.arange(len(hits))
            part, word, rank = part[keep], word[keep], rank[keep]
            for at in (moved, moved[moved > 0] - 1):  # the new part with its neighbours
                right = np.minimum(at + 1, len(part) - 1)
                same = (at + 1 < len(part)) & (word[at] == word[right])
                new = np.full(len(at), NONE, np.int64)
                new[same] = self.rank(part[at[same]], part[right[same]])
                rank[at] = new
        w = np.concatenate([d[0] for d in done])
        p = np.concatenate([d[1] for d in done])
        ids = np.concatenate([d[2] for d in done])
        order = np.lexsort((p, w))
        return ids[order], np.bincount(w, minlength=len(words))

    def _neighbours(self, part: np.ndarray, word: np.ndarray) -> np.ndarray:
        out = np.full(len(part), NONE, np.int64)
        same = np.flatnonzero(word[1:] == word[:-1])
        out[same] = self.rank(part[same], part[same + 1])
        return out

    def _by_heap(self, word: bytes) -> np.ndarray:
        """Merges of one long word, lowest rank and leftmost first."""
        ids = [int(self.bytes_of[b]) for b in word]
        n = len(ids)
        before, after = list(range(-1, n - 1)), [*range(1, n), -1]
        pieces = [bytes([b]) for b in word]
        heap = [(r, i, pieces[i] + pieces[i + 1]) for i in range(n - 1) if (r := self.ranks.get(pieces[i] + pieces[i + 1])) is not None]
        heapq.heapify(heap)
        alive = [True] * n
        while heap:
            r, i, joined = heapq.heappop(heap)
            j = after[i] if alive[i] else -1
            if j < 0 or pieces[i] + pieces[j] != joined:
                continue
            pieces[i], ids[i], alive[j] = joined, r, False
            after[i] = after[j]
            if after[i] >= 0:
                before[after[i]] = i
            for a in (before[i], i):
                b = after[a] if a >= 0 else -1
                if b >= 0 and (q := self.ranks.get(pieces[a] + pieces[b])) is not None:
                    heapq.heappush(heap, (q, a, pieces[a] + pieces[b]))
        return np.array([ids[i] for i in range(n) if alive[i]], np.int64)


#: Rank of a pair that does not join.
NONE = np.int64(1) << np.int64(40)


def encode_texts(texts: list[str | None], merges: Merges, cut: regex.Pattern) -> tuple[np.ndarray, np.ndarray]:
    """(ids, sizes): tokens of the texts, each distinct word folded once."""
    index: dict[str, int] = {}
    rows, counts = array("i"), []
    for text in texts:
        before = len(rows)
        rows.extend([index.setdefault(w, len(index)) for w in cut.findall(text or "")])
        counts.append(len(rows) - before)
    if not index:
        return np.empty(0, np.int64), np.zeros(len(texts), np.int64)
    words = [w.encode("utf-8", "surrogatepass") for w in index]
    del index
    ids, sizes = merges.fold(words)
    row = np.frombuffer(rows, np.int32)
    starts = np.cumsum(sizes) - sizes
    per_word = sizes[row]
    ends = np.append(0, np.cumsum(per_word))
    at = np.append(0, np.cumsum(counts))
    return ids[ragged(starts[row], per_word)], ends[at[1:]] - ends[at[:-1]]


def _encoder(ranks_path: str, pattern: str, spark):
    """A broadcast vocabulary (bounded by its file) and a lazily built table per worker."""
    shared = spark.sparkContext.broadcast(load_ranks(ranks_path))
    state: dict[str, object] = {}

    def tables() -> tuple[Merges, regex.Pattern]:
        if not state:
            state["m"], state["p"] = Merges(shared.value), compile_pattern(pattern)
        return state["m"], state["p"]

    return tables


def encode(docs: DataFrame, ranks_path: str, pattern: str, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The ``keep`` columns of ``docs`` with ids (array<int>)."""
    tables = _encoder(ranks_path, pattern, docs.sparkSession)
    own = docs.select(*keep, F.col(text).alias("__text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        merges, cut = tables()
        for batch in batches:
            for a, b in text_slices(batch["__text"], SLICE_BYTES):
                part = batch.slice(a, b - a)
                ids, sizes = encode_texts(part["__text"].to_pylist(), merges, cut)
                yield pa.RecordBatch.from_arrays(
                    [*[part[c] for c in keep], list_array(ids.astype(np.int32), sizes, pa.int32())], names=[*keep, "ids"])

    return own.mapInArrow(run, _schema(own, keep, "ids array<int>"))


def decode(encoded: DataFrame, ranks_path: str, keep: tuple[str, ...] = ("doc_id",), ids: str = "ids") -> DataFrame:
    """The ``keep`` columns with ``data``: the pieces of each row's ids, concatenated."""
    tables = _encoder(ranks_path, "", encoded.sparkSession)
    own = encoded.select(*keep, F.col(ids).alias("__ids"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        merges, _ = tables()
        for batch in batches:
            data = [None if x is None else merges.decode(np.array(x, np.int64))[0].tobytes() for x in batch["__ids"].to_pylist()]
            yield pa.RecordBatch.from_arrays([*[batch[c] for c in keep], pa.array(data, pa.binary())], names=[*keep, "data"])

    return own.mapInArrow(run, _schema(own, keep, "data binary"))


def _schema(df: DataFrame, keep: tuple[str, ...], more: str) -> str:
    return ", ".join([f"`{c}` {df.schema[c].dataType.simpleString()}" for c in keep] + [more])


def round_trip(docs: DataFrame, ranks_path: str, pattern: str, text: str = "text", keep: tuple[str, ...] = ("doc_id",),
               with_ids: bool = False) -> DataFrame:
    """Encode and decode each text in one pass over the documents: the ``keep``
    columns, n_tokens, ids_sha256 (ids as little-endian unsigned 32-bit),
    decoded_sha256, and token_ids if asked for."""
    tables = _encoder(ranks_path, pattern, docs.sparkSession)
    own = docs.select(*keep, F.col(text).alias("__text"))
    more = "n_tokens long, ids_sha256 string, decoded_sha256 string" + (", token_ids array<int>" if with_ids else "")
    names = [*keep, "n_tokens", "ids_sha256", "decoded_sha256", *["token_ids"] * with_ids]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        merges, cut = tables()
        for batch in batches:
            for a, b in text_slices(batch["__text"], SLICE_BYTES):
                part = batch.slice(a, b - a)
                ids, sizes = encode_texts(part["__text"].to_pylist(), merges, cut)
                data, lengths = merges.decode(ids)
                ends, bytes_ends = np.append(0, np.cumsum(sizes)), np.append(0, np.cumsum(lengths))
                raw, plain = memoryview(ids.astype("<u4").tobytes()), memoryview(data.tobytes())
                sha = lambda x: hashlib.sha256(x).hexdigest()
                spans = list(zip(ends[:-1].tolist(), ends[1:].tolist()))
                cols = [pa.array(sizes, pa.int64()), pa.array([sha(raw[4 * i:4 * j]) for i, j in spans], pa.string()),
                        pa.array([sha(plain[bytes_ends[i]:bytes_ends[j]]) for i, j in spans], pa.string())]
                if with_ids:
                    cols.append(list_array(ids.astype(np.int32), sizes, pa.int32()))
                yield pa.RecordBatch.from_arrays([*[part[c] for c in keep], *cols], names=names)

    return own.mapInArrow(run, _schema(own, keep, more))


def rank_buckets(ranks: dict[bytes, int], buckets: int) -> Column:
    """A literal rank map for SQL: maps of hex strings to ranks, by bucket of the
    key's CRC-32, as Spark searches a map from front to end."""
    import zlib

    parts: list[dict[str, int]] = [{} for _ in range(buckets)]
    for word, rank in ranks.items():
        parts[zlib.crc32(word) % buckets][word.hex().upper()] = rank
    text = ";".join(",".join(f"{k}:{v}" for k, v in p.items()) for p in parts)
    return F.expr(f"transform(split('{text}', ';'), x -> str_to_map(x, ',', ':'))")


def fold_words(words: DataFrame, ranks: dict[bytes, int], buckets: int = 4096) -> DataFrame:
    """(word, ids) for a table of distinct words, in higher-order functions only:
    the parts start as single bytes, and each step of the fold joins the pair
    of lowest rank.  The rank map is one row that is joined to every word."""
    table = words.sparkSession.range(1).select(rank_buckets(ranks, buckets).alias("rk"))
    rank = "CAST(try_element_at(rk[CAST(crc32({p}) % {b} AS INT)], hex({p})) AS INT)".format(p="{p}", b=buckets)
    pair = rank.format(p="concat(a[i], a[i + 1])")
    best = f"array_min(transform(sequence(0, size(a) - 2), i -> named_struct('r', coalesce({pair}, 2147483647), 'i', i)))"
    joined = ("transform(filter(sequence(0, size(a) - 1), i -> i <> m.i + 1), "
              "i -> IF(i = m.i, concat(a[i], a[i + 1]), a[i]))")
    step = f"IF(size(a) < 2, a, transform(array({best}), m -> IF(m.r = 2147483647, a, {joined}))[0])"
    whole = rank.format(p="b")
    text = ("transform(array(encode(word, 'UTF-8')), b -> IF(length(b) = 0, CAST(array() AS array<int>), "
            f"IF({whole} IS NOT NULL, array({whole}), transform(aggregate(sequence(1, length(b)), "
            f"transform(sequence(1, length(b)), i -> substring(b, i, 1)), (a, x) -> {step}), p -> {rank.format(p='p')}))))[0]")
    return words.crossJoin(F.broadcast(table)).select("word", F.expr(text).alias("ids"))
