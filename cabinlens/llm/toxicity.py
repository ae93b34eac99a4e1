"""Toxicity by averaged subword embeddings and a linear softmax (operator 4).

A text is lower-cased, a word that repeats the one before it is skipped, and
the rest is cut into windows of ``WINDOW`` words.  A window is
the bag of the character n-grams (3 to 5) of its words, word borders included;
each n-gram has an embedding (hashed into 2**``BITS`` rows), a word is the
average of its n-grams, and the average of the words (``FLOOR`` at least) goes
through a linear softmax.  Embeddings and softmax are trained jointly in
numpy by gradient descent, so a misspelling that was never seen still shares
most of its vectors with the word it hides.

A label is given to a whole text, while a few words in one window may earn it.
So training goes in rounds: first every window carries its text's label, then
each text is represented by its highest-scoring window (of a toxic text the
likeliest culprit, of a clean one the hardest to tell).  A text's score is the
calibrated score of its highest window; all windows of the whole text count.

The labelled rows that may be learned from are those whose crc32(doc_id)
modulo ``folds`` is not ``held``; of these a bounded sample (``per_class`` toxic
and ``clean_share`` times as many clean ones, in hash order) is fitted on the
driver.

Defined cases: a text that is null, empty or without words scores as an empty
window; long texts have as many windows as they need; documents with several
labels are toxic if any is; null labels are ignored; a null ``doc_id`` is
neither held out nor learned from; without labels of both kinds every score is
the share of toxic ones (0 without any); repeated rows score alike; other
columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cabinlens.llm.common import MULT, mix, text_slices
from cabinlens.llm.language_id import fold
from cabinlens.llm.ngrams import SPACE, grams, normalized

BITS = 16
DIM = 8
WINDOW = 8
SIZES = (3, 4, 5)
#: A window of fewer words is averaged as if it had so many, the rest neutral.
FLOOR = 4
#: A score of this or more is predicted toxic (fixed by the contract of the query).
CUT = 0.3


def windows(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(window, bucket, weight) of every subword, and the first window of each
    text (one more at the end); a text has one window at least.  The weights of
    a word's subwords add up to 1 / (words of its window)."""
    codes, offsets = normalized(texts, digits=True, extra="@$*")
    blank = codes == SPACE
    row = np.repeat(np.arange(len(texts)), np.diff(offsets))
    starts = np.flatnonzero(~blank[1:] & blank[:-1]) + 1  # first letter of each word
    begins = np.zeros(len(codes), np.int64)
    begins[starts] = 1
    word = np.cumsum(begins) - 1
    kept = ~_repeats(codes, starts, blank, word, row[starts])
    per_row = np.bincount(row[starts], weights=kept, minlength=len(texts)).astype(np.int64)
    first_word = np.cumsum(per_row) - per_row
    counts = np.maximum(-(-per_row // WINDOW), 1)
    first = np.append(0, np.cumsum(counts))
    window_of = first[row[starts]] + (np.cumsum(kept) - 1 - first_word[row[starts]]) // WINDOW
    out_w, out_b = [], []
    for n in SIZES:
        # a run inside one word, its borders included: only its ends may be blank
        ok = np.ones(max(len(codes) - n + 1, 0), bool)
        for i in range(1, n - 1):
            ok &= ~blank[i:len(codes) - n + 1 + i]
        at = np.flatnonzero(ok)
        at = at[kept[word[at + 1]]]
        out_b.append(grams(codes, n, BITS)[at])
        out_w.append(word[at + 1])
    word_of = np.concatenate(out_w)
    words_in = np.maximum(np.bincount(window_of[kept], minlength=first[-1]), FLOOR)
    weight = 1 / np.maximum(np.bincount(word_of, minlength=len(starts)), 1) / words_in[window_of]
    return window_of[word_of], np.concatenate(out_b), weight[word_of], first


def _repeats(codes: np.ndarray, starts: np.ndarray, blank: np.ndarray, word: np.ndarray, row: np.ndarray) -> np.ndarray:
    """Which words equal the word before them in the same text (by hash)."""
    out = np.zeros(len(starts), bool)
    if len(starts) > 1:
        at = np.flatnonzero(~blank)
        with np.errstate(over="ignore"):
            place = (at - starts[word[at]]).astype(np.uint64)
            letters = mix(codes[at].astype(np.uint64) + place * MULT)
            hashes = np.add.reduceat(letters, np.searchsorted(at, starts))
        out[1:] = (hashes[1:] == hashes[:-1]) & (row[1:] == row[:-1])
    return out


class Model:
    """``table`` is the log-odds of each subword, its embedding times the
    difference of the softmax rows; a window's log-odds are their mean + bias."""

    def __init__(self, table: np.ndarray, bias: float, slope: float = 1.0, shift: float = 0.0):
        self.table, self.bias, self.slope, self.shift = table, bias, slope, shift

    def odds(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Log-odds of every window, and the first window of each text."""
        win, bucket, weight, first = windows(texts)
        return np.bincount(win, weights=self.table[bucket] * weight, minlength=first[-1]) + self.bias, first

    def highest(self, texts: list[str | None]) -> np.ndarray:
        z, first = self.odds(texts)
        return np.maximum.reduceat(z, first[:-1]) if len(texts) else np.empty(0)

    def score(self, texts: list[str | None]) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * self.highest(texts) + self.shift, -500, 500)))


def train(texts: list[str], labels: np.ndarray, rounds: int = 14, batch: int = 64, rate: float = 60.0, seed: int = 11) -> Model:
    """Joint gradient descent (Adagrad) on embeddings and softmax rows."""
    rng = np.random.default_rng(seed)
    buckets, weights, parts, firsts = [], [], [], [np.zeros(1, np.int64)]
    for i in range(0, len(texts), 64):
        win, bucket, weight, first = windows(texts[i:i + 64])
        order = np.argsort(win, kind="stable")
        buckets.append(bucket[order].astype(np.uint16))
        weights.append(weight[order].astype(np.float16))
        parts.append(np.bincount(win, minlength=first[-1]))
        firsts.append(first[1:] + firsts[-1][-1])
    bucket, weight, sizes, first = (np.concatenate(x) for x in (buckets, weights, parts, firsts))
    starts = np.cumsum(sizes) - sizes
    of_text = np.repeat(np.arange(len(texts)), np.diff(first))
    embed = rng.normal(0, 0.1, (1 << BITS, DIM))
    soft = np.array([np.ones(DIM), -np.ones(DIM)]) * np.linspace(-1, 1, DIM)
    bias = np.zeros(2)
    seen = [np.full(a.shape, 1e-3) for a in (embed, soft, bias)]
    steps = (rate / 400, rate / 1000, rate / 1000)
    for turn in range(rounds):
        if turn == 0:  # all windows of the toxic texts and as many of clean ones
            toxic = np.flatnonzero(labels[of_text] == 1)
            clean = np.flatnonzero(labels[of_text] == 0)
            chosen = rng.permutation(np.concatenate([toxic, rng.permutation(clean)[:len(toxic)]]))
        else:
            table = embed @ (soft[1] - soft[0])
            z = np.empty(len(sizes))
            for i in range(0, len(sizes), 4096):
                own = sizes[i:i + 4096]
                here = slice(starts[i], starts[i] + own.sum())
                z[i:i + 4096] = np.bincount(np.repeat(np.arange(len(own)), own), weights=table[bucket[here]] * weight[here], minlength=len(own))
            top = np.array([first[i] + int(np.argmax(z[first[i]:first[i + 1]])) for i in range(len(texts))])
            other = np.array([rng.integers(first[i], first[i + 1]) for i in range(len(texts)) if not labels[i]], np.int64)
            chosen = rng.permutation(np.concatenate([top, other]))
        for i in range(0, len(chosen), batch):
            w = chosen[i:i + batch]
            at = np.concatenate([np.arange(starts[j], starts[j] + sizes[j]) for j in w])
            b, r = bucket[at].astype(np.int64), np.repeat(np.arange(len(w)), sizes[w])
            share = weight[at].astype(np.float64)
            hidden = np.stack([np.bincount(r, weights=embed[b, d] * share, minlength=len(w)) for d in range(DIM)], axis=1)
            out = hidden @ soft.T + bias
            p = np.exp(out - out.max(axis=1, keepdims=True))
            p /= p.sum(axis=1, keepdims=True)
            p[np.arange(len(w)), labels[of_text[w]]] -= 1
            back = p @ soft
            used, inverse = np.unique(b, return_inverse=True)
            grad = np.stack([np.bincount(inverse, weights=back[r, d] * share, minlength=len(used)) for d in range(DIM)], axis=1)
            for a, g, s, step, u in ((embed, grad, seen[0], steps[0], used), (soft, p.T @ hidden, seen[1], steps[1], slice(None)),
                                     (bias, p.sum(axis=0), seen[2], steps[2], slice(None))):
                s[u] += g * g
                a[u] -= step * g / np.sqrt(s[u])
    return Model((embed @ (soft[1] - soft[0])).astype(np.float64), float(bias[1] - bias[0]))


def calibrate(model: Model, texts: list[str], labels: np.ndarray) -> None:
    """Logistic map from a text's highest window to its score, by Newton steps,
    on texts that the embeddings have not seen."""
    z = model.highest(texts)
    center, scale = float(z.mean()), float(z.std()) or 1.0
    x = np.stack([(z - center) / scale, np.ones(len(z))], axis=1)
    pos, neg = int(labels.sum()), int((1 - labels).sum())
    target = np.where(labels == 1, (pos + 1) / (pos + 2), 1 / (neg + 2))
    w = np.array([1.0, 0.0])
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        h = (x * (p * (1 - p))[:, None]).T @ x + 1e-3 * np.eye(2)
        w = w - np.clip(np.linalg.solve(h, x.T @ (p - target) + 1e-3 * w * [1, 0]), -2, 2)
    model.slope, model.shift = float(w[0] / scale), float(w[1] - w[0] * center / scale)


def fit(docs: DataFrame, labels: DataFrame, folds: int = 4, held: int = 2, per_class: int = 800, clean_share: int = 3,
        doc_id: str = "doc_id", text: str = "text", label: str = "toxic") -> Model:
    known = labels.select(F.col(doc_id).alias("d"), F.col(label).cast("int").alias("y")).where(
        F.col("y").isin(0, 1) & (fold(F.col("d"), folds) != held))
    known = known.groupBy("d").agg(F.max("y").alias("y"))
    picked = known.withColumn("k", F.xxhash64("d")).withColumn("salt", F.pmod(F.col("k"), F.lit(64)))
    most = F.when(F.col("y") == 1, per_class).otherwise(clean_share * per_class)
    for group in (["y", "salt"], ["y"]):  # each class is first cut down in 64 parts
        order = Window.partitionBy(*group).orderBy("k", "d")
        picked = picked.withColumn("r", F.row_number().over(order)).where(F.col("r") <= most)
    picked = picked.select("d", "y", "k")
    rows = docs.select(F.col(doc_id).alias("__d"), F.col(text).alias("text")).where("text IS NOT NULL").join(
        F.broadcast(picked), F.col("__d") == F.col("d")).select("k", "y", "text").dropDuplicates()
    sample = sorted((r["k"], r["y"], r["text"]) for r in rows.collect())
    texts, y = [r[2] for r in sample], np.array([r[1] for r in sample], np.int64)
    if not len(y) or y.min() == y.max():
        share = float(y.mean()) if len(y) else 0.0
        return Model(np.zeros(1 << BITS), 0.0, 0.0, float(np.log(max(share, 1e-9) / max(1 - share, 1e-9))))
    back = np.array([r[0] % 4 == 0 for r in sample])
    if len(set(y[~back])) < 2 or len(set(y[back])) < 2:
        back[:] = False
    model = train([t for t, b in zip(texts, back) if not b], y[~back])
    calibrate(model, [t for t, b in zip(texts, back) if b] or texts, y[back] if back.any() else y)
    return model


def score(docs: DataFrame, labels: DataFrame, folds: int = 4, held: int = 2, doc_id: str = "doc_id", text: str = "text", **how) -> DataFrame:
    """Per document: doc_id, held_out, score, predicted."""
    model = fit(docs, labels, folds, held, doc_id=doc_id, text=text, **how)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b in text_slices(batch["text"], 1 << 20):
                part = batch.slice(a, b - a)
                scores = model.score(part["text"].to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [part["doc_id"], part["held_out"], pa.array(scores, pa.float64()), pa.array((scores >= CUT).astype(np.int32))],
                    names=["doc_id", "held_out", "score", "predicted"])

    own = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(fold(F.col(doc_id), folds) == held, F.lit(False)).alias("held_out"),
                      F.col(text).alias("text"))
    return own.mapInArrow(run, f"doc_id {own.schema['doc_id'].dataType.simpleString()}, held_out boolean, score double, predicted int")
