"""Language of a text by sparse multinomial logistic regression (operator 10).

Features are TF-IDF weights of hashed character n-grams (1 to ``ORDERS``) of
the lower-cased text with all but letters as spaces: relative frequency times
log(documents / documents with it).  The document frequencies come from all
training documents, in one distributed pass.  The weights are learned in numpy
by follow-the-regularised-leader (per-coordinate rates, elastic-net penalty:
L1 sets rare n-grams to exactly zero) on a bounded sample of training rows,
``per_lang`` for each language and ``max_rows`` in all, in hash order.  A part
of the sample is kept back to fit the temperature of the softmax.

Training uses only rows whose crc32(doc_id) modulo ``folds`` is not ``held``
and whose lang is not null; a score reads nothing but the text.

Defined cases: a text that is null or has no letter is `und` with score 0; so
is every text if there is nothing to learn from; ties of the score go to the
alphabetically first language; rows with a null ``doc_id`` are never held out
and never learned from; repeated rows are scored alike; other columns are not
read by ``identify`` and kept by ``keep_known``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cabinlens.llm.common import text_slices
from cabinlens.llm.ngrams import SPACE, grams, normalized

ORDERS = 3
BITS = 15
UNKNOWN = "und"
#: Bytes of text that a task works on at a time.
SLICE_BYTES = 1 << 18


def fold(doc_id: Column, folds: int) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % folds


def features(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, bucket) of every n-gram, and the number of letters of each row."""
    codes, offsets = normalized(texts)
    blank = codes == SPACE
    row = np.repeat(np.arange(len(texts)), np.diff(offsets))
    letters = np.bincount(row[~blank], minlength=len(texts))
    rows, buckets = [], []
    for n in range(1, ORDERS + 1):
        ok = row[n - 1:] == row[:len(row) - n + 1]
        if n == 1:
            ok &= ~blank
        for i in range(n - 1):  # no two spaces in a row
            ok &= ~(blank[i:len(codes) - n + 1 + i] & blank[i + 1:len(codes) - n + 2 + i])
        buckets.append(grams(codes, n, BITS)[ok])
        rows.append(row[:len(row) - n + 1][ok])
    return np.concatenate(rows), np.concatenate(buckets), letters


def _document_frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row a bucket and task: documents that hold it; bucket -1: documents."""
    total, docs = np.zeros(1 << BITS, np.int64), 0
    for batch in batches:
        docs += batch.num_rows
        for a, b in text_slices(batch["text"], SLICE_BYTES):
            texts = batch["text"].slice(a, b - a).to_pylist()
            for i in range(0, len(texts), 256):  # a bit for each document and bucket
                row, bucket, _ = features(texts[i:i + 256])
                seen = np.zeros((min(256, len(texts) - i), 1 << BITS), bool)
                seen[row, bucket] = True
                total += seen.sum(axis=0)
    some = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays(
        [pa.array(np.append(some, -1), pa.int32()), pa.array(np.append(total[some], docs), pa.int64())], names=["bucket", "n"])


class Model:
    """idf, weights (bucket, language), bias, temperature and languages."""

    def __init__(self, idf: np.ndarray, langs: list[str]):
        self.idf, self.langs = idf.astype(np.float32), langs
        self.weights = np.zeros((1 << BITS, len(langs)), np.float32)
        self.bias = np.zeros(len(langs))
        self.temperature = 1.0

    def vectors(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Dense TF-IDF rows (for training batches) and letters."""
        row, bucket, letters = features(texts)
        x = np.bincount(row * (1 << BITS) + bucket, minlength=len(texts) << BITS).reshape(len(texts), -1).astype(np.float32)
        x *= self.idf / np.maximum(x.sum(axis=1, keepdims=True), 1)
        return x, letters

    def logits(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Scores before the softmax, summed over the n-grams, and letters."""
        row, bucket, letters = features(texts)
        count = np.maximum(np.bincount(row, minlength=len(texts)), 1)
        table = self.weights * self.idf[:, None]
        out = np.stack([np.bincount(row, weights=table[:, c][bucket], minlength=len(texts)) for c in range(len(self.langs))], axis=1)
        return out / count[:, None] + self.bias, letters

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        if not self.langs:
            return [UNKNOWN] * len(texts), np.zeros(len(texts))
        z, letters = self.logits(texts)
        p = softmax(z / self.temperature)
        best = p.argmax(axis=1)
        known = letters > 0
        return [self.langs[b] if k else UNKNOWN for b, k in zip(best, known)], np.where(known, p.max(axis=1), 0.0)


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def train_ftrl(model: Model, texts: list[str], labels: np.ndarray, epochs: int = 4, batch: int = 32,
               rate: float = 4.0, beta: float = 1.0, l1: float = 2e-4, l2: float = 1e-4, seed: int = 7) -> None:
    """Follow-the-regularised-leader over mini-batches; weights from (z, n)."""
    shape = model.weights.shape
    z, n = np.zeros(shape), np.zeros(shape)
    bz, bn = np.zeros(shape[1]), np.zeros(shape[1])
    rng = np.random.default_rng(seed)
    for _ in range(epochs):
        order = rng.permutation(len(texts))
        for i in range(0, len(order), batch):
            at = order[i:i + batch]
            x, _ = model.vectors([texts[j] for j in at])
            error = softmax(x @ model.weights + model.bias)
            error[np.arange(len(at)), labels[at]] -= 1
            used = np.flatnonzero(x.any(axis=0))
            g = x[:, used].T @ error / len(at)
            for zz, nn, gg, w in ((z, n, g, model.weights), (bz, bn, error.mean(axis=0), model.bias)):
                u = used if zz is z else slice(None)
                grown = np.sqrt(nn[u] + gg * gg) - np.sqrt(nn[u])
                zz[u] += gg - grown / rate * w[u]
                nn[u] += gg * gg
                if zz is z:
                    w[u] = np.where(np.abs(zz[u]) <= l1, 0, -(zz[u] - np.sign(zz[u]) * l1) / ((beta * 1e-2 + np.sqrt(nn[u])) / rate + l2))
                else:
                    w[u] = -zz[u] / ((beta + np.sqrt(nn[u])) / rate)


def fit_temperature(z: np.ndarray, labels: np.ndarray) -> float:
    """The temperature of least log loss on rows that the weights have not seen.
    One row in len + 2 counts as unexplained, so that a faultless part does not
    make every score 1."""
    if not len(labels):
        return 1.0
    slack = 1 / (len(labels) + 2)
    grid = np.exp(np.linspace(np.log(0.02), np.log(20), 140))
    loss = []
    for t in grid:
        p = np.maximum(softmax(z / t), 1e-300)
        loss.append(-((1 - slack) * np.log(p[np.arange(len(labels)), labels]) + slack * np.log(p).mean(axis=1)).mean())
    return float(grid[int(np.argmin(loss))])


def fit(docs: DataFrame, folds: int = 5, held: int = 0, per_lang: int = 600, max_rows: int = 6000,
        doc_id: str = "doc_id", text: str = "text", lang: str = "lang") -> Model:
    own = docs.select(F.col(doc_id).alias("d"), F.col(text).alias("text"), F.col(lang).alias("lang")).where(
        F.col("lang").isNotNull() & F.col("text").isNotNull() & (fold(F.col("d"), folds) != held))
    counts = own.select("text").mapInArrow(_document_frequencies, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    df = {r["bucket"]: r["n"] for r in counts.collect()}  # at most 2**BITS + 1 rows
    n_docs = df.pop(-1, 0)
    idf = np.zeros(1 << BITS)
    idf[list(df)] = np.log((n_docs + 1) / np.array(list(df.values()), float)) if df else 0

    # a bounded sample: the smallest hashes of each language
    from pyspark.sql import Window

    picked = own.select("d", "lang", F.xxhash64("d", "text").alias("k")).withColumn("salt", F.pmod(F.col("k"), F.lit(64)))
    for group in (["lang", "salt"], ["lang"]):  # a common language is first cut down in 64 parts
        order = Window.partitionBy(*group).orderBy("k", "d")
        picked = picked.withColumn("r", F.row_number().over(order)).where(F.col("r") <= per_lang)
    picked = picked.orderBy("r", "lang").limit(max_rows).select(F.col("lang").alias("p_lang"), F.col("k").alias("p_k")).distinct()
    rows = own.withColumn("k", F.xxhash64("d", "text")).join(
        F.broadcast(picked), (F.col("lang") == F.col("p_lang")) & (F.col("k") == F.col("p_k"))).select("k", "lang", "text")
    sample = sorted({(r["k"], r["lang"], r["text"]) for r in rows.dropDuplicates().collect()})
    langs = sorted({r[1] for r in sample})
    model = Model(idf, langs)
    texts, labels = [r[2] for r in sample], np.array([langs.index(r[1]) for r in sample], np.int64)
    if len(langs) < 2:
        return model
    kept_back = np.array([r[0] % 5 == 0 for r in sample])
    train_ftrl(model, [t for t, k in zip(texts, kept_back) if not k], labels[~kept_back])
    back = [t for t, k in zip(texts, kept_back) if k]
    if back:
        model.temperature = fit_temperature(model.logits(back)[0], labels[kept_back])
    return model


def identify(docs: DataFrame, folds: int = 5, held: int = 0, doc_id: str = "doc_id", text: str = "text", **how) -> DataFrame:
    """Per document: doc_id, held_out, lang_pred, score."""
    model = fit(docs, folds, held, doc_id=doc_id, text=text, **how)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b in text_slices(batch["text"], SLICE_BYTES):
                part = batch.slice(a, b - a)
                names, scores = model.predict(part["text"].to_pylist())
                yield pa.RecordBatch.from_arrays([part["doc_id"], part["held_out"], pa.array(names, pa.string()), pa.array(scores)],
                                                 names=["doc_id", "held_out", "lang_pred", "score"])

    own = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(fold(F.col(doc_id), folds) == held, F.lit(False)).alias("held_out"),
                      F.col(text).alias("text"))
    return own.mapInArrow(run, f"doc_id {own.schema['doc_id'].dataType.simpleString()}, held_out boolean, lang_pred string, score double")


def keep_known(docs: DataFrame, least: float = 0.5, **how) -> DataFrame:
    """Documents whose language is known with a score of ``least`` or more, all
    columns kept; the scores are found in the same pass that hands the rows on."""
    model = fit(docs, **how)
    position = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b in text_slices(batch.column(position), SLICE_BYTES):
                part = batch.slice(a, b - a)
                names, scores = model.predict(part.column(position).to_pylist())
                yield part.filter(pa.array([n != UNKNOWN and s >= least for n, s in zip(names, scores)], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
