"""The trained models against scalar loops: scores, one training step, calibration."""

import math
import random

import numpy as np
import pytest

from cabinlens.llm import language_id, toxicity

TEXTS = ["The cat, sat on the mat!", "", None, "a", "  ", "Zażółć gęślą jaźń 123", "x1 x1 x1 b@d w0rd$ and more words here to fill two windows",
         "word word Word other", "日本 語", "!!! ?", "one two three four five six seven eight nine ten eleven"]


def bucket(gram, bits):
    h = 0x811C9DC5 + len(gram)
    for c in gram:
        h = ((h ^ ord(c)) * 0x85EBCA6B) & 0xFFFFFFFF
        h ^= h >> 13
    return ((h * 0xC2B2AE35) & 0xFFFFFFFF) >> (32 - bits)


def cleaned(text, digits=False, extra=""):
    return "".join(c if c.isalpha() or (digits and c.isdigit()) or c in extra else " " for c in f" {(text or '').lower()} ")


def language_grams(text):
    s = cleaned(text)
    out = [bucket(c, language_id.BITS) for c in s if c != " "]
    for n in range(2, language_id.ORDERS + 1):
        out += [bucket(s[i:i + n], language_id.BITS) for i in range(len(s) - n + 1) if "  " not in s[i:i + n]]
    return out


def test_language_scores():
    rng = np.random.default_rng(1)
    model = language_id.Model(rng.random(1 << language_id.BITS), ["aa", "bb", "cc"])
    model.weights[:] = rng.normal(size=model.weights.shape)
    model.bias[:], model.temperature = [0.1, -0.2, 0.3], 0.7
    langs, scores = model.predict(TEXTS)
    for text, lang, score in zip(TEXTS, langs, scores):
        found = language_grams(text)
        z = [model.bias[c] + sum(float(model.weights[b, c] * model.idf[b]) for b in found) / max(len(found), 1) for c in range(3)]
        p = [math.exp(v / 0.7) for v in z]
        if any(c.isalpha() for c in text or ""):
            assert lang == model.langs[int(np.argmax(p))] and score == pytest.approx(max(p) / sum(p), rel=1e-4)
        else:
            assert (lang, score) == ("und", 0.0)


def test_two_steps_of_the_leader():
    """Follow-the-regularised-leader with elastic net, coordinate by coordinate."""
    texts, labels = ["the cat", "le chat et le chien"], np.array([0, 1])
    rate, beta, l1, l2 = 4.0, 1.0, 2e-4, 1e-4
    rng = np.random.default_rng(2)
    idf = rng.random(1 << language_id.BITS).astype(np.float32)
    model = language_id.Model(idf, ["en", "fr"])
    language_id.train_ftrl(model, texts, labels, epochs=1, batch=1, rate=rate, beta=beta, l1=l1, l2=l2, seed=7)
    order = np.random.default_rng(7).permutation(2)
    w, z, n = {}, {}, {}
    bias, bz, bn = [0.0, 0.0], [0.0, 0.0], [0.0, 0.0]
    for j in order:
        found = language_grams(texts[j])
        x = {b: found.count(b) / len(found) * float(idf[b]) for b in set(found)}
        out = [sum(x[b] * w.get((b, c), 0.0) for b in x) + bias[c] for c in range(2)]
        p = [math.exp(v) / sum(map(math.exp, out)) for v in out]
        for c in range(2):
            e = p[c] - (labels[j] == c)
            for b in x:
                g, k = x[b] * e, (b, c)
                z[k] = z.get(k, 0) + g - (math.sqrt(n.get(k, 0) + g * g) - math.sqrt(n.get(k, 0))) / rate * w.get(k, 0)
                n[k] = n.get(k, 0) + g * g
                w[k] = 0.0 if abs(z[k]) <= l1 else -(z[k] - math.copysign(l1, z[k])) / ((beta * 1e-2 + math.sqrt(n[k])) / rate + l2)
            bz[c] += e - (math.sqrt(bn[c] + e * e) - math.sqrt(bn[c])) / rate * bias[c]
            bn[c] += e * e
            bias[c] = -bz[c] / ((beta + math.sqrt(bn[c])) / rate)
    assert model.bias == pytest.approx(bias, rel=1e-4)
    for (b, c), v in w.items():
        assert model.weights[b, c] == pytest.approx(v, rel=1e-3, abs=1e-6)
    assert set(zip(*np.nonzero(model.weights))) <= set(w)


def test_temperature_is_the_best_of_a_fine_grid():
    rng = np.random.default_rng(4)
    labels = rng.integers(0, 3, 200)
    z = rng.normal(size=(200, 3)) * 4
    z[np.arange(200), labels] += 3

    def loss(t):
        slack, p = 1 / 202, np.maximum(language_id.softmax(z / t), 1e-300)
        return -((1 - slack) * np.log(p[np.arange(200), labels]) + slack * np.log(p).mean(axis=1)).mean()

    found = language_id.fit_temperature(z, labels)
    fine = np.exp(np.linspace(math.log(0.02), math.log(20), 5000))
    best = fine[int(np.argmin([loss(t) for t in fine]))]
    assert abs(math.log(found / best)) < 0.05 and loss(found) < loss(best) + 1e-4


def toxic_windows(text):
    """For each window its (bucket, weight) pairs."""
    words, before = [], None
    for word in cleaned(text, digits=True, extra="@$*").split():
        if word != before:
            words.append(word)
        before = word
    out = []
    for i in range(0, max(len(words), 1), toxicity.WINDOW):
        own = words[i:i + toxicity.WINDOW]
        pairs = []
        for word in own:
            padded = f" {word} "
            subs = [padded[k:k + n] for n in toxicity.SIZES for k in range(len(padded) - n + 1)]
            pairs += [(bucket(s, toxicity.BITS), 1 / len(subs) / max(len(own), toxicity.FLOOR)) for s in subs]
        out.append(pairs)
    return out


def test_toxicity_scores():
    rng = np.random.default_rng(6)
    model = toxicity.Model(rng.normal(size=1 << toxicity.BITS), 0.2, 1.3, -0.4)
    long = " ".join(random.Random(1).choices(["idiot", "nice", "w0rd", "go"], k=3000))
    texts = [*TEXTS, long, long]
    for text, got in zip(texts, model.score(texts)):
        best = max(sum(model.table[b] * w for b, w in pairs) + 0.2 for pairs in toxic_windows(text))
        assert got == pytest.approx(1 / (1 + math.exp(-(1.3 * best - 0.4))), rel=1e-9)
    assert model.score([]).tolist() == []


def test_one_toxicity_step_against_finite_differences():
    """The first update of embeddings, softmax rows and biases, its gradients
    taken numerically from the summed log loss of the two windows."""
    texts, labels, seed, rate = ["you fool", "fine day"], np.array([1, 0]), 3, 60.0
    model = toxicity.train(texts, labels, rounds=1, batch=64, rate=rate, seed=seed)
    rng = np.random.default_rng(seed)
    embed = rng.normal(0, 0.1, (1 << toxicity.BITS, toxicity.DIM))
    soft = np.array([np.ones(toxicity.DIM), -np.ones(toxicity.DIM)]) * np.linspace(-1, 1, toxicity.DIM)
    bias = np.zeros(2)
    rows = [[(b, float(np.float16(w))) for b, w in toxic_windows(t)[0]] for t in texts]

    def loss():
        total = 0.0
        for pairs, y in zip(rows, labels):
            out = soft @ sum(embed[b] * w for b, w in pairs) + bias
            total += math.log(np.exp(out - out.max()).sum()) + out.max() - out[y]
        return total

    def slope(array, at):
        kept, step = array[at], 1e-5
        array[at] = kept + step
        high = loss()
        array[at] = kept - step
        low = loss()
        array[at] = kept
        return (high - low) / (2 * step)

    used = sorted({b for pairs in rows for b, _ in pairs})
    spots = [(embed, (b, d), rate / 400) for b in used for d in range(toxicity.DIM)]
    spots += [(soft, (c, d), rate / 1000) for c in range(2) for d in range(toxicity.DIM)] + [(bias, (c,), rate / 1000) for c in range(2)]
    grads = [slope(a, at) for a, at, _ in spots]
    for (a, at, step), g in zip(spots, grads):
        a[at] -= step * g / math.sqrt(1e-3 + g * g)
    want = embed @ (soft[1] - soft[0])
    assert model.bias == pytest.approx(bias[1] - bias[0], rel=1e-5)
    assert model.table[used] == pytest.approx(want[used], rel=1e-4, abs=1e-6)
