"""The whole of op7's and op10's scores, from the texts to the probability, by plain versions of their definitions."""

import math
import random
import zlib
from collections import Counter
from functools import lru_cache

import numpy as np
import pytest

from hostlens.llm import labelled, quality, queries, toxicity

SF = "/root/testdata/sf0.001"


def plain_statistics(text):
    data = (text or "").encode()
    words = data.split()
    n, size = max(1, len(words)), max(1, len(data))

    def count(chars):
        return sum(c in chars for c in data)

    letters = count(bytes([*range(65, 91), *range(97, 123), *range(128, 256)]))
    return [math.log1p(len(words)), math.log1p(len(data)), sum(map(len, words)) / n, count(bytes(range(65, 91))) / max(1, letters),
            sum(33 <= c < 127 and not chr(c).isalnum() for c in data) / size, count(b"#$%&*@^~+=<>{}[]\\") / n, count(b"!") / n, count(b"|") / n,
            count(b"0123456789") / size, sum(c > 127 for c in data) / size, len(set(words)) / n**0.9,
            sum(a == b for a, b in zip(words, words[1:], strict=False)) / n, count(b"\n") / n, count(b".") / n, count(b",") / n, math.log1p(len(set(data)))]


def test_op7_by_a_plain_version(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    drawn = labelled.training_labels(spark.read.parquet(f"{SF}/labels.parquet"), "quality", 5, 0, 200_000).collect()
    assert all(zlib.crc32(str(r.doc_id).encode()) % 5 for r in drawn)
    ids = list(docs)
    stats = np.array([plain_statistics(docs[i]) for i in ids])
    std = stats.std(0)
    x = np.clip((stats - stats.mean(0)) / np.where(std > 1e-9, std, 1), -6, 6)
    rng = np.random.default_rng(3)
    w, b = rng.normal(size=(16, 256)) / 4, rng.uniform(0, 2 * np.pi, 256)
    f = np.concatenate([np.ones((len(x), 1)), x, np.cos(x @ w + b)], 1)
    row = {i: k for k, i in enumerate(ids)}
    learnt = [(row[r.doc_id], r.label) for r in drawn if r.part > 0]
    apart = [(row[r.doc_id], r.label) for r in drawn if r.part == 0]
    # ridge regression as least squares with one more row for each weight
    a = np.concatenate([f[[k for k, _ in learnt]], np.diag(np.sqrt(3.0 * np.array([1e-6, *[1.0] * 272])))])
    beta = np.linalg.lstsq(a, np.array([y for _, y in learnt] + [0.0] * 273), rcond=None)[0]
    raw = f @ beta
    base = np.mean([r.label for r in drawn])
    cells = {}
    for k, y in apart:
        cells.setdefault(float(np.sign(raw[k]) * np.floor(abs(raw[k] * 500) + 0.5)), []).append(y)
    at = sorted(cells)
    y = np.array([(sum(cells[c]) + 0.1 * base) / (len(cells[c]) + 0.1) for c in at])
    n = np.array([len(cells[c]) + 0.1 for c in at])

    def mean(i, j):
        return (y[i : j + 1] @ n[i : j + 1]) / n[i : j + 1].sum()

    steps = [max(min(mean(i, j) for j in range(k, len(at))) for i in range(k + 1)) for k in range(len(at))]
    want = np.clip(0.999 * np.interp(raw, np.array(at) / 500, steps) + 0.001 / (1 + np.exp(-4 * (raw - 0.5))), 0, 1)
    got = queries.op7_fourier_quality(spark, SF).collect()
    assert len(got) == len(ids)
    for r in got:
        assert r.score == pytest.approx(want[row[r.doc_id]], abs=1e-5) and r.predicted == int(r.score >= 0.3)


def words_of(text):
    return [(w, w.lower().replace("\x01", "").replace("\x02", "").strip(toxicity.EDGES)) for w in (text or "").split()]


def grams_of(word):
    s = "\x01" * 4 + word + "\x02"
    return [s[i - 4 : i + 1] for i in range(4, len(s))]


def plain_evidence(docs, label_of):
    """The log-likelihood ratio of a word, from the definition."""
    grams, cls, d = Counter(), {0: Counter(), 1: Counter()}, 0.75
    for i, text in docs:
        for _, w in words_of(text):
            if w:
                grams.update(grams_of(w))
                if i in label_of:
                    cls[label_of[i]].update(grams_of(w))
    types = {5: dict.fromkeys(grams, 1)}
    for k in (4, 3, 2, 1):
        types[k] = Counter(g[1:] for g in types[k + 1])
    starts = {k: {} for k in types}
    for k, t in types.items():
        for g, v in t.items():
            starts[k].setdefault(g[:-1], []).append(v)
    by_class = {c: {} for c in cls}
    for c, t in cls.items():
        for g, v in t.items():
            by_class[c].setdefault(g[:-1], []).append(v)

    @lru_cache(None)
    def shared(g):
        if len(g) == 1:
            return 0.999 * types[1][g] / sum(types[1].values()) + 0.001 / 4096
        same = starts[len(g)][g[:-1]]
        return (types[len(g)][g] - d + d * len(same) * shared(g[1:])) / sum(same)

    def weight(c, h):
        same = by_class[c].get(h)
        return d * len(same) / sum(same) if same else 1.0

    @lru_cache(None)
    def ratio(g):
        h = g[:-1]
        if cls[0][g] + cls[1][g] == 0:  # an ending that neither class knows: the stem alone
            return math.log(weight(1, h) / weight(0, h)) if h in by_class[0] or h in by_class[1] else 0.0
        p = [max(cls[c][g] - d, 0) / sum(by_class[c][h]) + weight(c, h) * shared(g[1:]) if h in by_class[c] else shared(g[1:]) for c in (0, 1)]
        return math.log(p[1] / p[0])

    return lambda word: sum(map(ratio, grams_of(word)))


def plain_features(text, evidence):
    words = words_of(text)
    if not words:
        return [0.0] * 5
    s = [evidence(b) for _, b in words]
    k = max(range(len(s)), key=lambda i: s[i])
    longest = 1 + len(words[k][0])
    return [sum(s) / sum(1 + len(w) for w, _ in words), s[k], sum(sorted(s)[-3:]) / 3, s[k] / longest, math.log1p(len(words))]


def plain_logistic(x, y, ridge=1e-4):
    """Newton's method on the mean logistic loss, with the penalty on the weights of standardised features."""
    std = x.std(0, ddof=1)
    z = np.concatenate([np.ones((len(x), 1)), x / np.where(std > 0, std, 1)], 1)
    z[:, 1:][:, std == 0] = 0
    beta, pen = np.zeros(z.shape[1]), ridge * np.diag([0.0, *[1.0] * x.shape[1]])
    for _ in range(100):
        p = 1 / (1 + np.exp(-z @ beta))
        beta -= np.linalg.solve(z.T @ (z * (p * (1 - p))[:, None]) / len(x) + pen + 1e-12 * np.eye(len(beta)), z.T @ (p - y) / len(x) + pen @ beta)
    return lambda rows: 1 / (1 + np.exp(-(beta[0] + rows @ np.where(std > 0, beta[1:] / np.where(std > 0, std, 1), 0))))


def test_op10_by_a_plain_version(spark):
    rng = random.Random(5)
    good = "the house garden morning people walking river quiet letter window evening".split()
    bad = "idiot moron stupid vile idiots scum".split()
    docs, marks = [], []
    for i in range(400):
        toxic = rng.random() < 0.4
        words = rng.choices(good, k=rng.randint(3, 25)) + (rng.choices(bad, k=rng.randint(1, 2)) if toxic or rng.random() < 0.15 else [])
        rng.shuffle(words)
        docs.append((i, " ".join(w.capitalize() if rng.random() < 0.1 else w + rng.choice(["", "", ",", "!"]) for w in words)))
        if i % 10:
            marks.append((i, int(toxic)))
    docs += [(1000, ""), (1001, None), (1002, "idiotic riverside scummy zzz"), (1003, "...")]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    labels = spark.createDataFrame(marks, "doc_id long, toxic int")
    drawn = labelled.training_labels(labels, "toxic", 4, 2, 100_000).collect()
    evidence = lru_cache(None)(plain_evidence(docs, {r.doc_id: r.label for r in drawn if r.part > 0}))
    features = {i: plain_features(t, evidence) for i, t in docs}
    fit = [(features[r.doc_id], r.label) for r in drawn if r.part == 0]
    predict = plain_logistic(np.array([f for f, _ in fit]), np.array([y for _, y in fit], float))
    got = toxicity.score(frame, labels, "toxic", folds=4, fold=2, threshold=0.3).collect()
    assert len(got) == len(docs)
    for r in got:
        want = float(predict(np.array([features[r.doc_id]]))[0])
        assert r.score == pytest.approx(want, abs=2e-3), (r, want)
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and r.predicted == int(r.score >= 0.3)


def test_statistics_by_a_plain_version():
    for text in (None, "", "a", "A b!! a b|b 12 é\n\n x.y,z {}[]\\ ~", "é" * 50, "| |  |\t|"):
        assert quality.statistics(text) == pytest.approx(plain_statistics(text))
