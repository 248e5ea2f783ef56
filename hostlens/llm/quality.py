"""Quality classifier: ridge regression on random Fourier features of document statistics, calibrated.

Statistics of a text (lengths, shares of kinds of characters, repetition) are standardised over all
documents. cos(w.x + b) with normal w and uniform b approximates a Gaussian kernel; tasks sum the normal
equations of their labelled rows, and the small system is solved once. Isotonic regression on labelled
rows that the ridge fit hasn't seen turns its values into probabilities.

Nulls and odd cases: a null text counts as empty; rows that share a doc_id are scored one by one; without
labels of both kinds every score is the share of label 1 (0.5 if there are none); with so few labels that
the quarter for calibration is empty, that share holds apart from the last thousandth; an empty table gives
an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hostlens.llm.common import chunks, text_bytes
from hostlens.llm.labelled import held_out, training_labels
from hostlens.session import materialize

STATS = ("log_words", "log_bytes", "word_length", "upper", "punctuation", "symbols", "exclaims", "bars", "digits", "non_ascii",
         "distinct_words", "repeated_next", "lines", "stops", "commas", "distinct_bytes")


def _mask(chars: bytes) -> np.ndarray:
    m = np.zeros(256)
    m[list(chars)] = 1
    return m


_LETTERS, _UPPER = _mask(bytes([*range(65, 91), *range(97, 123), *range(128, 256)])), _mask(bytes(range(65, 91)))
_PUNCT = _mask(bytes(i for i in range(33, 127) if not chr(i).isalnum()))
_KINDS = np.stack([_LETTERS, _UPPER, _PUNCT, _mask(b"#$%&*@^~+=<>{}[]\\"), _mask(b"!"), _mask(b"|"), _mask(b"0123456789"),
                   _mask(bytes(range(128, 256))), _mask(b"\n"), _mask(b"."), _mask(b",")])


def statistics(text: str | None) -> list[float]:
    data = text_bytes(text)
    words = data.split()
    n, size = max(1, len(words)), max(1, len(data))
    held = np.bincount(np.frombuffer(data, np.uint8), minlength=256)
    letters, upper, punct, symbols, exclaims, bars, digits, high, lines, stops, commas = (_KINDS @ held).tolist()
    return [np.log1p(len(words)), np.log1p(len(data)), sum(map(len, words)) / n, upper / max(1.0, letters), punct / size, symbols / n,
            exclaims / n, bars / n, digits / size, high / size, len(set(words)) / n ** 0.9, sum(map(eq, words, words[1:])) / n,
            lines / n, stops / n, commas / n, np.log1p(int((held > 0).sum()))]


def _stats(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in chunks(batches):
        s = np.array([statistics(t) for t in b["text"].to_pylist()], float).reshape(-1, len(STATS))
        rest = {n: b[n] for n in b.schema.names if n != "text"}
        yield pa.RecordBatch.from_pydict(rest | {n: s[:, i] for i, n in enumerate(STATS)})


@dataclass
class Model:
    mean: np.ndarray
    std: np.ndarray
    w: np.ndarray
    b: np.ndarray
    beta: np.ndarray
    knots: np.ndarray
    values: np.ndarray

    def features(self, stats: np.ndarray) -> np.ndarray:
        x = np.clip((stats - self.mean) / self.std, -6, 6)
        return np.concatenate([np.ones((len(x), 1)), x, np.cos(x @ self.w + self.b)], 1)

    def raw(self, stats: np.ndarray) -> np.ndarray:
        return self.features(stats) @ self.beta

    def score(self, stats: np.ndarray) -> np.ndarray:
        """The calibrated value, with a last thousandth for the order within a flat step."""
        raw = self.raw(stats)
        return np.clip(0.999 * np.interp(raw, self.knots, self.values) + 0.001 / (1 + np.exp(-4 * (raw - 0.5))), 0, 1)


def isotonic(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Knots and values of the non-decreasing least-squares fit (pool adjacent violators); x ascends."""
    pools: list[list[float]] = []
    for a, v, w in zip(x.tolist(), y.tolist(), weight.tolist(), strict=True):
        pools.append([v, w, a, a])
        while len(pools) > 1 and pools[-2][0] >= pools[-1][0]:
            v2, w2, _, end = pools.pop()
            v1, w1, start, _ = pools[-1]
            pools[-1] = [(v1 * w1 + v2 * w2) / (w1 + w2), w1 + w2, start, end]
    return np.array([k for p in pools for k in p[2:]]), np.array([v for p in pools for v in (p[0], p[0])])


def _normal_equations(model: Model, at: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size = len(STATS) + len(model.b) + 1
        total = np.zeros((size, size + 1))
        for b in batches:
            for i in range(0, b.num_rows, 4096):
                part = b.slice(i, 4096)
                f = model.features(np.stack([part[n].to_numpy() for n in STATS], 1))
                total[:, :-1] += f.T @ f
                total[:, -1] += f.T @ part[at].to_numpy()
        yield pa.RecordBatch.from_pydict({"sums": [total.tobytes()]})

    return run


def _apply(model: Model, what: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = getattr(model, what)(np.stack([b[n].to_numpy() for n in STATS], 1))
            yield pa.RecordBatch.from_pydict({n: b[n] for n in b.schema.names if n not in STATS} | {what: x})

    return run


def fit(stats: DataFrame, labels: DataFrame, name: str, folds: int, fold: int, features: int = 256, ridge: float = 3.0,
        most: int = 200_000, seed: int = 3) -> Model:
    """Learns from ``most`` labelled rows at most; eight matrices of fixed size reach the driver."""
    row = stats.agg(*(f(n).alias(f"{k}_{n}") for n in STATS for k, f in (("m", F.avg), ("s", F.stddev_pop)))).first()
    mean, std = (np.array([row[f"{k}_{n}"] or 0.0 for n in STATS]) for k in "ms")
    rng = np.random.default_rng(seed)
    model = Model(mean, np.where(std > 1e-9, std, 1.0), rng.normal(size=(len(STATS), features)) / len(STATS) ** 0.5, rng.uniform(0, 2 * np.pi, features),
                  np.zeros(0), np.array([0.0]), np.array([0.5]))
    train = materialize(stats.join(training_labels(labels, name, folds, fold, most), "doc_id").select("label", "part", *STATS), "quality-train")
    counts = dict(train.groupBy("label").count().collect())
    model.beta = np.zeros(len(STATS) + features + 1)
    if len(counts) < 2:
        model.values = np.array([counts.get(1, 0) / sum(counts.values()) if counts else 0.5])
        return model
    sums = train.where("part > 0").repartition(8).mapInArrow(_normal_equations(model, "label"), "sums binary").collect()
    size = len(model.beta)
    total = sum(np.frombuffer(r.sums).reshape(size, size + 1) for r in sums)
    model.beta = np.linalg.solve(total[:, :-1] + ridge * np.diag([1e-6, *[1.0] * (size - 1)]), total[:, -1])
    cells = (train.where("part = 0").mapInArrow(_apply(model, "raw"), "label int, part int, raw double").groupBy(F.round(F.col("raw").cast("double") * 500).alias("cell"))
             .agg(F.avg("label").alias("y"), F.count("*").alias("n")).where("abs(cell) < 5000").orderBy("cell").toPandas())
    # a little of the overall share in every cell, so that no score claims certainty from a few rows
    base = counts[1] / sum(counts.values())
    if not len(cells):  # a few labels, all of other parts
        model.values = np.array([base])
        return model
    knots, values = isotonic(cells["cell"].to_numpy(float) / 500, ((cells["y"] * cells["n"] + 0.1 * base) / (cells["n"] + 0.1)).to_numpy(float), cells["n"].to_numpy(float) + 0.1)
    model.knots, model.values = knots, values
    return model


def _accepted(model: Model, threshold: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in chunks(batches):
            x = np.array([statistics(t) for t in b["text"].to_pylist()], float).reshape(-1, len(STATS))
            yield b.filter(pa.array(model.score(x) >= threshold))

    return run


def accepted(docs: DataFrame, labels: DataFrame, name: str = "quality", folds: int = 5, fold: int = 0, threshold: float = 0.3,
             features: int = 256, most: int = 200_000) -> DataFrame:
    """The documents that score() gives at least ``threshold``, unchanged and where they are."""
    stats = materialize(docs.select("doc_id", "text").mapInArrow(_stats, "doc_id long" + "".join(f", {n} double" for n in STATS)), "quality-stats")
    return docs.mapInArrow(_accepted(fit(stats, labels, name, folds, fold, features, most=most), threshold), docs.schema)


def score(docs: DataFrame, labels: DataFrame, name: str = "quality", folds: int = 5, fold: int = 0, threshold: float = 0.3,
          carry: tuple[str, ...] = (), features: int = 256, most: int = 200_000) -> DataFrame:
    """doc_id, held_out, score, predicted and the ``carry`` columns for every row."""
    named = [F.col(c).alias(f"_{c}") for c in carry]
    out = ", ".join(f"{n} {t}" for n, t in docs.select("doc_id", *named).dtypes)
    stats = docs.select("doc_id", *named, "text").mapInArrow(_stats, out + "".join(f", {n} double" for n in STATS))
    stats = materialize(stats, "quality-stats")
    model = fit(stats, labels, name, folds, fold, features, most=most)
    scored = stats.mapInArrow(_apply(model, "score"), out + ", score double")
    decided: Column = F.when(F.col("score") >= threshold, 1).otherwise(0)
    return scored.select("doc_id", held_out("doc_id", folds, fold).alias("held_out"), "score", decided.cast("int").alias("predicted"), *[F.col(f"_{c}").alias(c) for c in carry])
