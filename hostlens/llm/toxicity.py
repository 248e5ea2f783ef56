"""Toxicity by class-conditional Kneser-Ney models over the characters of words.

A model gives each character of a word a probability after the four before it. Both classes have their
own counts of five characters (from labelled rows); what they don't know they take from one shared
Kneser-Ney model of four characters and fewer, whose continuation counts come from all documents. Unseen
endings of a known stem are rated by the stem alone. A word's evidence is the difference of its two
log-likelihoods; a document is compared by the means over all its characters and over its most toxic
words, each by length, and logistic regression on labelled rows that the counts haven't seen makes a
probability of them.

A character from U+07C0 on is two symbols of the model, so that no two characters are taken for one.

The model keeps every gram of the labelled rows. It is broadcast up to a bound; a larger one stays a stored
table, and blocks of documents fetch the part of it that their words ask for. Both give the same features.

Nulls and odd cases: a null or empty text has no evidence either way; rows that share a doc_id are scored
one by one; without labels of both kinds every score is the share of label 1 (0 if there are none); an
empty table gives an empty result.
"""

from __future__ import annotations

import string
import uuid
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hostlens.llm.common import CHUNK_BYTES, chunks
from hostlens.llm.labelled import held_out, training_labels
from hostlens.session import materialize

ORDER, BITS, DISCOUNT, START, END = 5, 12, 0.75, "\x01", "\x02"
#: Code points below are one symbol. 1088 upper parts and 1024 lower ones of all others make 4096 symbols in all.
PAIRED = 1984
EDGES = string.punctuation + "…“”„«»‘’¿¡–—"
#: Distinct words that a task holds before it passes its counts on, and that a scoring worker remembers.
HELD, REMEMBERED = 200_000, 500_000
#: Bytes of text of a block of documents that fetches its part of a large model.
BLOCK_BYTES = 16 << 20
FEATURES = ("overall", "peak", "peak_mean", "peak_long", "log_words")


def symbols(points: np.ndarray) -> np.ndarray:
    """Code points as numbers below 2**BITS, each text as one sequence of its own: a point from PAIRED on is two
    symbols, its upper bits and its lower ten, of ranges of their own."""
    pair = points >= PAIRED
    if not pair.any():
        return points
    out = np.repeat(points, 1 + pair)
    first = (np.cumsum(1 + pair) - 2)[pair]
    out[first], out[first + 1] = PAIRED + (points[pair] >> 10), PAIRED + 1088 + (points[pair] & 1023)
    return out


def five_grams(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Packed characters, the last one being predicted, and the number of the word each belongs to."""
    text = symbols(np.frombuffer("".join(START * (ORDER - 1) + w + END for w in words).encode("utf-32-le", "surrogatepass"), "<u4").astype(np.int64))
    at = np.flatnonzero(text != 1)
    key = np.zeros(len(at), np.int64)
    for k in range(ORDER):
        key = (key << BITS) | text[at - (ORDER - 1) + k]
    ends = np.cumsum(text[at] == 2)
    return key, ends - (text[at] == 2)


def bare(word: str) -> str:
    return word.lower().replace(START, "").replace(END, "").strip(EDGES)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held = {None: Counter(), 0: Counter(), 1: Counter()}  # by label

    def flush() -> pa.RecordBatch:
        by: dict[str, list[int]] = {}
        for i, label in enumerate((None, 0, 1)):
            for w, n in held[label].items():
                x = by.setdefault(bare(w), [0, 0, 0])
                x[0] += n
                x[i] += n if i else 0
            held[label].clear()
        by.pop("", None)
        key, of = five_grams(list(by))
        n = np.array(list(by.values()), float).reshape(-1, 3)[of]
        keys, at = np.unique(key, return_inverse=True)
        return pa.RecordBatch.from_pydict({"key": keys} | {c: np.bincount(at, n[:, i], len(keys)).astype(np.int64) for i, c in enumerate(("n", "ordinary", "toxic"))})

    for b in chunks(batches):
        for text, label in zip(b["text"].to_pylist(), b["label"].to_pylist(), strict=True):
            held[label].update((text or "").split())
        if sum(map(len, held.values())) > HELD:
            yield flush()
    if any(held.values()):
        yield flush()


def gram_counts(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """key, n, ordinary, toxic: five-character counts over all documents and over the labelled ones.

    ``labels`` is the bounded sample; each task sends a row per distinct key.
    """
    tagged = docs.select(F.col("doc_id").cast("long"), "text").join(F.broadcast(labels.select("doc_id", "label")), "doc_id", "left")
    rows = tagged.select("text", "label").mapInArrow(_count, "key long, n long, ordinary long, toxic long")
    return rows.groupBy("key").agg(*(F.sum(c).alias(c) for c in ("n", "ordinary", "toxic")))


def shared_backoff(counts: DataFrame) -> DataFrame:
    """tail, shared: the Kneser-Ney probability of each four characters' last one, from distinct continuations."""
    below, n, p = [], counts.select(F.col("key").alias("k")), None
    for order in range(ORDER - 1, 0, -1):  # how many different characters come before each tail
        n = n.groupBy(F.col("k").bitwiseAND((1 << BITS * order) - 1).alias("k")).agg(F.count("*").alias("n"))
        n = materialize(n, f"toxicity-{order}")
        below.append(n)
        n = n.select("k")
    for order, n in enumerate(reversed(below), 1):
        n = n.withColumn("h", F.shiftright("k", BITS))
        per = n.groupBy("h").agg(F.sum("n").alias("total"), F.count("*").alias("types"))
        n = n.join(per, "h")
        if order == 1:
            p = n.select("k", (0.999 * F.col("n") / F.col("total") + 0.001 / (1 << BITS)).alias("p"))
            continue
        lower = p.select(F.col("k").alias("tail"), F.col("p").alias("q"))
        n = n.withColumn("tail", F.col("k").bitwiseAND((1 << BITS * (order - 1)) - 1)).join(lower, "tail")
        p = n.select("k", ((F.col("n") - DISCOUNT + DISCOUNT * F.col("types") * F.col("q")) / F.col("total")).alias("p"))
    return p.select(F.col("k").alias("tail"), F.col("p").alias("shared"))


def evidence(counts: DataFrame) -> DataFrame:
    """key, h (its start), llr of the labelled rows' five characters, and other: the llr of h's unseen endings.

    llr: log-probability of the last character in the toxic model less that in the ordinary one.
    """
    seen = counts.where("ordinary + toxic > 0").withColumn("h", F.shiftright("key", BITS)).withColumn("tail", F.col("key").bitwiseAND((1 << BITS * (ORDER - 1)) - 1))
    per = seen.groupBy("h").agg(*(f(c).alias(f"{k}_{c}") for c in ("toxic", "ordinary") for k, f in (("sum", F.sum), ("types", lambda c: F.count(F.when(F.col(c) > 0, 1))))))

    def weight(c):
        return F.when(F.col(f"sum_{c}") > 0, DISCOUNT * F.col(f"types_{c}") / F.col(f"sum_{c}")).otherwise(F.lit(1.0))

    def own(c):
        return F.when(F.col(f"sum_{c}") > 0, F.greatest(F.col(c) - DISCOUNT, F.lit(0.0)) / F.col(f"sum_{c}")).otherwise(F.lit(0.0))

    both = seen.join(per, "h").join(shared_backoff(counts), "tail")
    p = {c: own(c) + weight(c) * F.col("shared") for c in ("toxic", "ordinary")}
    other = F.log(weight("toxic") / weight("ordinary"))
    return both.select("key", "h", F.log(p["toxic"] / p["ordinary"]).cast("float").alias("llr"), other.cast("float").alias("other"))


def sorted_tables(grams: pa.Table) -> tuple[np.ndarray, ...]:
    """key, llr, h and llr of h's unseen endings, sorted for WordEvidence."""
    grams = grams.sort_by("key")
    key, llr, other = (grams[c].to_numpy() for c in ("key", "llr", "other"))
    starts, at = np.unique(key >> BITS, return_index=True)
    return key, llr, starts, other[at]


class WordEvidence:
    """Evidence of words from the sorted tables of a model; one per worker and model."""

    _kept: dict[str, WordEvidence] = {}

    def __init__(self, tables: tuple[np.ndarray, ...]):
        self.keys, self.llr, self.starts, self.start_llr = tables
        self.known: dict[str, float] = {}

    @classmethod
    def of(cls, name: str, tables) -> WordEvidence:
        if name not in cls._kept:
            cls._kept.clear()
            cls._kept[name] = cls(tables.value)
        return cls._kept[name]

    @staticmethod
    def _find(table: np.ndarray, values: np.ndarray, x: np.ndarray, default) -> np.ndarray:
        if not len(table):
            return np.zeros(len(x)) + default
        at = np.minimum(np.searchsorted(table, x), len(table) - 1)
        return np.where(table[at] == x, values[at], default)

    def of_words(self, words: list[str]) -> np.ndarray:
        key, of = five_grams(words)
        llr = self._find(self.keys, self.llr, key, self._find(self.starts, self.start_llr, key >> BITS, 0.0))
        return np.bincount(of, llr, len(words))

    def features(self, text: str | None) -> tuple[float, ...]:
        """FEATURES of a text; every word of it counts."""
        words = (text or "").split()
        if not words:
            return (0.0,) * len(FEATURES)
        s = np.fromiter(map(self.known.__getitem__, words), float, len(words))
        top = np.partition(s, -min(3, len(s)))[-min(3, len(s)) :]
        k = int(s.argmax())
        return s.sum() / (len(words) + sum(map(len, words))), s[k], top.sum() / 3, s[k] / (1 + len(words[k])), np.log1p(len(words))

    def learn(self, texts: list[str | None]) -> None:
        """Looks up the words of some texts together."""
        new: set[str] = set()
        for t in texts:
            new.update((t or "").split())
        if len(self.known) > REMEMBERED:
            self.known.clear()
        words = list(new.difference(self.known))
        self.known.update(zip(words, self.of_words([bare(w) for w in words]).tolist(), strict=True))


FEATURE_ROWS = "doc_id long" + "".join(f", {n} double" for n in FEATURES)


def _rated(model: WordEvidence, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in chunks(batches):
        texts = b["text"].to_pylist()
        model.learn(texts)
        f = np.array([model.features(t) for t in texts], float).reshape(-1, len(FEATURES))
        yield pa.RecordBatch.from_pydict({"doc_id": b["doc_id"]} | {n: f[:, i] for i, n in enumerate(FEATURES)})


def _features(name: str, tables):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _rated(WordEvidence.of(name, tables), batches)

    return run


def _blocks(limit: int):
    """Numbers the rows' blocks of about ``limit`` bytes; the number is unique to a task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, size = TaskContext.get().partitionId() << 33, 0
        for b in chunks(batches, min(limit, CHUNK_BYTES)):
            if size and size + b.nbytes > limit:
                block, size = block + 1, 0
            size += b.nbytes
            yield pa.RecordBatch.from_pydict({"doc_id": b["doc_id"], "text": b["text"], "block": np.full(b.num_rows, block)})

    return run


def _wanted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The starts that the words of each block ask for."""
    for b in chunks(batches):
        words: dict[int, set[str]] = {}
        for block, text in zip(b["block"].to_pylist(), b["text"].to_pylist(), strict=True):
            words.setdefault(block, set()).update((text or "").split())
        for block, of in words.items():
            h = np.unique(five_grams([bare(w) for w in of])[0] >> BITS)
            yield pa.RecordBatch.from_pydict({"block": np.full(len(h), block), "h": h})


def _block_features(rows: pa.Table, grams: pa.Table) -> pa.Table:
    return pa.Table.from_batches(_rated(WordEvidence(sorted_tables(grams)), rows.to_batches()))


def features_by_blocks(docs: DataFrame, grams: DataFrame) -> DataFrame:
    """FEATURES of every row from a model of any size: a block holds the endings of its own words' starts only.

    A start is asked for once a block, however many documents hold it.
    """
    rows = materialize(docs.mapInArrow(_blocks(BLOCK_BYTES), "doc_id long, text string, block long"), "toxicity-blocks")
    wanted = rows.select("block", "text").mapInArrow(_wanted, "block long, h long").distinct()
    part = wanted.join(grams, "h").select("block", "key", "llr", "other")
    return rows.groupBy("block").cogroup(part.groupBy("block")).applyInArrow(_block_features, FEATURE_ROWS)


def model_tables(counts: DataFrame, entries: int) -> tuple[np.ndarray, ...] | DataFrame:
    """The whole model: as sorted tables if it has no more than ``entries`` grams, as the stored table of evidence() otherwise."""
    grams = materialize(evidence(counts), "toxicity-model")
    return grams if grams.count() > entries else sorted_tables(grams.select("key", "llr", "other").toArrow())


def score(docs: DataFrame, labels: DataFrame, name: str = "toxic", folds: int = 4, fold: int = 2, threshold: float = 0.3,
          most: int = 100_000, entries: int = 1 << 21) -> DataFrame:
    """doc_id, held_out, score, predicted for every row. ``most`` bounds the labelled rows, ``entries`` a broadcast of the model."""
    spark = docs.sparkSession
    train = materialize(training_labels(labels, name, folds, fold, most), "toxicity-labels")
    counts = materialize(gram_counts(docs, train.where("part > 0")), "toxicity-counts")
    model = model_tables(counts, entries)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    if isinstance(model, DataFrame):
        rows = features_by_blocks(rows, model)
    else:
        rows = rows.mapInArrow(_features(uuid.uuid4().hex, spark.sparkContext.broadcast(model)), FEATURE_ROWS)
    rows = materialize(VectorAssembler(inputCols=list(FEATURES), outputCol="x").transform(rows), "toxicity-features")
    fit = materialize(rows.select("doc_id", "x").join(train.where("part = 0"), "doc_id").select("x", "label"), "toxicity-fit")
    found = dict(fit.groupBy("label").count().collect())
    if len(found) < 2:
        scored = rows.withColumn("score", F.lit(found.get(1, 0) / max(1, sum(found.values()))))
    else:
        model = LogisticRegression(featuresCol="x", labelCol="label", regParam=1e-4, maxIter=60).fit(fit)
        scored = model.transform(rows).withColumn("score", vector_to_array("probability")[1])
    return scored.select("doc_id", held_out("doc_id", folds, fold).alias("held_out"), "score", F.when(F.col("score") >= threshold, 1).otherwise(0).cast("int").alias("predicted"))
