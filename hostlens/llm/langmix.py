"""Language identification by mixture inference.

Training counts the byte trigrams of the words of all documents whose language may be learnt; a language's
probability of a byte after two others backs off to shorter contexts (Witten-Bell). A document's words are then
taken as drawn from a mixture of languages: expectation-maximisation estimates the proportions from the words'
likelihoods under each language. The languages are ranked by proportion, and of the first m the number m is
chosen that maximises the log-likelihood less ``penalty * (m - 1) * log(words + 1)``; languages that explain less
than one word are left out before. The prediction is the language of the largest proportion, which is the score.

Words are runs of letters in lower case, within tokens of ASCII letters and anything beyond ASCII; a word counts
against a language by ``FLOOR`` at most. Everything is done in fixed numbers of iterations, so a result doesn't
depend on the documents around it but for the last digits; scores are rounded to 6 places.

The model has three tables of 65536 contexts by language and the trigram counts. With up to ``entries`` cells
(trigrams times languages) the counts are broadcast; a larger table is joined to the trigrams of stored blocks of
documents, with the same results. No trigram is dropped.

Nulls and odd cases: a null text, or one without a letter, is ``und`` with score 0, as is everything if no
language can be learnt; a null lang or doc_id teaches nothing, and a row without doc_id counts as held out; rows
that repeat have a result each; an empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hostlens.llm.bytewords import byte_kinds, byte_rows, split_words
from hostlens.llm.common import chunks
from hostlens.llm.labelled import held_out
from hostlens.session import materialize

KINDS = byte_kinds(blank=bytes(b for b in range(128) if not chr(b).isalpha()), cut=b"")
RUN = re.compile(r"[^\W\d_]+")
FLOOR, ROUNDS, ENTRIES = 30.0, 15, 1 << 22


def letter_runs(token: bytes) -> list[str]:
    low = token.decode("utf-8", "replace").lower()
    return [low] if low.isalpha() else [r for r in RUN.findall(low) if any(c.isalpha() for c in r)]


def trigrams(tokens: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Code and token of every byte trigram of the tokens' words; two marks stand before a word and one after it."""
    parts = ["".join("\x01\x01" + r for r in letter_runs(t)) for t in tokens]
    parts = [p.encode("utf-8", "surrogatepass") for p in parts]
    data = np.frombuffer(b"".join(parts) + b"\x01\x01", np.uint8).astype(np.int64)
    of = np.append(np.repeat(np.arange(len(parts)), [len(p) for p in parts]), [len(parts)] * 2)
    code = (data[:-2] << 16) | (data[1:-1] << 8) | data[2:]
    # from the first mark of a word to the last two bytes before the next one's; not (byte, mark, mark)
    use = ~((data[1:-1] == 1) & (data[2:] == 1))
    return code[use], of[:-2][use]


class Model(NamedTuple):
    langs: list[str]
    low: np.ndarray  # probability of a byte after one other, by both
    kinds: np.ndarray  # different bytes after two others
    seen: np.ndarray  # occurrences of two bytes before another
    grams: np.ndarray  # codes, ascending
    counts: np.ndarray  # by code and language

    def logs(self, codes: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """Log-probability of a trigram's last byte in each language."""
        context = codes >> 8
        kinds, seen, low = (x[at].astype(np.float64) for x, at in ((self.kinds, context), (self.seen, context), (self.low, codes & 0xFFFF)))
        return np.log(np.where(seen > 0, (counts + kinds * low) / np.maximum(seen + kinds, 1), low))

    def counts_of(self, codes: np.ndarray) -> np.ndarray:
        if not len(self.grams):
            return np.zeros((len(codes), len(self.langs)))
        at = np.minimum(np.searchsorted(self.grams, codes), len(self.grams) - 1)
        return np.where((self.grams[at] == codes)[:, None], self.counts[at], 0).astype(np.float64)


def _lower_tables(contexts: pa.Table, pairs: pa.Table, langs: int) -> list[np.ndarray]:
    """Of two bytes and a language: probability of the second after the first, different bytes after both, occurrences."""

    def dense(t: pa.Table, column: str) -> np.ndarray:
        out = np.zeros((1 << 16, langs))
        out[t["at"].to_numpy(), t["lang"].to_numpy()] = t[column].to_numpy()
        return out

    seen, kinds, pair = dense(contexts, "n"), dense(contexts, "kinds"), dense(pairs, "n")
    square = pair.reshape(256, 256, langs)
    single = square.sum(0)
    one = (single + 1) / (single.sum(0) + 256)
    after, different = square.sum(1, keepdims=True), (square > 0).sum(1, keepdims=True)
    low = np.where(after > 0, (square + different * one[None]) / np.maximum(after + different, 1), one[None])
    return [low.reshape(1 << 16, langs).astype(np.float32), kinds.astype(np.float32), seen.astype(np.float32)]


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """lang, gram, n: a task's trigrams."""
    held: dict[str, list] = {}

    def summed(parts: list) -> tuple[np.ndarray, np.ndarray]:
        code, at = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
        return code, np.bincount(at, np.concatenate([p[1] for p in parts]), len(code)).astype(np.int64)

    for b in chunks(batches):
        of, texts = b["lang"].to_pylist(), byte_rows(b["text"])
        for lang in dict.fromkeys(of):
            found = split_words([t for t, x in zip(texts, of, strict=True) if x == lang], KINDS)
            times = np.bincount(found.ids, minlength=len(found.words))
            code, token = trigrams(found.words.to_pylist())
            parts = held.setdefault(lang, [])
            parts.append(summed([(code, times[token])]))
            if len(parts) > 8:
                held[lang] = [summed(parts)]
    for lang, parts in held.items():
        code, n = summed(parts)
        yield pa.RecordBatch.from_pydict({"lang": [lang] * len(code), "gram": code, "n": n})


def _mixture(p: np.ndarray, n: np.ndarray, head: np.ndarray, size: np.ndarray, allowed: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Proportions by document and language, and the log-likelihood (of the words' likelihoods over their largest).

    ``p`` has the words of one document after the other, ``head`` where each begins, ``size`` how many it has,
    ``n`` their occurrences, ``allowed`` a document's languages.
    """
    words = np.add.reduceat(n, head)
    share = allowed / allowed.sum(1, keepdims=True)
    for _ in range(ROUNDS):
        joint = p * np.repeat(share, size, 0)
        joint *= (n / joint.sum(1))[:, None]
        share = np.add.reduceat(joint, head, 0) / words[:, None]
    return share, np.add.reduceat(n * np.log((p * np.repeat(share, size, 0)).sum(1)), head)


def mixtures(logs: np.ndarray, n: np.ndarray, head: np.ndarray, penalty: float) -> np.ndarray:
    """Proportions of the chosen languages by document; of the others 0. ``logs``: of words, by language."""
    p = np.exp(np.maximum(logs - logs.max(1, keepdims=True), -FLOOR))
    size, n = np.diff(np.append(head, len(p))), n.astype(np.float64)
    words, langs = np.add.reduceat(n, head), p.shape[1]
    share, _ = _mixture(p, n, head, size, np.ones((len(head), langs)))
    place = np.argsort(np.argsort(-share, axis=1, kind="stable"), axis=1, kind="stable")
    most = np.maximum(1, (share * words[:, None] >= 1).sum(1))
    chosen = (place == 0).astype(np.float64)
    best = np.add.reduceat(n * np.log((p * np.repeat(chosen, size, 0)).sum(1)), head)
    for m in range(2, int(most.max()) + 1):
        docs = np.flatnonzero(most >= m)
        rows = np.flatnonzero(np.repeat(most >= m, size))
        own = size[docs]
        got, fit = _mixture(p[rows], n[rows], np.cumsum(own) - own, own, (place[docs] < m).astype(np.float64))
        fit -= penalty * (m - 1) * np.log(words[docs] + 1)
        better = docs[fit > best[docs]]
        chosen[better], best[better] = got[fit > best[docs]], fit[fit > best[docs]]
    return chosen


PREDICTED = "doc_id long, held_out boolean, lang_pred string, score double, langs string"
_SCHEMA = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("lang_pred", pa.string()), ("score", pa.float64()), ("langs", pa.string())])


def _predict(b: pa.RecordBatch, model: Model, counts_of, penalty: float) -> pa.RecordBatch:
    texts = byte_rows(b["text"])
    found = split_words(texts, KINDS)
    ends = np.cumsum([len(t) + 1 for t in texts])
    doc = np.searchsorted(ends, found.start, side="right")
    tokens = found.words.to_pylist()
    code, token = trigrams(tokens)
    pred, score, langs = ["und"] * len(texts), [0.0] * len(texts), [""] * len(texts)
    if len(code) and model.langs:
        used, at = np.unique(code, return_inverse=True)
        table = model.logs(used, counts_of(used))
        logs = np.stack([np.bincount(token, table[at, k], len(tokens)) for k in range(len(model.langs))], 1)
        lettered = np.bincount(token, minlength=len(tokens)) > 0
        key, n = np.unique((doc * len(tokens) + found.ids)[lettered[found.ids]], return_counts=True)
        of = key // len(tokens)
        head = np.flatnonzero(np.diff(of, prepend=-1))
        share = mixtures(logs[key % len(tokens)], n, head, penalty)
        for i, x in zip(of[head].tolist(), share, strict=True):
            order = [k for k in np.argsort(-x, kind="stable").tolist() if x[k] > 0]
            pred[i], score[i] = model.langs[order[0]], round(min(1.0, float(x[order[0]])), 6)
            langs[i] = " ".join(f"{model.langs[k]}:{x[k]:.3f}" for k in order)
    return pa.RecordBatch.from_arrays([b["doc_id"], b["held_out"], *(pa.array(v, f.type) for v, f in zip((pred, score, langs), list(_SCHEMA)[2:], strict=True))], schema=_SCHEMA)


def _with_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for i, b in enumerate(chunks(batches)):
        yield b.append_column("block", pa.array([f"{TaskContext.get().partitionId()}-{i}"] * b.num_rows, pa.string()))


def _grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in chunks(batches):
        of, texts = b["block"].to_pylist(), byte_rows(b["text"])
        for block in dict.fromkeys(of):
            code = np.unique(trigrams(split_words([t for t, x in zip(texts, of, strict=True) if x == block], KINDS).words.to_pylist())[0])
            yield pa.RecordBatch.from_pydict({"block": [block] * len(code), "gram": code})


def predict(docs: DataFrame, folds: int = 5, fold: int = 0, penalty: float = 1.0, entries: int = ENTRIES) -> DataFrame:
    """doc_id, held_out, lang_pred, score, and the chosen languages with their proportions, of every row."""
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.col("lang").cast("string").alias("lang"))
    marked = docs.withColumn("held_out", held_out("doc_id", folds, fold))
    taught = marked.where(~F.col("held_out") & F.col("lang").isNotNull()).select("lang", "text")
    counts = materialize(taught.mapInArrow(_count, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n")), "langmix-counts")
    langs = sorted(r[0] for r in counts.select("lang").distinct().collect())
    number = spark.createDataFrame(list(enumerate(langs)), "number int, lang string")
    counts = counts.join(F.broadcast(number), "lang").select(F.col("number").alias("lang"), "gram", "n")
    contexts = counts.groupBy("lang", F.shiftright("gram", 8).alias("at")).agg(F.sum("n").alias("n"), F.count("*").alias("kinds")).toArrow()
    pairs = counts.groupBy("lang", F.col("gram").bitwiseAND(F.lit(0xFFFF).cast("long")).alias("at")).agg(F.sum("n").alias("n")).toArrow()
    model = Model(langs, *_lower_tables(contexts, pairs, len(langs)), np.zeros(0, np.int64), np.zeros((0, len(langs)), np.float32))
    rows = marked.select("doc_id", "held_out", "text")
    if counts.select("gram").distinct().count() * len(langs) <= entries:
        known = counts.toArrow()
        grams, at = np.unique(known["gram"].to_numpy(), return_inverse=True)
        table = np.zeros((len(grams), len(langs)), np.float32)
        table[at, known["lang"].to_numpy()] = known["n"].to_numpy()
        sent = spark.sparkContext.broadcast(model._replace(grams=grams, counts=table))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in chunks(batches):
                yield _predict(b, sent.value, sent.value.counts_of, penalty)

        return rows.mapInArrow(run, PREDICTED)
    sent = spark.sparkContext.broadcast(model)
    stored = materialize(rows.mapInArrow(_with_blocks, "doc_id long, held_out boolean, text string, block string"), "langmix-blocks")
    needed = stored.select("block", "text").mapInArrow(_grams, "block string, gram long").distinct().join(counts, "gram")

    def meet(own: pa.Table, known: pa.Table) -> pa.Table:
        grams, at = np.unique(known["gram"].to_numpy(), return_inverse=True)
        table = np.zeros((len(grams), len(langs)))
        table[at, known["lang"].to_numpy()] = known["n"].to_numpy()
        here = sent.value._replace(grams=grams, counts=table)
        return pa.Table.from_batches([_predict(b, here, here.counts_of, penalty) for b in own.combine_chunks().to_batches()], _SCHEMA)

    return stored.groupBy("block").cogroup(needed.groupBy("block")).applyInArrow(meet, PREDICTED)
