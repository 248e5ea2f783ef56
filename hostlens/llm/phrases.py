"""Collocations: phrases whose words occur together far more often than apart.

A suffix is a word with the words that follow it in its piece, as many as the longest phrase has. A chunk of
texts sends each distinct suffix once, with its number of occurrences, to the bucket of its leading word, so
that all suffixes that begin alike meet. A bucket sorts pointers to its suffixes by multikey three-way
quicksort as deep as the longest phrase: the size of the part equal to the pivot at a depth is the count of
the phrase up to there, and parts with fewer occurrences than a phrase needs are abandoned at once.

Leading words that hold more than 1 / (4 * partitions) of all suffixes are found in a counting pass; their
suffixes are dealt by the first two words, those of such a pair by all words, and the counts of such a word
or pair are summed over the buckets. At most 8 * partitions words and pairs can be hot.

Scores are exact: products are taken in decimals of 38 digits, which holds up to 10**15 occurrences.

Nulls and odd cases: a null text is empty, a null language is ``und``; rows that repeat count each; a language
without a phrase that is frequent enough has no row; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hostlens.llm.bytewords import Words, byte_kinds, byte_rows, split_words
from hostlens.llm.common import chunks, shuffle_parts
from hostlens.session import materialize

KINDS = byte_kinds(blank=b" \t", cut=b".,;:!?\n\x0b\x0c\r")
#: Suffixes that a bucket holds, and pointers below which a part is sorted at once.
BUCKET_SUFFIXES, SMALL_PART = 1_500_000, 512


def suffixes(found: Words, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct suffixes, a row of ``depth`` word numbers each (from 1; 0 after the end of the piece), and their counts."""
    n, base = len(found.ids), len(found.words) + 1
    rows = np.zeros((depth, n), np.int64)
    rows[0] = found.ids + 1
    for d in range(1, depth):
        rows[d, : n - d] = np.where(found.piece[d:] == found.piece[: n - d], rows[0, d:], 0)
    if base**depth < 2**63:
        key = rows[0]
        for d in range(1, depth):
            key = key * base + rows[d]
        key, count = np.unique(key, return_counts=True)
        out = np.empty((depth, len(key)), np.int64)
        for d in range(depth - 1, -1, -1):
            key, out[d] = np.divmod(key, base)
        return out, count
    rows = rows[:, np.lexsort(rows[::-1])]
    new = np.flatnonzero(np.concatenate([[True], (rows[:, 1:] != rows[:, :-1]).any(0)])[:n])
    return rows[:, new], np.diff(np.append(new, n))


def _by_language(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, Words]]:
    for b in chunks(batches):
        of, texts = b["lang"].to_pylist(), byte_rows(b["text"])
        for lang in dict.fromkeys(of):
            found = split_words([t for t, x in zip(texts, of, strict=True) if x == lang], KINDS)
            if len(found.ids):
                yield lang, found


def _frequent(depth: int, share: float):
    """Leading words and pairs with that share of a chunk's suffixes; the number of suffixes has no word."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lang, found in _by_language(batches):
            rows, _ = suffixes(found, depth)
            n = rows.shape[1]
            out = [(lang, None, None, n)]
            for d in (1, 2):
                head = np.flatnonzero(np.concatenate([[True], (rows[:d, 1:] != rows[:d, :-1]).any(0)]))
                size = np.diff(np.append(head, n))
                for i in np.flatnonzero(size >= share * n).tolist():
                    pair = [found.words[int(w) - 1].as_py().decode() if w else "" for w in rows[:d, head[i]]]
                    out.append((lang, pair[0], pair[1] if d == 2 else None, int(size[i])))
            yield pa.RecordBatch.from_pydict(dict(zip(("lang", "first", "second", "n"), map(list, zip(*out, strict=True)), strict=True)),
                                             pa.schema([("lang", pa.string()), ("first", pa.string()), ("second", pa.string()), ("n", pa.int64())]))

    return run


def _mixed(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    x = (a ^ (b + np.uint64(0x9E3779B97F4A7C15) + (a << np.uint64(6)) + (a >> np.uint64(2)))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(31))


def _send(depth: int, buckets: int, hot: dict):
    """bucket, lang and its suffixes: the words, each once, their numbers by depth, counts, and how many leading
    words were dealt by the next word too."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lang, found in _by_language(batches):
            rows, count = suffixes(found, depth)
            words = found.words.to_pylist()
            number = {w: i + 1 for i, w in enumerate(words)}
            number[b""] = 0
            mark = np.array([0, *(xxhash.xxh3_64_intdigest(w) for w in words)], np.uint64)
            route = _mixed(np.full(rows.shape[1], xxhash.xxh3_64_intdigest(lang), np.uint64), mark[rows[0]])
            spread = np.zeros(rows.shape[1], np.uint8)
            firsts, pairs = hot.get(lang, ((), ()))
            at = [number[w] for w in firsts if w in number]
            spread[np.isin(rows[0], at)] = 1
            base = len(words) + 1
            at = [number[a] * base + number[b] for a, b in pairs if a in number and b in number]
            spread[(spread == 1) & np.isin(rows[0] * base + rows[1], at)] = 2
            for d in range(1, depth):
                more = spread >= min(d, 2)
                route[more] = _mixed(route[more], mark[rows[d][more]])
            bucket = (route % np.uint64(buckets)).astype(np.int64)
            order = np.argsort(bucket, kind="stable")
            edges = np.append(np.flatnonzero(np.diff(bucket[order], prepend=-1)), len(order))
            out = {k: [] for k in ("bucket", "words", "numbers", "counts", "spread")}
            for a, b in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
                part = order[a:b]
                used, local = np.unique(rows[:, part], return_inverse=True)
                if used[0]:  # 0 stays the end of a piece
                    used, local = np.append(0, used), local + 1
                out["bucket"].append(int(bucket[part[0]]))
                out["words"].append(b"\n".join([words[i - 1] for i in used[1:].tolist()]))
                out["numbers"].append(local.astype("<u2" if len(used) < 1 << 16 else "<u4").tobytes())
                out["counts"].append(count[part].astype("<u4").tobytes())
                out["spread"].append(spread[part].tobytes())
            out["lang"] = [lang] * len(out["bucket"])
            schema = pa.schema([("bucket", pa.int64()), ("lang", pa.string()), *((k, pa.binary()) for k in ("words", "numbers", "counts", "spread"))])
            yield pa.RecordBatch.from_pydict(out, schema)

    return run


def _sorted_part(keys: np.ndarray, size: np.ndarray, part: np.ndarray, d: int, least: int):
    """What equal_parts() finds in a small part, whose keys are equal above depth ``d``."""
    part = part[np.lexsort(keys[d:, part][::-1])]
    mine = keys[:, part]
    new = np.zeros(len(part), bool)
    new[0] = True
    for e in range(d, len(keys)):
        new[1:] |= mine[e, 1:] != mine[e, :-1]
        head = np.flatnonzero(new)
        total = np.add.reduceat(size[part], head)
        ok = (total >= least) & (mine[e, head] > 0)
        if not ok.any():
            return
        yield e, part[head[ok]], total[ok]


def equal_parts(keys: np.ndarray, size: np.ndarray, least: int):
    """(depth, pointers, totals): a pointer into each part of suffixes that are equal down to a depth and whose
    sizes add up to ``least`` or more. Multikey three-way quicksort; smaller parts are not sorted further."""
    todo = [(np.arange(keys.shape[1]), 0)]
    while todo:
        part, d = todo.pop()
        if len(part) <= SMALL_PART:
            if len(part):
                yield from _sorted_part(keys, size, part, d, least)
            continue
        key = keys[d, part]
        pivot = np.sort(key[:: max(1, len(key) // 9)])[4]
        low, high = key < pivot, key > pivot
        same = part[~(low | high)]
        total = int(size[same].sum())
        if pivot > 0 and total >= least:
            yield d, same[:1], np.array([total])
            if d + 1 < len(keys):
                todo.append((same, d + 1))
        for side in (part[low], part[high]):
            if int(size[side].sum()) >= least:
                todo.append((side, d))


COUNTS = "lang string, size int, phrase string, n long"


def _count(depth: int, least: int):
    """Counts of a bucket's frequent phrases, its share of those dealt over buckets, and its words by language (size 0)."""

    def run(t: pa.Table) -> pa.Table:
        number: dict[bytes, int] = {b"": 0}
        langs: dict[str, int] = {}
        keys, sizes, spreads = [], [], []
        for row in t.select(["lang", "words", "numbers", "counts", "spread"]).to_batches():
            for r in row.to_pylist():
                here = np.array([0, *(number.setdefault(w, len(number)) for w in r["words"].split(b"\n"))], np.int32)
                n = len(r["counts"]) // 4
                local = np.frombuffer(r["numbers"], "<u2" if len(r["numbers"]) == 2 * depth * n else "<u4").reshape(depth, n)
                keys.append(np.concatenate([np.full((1, n), 1 + langs.setdefault(r["lang"], len(langs)), np.int32), here[local]]))
                sizes.append(np.frombuffer(r["counts"], "<u4").astype(np.int64))
                spreads.append(np.frombuffer(r["spread"], np.uint8))
        keys, size, spread = np.concatenate(keys, 1), np.concatenate(sizes), np.concatenate(spreads)
        words, names = [w.decode() for w in number], list(langs)
        out = [(names[i], 0, "", int(n)) for i, n in enumerate(np.bincount(keys[0] - 1, size, len(names))) if n]

        def told(pointers, d, totals):
            for p, n in zip(pointers.tolist(), totals.tolist(), strict=True):
                out.append((names[keys[0, p] - 1], d, " ".join(words[w] for w in keys[1 : d + 1, p]), int(n)))

        for d, pointers, totals in equal_parts(keys, size, least):
            whole = spread[pointers] < d if d < 3 else np.ones(len(pointers), bool)
            if d:
                told(pointers[whole], d, totals[whole])
        for d in (1, 2):
            part = np.flatnonzero((spread >= d) & (keys[d] > 0))
            part = part[np.lexsort(keys[: d + 1, part])]
            head = np.flatnonzero(np.concatenate([[True], (np.diff(keys[: d + 1, part]) != 0).any(0)])[: len(part)])
            if len(head):
                told(part[head], d, np.add.reduceat(size[part], head))
        return pa.table(dict(zip(("lang", "size", "phrase", "n"), map(list, zip(*out, strict=True)), strict=True)),
                        pa.schema([("lang", pa.string()), ("size", pa.int32()), ("phrase", pa.string()), ("n", pa.int64())]))

    return run


def phrase_counts(docs: DataFrame, depth: int = 3, least: int = 10) -> DataFrame:
    """lang, size, phrase, n of every phrase of up to ``depth`` (3 or more) words that occurs ``least`` times; size 0
    has the number of a language's words."""
    spark = docs.sparkSession
    rows = docs.select(F.coalesce(F.col("lang"), F.lit("und")).alias("lang"), "text")
    share = 1 / (8 * shuffle_parts(spark))
    seen = rows.mapInArrow(_frequent(depth, share), "lang string, first string, second string, n long").groupBy("lang", "first", "second").agg(F.sum("n").alias("n"))
    seen = materialize(seen, "phrases-leading")
    total = seen.where("first is null").agg(F.sum("n")).first()[0] or 0
    # a pair or word of twice the share is reported for more than a share; no more than 2 / share can be
    hot: dict[str, tuple[list, list]] = {}
    for r in seen.where(F.col("first").isNotNull() & (F.col("n") >= total * share)).toArrow().to_pylist():
        firsts, pairs = hot.setdefault(r["lang"], ([], []))
        if r["second"] is None:
            firsts.append(r["first"].encode())
        else:
            pairs.append((r["first"].encode(), r["second"].encode()))
    buckets = max(4 * shuffle_parts(spark), -(-total // BUCKET_SUFFIXES))
    sent = rows.mapInArrow(_send(depth, buckets, hot), "bucket long, lang string, words binary, numbers binary, counts binary, spread binary")
    met = sent.groupBy("bucket").applyInArrow(_count(depth, least), COUNTS)
    return met.groupBy("lang", "size", "phrase").agg(F.sum("n").alias("n")).where((F.col("size") == 0) | (F.col("n") >= least))


def collocations(docs: DataFrame, words: int = 3, least: int = 10, covered_percent: int = 50, top: int = 2000) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: the ``top`` phrases of each language by floor(10**6 * a * a / (l * r)).

    a is a phrase's count, l and r those of its parts at the cut that scores lowest, n the language's words. Phrases
    go that lie inside a longer one with ``covered_percent`` of their count or more.
    """
    counts = materialize(phrase_counts(docs, words, least), "phrases-counts")
    phrases = counts.where("size > 0")
    split = F.split("phrase", " ")
    long_ones = phrases.where("size > 1").select("lang", "phrase", "size", F.col("n").alias("a"), split.alias("w"))
    cuts = long_ones.withColumn("cut", F.explode(F.sequence(F.lit(1), F.col("size") - 1))).select(
        "lang", "phrase", "size", "a", "cut", F.array_join(F.slice("w", F.lit(1), F.col("cut")), " ").alias("left"),
        F.array_join(F.slice("w", F.col("cut") + 1, F.col("size") - F.col("cut")), " ").alias("right"))
    parts = phrases.where(F.col("size") < words)
    cuts = (cuts.join(parts.select("lang", F.col("phrase").alias("left"), F.col("n").alias("l")), ["lang", "left"])
            .join(parts.select("lang", F.col("phrase").alias("right"), F.col("n").alias("r")), ["lang", "right"]))
    score = F.expr("(cast(a as decimal(19,0)) * cast(a as decimal(19,0)) * cast(1000000 as decimal(7,0))) div (cast(l as decimal(19,0)) * cast(r as decimal(19,0)))")
    best = cuts.groupBy("lang", "phrase", "size", "a").agg(F.min(F.struct(score.alias("score"), "cut", "l", "r")).alias("x"))
    inside = F.expr("flatten(transform(sequence(2, size - 1), m -> transform(sequence(1, size - m + 1), s -> array_join(slice(w, s, m), ' '))))")
    covers = long_ones.where("size > 2").select("lang", F.explode(inside).alias("phrase"), "a").groupBy("lang", "phrase").agg(F.max("a").alias("longest"))
    kept = best.join(covers, ["lang", "phrase"], "left").where(F.col("longest").isNull() | (F.col("longest") * 100 < F.col("a") * covered_percent))
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = kept.select("lang", "phrase", "a", "x.l", "x.r", "x.score").withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    total = counts.where("size = 0").select("lang", "n")
    return ranked.join(total, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
