"""Removal of repeated windows against brute force."""

import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from hostlens.llm import queries, substring

SF = "/root/testdata/sf0.001"


def brute(docs, window):
    """docs: (id, mark, text) in order; the same (id, mark) twice is one document."""
    seen, out = {}, {}
    for key, text in docs:
        if key in out:
            continue
        words = (text or "").encode().split()
        gone = [False] * len(words)
        for s in range(len(words) - window + 1):
            if seen.setdefault(tuple(words[s : s + window]), (key, s)) != (key, s):
                gone[s : s + window] = [True] * window
        kept = b" ".join(w for w, g in zip(words, gone, strict=True) if not g)
        out[key] = (len(words), sum(gone), hashlib.sha256(kept).hexdigest())
    return out


def test_op1_by_brute_force(spark):
    docs = sorted((r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect())
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in queries.op1_super_kmer_dedup(spark, SF).collect()}
    assert got == brute(docs, 20)
    assert sum(n for _, n, _ in got.values()) > 0


def drawn(seed, n=400):
    """Passages and a line that a third of the documents share, copies, and words that repeat on and on."""
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(3000)]
    passages = [rng.choices(words, k=rng.randint(3, 30)) for _ in range(12)]
    line, out = rng.choices(words, k=9), []
    for i in range(n):
        text = rng.choices(words, k=rng.randint(0, 40))
        for _ in range(rng.randint(0, 3)):
            at = rng.randint(0, len(text))
            text[at:at] = rng.choice(passages)
        if i % 3 == 0:
            text[len(text) // 2 : len(text) // 2] = line
        if i % 50 == 7:
            text += ["of"] * rng.randint(5, 60)
        out.append(out[rng.randrange(i)] if i and rng.random() < 0.1 else rng.choice([" ", "\n", "\t\x0b "]).join(text))
    return out


@pytest.mark.parametrize("window,mer", [(8, 3), (5, 5), (12, 1)])
def test_windows_mers_and_skew(spark, window, mer):
    texts = drawn(window)
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, start string").repartition(7)
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in substring.remove_repeats(docs, window, mer).collect()}
    assert got == brute(list(enumerate(texts)), window)


def test_odd_rows(spark):
    rng = random.Random(1)
    long = " ".join(rng.choices("abcdefghij", k=200_000))
    a, b = " ".join(map(str, range(30))), "x\x1cy é　z \x00 " * 12
    rows = [(5, a), (5, a), (None, a), (None, None), (7, None), (8, ""), (9, " \n "), (2, long), (3, b), (4, b), (4, "4 5 6"), (1, "0 " + a)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = sorted(((r.doc_id is None, r.doc_id or 0, r.n_words, r.n_removed) for r in substring.remove_repeats(docs, 6, 2, keep_text=True).collect()))
    assert len(got) == len(rows)
    by_id = {}
    for null, i, n, gone in got:
        by_id.setdefault((null, i), []).append((n, gone))
    assert by_id[(False, 5)] == [(30, 30), (30, 30)]  # the same row twice, both repeat document 1
    assert by_id[(True, 0)] == [(0, 0), (30, 30)]
    assert by_id[(False, 1)] == [(31, 0)]
    n_b = len(b.encode().split())
    first = brute([(3, b)], 6)[3][1]  # its own repetitions
    assert by_id[(False, 3)] == [(n_b, first)] and by_id[(False, 4)] == [(3, 0), (n_b, n_b)]
    assert by_id[(False, 2)] == [brute([(2, long)], 6)[2][:2]]
    assert substring.remove_repeats(docs.limit(0)).count() == 0


def test_rows_that_share_an_id(spark):
    a, b = " ".join(map(str, range(30))), " ".join(map(str, range(-5, 25)))
    docs = spark.createDataFrame([(5, a), (5, b)], "doc_id long, text string")
    got = [r.n_removed for r in substring.remove_repeats(docs, 20).collect()]
    assert sorted(got) == [0, 25]


def test_hash_collisions_are_found_out(monkeypatch):
    monkeypatch.setattr(substring, "slice_hashes", lambda data, s, e: np.asarray((e - s) % 3).astype(np.uint64))
    texts = [t.encode() for t in ("a b c d e", "b c d e f", "c c d e f", "x b c d e f")]
    numbers = np.array([[0, 1, 2, 3], [0] * 4, [0] * 4, [2, 2, 2, 3]])
    seen, want = {}, []
    for i, t in enumerate(texts):
        words = t.split()
        for s in range(len(words) - 3):
            want.append(seen.setdefault(tuple(words[s : s + 4]), (i, s)) != (i, s))
    assert substring.repeats_of(numbers, texts, 4).tolist() == want


@pytest.mark.parametrize("doc_id", [5, None])
def test_texts_of_one_id_whose_marks_share_32_bits(spark, doc_id):
    text = "array_join(transform(sequence(1, 25 + id % 20), j -> concat(id, '-', j)), ' ')"
    drawn = spark.range(250_000).selectExpr(f"xxhash64({str(doc_id is None).lower()}, {text}) & 4294967295 AS low", f"{text} AS text")
    pair = drawn.groupBy("low").agg(F.collect_list("text").alias("texts")).where("size(texts) > 1").first().texts[:2]
    rows = [(1, pair[0]), (doc_id, pair[0]), (doc_id, pair[1])]
    for parts in (1, 3):
        docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(parts)
        got = sorted((r.doc_id != 1, r.n_words, r.n_removed) for r in substring.remove_repeats(docs, 20).collect())
        n, m = (len(x.split()) for x in pair)
        assert got == sorted([(False, n, 0), (True, n, n), (True, m, 0)])  # only the text that document 1 has goes
