"""Ranked search against plain scoring."""

import math
import re
from collections import Counter

import numpy as np
import pytest

from hostlens.llm import lexical

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
DOCS = "doc_id long, text string, n long, item_id int, ids binary, score string"
ITEMS = "item_id long, text string, doc_id int, term string"


def terms_of(text):
    return TERM.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items, k=10):
    held = [(i, Counter(terms_of(t))) for i, t in docs]
    held = [(i, c, sum(c.values())) for i, c in held if c]
    n_all, total = len(held), sum(n for _, _, n in held)
    df = Counter(t for _, c, _ in held for t in c)
    out = []
    for item, text in items:
        found = []
        for i, c, n in held:
            m = 100 - 90 + (90 * n * n_all) // total
            s = sum(math.floor(1000 * math.log((2 * n_all + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 8 * m)) for t in set(terms_of(text)) if c[t])
            if s > 0:
                found.append((-s, i is None, i or 0))
        out += [(item, r + 1, None if null else i, -s) for r, (s, null, i) in enumerate(sorted(found)[:k])]
    return sorted(out, key=str)


def got_of(df):
    assert df.columns == ["item_id", "rank", "doc_id", "score"]
    return sorted((tuple(r) for r in df.collect()), key=str)


def drawn(seed, n, longest):
    rng = np.random.default_rng(seed)
    vocab = [f"w{i}" for i in range(60)] + ["The", "THE", "the", "Ünï", "ünï", "日本語", "a_b", "x'y", "10%", " "]
    p = 1 / np.arange(1, len(vocab) + 1)
    return [" ".join(rng.choice(vocab, int(rng.integers(0, longest)), p=p / p.sum())) for _ in range(n)]


def frames(spark, docs, items):
    return (spark.createDataFrame([(i, t, 1, 2, b"x", "y") for i, t in docs], DOCS).repartition(4),
            spark.createDataFrame([(i, t, 3, "z") for i, t in items], ITEMS))


ODD_DOCS = [(None, "w1 w2"), (None, "w1 w2"), (7, None), (8, ""), (9, " .,"), (5, "w3 w4"), (5, "w3 w4"), (5, "w9")]
ODD_ITEMS = [(None, "w1 the"), (901, None), (902, ""), (903, "nowhere"), (904, "w5 w5 W5"), (904, "w6")]


@pytest.mark.parametrize("item_block,term_block", [(1024, 1 << 15), (7, 12)])
def test_against_plain_scores(spark, item_block, term_block):
    texts = drawn(1, 90, 80)
    docs = [(i, texts[i % 70]) for i in range(300)] + ODD_DOCS  # copies tie
    items = list(enumerate(drawn(2, 25, 12))) + ODD_ITEMS
    d, it = frames(spark, docs, items)
    assert got_of(lexical.search(spark, d, it, item_block=item_block, term_block=term_block)) == brute(docs, items)


def test_one_hot_text_and_very_long_text(spark):
    docs = [(i, "w1 w2 w3") for i in range(5000)] + [(-1, "w1 " * 400_000 + "w2")]
    items = [(1, "w1 w2"), (2, "w3"), (3, " ".join(f"w{i}" for i in range(3000)))]
    d, it = frames(spark, docs, items)
    assert got_of(lexical.search(spark, d, it)) == brute(docs, items)


def test_empty_tables(spark):
    d, it = frames(spark, ODD_DOCS, ODD_ITEMS)
    assert lexical.search(spark, d.limit(0), it).count() == 0
    assert lexical.search(spark, d, it.limit(0)).count() == 0
    assert lexical.search(spark, d, it.where("item_id = 901")).count() == 0


def test_tiles_of_terms_stay_exact():
    # weights so large that a vocabulary tile has two terms
    rng = np.random.default_rng(3)
    terms, docs = 9, 6
    block = lexical.Items(0, [0, 1], None, np.repeat([0, 1], terms), np.tile(np.arange(terms), 2))._replace(terms=list(range(terms)))
    weight = rng.integers(4 * 10**9, 4_400_000_000, terms)
    tf = rng.integers(1, 50, (docs, terms))
    length = tf.sum(1)
    doc, term = np.nonzero(tf)
    row = {"ids": np.arange(docs), "lengths": length, "doc": doc.astype("<i4"), "term": term.astype("<i4"), "tf": tf[doc, term].astype("<i4")}
    import pyarrow as pa

    batch = pa.RecordBatch.from_pydict({k: [np.asarray(v).tobytes()] for k, v in row.items()})
    out = next(lexical._search(block, weight, docs, int(length.sum()), 3)([batch])).to_pydict()
    want = []
    for d in range(docs):
        m = 10 + 90 * int(length[d]) * docs // int(length.sum())
        want.append(sum(int(w) * (10**9 * int(f) // (1000 * int(f) + 8 * m)) for w, f in zip(weight, tf[d], strict=True)))
    best = sorted(range(docs), key=lambda i: (-want[i], i))[:3]
    assert out["id"] == best * 2 and out["score"] == [want[i] for i in best] * 2


def test_impacts_beyond_64_bits():
    got = lexical.impacts(np.array([3]), np.array([2 * 10**9]), 10**9, 10**18)
    m = 10 + 90 * 2 * 10**9 * 10**9 // 10**18
    assert got.tolist() == [3 * 10**9 // (3000 + 8 * m)]
    assert lexical.impacts(np.array([3]), np.array([2 * 10**9]), 10**11, 10**18).tolist() == [3 * 10**9 // (3000 + 8 * (10 + 90 * 2 * 10**20 // 10**18))]
