"""Near-duplicate classes against all pairs, and the signature's law."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from hostlens.llm import neardup, queries
from hostlens.llm.common import with_copies

SF = "/root/testdata/sf0.001"


def brute(docs, similarity=0.8, size=5):
    """(id, text) rows: the classes' smallest ids."""
    sets = []
    for _, t in docs:
        w = (t or "").encode().split()
        sets.append({tuple(w[i : i + size]) for i in range(max(1, len(w) - size + 1))} if w else None)
    of = list(range(len(docs)))

    def find(x):
        while of[x] != x:
            x = of[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and len(a & b) >= similarity * len(a | b):
                of[find(i)] = find(j)
    low = {}
    for i, (d, _) in enumerate(docs):
        low[find(i)] = min(low.get(find(i), d), d)
    return [low[find(i)] for i in range(len(docs))]


def test_op2_by_all_pairs(spark):
    docs = sorted((r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect())
    got = {r.doc_id: r.class_id for r in queries.op2_dart_minhash(spark, SF).collect()}
    assert [got[d] for d, _ in docs] == brute(docs)
    assert len(set(got.values())) < len(docs)


def edited(rng, words, n):
    out = list(words)
    for _ in range(n):
        out[rng.randrange(len(out))] = f"e{rng.randrange(10**6)}"
    return out


def test_hot_groups_chains_and_shared_passages(spark):
    """A third of all rows near one text, chains whose ends aren't alike, many texts with one passage, copies."""
    rng = random.Random(2)
    word = lambda k: [f"w{rng.randrange(5000)}" for _ in range(k)]
    base, passage, docs = word(200), word(60), []
    for _ in range(120):
        docs.append(edited(rng, base, rng.randint(0, 4)))
    chain = word(150)
    for _ in range(12):
        docs.append(chain := edited(rng, chain, 2))
    for _ in range(80):
        docs.append(word(rng.randint(20, 90)) + passage)
    docs += [docs[0]] * 40 + [word(rng.randint(1, 60)) for _ in range(80)]
    rng.shuffle(docs)
    rows = [(i, " ".join(w)) for i, w in enumerate(docs)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    want = brute(rows)
    for leaders in (0, 1, 3):  # without leaders the exact step does it all
        got = {r.doc_id: (r.class_id, r.class_size) for r in neardup.classes(df, leaders=leaders).collect()}
        assert [got[i][0] for i, _ in rows] == want
        assert all(got[i][1] == want.count(want[i]) for i, _ in rows)


def test_odd_rows(spark):
    long = " ".join(str(i * 7919 % 100_003) for i in range(60_000))
    rows = [(1, None), (2, ""), (3, " \n"), (4, "a b"), (5, "a  b"), (None, "a b"), (6, "a b c"), (7, "a b"), (7, "a b"), (7, "x y z"), (8, long), (9, long + " end"), (None, None)]
    df = spark.createDataFrame([(i, t, 0, "k") for i, t in rows], "doc_id long, text string, v int, label string")
    got = neardup.classes(df).collect()
    assert len(got) == len(rows)
    by = {}
    for r in got:
        by.setdefault(r.doc_id, set()).add((r.class_id, r.class_size))
    assert by[4] == by[5] == {(4, 5)} and by[7] == {(4, 5), (7, 1)}
    assert by[1] == {(1, 1)} and by[2] == {(2, 1)} and by[6] == {(6, 1)} and by[8] == by[9] == {(8, 2)}
    assert by[None] == {(4, 5), (None, 1)}
    assert neardup.classes(df.limit(0)).count() == 0
    firsts = neardup.classes(df).where("first").groupBy("doc_id", "_row").agg(F.lit(1).alias("copies"), F.count("*").alias("times"))
    kept = sorted((r.doc_id or 0, (r.text or "").strip()) for r in with_copies(df, firsts).collect())
    assert [k for k in kept if k[1]] == [(4, "a b"), (6, "a b c"), (7, "x y z"), (8, long)]


@pytest.mark.parametrize("counted", [False, True])
def test_signatures_agree_as_often_as_weights_overlap(counted):
    rng = np.random.default_rng(4)
    h = rng.integers(0, 2**63, 300).astype(np.uint64)
    a, b = rng.integers(1, 9, 300), rng.integers(1, 9, 300)
    a[200:250], b[250:] = 0, 0
    if not counted:
        a, b = np.minimum(a, 1), np.minimum(b, 1)
    elements, doc = np.concatenate([np.repeat(h, a), np.repeat(h, b)]), np.repeat([0, 1], [a.sum(), b.sum()])
    sig = neardup.darts(*neardup.weighted(elements, doc, counted), 2, 4000)
    want = np.minimum(a, b).sum() / np.maximum(a, b).sum()
    assert abs((sig[0] == sig[1]).mean() - want) < 0.03
    again = neardup.darts(*neardup.weighted(elements[::-1].copy(), doc[::-1].copy(), counted), 2, 4000)
    assert (again == sig).all()


def test_components_of_paths_stars_and_cycles(spark):
    rng = random.Random(0)
    edges = [(i, i + 1) for i in range(100, 160)] + [(0, i) for i in range(1, 50)] + [(200, 201), (201, 202), (202, 200), (300, 301)]
    rng.shuffle(edges)
    got = neardup.components(spark.createDataFrame(edges, "a long, b long")).collect()
    groups = {}
    for r in got:
        groups.setdefault(r.label, set()).add(r.v)
    assert sorted(map(sorted, groups.values())) == [list(range(50)), list(range(100, 161)), [200, 201, 202], [300, 301]]
