"""Quality and toxicity: held-out accuracy, the parts of the models, odd rows."""

import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from hostlens.llm import labelled, quality, queries, toxicity

SF = "/root/testdata/sf0.1"


def auc(scores, labels):
    pos = [s for s, y in zip(scores, labels, strict=True) if y]
    neg = [s for s, y in zip(scores, labels, strict=True) if not y]
    order = {s: i for i, s in enumerate(sorted(set(scores)))}
    return np.mean([(order[p] > order[n]) + 0.5 * (order[p] == order[n]) for p in pos for n in neg])


@pytest.mark.parametrize("query,name,folds,fold", [("op7_fourier_quality", "quality", 5, 0), ("op10_kneser_ney_toxicity", "toxic", 4, 2)])
def test_held_out_accuracy(spark, query, name, folds, fold):
    rows = queries.QUERIES[query](spark, SF).collect()
    assert len(rows) == spark.read.parquet(f"{SF}/documents.parquet").count()
    y = {r.doc_id: r[name] for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % folds == fold)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3)
    held = [r for r in rows if r.held_out and r.doc_id in y]
    assert len(held) > 300
    assert auc([r.score for r in held], [y[r.doc_id] for r in held]) > 0.97
    assert np.mean([r.predicted == y[r.doc_id] for r in held]) > 0.96


def test_scores_do_not_depend_on_held_out_labels_or_other_columns(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    turned = labels.withColumn("toxic", F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    turned = turned.withColumn("quality", F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, 1 - F.col("quality")).otherwise(F.col("quality")))
    other = docs.withColumn("lang", F.lit("xx")).withColumn("source", F.lit(None).cast("string"))
    for module, name in ((quality, "quality"), (toxicity, "toxic")):
        a = {r.doc_id: r.score for r in module.score(docs, labels, name).collect()}
        b = {r.doc_id: r.score for r in module.score(other, turned, name).collect()}
        assert a.keys() == b.keys() and max(abs(a[k] - b[k]) for k in a) < 1e-6


@pytest.mark.parametrize("module,name", [(quality, "quality"), (toxicity, "toxic")])
def test_odd_rows(spark, module, name):
    rng = random.Random(1)
    rows = [(i, " ".join(rng.choices(["alpha", "beta", "gamma", "vile"] if i % 4 else ["alpha", "beta!!", "VILE***"], k=30)), "en", 0.5) for i in range(200)]
    rows += [(None, "alpha", None, None), (900, None, "x", 0.1), (901, "", "x", 0.1), (902, "alpha " * 60_000, "x", 0.1), (5, "alpha\x01\x02 \U0001f600", "x", 0.1), (5, "alpha\x01\x02 \U0001f600", "x", 0.1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, label string, score double")
    marks = [(i, int(i % 4 == 0), "n") for i in range(150)] + [(3, 0, "n"), (3, None, "n"), (None, 1, "n"), (7, 5, "n"), (5000, 1, "n")]
    labels = spark.createDataFrame(marks, f"doc_id long, {name} int, text string")
    got = module.score(docs, labels, name).collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 for r in got)
    assert [r.held_out for r in got if r.doc_id is None] == [True]
    assert len({r.score for r in got if r.doc_id == 5 and r.score is not None}) <= 2
    empty = module.score(docs, labels.limit(0), name).collect()
    assert len(empty) == len(rows) and len({r.score for r in empty}) == 1
    one = module.score(docs, labels.where(f"{name} = 1"), name).collect()
    assert {r.predicted for r in one} == {1}
    assert module.score(docs.limit(0), labels, name).count() == 0


def test_training_labels_are_bounded(spark):
    labels = spark.range(4000).select(F.col("id").alias("doc_id"), (F.col("id") % 2).alias("quality"))
    rows = labelled.training_labels(labels, "quality", 5, 0, 1000).collect()
    assert 700 < len(rows) <= 1000 and all(zlib.crc32(str(r.doc_id).encode()) % 5 for r in rows)


def test_isotonic_against_brute_force():
    rng = np.random.default_rng(3)
    y, w = rng.random(9).round(2), rng.integers(1, 4, 9).astype(float)
    knots, values = quality.isotonic(np.arange(9.0), y, w)
    got = np.interp(np.arange(9.0), knots, values)
    # minimax formula of isotonic regression
    mean = lambda i, j: (y[i : j + 1] @ w[i : j + 1]) / w[i : j + 1].sum()
    want = [max(min(mean(i, j) for j in range(k, 9)) for i in range(k + 1)) for k in range(9)]
    assert np.allclose(got, want)


def test_fourier_features_approach_the_gaussian_kernel():
    rng = np.random.default_rng(1)
    d = len(quality.STATS)
    m = quality.Model(np.zeros(d), np.ones(d), rng.normal(size=(d, 20_000)), rng.uniform(0, 2 * np.pi, 20_000), np.zeros(0), np.zeros(1), np.zeros(1))
    x = rng.normal(size=(2, d)) * 0.3
    f = m.features(x)[:, 1 + d :]
    assert 2 * (f[0] @ f[1]) / 20_000 == pytest.approx(math.exp(-((x[0] - x[1]) ** 2).sum() / 2), abs=0.03)


def test_kneser_ney_by_brute_force(spark):
    """Evidence from the definition, on a few words, against the tables."""
    train = {"idiot": (2, 5), "idiom": (6, 0), "moron": (0, 3), "mor": (4, 1), "the": (9, 9)}
    unseen = ["them", "idle"]
    grams, cls = Counter(), {0: Counter(), 1: Counter()}
    for w in [*train, *unseen]:
        s = "\x01" * 4 + w + "\x02"
        for i in range(4, len(s)):
            grams[s[i - 4 : i + 1]] += 1
            for c in (0, 1):
                cls[c][s[i - 4 : i + 1]] += train.get(w, (0, 0))[c]
    d, types = 0.75, {5: set(grams)}
    for n in (4, 3, 2, 1):
        types[n] = {}
        for g in types[n + 1]:
            types[n][g[1:]] = types[n].get(g[1:], 0) + 1

    def shared(g):
        if len(g) == 1:
            return 0.999 * types[1][g] / sum(types[1].values()) + 0.001 / 4096
        same = {k: v for k, v in types[len(g)].items() if k[:-1] == g[:-1]}
        return (types[len(g)][g] - d + d * len(same) * shared(g[1:])) / sum(same.values())

    def p(c, g):
        same = {k: v for k, v in cls[c].items() if k[:-1] == g[:-1] and v}
        total = sum(same.values())
        return max(cls[c][g] - d, 0) / total + d * len(same) / total * shared(g[1:]) if total else shared(g[1:])

    docs = spark.createDataFrame([(i, " ".join([w] * n + ["x-"] * 0), c) for i, (w, n, c) in enumerate([(w, ns[c], c) for w, ns in train.items() for c in (0, 1) if ns[c]] + [(w, 1, None) for w in unseen])], "doc_id long, text string, label int")
    counts = toxicity.gram_counts(docs.select("doc_id", "text"), docs.where("label IS NOT NULL").select("doc_id", "label"))
    model = toxicity.WordEvidence(toxicity.model_tables(counts, 1 << 21))
    for w in train:
        s = "\x01" * 4 + w + "\x02"
        want = sum(math.log(p(1, s[i - 4 : i + 1]) / p(0, s[i - 4 : i + 1])) for i in range(4, len(s)))
        assert model.of_words([w])[0] == pytest.approx(want, abs=1e-4)


def test_a_model_above_the_broadcast_bound_keeps_every_gram(spark, monkeypatch):
    """Scores are the same whether the model is broadcast or joined to blocks of documents."""
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    odd = spark.createDataFrame([(None, "alpha"), (-1, None), (-2, ""), (-3, " !! "), (-4, "\u4e00\u4e8c " * 9)], "doc_id long, text string")
    docs = docs.select("doc_id", "text").unionByName(odd)
    monkeypatch.setattr(toxicity, "BLOCK_BYTES", 1 << 16, raising=False)
    whole, joined = ({(r.doc_id, r.predicted, r.held_out): r.score for r in toxicity.score(docs, labels, "toxic", entries=n).collect()} for n in (1 << 21, 500))
    assert whole.keys() == joined.keys() and len(whole) == docs.count()
    assert max(abs(whole[k] - joined[k]) for k in whole) < 1e-6


def test_no_two_characters_are_taken_for_one():
    points = np.array([*range(1, 5000), *range(0x4DF0, 0x5700), 0xFFFF, 0x10000, 0x1F600, 0x10FFFF])
    coded = {tuple(toxicity.symbols(np.array([p])).tolist()) for p in points.tolist()}
    assert len(coded) == len(points) and max(max(c) for c in coded) < 1 << toxicity.BITS
    assert {len(c) for c in coded} == {1, 2} and not {c[0] for c in coded if len(c) == 2} & {c[-1] for c in coded}
    whole = toxicity.symbols(points).tolist()
    assert whole == [x for p in points.tolist() for x in toxicity.symbols(np.array([p])).tolist()]
    a, b = (set(toxicity.five_grams([w])[0].tolist()) for w in ("一", "嘀"))
    assert a.isdisjoint(b) and len(toxicity.five_grams(["一x", "y"])[0]) == 4 + 2
    assert toxicity.five_grams(["一x", "y"])[1].tolist() == [0] * 4 + [1] * 2


def test_every_gram_and_start_of_a_large_model_is_there(spark):
    words = [f"{a}{b}{c}" for a in "abcdefgh" for b in "ijklm" for c in "nopq"]
    docs = spark.createDataFrame([(i, w, i % 2) for i, w in enumerate(words)], "doc_id long, text string, label int")
    counts = toxicity.gram_counts(docs.select("doc_id", "text"), docs.select("doc_id", "label"))
    model = toxicity.model_tables(counts, 10)
    want = set(toxicity.five_grams(words)[0].tolist())
    assert {r.key for r in model.select("key").collect()} == want
    assert {r.h for r in model.select("h").collect()} == {k >> toxicity.BITS for k in want}


def test_few_labels_are_calibrated_on_rows_the_fit_has_not_seen(spark):
    rng = random.Random(4)
    docs = spark.createDataFrame([(i, " ".join(rng.choices(["alpha", "beta", "gamma!", "7"], k=5 + i % 40))) for i in range(300)], "doc_id long, text string")
    stats = docs.mapInArrow(quality._stats, "doc_id long" + "".join(f", {n} double" for n in quality.STATS))
    labels = docs.select("doc_id", (F.col("doc_id") % 40 > 15).cast("int").alias("quality"))
    apart = [r.doc_id for r in labelled.training_labels(labels, "quality", 5, 0, 200_000).where("part = 0").collect()]
    turned = labels.withColumn("quality", F.when(F.col("doc_id").isin(apart), 1 - F.col("quality")).otherwise(F.col("quality")))
    a, b = (quality.fit(stats, x, "quality", 5, 0, features=32) for x in (labels, turned))
    assert len(apart) > 30 and np.allclose(a.beta, b.beta) and not np.array_equal(a.values, b.values)
    none = labels.where(~F.col("doc_id").isin(apart))
    share = [r.score for r in quality.score(docs, none, "quality", 5, 0, features=32).collect()]
    assert max(share) - min(share) <= 0.001 and 0 < min(share) < max(share) < 1
