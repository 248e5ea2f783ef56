"""Language mixtures: held-out accuracy, a plain version of the model, and odd rows."""

import math
import re
import zlib
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from hostlens.llm import langmix

SF = "/root/testdata/sf0.01/documents.parquet"
SCHEMA = "doc_id long, text string, lang string, source string, score int, held_out string, gram binary"


def frame(spark, rows):
    return spark.createDataFrame([(i, t, x, "s", 1, "h", b"g") for i, t, x in rows], SCHEMA)


def got_of(df):
    return {(r.doc_id, r.held_out, r.lang_pred, r.score) for r in df.collect()}


def words_of(text):
    """Runs of letters within runs of ASCII letters and anything beyond ASCII, in lower case."""
    out = []
    for token in re.findall(r"[A-Za-z\x80-\U0010FFFF]+", text or ""):
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in token).lower()
        out.append([r for r in re.findall(r"[^\W\d_]+", low) if any(c.isalpha() for c in r)])
    return [x for x in out if x]


def grams_of(word):
    b = b"\x01\x01" + word.encode() + b"\x01"
    return [b[i : i + 3] for i in range(len(b) - 2)]


def plain(rows, penalty=1.0):
    """The model by its formulas, a document at a time."""
    counts = {}
    for i, t, x in rows:
        if i is not None and x is not None and zlib.crc32(str(i).encode()) % 5:
            counts.setdefault(x, Counter()).update(g for w in words_of(t) for r in w for g in grams_of(r))
    langs = sorted(k for k, c in counts.items() if c)

    def prob(lang):
        three = counts[lang]
        two, one, seen = Counter(), Counter(), Counter()
        for g, n in three.items():
            two[g[1:]] += n
            one[g[2:]] += n
            seen[g[:2]] += n
        kinds, after, total = Counter(g[:2] for g in three), Counter(), sum(one.values())
        different = Counter(g[:1] for g in two)
        for g, n in two.items():
            after[g[:1]] += n

        def p(g):
            p1 = (one[g[2:]] + 1) / (total + 256)
            y = g[1:2]
            p2 = (two[g[1:]] + different[y] * p1) / (after[y] + different[y]) if after[y] else p1
            xy = g[:2]
            return (three[g] + kinds[xy] * p2) / (seen[xy] + kinds[xy]) if seen[xy] else p2

        return p

    probs = [prob(x) for x in langs]
    out = {}
    for i, t, _ in rows:
        words = Counter(tuple(w) for w in words_of(t))
        if not words or not langs:
            out[i] = ("und", 0.0)
            continue
        logs = [[sum(math.log(p(g)) for r in w for g in grams_of(r)) for p in probs] for w in words]
        ps = [[math.exp(max(x - max(row), -30)) for x in row] for row in logs]
        ns = list(words.values())

        def fit(allowed):
            share = [1 / len(allowed) if k in allowed else 0.0 for k in range(len(langs))]
            for _ in range(15):
                new = [0.0] * len(langs)
                for p, n in zip(ps, ns, strict=True):
                    s = sum(a * b for a, b in zip(p, share, strict=True))
                    for k in range(len(langs)):
                        new[k] += n * p[k] * share[k] / s
                share = [x / sum(ns) for x in new]
            return share, sum(n * math.log(sum(a * b for a, b in zip(p, share, strict=True))) for p, n in zip(ps, ns, strict=True))

        full, _ = fit(range(len(langs)))
        order = sorted(range(len(langs)), key=lambda k: -full[k])
        most = max(1, sum(x * sum(ns) >= 1 for x in full))
        best = max((fit(order[:m])[1] - penalty * (m - 1) * math.log(sum(ns) + 1), -m) for m in range(1, most + 1))
        share, _ = fit(order[: -best[1]])
        k = max(range(len(langs)), key=lambda k: share[k])
        out[i] = (langs[k], share[k])
    return out


ODD = [(None, "hello there", "en"), (3000, None, "en"), (3001, "", None), (3002, "123 ½ ... ²", "fr"), (3003, "日本", None), (3003, "日本", None)]


def test_equals_the_plain_model_and_ignores_its_inputs_order(spark):
    rows = [tuple(r) for r in spark.read.parquet(SF).where("length(text) < 900").orderBy("doc_id").limit(60).select("doc_id", "text", "lang").collect()] + ODD[1:]
    rows += [(4000, " ".join(t or "" for _, t, x in rows if x in ("en", "fr"))[:3000], None)]
    want = plain(rows)
    for df in (langmix.predict(frame(spark, rows)), langmix.predict(frame(spark, rows[::-1]).repartition(5), entries=3)):
        got = df.collect()
        assert len(got) == len(rows)
        for r in got:
            assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
            assert r.lang_pred == want[r.doc_id][0] and abs(r.score - want[r.doc_id][1]) < 1e-4, (r, want[r.doc_id])


def test_held_out_accuracy_and_mixtures(spark):
    docs = spark.read.parquet(SF)
    got = langmix.predict(docs).join(docs.select("doc_id", "lang"), "doc_id").where("held_out")
    assert got.count() > 100
    assert got.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0] > 0.98
    halves = docs.where("lang in ('de', 'fr') and length(text) between 600 and 3000")
    de, fr = (halves.where(F.col("lang") == x).orderBy("doc_id").first().text for x in ("de", "fr"))
    n = len(fr.split())
    mixed = frame(spark, [(90001, " ".join(de.split()[:n]) + " " + fr, None)]).select("doc_id", "text", "lang").unionByName(docs.select("doc_id", "text", "lang"))
    r = langmix.predict(mixed).where("doc_id = 90001").first()
    assert {x.split(":")[0] for x in r.langs.split()} >= {"de", "fr"} and 0.3 < r.score < 0.75


def test_odd_rows_empty_tables_and_nothing_learnt(spark):
    df = frame(spark, ODD)
    got = langmix.predict(df).collect()
    assert len(got) == len(ODD)
    assert {(r.doc_id, r.lang_pred) for r in got if r.doc_id in (3000, 3001, 3002)} == {(i, "und") for i in (3000, 3001, 3002)}
    assert all(r.held_out for r in got if r.doc_id is None)
    assert langmix.predict(df.limit(0)).count() == 0
    assert {(r.lang_pred, r.score) for r in langmix.predict(df.withColumn("lang", F.lit(None).cast("string"))).collect()} == {("und", 0.0)}


def test_very_long_texts_and_hot_copies(spark):
    rows = [(i, "the cat sat on the mat and the dog", "en") for i in range(1, 40)] + [(i, "le chat et le chien sur la table", "fr") for i in range(40, 80)]
    rows += [(100, "x" * 2_000_000, None), (101, "le chat et le chien " * 50_000, None)] + [(200 + i, "the dog", None) for i in range(3000)]
    got = {r.doc_id: r for r in langmix.predict(frame(spark, rows)).collect()}
    assert got[101].lang_pred == "fr" and got[101].score > 0.99 and 100 in got
    assert {(got[200 + i].lang_pred, got[200 + i].score) for i in range(3000)} == {(got[200].lang_pred, got[200].score)} and got[200].lang_pred == "en"


def test_a_model_of_nothing_is_uniform():
    low, kinds, seen = langmix._lower_tables(*[_empty() for _ in range(2)], 2)
    m = langmix.Model(["a", "b"], low, kinds, seen, np.zeros(0, np.int64), np.zeros((0, 2), np.float32))
    assert np.allclose(m.logs(np.array([1, 2, 3]), m.counts_of(np.array([1, 2, 3]))), math.log(1 / 256))


def _empty():
    import pyarrow as pa

    return pa.table({"at": pa.array([], pa.int64()), "lang": pa.array([], pa.int32()), "n": pa.array([], pa.int64()), "kinds": pa.array([], pa.int64())})
