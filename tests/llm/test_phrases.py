"""Collocations against plain counting."""

import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from hostlens.llm import bytewords, phrases

SCHEMA = "doc_id long, text string, lang string, n long, phrase string, words binary, a int"


def brute(rows, least, top, percent=50, depth=3):
    f, total = defaultdict(Counter), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", low):
            w = re.findall(r"[^\x20\x09]+", piece)
            total[lang] += len(w)
            for k in range(1, depth + 1):
                for i in range(len(w) - k + 1):
                    f[lang][tuple(w[i : i + k])] += 1
    out = []
    for lang, c in f.items():
        found = []
        for p, a in c.items():
            if len(p) < 2 or a < least:
                continue
            longer = [q for q, n in c.items() if len(q) > len(p) and n >= least and 100 * n >= percent * a]
            covered = any(q[i : i + len(p)] == p for q in longer for i in range(len(q) - len(p) + 1))
            if not covered:
                score, k = min((10**6 * a * a // (c[p[:k]] * c[p[k:]]), k) for k in range(1, len(p)))
                found.append((-score, -a, " ".join(p).encode(), c[p[:k]], c[p[k:]]))
        out += [(lang, i + 1, x[2].decode(), -x[1], x[3], x[4], total[lang], -x[0]) for i, x in enumerate(sorted(found)[:top])]
    return sorted(out)


def got_of(df):
    assert df.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    return sorted(tuple(r) for r in df.collect())


def frame(spark, rows):
    return spark.createDataFrame([(i, t, x, 1, "x", b"y", 2) for i, (t, x) in enumerate(rows)], SCHEMA)


def drawn(seed, n, longest=60):
    rng = np.random.default_rng(seed)
    vocab = ["the", "The", "THE", "of", "a", "ñu", "Ñu", "é e", "x-y", "12", "日本", "'", "zz\u0085z"]
    gaps = [" ", " ", " ", "\t", "  ", ". ", "!", "\n", "\x0b", ";", " \r\n "]
    p = np.array([9, 2, 1, 6, 3, 1, 1, 1, 1, 1, 1, 1, 1.0])
    texts = []
    for _ in range(n):
        k = int(rng.integers(0, longest))
        texts.append("".join(w + g for w, g in zip(rng.choice(vocab, k, p=p / p.sum()), rng.choice(gaps, k), strict=True)))
    return texts


ODD = [(None, "en"), ("", None), (" \t ", "en"), ("...", "xx"), ("one", "yy")]


@pytest.mark.parametrize("least,top", [(3, 2000), (10, 5)])
def test_against_plain_counts(spark, least, top):
    langs = ["en", "fr", None, "und"]
    rows = [(t, langs[i % 4]) for i, t in enumerate(drawn(least, 160))] + ODD + [("same words here. " * 7, "en")] * 6
    df = frame(spark, rows).repartition(5)
    assert got_of(phrases.collocations(df, least=least, top=top)) == brute(rows, least, top)


def test_hot_word_and_pair_are_dealt_over_buckets(spark):
    rng = np.random.default_rng(4)
    rows = [(" ".join(x for i in rng.integers(0, 900, 40) for x in ("hot", "pair", f"w{i}")), "en") for _ in range(120)]
    rows += [(" ".join(["hot"] * 200), "en")] * 3
    df = frame(spark, rows).repartition(3)
    share = 1 / (8 * 8)
    seen = df.select("lang", "text").mapInArrow(phrases._frequent(3, share), "lang string, first string, second string, n long")
    assert ("hot", "pair") in {(r["first"], r["second"]) for r in seen.collect()}
    assert got_of(phrases.collocations(df)) == brute(rows, 10, 2000)


def test_empty_table_and_only_empty_texts(spark):
    df = frame(spark, ODD)
    assert phrases.collocations(df.limit(0)).count() == 0
    assert phrases.collocations(df).count() == 0
    assert phrases.phrase_counts(df, least=1).where("size = 1").count() == 1


def test_equal_parts_equals_counting():
    rng = np.random.default_rng(7)
    for n, most, least in ((0, 3, 1), (40, 3, 2), (6000, 4, 5), (20000, 60, 10)):
        keys = np.stack([rng.integers(1, 3, n), *(rng.integers(0 if d else 1, most, n) for d in range(3))])
        size = rng.integers(1, 4, n)
        want = Counter()
        for i in range(n):
            for d in range(4):
                if keys[d, i] == 0:
                    break
                want[tuple(keys[: d + 1, i].tolist())] += int(size[i])
        # behind the end of a piece nothing follows
        ended = np.cumsum(keys == 0, 0) > 0
        keys[ended] = 0
        got = {tuple(keys[: d + 1, p].tolist()): int(t) for d, ps, ts in phrases.equal_parts(keys, size, least) for p, t in zip(ps, ts, strict=True)}
        assert got == {k: v for k, v in want.items() if v >= least}


def test_suffixes_without_room_for_one_key():
    class Many(list):
        def __len__(self):
            return 1 << 22

    found = bytewords.split_words([b"a b c. a b", b"b c"], phrases.KINDS)
    rows, n = phrases.suffixes(found, 3)
    wide, m = phrases.suffixes(found._replace(words=Many()), 3)
    assert (rows == wide).all() and (n == m).all() and n.sum() == 7


def test_one_long_piece_and_exact_scores(spark):
    rows = [("a b " * 150_000, "en"), ("c " * 10, "en")]
    got = {r["phrase"]: r for r in phrases.collocations(frame(spark, rows)).collect()}
    assert "c c c" not in got
    assert got["a b a"]["a"] == 149_999 and got["b a b"]["score"] == 10**6 * 149_999**2 // 150_000**2
    big = 10**14 + 3
    row = got["a b a"].asDict() | {"a": big}
    expr = "(cast(a as decimal(19,0)) * cast(a as decimal(19,0)) * cast(1000000 as decimal(7,0))) div (cast(l as decimal(19,0)) * cast(r as decimal(19,0)))"
    df = spark.createDataFrame([(row["a"], big + 5, big + 7)], "a long, l long, r long")
    assert df.select(F.expr(expr)).first()[0] == 10**6 * big * big // ((big + 5) * (big + 7))
