"""Personal data and the pipeline."""

import hashlib
import itertools
import re
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from hostlens.llm import mixing, pii, pii_examples, quality, queries

from test_neardup import brute
from test_tokens_packing import by_library

SF = "/root/testdata/sf0.001"

HELD_OUT = """
my phone {phone|(618) 555-7741} is off
tel {phone|0331 998877} at work
write to {email|lisa [at] garden [dot] org} today
ask {email|k.brown at corp dot com} about it
host {ip|2001:db8:0:1::42} is up
card {card|4539.1488.0343.6467} was used
ring {phone|503-555-0188} now
the version 4.5.1 is out
in 1999 there were 30 of them
password=9c1e77aa02b4d3f150 was leaked
meet me at 10:45 or 11:15
it costs 25,000 dollars
""".strip().split("\n")


@pytest.fixture(scope="module")
def field():
    return pii.train(pii_examples.ROWS)


def naive(text):
    """The contract's words, pattern by pattern."""
    out = []
    for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text):
        out.append((m.start(), 0, m.end()))
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(p) <= 255 for p in m[0].split(".")):
            out.append((m.start(), 1, m.end()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        d = [int(c) for c in m[0] if c.isdigit()]
        check = sum(x if i % 2 == 0 else x * 2 - 9 * (x > 4) for i, x in enumerate(d[::-1]))
        if 14 <= len(d) <= 19 and check % 10 == 0:
            out.append((m.start(), 2, m.end()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 10 <= sum(c.isdigit() for c in m[0]) <= 15:
            out.append((m.start(), 3, m.end()))
    return sorted(out)


ODD = [None, "", "é a.b@c.de, x@y x@y.z. 1.2.3.4.5 256.1.1.1 4111 1111 1111 1111 +1 (743) 555-3824 +12", "@@ a@b.c@d.e 00000001.2.3.255",
       "+1 (836) 555-9331 4913187196670932 53.121.55.90", "call (743) 555-3824 or bob [at] mail [dot] org", "1 " * 40_000, "9" * 5000, "١٢٣ ²³"]


def test_op6_by_the_patterns(spark, field):
    texts = {r.doc_id: r.text for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()}
    rows = queries.op6_crf_pii(spark, "/root/testdata/sf0.01").collect()
    assert len(rows) == len(texts)
    for r in rows:
        base = naive(texts[r.doc_id] or "")
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(k == j for _, k, _ in base) for j in range(4)]
        assert r.base_sha256 == hashlib.sha256(pii.joined(base).encode()).hexdigest()
        assert {f"{pii.KINDS[k]}:{a}:{b}" for a, k, b in base} <= set(r.spans.split(",") if r.spans else [])


def test_patterns_on_drawn_texts():
    rng = np.random.default_rng(12)
    for chars, n in (("ab@.-+ é", 30), ("12.9 ", 25), ("a1@.+ -()25%_", 40), ("4.1-", 30)):
        for _ in range(4000):
            text = "".join(rng.choice(list(chars), int(rng.integers(0, n))))
            assert pii.base_spans(text) == naive(text), text


@pytest.mark.parametrize("text", ["7" * 2_000_000, "x" * 1_000_000 + " a@b " + "y" * 1_000_000, "a@" * 1_000_000, "1." * 1_000_000, "a." * 500_000 + "@" + "b." * 500_000,
                                  "+" + "1(" * 1_000_000, "@" * 2_000_000])
def test_long_runs_take_linear_time(field, text):
    began = time.process_time()
    base = pii.base_spans(text)
    pii.added_spans([text], [base], field)
    assert time.process_time() - began < 20


def test_pieces_end_where_the_text_has_words_labelled_o(field):
    """A piece in the middle of a text is decoded with the moves from and to O, as in the whole chain."""
    words = [f"w{i}" for i in range(12)]
    (got,) = field.decode([(words, 3, 8)])
    emit, n = field.scores([(words, 3, 8)])
    best, want = -np.inf, None
    for path in itertools.product(range(len(pii.LABELS)), repeat=2):
        labels = [path[0], *([0] * 3), path[1]]
        score = emit[0, np.arange(5), labels].sum() + field.move[0, labels[0]] + sum(field.move[a, b] for a, b in itertools.pairwise(labels)) + field.move[labels[-1], 0]
        if score > best:
            best, want = score, labels
    (free,) = pii.viterbi(emit, n, field.move, np.stack([field.move[0], field.move[:, 0]])[:, None])
    assert got.tolist() == free.tolist() and (got.tolist() == want or any(got[1:4]))


def test_odd_rows(spark, field):
    docs = spark.createDataFrame([(i if i != 3 else None, t, "k", 1) for i, t in enumerate(ODD)] + [(2, ODD[2], "k", 1)], "doc_id long, text string, spans string, n_chars int")
    got = pii.find(docs, field).collect()
    assert len(got) == docs.count()
    for r, t in zip(got, [*ODD, ODD[2]], strict=True):
        assert r.base_sha256 == hashlib.sha256(pii.joined(naive(t or "")).encode()).hexdigest()
    assert "phone:5:19" in got[5].spans and "email:23:" in got[5].spans
    assert pii.find(docs.limit(0), field).count() == 0
    new = pii.mask(docs, field).collect()
    assert new[0].text is None and new[0].n_chars == 1 and new[1].text == ""
    assert new[5].text == "call <PHONE> or <EMAIL>" and new[5].n_chars == len(new[5].text)
    assert "a.b@c.de" not in new[2].text and new[6].text == ODD[6] and new[6].spans == "k"


def test_field_on_held_out_rows(field):
    hit = wrong = miss = 0
    for row in HELD_OUT:
        text, spans = pii.marked(row)
        got = set(pii.added_spans([text], [[]], field)[0])
        hit, wrong, miss = hit + len(got & set(spans)), wrong + len(got - set(spans)), miss + len(set(spans) - got)
    assert 2 * hit / (2 * hit + wrong + miss) > 0.8


def test_viterbi_by_all_paths():
    rng = np.random.default_rng(0)
    emit, move, ends, n = rng.normal(size=(4, 4, 3)), rng.normal(size=(3, 3)), rng.normal(size=(2, 3)), np.array([4, 1, 3, 2])
    for i, path in enumerate(pii.viterbi(emit, n, move, ends)):
        def value(p, i=i):
            return ends[0][p[0]] + ends[1][p[-1]] + sum(emit[i, t, a] for t, a in enumerate(p)) + sum(move[a, b] for a, b in zip(p, p[1:], strict=False))
        assert tuple(path) == max(itertools.product(range(3), repeat=int(n[i])), key=value)


def test_gradient_reaches_a_maximum():
    """At the end of training, small changes of the weights don't raise the penalised likelihood."""
    rows = ["call {phone|555-0100} now", "the year 2024", "mail {email|a at b dot c}", "at home"]
    f = pii.train(rows, steps=3000, ridge=0.1, rate=0.05)

    def value(x):
        total = -0.05 * (x.emit**2).sum() - 0.05 * (x.move**2).sum() - 0.05 * (x.ends**2).sum()
        for row in rows:
            text, spans = pii.marked(row)
            words = [m[0] for m in pii.TOKEN.finditer(text)]
            e = x.scores([(words, 0, len(words))])[0][0]
            gold = []
            for m in pii.TOKEN.finditer(text):
                s = next(((a, k, b) for a, k, b in spans if a < m.end() and b > m.start()), None)
                gold.append(0 if s is None else 1 + 2 * s[1] + (m.start() > s[0]))
            a = x.ends[0] + e[0]
            for t in range(1, len(e)):
                a = np.log(np.exp(a[:, None] + x.move).sum(0)) + e[t]
            total += x.ends[0][gold[0]] + x.ends[1][gold[-1]] + sum(e[t, g] for t, g in enumerate(gold)) + sum(x.move[p, q] for p, q in zip(gold, gold[1:], strict=False)) - np.log(np.exp(a + x.ends[1]).sum())
        return total

    best, rng = value(f), np.random.default_rng(0)
    for _ in range(20):
        g = pii.Field(f.index, *(w + 0.01 * rng.normal(size=w.shape) for w in (f.emit, f.move, f.ends)))
        assert value(g) < best + 1e-3


def test_pipeline_by_brute_force(spark, field):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    good = {r.doc_id for r in quality.score(docs, labels).where("predicted = 1").collect()}
    rows = sorted((r.doc_id, r.text, r.source) for r in docs.collect() if r.doc_id in good)
    first = brute([r[:2] for r in rows])
    rows = [r for r, c in zip(rows, first, strict=True) if r[0] == c or not (r[1] or "").split()]
    new = []
    for i, text, source in rows:
        base = naive(text or "")
        new.append((i, pii.masked(text, base + pii.added_spans([text], [base], field)[0]) if text else text, source))
    copies = {r.doc_id: r.copies for r in mixing.balanced_mix(spark.createDataFrame(new, "doc_id long, text string, source string")).collect()}
    ids = dict(zip([r[0] for r in new], by_library("byte_bpe_50k.json", [r[1] for r in new], 0), strict=True))
    pieces = corpus_pipeline.run(spark, SF).collect()
    seen = {}
    for r in pieces:
        seen.setdefault(r.doc_id, []).append(r.start)
        assert r.doc_tokens == len(ids[r.doc_id])
    for i, n in copies.items():
        assert sorted(seen.get(i, [])) == sorted([*range(0, len(ids[i]), 1024)] * n)
    assert len({(r.sequence_id, r.offset) for r in pieces}) == len(pieces)


def test_stages_on_odd_rows_and_clashing_columns(spark):
    rows = [(i, f"w{i} good words here and there {i * 7}" * 3, "en", f"s{i % 3}", 10, "x", 1) for i in range(60)]
    rows += [(None, None, None, None, None, None, None), (1, rows[1][1], "en", "s1", 10, "x", 1), (1, rows[1][1], "en", "s1", 10, "x", 1), (70, "", "de", None, 0, "y", 2)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, label string, _row int")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns and out.count() > 0
        assert stage(spark, docs.limit(0), SF).count() == 0
    once = corpus_pipeline.distinct_documents(spark, docs, SF)
    assert once.where("doc_id = 1").count() == 1 and once.where("doc_id IS NULL").count() == 1
    assert corpus_pipeline.packed_documents(spark, docs, SF).select(F.countDistinct("doc_id")).first()[0] == 61


@pytest.mark.parametrize("text", [f"write to info {mark} site.org today" for mark in ("(At)", "[At]", "<AT>", "{AT}", "{aT}", "(at)")] + ["write to info at site dOt org today"])
def test_spelt_out_addresses_in_any_case(field, text):
    assert pii.pieces(text)
    assert [kind for _, kind, _ in pii.added_spans([text], [[]], field)[0]] == [kind for _, kind, _ in pii.added_spans([text.lower()], [[]], field)[0]]


def test_map_columns_and_one_choice_among_rows_of_one_id(spark):
    """Rows of equal id and text: the same one stays however the table is partitioned; a map column is kept."""
    rows = [(1, "same text here", s, {"b": 1, "a": i}, "many") for i, s in enumerate("pqrt")] + [(2, "other words", "p", None, "few"), (None, "x y z", "q", {}, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, tags map<string,int>, n_chars string")
    stays, mixes = set(), set()
    for parts in (1, 3, 7):
        df = docs.repartition(parts)
        kept = corpus_pipeline.distinct_documents(spark, df, SF)
        stays.add(str(sorted(map(str, kept.collect()))))
        mixes.add(str(sorted(map(str, corpus_pipeline.mixed_documents(spark, kept, SF).collect()))))
        assert kept.columns == docs.columns and kept.count() == 3
        assert pii.mask(kept, queries.pii_field(spark)).count() == 3
    assert len(stays) == 1 and len(mixes) == 1
