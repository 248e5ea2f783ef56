"""Token files and packing against the tokenizer itself."""

import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from hostlens.llm import packing, pfor, queries, token_output
from hostlens.llm.tokens import TokenIds

SF = "/root/testdata/sf0.001"
ODD = [None, "", " ", "a", "The  the\n\n the\tThe", "x y　z  w  \n q", "don't DON'T 'S <|endoftext|> é é ΑΣ Σ", "word " * 30_000,
       "a\x1cb \x85 c", "  lead", "trail  ", "\n\n\n", "99 1,000 9a9", "\U0001f600‍\U0001f600", "ﬁ Ⅷ İ",
       "see <|endoftext|> here", "a<|startoftext|>b<|EndOfText|>", "<|endoftext|>", " <|endoftext|>\n\n<|pad|> <| x"]


def by_library(name, texts, end):
    t = Tokenizer.from_file(public_tokenizers.path(name))
    return [np.array([*t.encode(x or "", add_special_tokens=False).ids, end], "<u4") for x in texts]


@pytest.mark.parametrize("name,spaced", [("word_bpe_49k.json", False), ("byte_bpe_50k.json", True)])
def test_cached_words_give_the_library_ids(name, spaced):
    got = TokenIds.of(public_tokenizers.path(name), spaced).encode(ODD)
    for x, want, text in zip(got, by_library(name, ODD, 0), ODD, strict=True):
        assert x.tolist() == want[:-1].tolist(), text and text[:50]


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet=st.sampled_from("aAbß'sé́Σ .,!9\n\t\xa0 \x1f|<>%ﬁ​"), max_size=40))
def test_cached_words_on_drawn_texts(text):
    for name, spaced in (("word_bpe_49k.json", False), ("byte_bpe_50k.json", True)):
        got = TokenIds.of(public_tokenizers.path(name), spaced).encode([text])[0]
        assert got.tolist() == by_library(name, [text], 0)[0][:-1].tolist()


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 2**32 - 1) | st.integers(0, 300), min_size=1, max_size=300), st.sampled_from([0.0, 50.0, 90.0, 100.0]))
def test_pfor_block_round_trip(ids, percentile):
    assert pfor.decode_block(memoryview(pfor.encode_block(np.array(ids, "<u4"), percentile))).tolist() == ids


def test_pfor_file_index():
    ids = np.random.default_rng(1).integers(0, 50_000, 3 * pfor.BLOCK + 5).astype("<u4")
    data = pfor.encode_file(ids, np.array([3, 9]), np.array([10, len(ids) - 10]))
    got, docs, lengths = pfor.decode_file(data)
    assert (got == ids).all() and docs.tolist() == [3, 9] and lengths[0] == 10
    assert (pfor.read_block(data, 3) == ids[3 * pfor.BLOCK :]).all()
    with pytest.raises(ValueError):
        pfor.decode_file(b"\0" * 64)


def test_op4_is_what_the_tokenizer_says(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").orderBy("doc_id").toPandas()
    want, at = {}, 0
    for doc_id, ids in zip(docs.doc_id, by_library("word_bpe_49k.json", docs.text, 1), strict=True):
        want[doc_id] = (at, len(ids), zlib.crc32(ids.tobytes()))
        at += len(ids)
    got = {r.doc_id: (r.start, r.n_tokens, r.ids_crc32) for r in queries.op4_token_files(spark, SF).collect()}
    assert got == want


def odd_docs(spark):
    rows = [(i if i != 3 else None, t, "x", None, 1) for i, t in enumerate(ODD)] + [(5, "same id", None, "s", 2), (5, "same id", None, "s", 2)]
    return spark.createDataFrame(rows, "doc_id long, text string, file string, source string, start int")


def test_token_files_odd_rows(spark):
    path, docs = public_tokenizers.path("word_bpe_49k.json"), odd_docs(spark)
    folder, written = token_output.write_tokens(docs, path, 1, ids_per_file=1000)
    got = token_output.read_tokens(spark, folder, written, keep_ids=True).orderBy("start").collect()
    assert written.count() > 1 and len(got) == docs.count()
    assert [r.doc_id for r in got] == [*sorted(r.doc_id for r in got if r.doc_id is not None), None]
    assert [r.start for r in got] == np.concatenate([[0], np.cumsum([r.n_tokens for r in got])])[:-1].tolist()
    want = {ids.tobytes() for ids in by_library("word_bpe_49k.json", [*ODD, "same id"], 1)}
    assert {bytes(r.ids) for r in got} == want
    assert token_output.read_tokens(spark, *token_output.write_tokens(docs.limit(0), path, 1)).count() == 0


def check_packing(pieces, texts, window=1024):
    by_doc, by_seq = {}, {}
    for r in pieces:
        by_doc.setdefault((r.doc_id, r.doc_tokens), []).append(r)
        by_seq.setdefault(r.sequence_id, []).append(r)
        assert 0 < r.length <= window and zlib.crc32(r.ids) == r.ids_crc32
    for rows in by_seq.values():
        at = 0
        for r in sorted(rows, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= window
    return by_doc, by_seq


def test_packing_covers_every_id_once(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    path = public_tokenizers.path("byte_bpe_50k.json")
    pieces = packing.pack(docs, path, keep_ids=True).collect()
    texts = {r.doc_id: r.text for r in docs.collect()}
    by_doc, by_seq = check_packing(pieces, texts)
    want = dict(zip(texts, by_library("byte_bpe_50k.json", texts.values(), 0), strict=True))
    assert {k for k, _ in by_doc} == set(texts)
    for (doc_id, _), rows in by_doc.items():
        assert b"".join(bytes(r.ids) for r in sorted(rows, key=lambda r: r.start)) == want[doc_id].tobytes()
    used = sum(r.length for r in pieces)
    assert used / (1024 * len(by_seq)) > 0.97


def test_packing_odd_rows(spark):
    path = public_tokenizers.path("byte_bpe_50k.json")
    pieces = packing.pack(odd_docs(spark), path, window=16, keep_ids=True, bin_pieces=50).collect()
    check_packing(pieces, ODD, 16)
    want = sum(len(x) for x in by_library("byte_bpe_50k.json", [*ODD, "same id", "same id"], 0))
    assert sum(r.length for r in pieces) == want
    assert packing.pack(odd_docs(spark).limit(0), path).count() == 0


@settings(max_examples=50, deadline=None)
@given(st.lists(st.integers(1, 32), max_size=80))
def test_best_fit_decreasing_by_brute_force(lengths):
    lengths = np.array(lengths, np.int64)
    where, offset = packing.best_fit_decreasing(lengths, 32)
    rooms = []
    for k in np.argsort(-lengths, kind="stable"):
        fits = [(room, w) for w, room in enumerate(rooms) if room >= lengths[k]]
        if fits:
            assert rooms[where[k]] == min(fits)[0]
        else:
            assert where[k] == len(rooms)
            rooms.append(32)
        assert offset[k] == 32 - rooms[where[k]]
        rooms[where[k]] -= lengths[k]


def test_texts_may_quote_special_tokens():
    for name, spaced in (("word_bpe_49k.json", False), ("byte_bpe_50k.json", True)):
        added = [t.content for t in Tokenizer.from_file(public_tokenizers.path(name)).get_added_tokens_decoder().values()]
        texts = [x + t + y for t in added for x in ("", "a", "see ", "\n") for y in ("", "b", " here", "\n\n", t)]
        got = TokenIds.of(public_tokenizers.path(name), spaced).encode(texts)
        assert [x.tolist() for x in got] == [x[:-1].tolist() for x in by_library(name, texts, 0)]


def test_equal_rows_are_dealt_over_bins(spark):
    """A third of all rows have no id and the same text."""
    docs = spark.range(3000).select(F.when(F.col("id") % 3 > 0, F.col("id")).alias("doc_id"), F.when(F.col("id") % 3 > 0, F.concat(F.lit("word "), F.col("id"))).otherwise("a b c").alias("text"))
    got = packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"), window=64, bin_pieces=100).withColumn("bin", F.shiftright("sequence_id", 32))
    sizes = [r["count"] for r in got.groupBy("bin").count().collect()]
    assert len(sizes) > 20 and max(sizes) < 200 and sum(sizes) == 3000


def test_bins_are_bounded(spark):
    docs = spark.range(300).select(F.col("id").alias("doc_id"), F.lit("a b c").alias("text"))
    got = packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"), window=64, bin_pieces=40)
    assert got.select(F.floor(F.col("sequence_id") / (1 << 32))).distinct().count() > 3
