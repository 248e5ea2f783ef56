"""The registered queries opN_<name> and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from hostlens.llm import hnsw, langmix, lexical, mixing, neardup, packing, phrases, pii, pii_examples, quality, substring, token_output, topk, toxicity
from hostlens.llm.common import table

EVERY_20TH = "vec_id % 20 = 0"


def op1_super_kmer_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring.remove_repeats(table(spark, sf_dir, "documents"), window=20)


def op2_dart_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.classes(table(spark, sf_dir, "documents")).drop("first", "_row")


def op3_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"), EVERY_20TH, k=20, scale=64.0)


def op5_cube_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.balanced_mix(table(spark, sf_dir, "documents"), weights=(5, 2, 1), most=3.0)


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def pii_field(spark: SparkSession) -> pii.Field:
    return pii.train(pii.labelled_rows(spark.createDataFrame([(r,) for r in pii_examples.ROWS], "text string")))


def op4_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder, written = token_output.write_tokens(table(spark, sf_dir, "documents"), tokenizer_path("word_bpe_49k.json"), end_id=1)
    return token_output.read_tokens(spark, folder, written)


def op6_crf_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find(table(spark, sf_dir, "documents"), pii_field(spark))


def op7_fourier_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), "quality", folds=5, fold=0, threshold=0.3)


def op8_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"), window=1024, end_id=0)


def op9_hnsw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hnsw.nearest(table(spark, sf_dir, "embeddings"), EVERY_20TH, k=20)


def op10_kneser_ney_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), "toxic", folds=4, fold=2, threshold=0.3)


def op11_phrase_quicksort(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(table(spark, sf_dir, "documents"), words=3, least=10, covered_percent=50, top=2000)


def op12_language_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langmix.predict(table(spark, sf_dir, "documents"), folds=5, fold=0, penalty=1.0)


def op13_blas_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.search(spark, table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), k=10)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_super_kmer_dedup": op1_super_kmer_dedup,
    "op2_dart_minhash": op2_dart_minhash,
    "op3_exact_topk": op3_exact_topk,
    "op4_token_files": op4_token_files,
    "op5_cube_mix": op5_cube_mix,
    "op6_crf_pii": op6_crf_pii,
    "op7_fourier_quality": op7_fourier_quality,
    "op8_best_fit_packing": op8_best_fit_packing,
    "op9_hnsw": op9_hnsw,
    "op10_kneser_ney_toxicity": op10_kneser_ney_toxicity,
    "op11_phrase_quicksort": op11_phrase_quicksort,
    "op12_language_mixture": op12_language_mixture,
    "op13_blas_search": op13_blas_search,
}

ORACLE_SQL: dict[str, str] = {
    "op3_exact_topk": """
        WITH v AS (
          SELECT vec_id, [CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS e, row_number() OVER () AS row
          FROM (SELECT DISTINCT vec_id, embedding FROM embeddings)
          WHERE embedding IS NOT NULL AND vec_id IS NOT NULL
            AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
        s AS (
          SELECT q.row AS query_row, q.vec_id AS query_id, c.vec_id AS vec_id,
                 CAST(list_sum([p[1] * p[2] FOR p IN list_zip(q.e, c.e)]) AS BIGINT) AS score
          FROM v q JOIN v c ON q.row <> c.row WHERE q.vec_id % 20 = 0)
        SELECT query_id, CAST(row_number() OVER (PARTITION BY query_row ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
        FROM s QUALIFY rank <= 20""",
    "op11_phrase_quicksort": r"""
        WITH pieces AS (
          SELECT coalesce(lang, 'und') AS lang,
                 unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                              '[.,;:!?\x0A-\x0D]')) AS piece
          FROM documents),
        ws AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
        starts AS (SELECT lang, unnest(list_zip(w, w[2:], w[3:])) AS x FROM ws),
        grams AS (SELECT lang, 1 AS k, x[1] AS phrase FROM starts
                  UNION ALL SELECT lang, 2, x[1] || ' ' || x[2] FROM starts WHERE x[2] IS NOT NULL
                  UNION ALL SELECT lang, 3, x[1] || ' ' || x[2] || ' ' || x[3] FROM starts WHERE x[3] IS NOT NULL),
        f AS MATERIALIZED (SELECT lang, k, phrase, count(*) AS n FROM grams GROUP BY ALL),
        totals AS (SELECT lang, CAST(sum(n) AS BIGINT) AS n FROM f WHERE k = 1 GROUP BY lang),
        cand AS (SELECT lang, k, phrase, n AS a, string_split(phrase, ' ') AS w FROM f WHERE k > 1 AND n >= 10),
        cuts AS (SELECT lang, k, phrase, a, c, array_to_string(w[1:c], ' ') AS lp, array_to_string(w[c + 1:], ' ') AS rp
                 FROM cand, (VALUES (1), (2)) AS places(c) WHERE c < k),
        lefts AS MATERIALIZED (SELECT u.*, x.n AS l FROM cuts u JOIN f x ON x.lang = u.lang AND x.phrase = u.lp AND x.k = u.c AND x.n >= 10),
        both_parts AS MATERIALIZED (SELECT u.*, y.n AS r FROM lefts u JOIN f y ON y.lang = u.lang AND y.phrase = u.rp AND y.k = u.k - u.c AND y.n >= 10),
        scored AS (
          SELECT lang, k, phrase, a, l, r, CAST((CAST(1000000 AS HUGEINT) * a * a) // (CAST(l AS HUGEINT) * r) AS BIGINT) AS score, c
          FROM both_parts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, c) = 1),
        inside AS (
          SELECT lang, phrase, max(a) AS longest
          FROM (SELECT lang, array_to_string(w[1:2], ' ') AS phrase, a FROM cand WHERE k = 3
                UNION ALL SELECT lang, array_to_string(w[2:3], ' '), a FROM cand WHERE k = 3) GROUP BY ALL),
        kept AS (SELECT s.* FROM scored s LEFT JOIN inside i USING (lang, phrase) WHERE i.longest IS NULL OR 100 * i.longest < 50 * s.a)
        SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, t.n AS n, score
        FROM kept JOIN totals t USING (lang) QUALIFY rank <= 2000""",
    "op13_blas_search": r"""
        WITH d AS (
          SELECT row_number() OVER () AS row, doc_id,
                 regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS t
          FROM documents),
        total AS (SELECT CAST(count(*) AS BIGINT) AS docs, CAST(sum(len(t)) AS BIGINT) AS terms FROM d WHERE len(t) > 0),
        tf AS (SELECT row, term, count(*) AS tf FROM (SELECT row, unnest(t) AS term FROM d) GROUP BY ALL),
        df AS (SELECT term, CAST(floor(1000 * ln((2 * docs + 2) / (2 * count(*) + 1))) AS BIGINT) AS w FROM tf, total GROUP BY term, docs),
        m AS (SELECT row, doc_id, 100 - 90 + (90 * len(t) * docs) // terms AS m FROM d, total WHERE len(t) > 0),
        i AS (
          SELECT row_number() OVER () AS item, item_id,
                 unnest(list_distinct(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                         '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+'))) AS term
          FROM benchmark),
        s AS (
          SELECT item, item_id, row, doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * m))) AS BIGINT) AS score
          FROM i JOIN tf USING (term) JOIN df USING (term) JOIN m USING (row) GROUP BY ALL)
        SELECT item_id, CAST(row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id NULLS LAST) AS INTEGER) AS rank, doc_id, score
        FROM s WHERE score > 0 QUALIFY rank <= 10""",
}
