"""Text statistics: token counts, lexicon sentiment, TF-IDF keywords."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text as T
from ..session import materialize
from .joins import bounded_broadcast
from .vocabulary import frequent_terms


def token_counts(df: DataFrame, id_col: str, text_col: str,
                 stop_words: Iterable[str] = ()) -> DataFrame:
    """(id, token, n): tokens per document minus stop words, counted."""
    toks = T.without_words(T.tokens(F.col(text_col)), stop_words)
    return (df.select(F.col(id_col), F.explode(toks).alias("token"))
              .groupBy(id_col, "token").agg(F.count(F.lit(1)).alias("n")))


# A lexicon of more words than this is joined in as a table.
MAP_WORDS = 100


def with_sentiment(df: DataFrame, text_col: str, lexicon: Mapping[str, float] | DataFrame = T.DEFAULT_LEXICON,
                   negators: Iterable[str] = T.DEFAULT_NEGATORS, name: str = "sentiment_score") -> DataFrame:
    """Adds the lexicon polarity of ``text_col``.

    A small mapping is looked up inside the row (no shuffle).  A large one, or
    a table (word, polarity), is joined to the tokens instead, so the time per
    token does not grow with the lexicon: see :func:`sentiment_by_join`.
    """
    if isinstance(lexicon, DataFrame) or len(lexicon) > MAP_WORDS:
        return sentiment_by_join(df, text_col, lexicon, negators, name)
    tmp = f"__{name}_tokens"
    return (df.withColumn(tmp, T.tokens(F.col(text_col)))
              .withColumn(name, T.sentiment_from_tokens(F.col(tmp), lexicon, list(negators)))
              .drop(tmp))


def sentiment_by_join(df: DataFrame, text_col: str, lexicon: Mapping[str, float] | DataFrame,
                      negators: Iterable[str] = T.DEFAULT_NEGATORS, name: str = "sentiment_score") -> DataFrame:
    """The same polarity through a join of (text, token) rows with the lexicon.

    The rows are stored first with a number each; only tokens of the lexicon
    leave the join, already summed per row (the row's tokens sit together, so
    the partial aggregate sends one record per row).  The lexicon is broadcast
    behind a row count.
    """
    spark = df.sparkSession
    if not isinstance(lexicon, DataFrame):
        lexicon = spark.createDataFrame([(k, float(v)) for k, v in lexicon.items()], "word string, polarity double")
    words = lexicon.groupBy(F.lower(F.col("word")).alias("__word")).agg(F.avg("polarity").alias("__polarity"))
    side, _ = bounded_broadcast(words)
    rows = materialize(df.withColumn("__row", F.monotonically_increasing_id()), "sentiment-rows")
    toks = rows.select("__row", T.tokens(F.col(text_col)).alias("__t"))
    flags = F.transform("__t", lambda t, i: F.struct(t.alias("w"), F.when(i > 0, F.get(F.col("__t"), i - 1)).alias("p")))
    each = toks.select("__row", F.explode(flags).alias("x")).select("__row", F.col("x.w").alias("__word"), F.col("x.p").alias("__before"))
    signed = F.when(F.col("__before").isin(*sorted(set(negators))), -F.col("__polarity")).otherwise(F.col("__polarity"))
    scored = each.join(side, "__word").groupBy("__row").agg(F.avg(signed).alias(name))
    return rows.join(scored, "__row", "left").withColumn(
        name, F.when(F.col(text_col).isNotNull(), F.coalesce(name, F.lit(0.0)))).drop("__row")


def with_phrase_sentiment(df: DataFrame, text_col: str, lexicon: Mapping[str, float] | DataFrame | None = None,
                          negators: Iterable[str] = T.DEFAULT_NEGATORS, intensifiers: Mapping[str, float] = T.DEFAULT_INTENSIFIERS,
                          negation: float = -1.0, name: str = "sentiment_score", join: bool | None = None) -> DataFrame:
    """Adds the polarity of ``text_col`` by a lexicon of words and phrases, with negators and intensifiers.

    See :func:`hostlens.functions.text.phrase_sentiment_from_tokens` for how matches count. A small mapping
    (default: the built-in words and phrases) is looked up inside the row; a large one, or a table
    (phrase, polarity), is joined to the texts' word sequences. A null text has no score.
    """
    lexicon = {**T.DEFAULT_LEXICON, **T.DEFAULT_PHRASES} if lexicon is None else lexicon
    mods = T.modifiers(negators, intensifiers, negation)
    if isinstance(lexicon, DataFrame) or join or (join is None and len(lexicon) > MAP_WORDS):
        return _phrase_sentiment_by_join(df, text_col, lexicon, mods, name)
    score = T.phrase_sentiment_from_tokens(T.tokens(F.col(text_col)), lexicon, mods)
    return df.withColumn(name, F.when(F.col(text_col).isNotNull(), score))


def _phrase_sentiment_by_join(df: DataFrame, text_col: str, lexicon: Mapping[str, float] | DataFrame,
                              mods: Mapping[str, float], name: str) -> DataFrame:
    """Only word sequences that the lexicon holds leave the join; a row's are gathered and gone through from left to
    right beside its tokens. The rows are stored first with a number each; the lexicon is broadcast behind a row
    count, and joined by a shuffle beyond it."""
    spark = df.sparkSession
    if not isinstance(lexicon, DataFrame):
        lexicon = spark.createDataFrame([(k, float(v)) for k, v in lexicon.items()], "phrase string, polarity double")
    entries = materialize(lexicon.groupBy(F.lower(F.col("phrase")).alias("__phrase")).agg(F.avg("polarity").alias("__polarity")), "phrase-lexicon")
    longest = entries.agg(F.max(F.size(F.split("__phrase", " ")))).first()[0] or 1
    side, _ = bounded_broadcast(entries, materialized=True)
    rows = materialize(df.withColumn("__row", F.monotonically_increasing_id()).withColumn("__t", T.tokens(F.col(text_col))), "phrase-rows")
    places = F.flatten(F.transform("__t", lambda t, i: F.transform(
        F.sequence(F.lit(1), F.least(F.lit(longest), F.size("__t") - i)),
        lambda n: F.struct(i.alias("at"), (-n).alias("minus"), F.array_join(F.slice(F.col("__t"), i + 1, n), " ").alias("phrase")))))
    each = rows.where(F.size("__t") > 0).select("__row", F.explode(places).alias("x")).select("__row", "x.at", "x.minus", F.col("x.phrase").alias("__phrase"))
    met = each.join(side, "__phrase").groupBy("__row").agg(F.array_sort(F.collect_list(F.struct("at", "minus", "__polarity"))).alias("__found"))
    factor = T.number_map(mods)

    def run(acc, word):
        return F.coalesce(acc * factor[word], F.lit(1.0))

    def step(acc, x):
        before = F.slice(F.col("__t"), acc["end"] + 1, F.greatest(x["at"] - acc["end"], F.lit(0)))
        polarity = T.clipped(x["__polarity"] * F.aggregate(before, F.lit(1.0), run))
        hit = x["at"] >= acc["end"]
        return F.struct(F.when(hit, acc["s"] + polarity).otherwise(acc["s"]).alias("s"), F.when(hit, acc["n"] + 1).otherwise(acc["n"]).alias("n"),
                        F.when(hit, x["at"] - x["minus"]).otherwise(acc["end"]).alias("end"))

    zero = F.struct(F.lit(0.0).alias("s"), F.lit(0).alias("n"), F.lit(0).alias("end"))
    score = F.aggregate("__found", zero, step, lambda acc: acc["s"] / acc["n"])
    scored = rows.join(met, "__row", "left").withColumn(name, F.when(F.col(text_col).isNotNull(), F.coalesce(score, F.lit(0.0))))
    return scored.drop("__row", "__t", "__found")


def tfidf_keywords(df: DataFrame, doc_col: str, text_col: str, group_col: str | None = None,
                   k: int = 20, stop_words: Iterable[str] = (), summary: int = 2000,
                   max_groups: int = 10_000, stage: bool = True) -> DataFrame:
    """Top-``k`` TF-IDF terms per group, weights summed over documents.

    Per group: vocabulary = the ``k`` terms with the highest total count
    (ties -> term); ``idf = ln((1+n)/(1+df)) + 1`` with ``n`` documents in the
    group; each document's weights ``tf*idf`` are divided by their L2 norm
    over the vocabulary; the score of a term is the sum over documents.

    Plan: documents are tokenized once (staged in the shared checkpoint
    folder when ``stage``).  The vocabulary comes from summaries of
    ``summary`` terms a group and an exact recount
    (:func:`hostlens.operators.vocabulary.frequent_terms`), so that no
    shuffle carries all terms.  The vocabulary (<= k terms per
    group) and then the idf table are attached to every document through a
    broadcast of one row per group, once a count shows at most
    ``max_groups`` groups; a document's term counts, weights and norm are
    computed inside its row.  So every shuffle carries partially aggregated
    (group, term) rows only -- no per-token or per-document shuffle.  (With
    more groups than the bound the two small tables are shuffle-joined.)
    Each row is one document (``doc_col`` names it for the caller; the
    computation needs no document key because nothing is regrouped by
    document).  Output ``(group, term, score)``.
    """
    g = group_col or "__group"
    base = df if group_col else df.withColumn(g, F.lit("all"))
    docs = base.select(F.col(g), T.without_words(T.tokens(F.col(text_col)), stop_words).alias("__toks"))
    if stage:
        docs = materialize(docs, "tfidf-docs")

    vocab = frequent_terms(docs, g, "__toks", k, size=summary)
    per_group = vocab.groupBy(g).agg(F.array_sort(F.collect_list("term")).alias("__vocab"))
    n_docs = docs.groupBy(g).agg(F.count(F.lit(1)).alias("__n"))
    groups, small = bounded_broadcast(n_docs.join(per_group, on=g, how="left"), max_groups)
    bc = F.broadcast if small else (lambda x: x)   # beyond the bound: shuffle joins on the group

    # term counts of the vocabulary inside each document row
    counted = docs.join(groups, on=g).select(
        g, "__n",
        F.filter(F.transform(F.coalesce(F.col("__vocab"), F.array().cast("array<string>")),
                             lambda v: F.struct(v.alias("term"),
                                                F.size(F.filter(F.col("__toks"), lambda t: t == v)).alias("tf"))),
                 lambda x: x["tf"] > 0).alias("__tf"))
    dfreq = (counted.select(g, "__n", F.explode("__tf").alias("x"))
                    .groupBy(g, "__n", F.col("x.term").alias("term")).agg(F.count(F.lit(1)).alias("__df")))
    idf = (dfreq.select(g, F.struct("term", (F.log((1 + F.col("__n")) / (1 + F.col("__df"))) + 1).alias("idf"))
                        .alias("e"))
                .groupBy(g).agg(F.map_from_entries(F.collect_list("e")).alias("__idf")))
    weighted = counted.where(F.size("__tf") > 0).join(bc(idf), on=g).select(
        g, F.transform("__tf", lambda x: F.struct(x["term"].alias("term"),
                                                   (x["tf"] * F.col("__idf")[x["term"]]).alias("w"))).alias("__w"))
    normed = weighted.select(
        g, "__w", F.sqrt(F.aggregate("__w", F.lit(0.0), lambda a, x: a + x["w"] * x["w"])).alias("__norm"))
    out = (normed.select(g, "__norm", F.explode("__w").alias("x"))
                 .groupBy(g, F.col("x.term").alias("term"))
                 .agg(F.sum(F.col("x.w") / F.col("__norm")).alias("score")))
    return out if group_col else out.drop(g)
