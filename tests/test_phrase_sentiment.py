"""Phrases, negators and intensifiers in the sentiment score, against a plain scan."""

import random
import re

from hostlens.functions import text as T
from hostlens.operators import text as TX

LEXICON = {"good": 0.7, "bad": -0.7, "clean": 0.4, "not bad": 0.35, "far from clean": -0.6, "from": 0.1, "good good": 0.9, "worst": -1.0, "very": 0.2}
MODS = {"very": 1.3, "really": 1.5, "slightly": 0.5}
NEGATORS = ["not", "never"]


def plain(text, lexicon, mods, negators, negation=-1.0):
    if text is None:
        return None
    t = re.findall(r"[^\W]{2,}", text.lower())
    factor = {**mods, **{w: negation for w in negators}}
    longest = max((len(p.split()) for p in lexicon), default=1)
    i, mod, found = 0, 1.0, []
    while i < len(t):
        for n in range(min(longest, len(t) - i), 0, -1):
            if " ".join(t[i : i + n]) in lexicon:
                found.append(max(-1.0, min(1.0, lexicon[" ".join(t[i : i + n])] * mod)))
                mod, i = 1.0, i + n
                break
        else:
            mod = mod * factor[t[i]] if t[i] in factor else 1.0
            i += 1
    return sum(found) / len(found) if found else 0.0


def texts():
    rng = random.Random(6)
    words = [*LEXICON, "far", "not", "never", "really", "slightly", "room", "a", "Good", "NOT", "été"]
    out = [rng.choice([" ", ", ", "\n"]).join(rng.choice(words) for _ in range(rng.randint(0, 25))) for _ in range(250)]
    return out + [None, "", "a", "room " * 50, "not " * 40 + "good", "good", "far from", "far from clean", "not not bad", "very very very worst"]


def test_both_forms_equal_a_plain_scan(spark):
    for lexicon in (LEXICON, {"good": 0.7}, {}):
        rows = [(i, t, "x") for i, t in enumerate(texts())] * 2
        df = spark.createDataFrame(rows, "id int, body string, at string").repartition(3)
        want = {i: plain(t, lexicon, MODS, NEGATORS) for i, t, _ in rows}
        for join in (False, True):
            got = TX.with_phrase_sentiment(df, "body", lexicon, NEGATORS, MODS, join=join)
            assert got.columns == ["id", "body", "at", "sentiment_score"]
            found = got.collect()
            assert len(found) == len(rows)
            for r in found:
                w, s = want[r["id"]], r["sentiment_score"]
                assert (w is None) == (s is None) and (w is None or abs(w - s) < 1e-9), (r, w)


def test_lexicon_tables_other_negation_and_defaults(spark):
    df = spark.createDataFrame([(1, "not good"), (2, "Highly recommend this place"), (3, "really not bad")], "id int, body string")
    table = spark.createDataFrame([("GOOD", 0.6), ("good", 0.8)], "phrase string, polarity double")
    got = {r["id"]: round(r["s"], 9) for r in TX.with_phrase_sentiment(df, "body", table, negation=-0.5, name="s").collect()}
    assert got == {1: -0.35, 2: 0.0, 3: 0.0}
    got = {r["id"]: round(r["s"], 9) for r in TX.with_phrase_sentiment(df, "body", name="s").collect()}
    assert got == {1: -T.DEFAULT_LEXICON["good"], 2: 0.9, 3: round(0.35 * 1.3, 9)}
    big = {f"word{i}": 0.5 for i in range(TX.MAP_WORDS)} | {"not good": -0.2}
    assert TX.with_phrase_sentiment(df, "body", big).where("sentiment_score = -0.2").count() == 1
    assert TX.with_phrase_sentiment(df.limit(0), "body", big).count() == 0


def test_long_runs_and_the_price_of_a_word(spark):
    """One text of modifiers only, and phrases at a few times the price of taking the words out of the texts."""
    import time

    from pyspark.sql import functions as F
    n = 100_000
    df = spark.createDataFrame([(1, "very " * n), (2, "really " * n + "x"), (3, "not " * n + "clean"), (4, "good " * n), (5, "not " * (n + 1) + "clean")], "id int, body string")
    lexicon = {k: v for k, v in LEXICON.items() if k != "very"}
    got = {r["id"]: round(r["s"], 6) for r in TX.with_phrase_sentiment(df, "body", lexicon, NEGATORS, MODS, name="s", join=False).collect()}
    assert got == {1: 0.0, 2: 0.0, 3: 0.4, 4: 0.9, 5: -0.4}

    rng = random.Random(8)
    words = [*LEXICON, *MODS, *NEGATORS, *(f"word{i}" for i in range(40))]
    many = spark.createDataFrame([(i, " ".join(rng.choice(words) for _ in range(400))) for i in range(3000)], "id int, body string").repartition(4).persist()
    took = {}
    for name, c in (("tokens", T.tokens("body")), ("score", T.phrase_sentiment_from_tokens(T.tokens("body"), LEXICON, T.modifiers(NEGATORS, MODS, -1.0)))) * 3:
        began = time.monotonic()
        many.select(F.col("id"), c.alias("c")).write.format("noop").mode("overwrite").save()
        took[name] = min(took.get(name, 1e9), time.monotonic() - began)
    many.unpersist()
    assert took["score"] < 8 * took["tokens"] + 0.5, took
