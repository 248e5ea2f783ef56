"""Text column functions: English filter, cleaning, tokens, sentiment.

Everything here is a built-in expression evaluated row by row on the
executors; nothing needs a Python worker.  The sentiment score is a
lexicon lookup over the token array with higher-order functions (a
``map`` literal looked up per token), so scoring a review costs no join
and no shuffle.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from ._util import col_of

# --- fixed values: foreign-language marker words and accented letters -------
# A review is dropped when one of these appears as a whole word (case-sensitive)
# or when it holds one of the accented letters.
FRENCH_WORDS = ["le", "la", "les", "un", "une", "est", "et", "par", "pour", "mais"]
GERMAN_WORDS = ["der", "die", "das", "ein", "eine", "und", "weil", "aber", "von"]
SPANISH_WORDS = ["el", "la", "los", "las", "un", "muy", "es", "y", "por", "el", "porque", "pero"]
ACCENT_CLASS = "[áéíóúñü¿¡äöüßàâæçèéêëîïôùûüÿœ]"
# ---------------------------------------------------------------------------

TAG = r"<[^>]*>"
NON_ASCII = r"[^\x00-\x7F]"
TOKEN = r"[\p{L}\p{N}_]{2,}"      # words of >= 2 letters/digits/underscore
BREAK_TAG_ANY = r"(?i)<br\s*/?\s*>"
EDGE_SPACE = r"^\s+|\s+$"


def word_list_pattern(words: Iterable[str]) -> str:
    """Whole-word alternation ``\\b(w1|w2|...)\\b``."""
    return r"\b(" + "|".join(words) + r")\b"


DEFAULT_MARKER_PATTERN = word_list_pattern(SPANISH_WORDS + GERMAN_WORDS + FRENCH_WORDS)


def is_ascii_text(c) -> Column:
    """False for NULL; else true when no non-ASCII character remains after
    removing ``<...>`` tags."""
    c = col_of(c)
    return F.coalesce(c.isNotNull() & ~F.regexp_replace(c, TAG, "").rlike(NON_ASCII), F.lit(False))


def has_marker_words(c, pattern: str = DEFAULT_MARKER_PATTERN) -> Column:
    return F.coalesce(col_of(c).rlike(pattern), F.lit(False))


def has_accents(c, accent_class: str = ACCENT_CLASS) -> Column:
    return F.coalesce(col_of(c).rlike(accent_class), F.lit(False))


def is_english(c, pattern: str = DEFAULT_MARKER_PATTERN,
               accent_class: str = ACCENT_CLASS) -> Column:
    """Not NULL, ASCII after tag removal, no marker word, no accent."""
    return is_ascii_text(c) & ~has_marker_words(c, pattern) & ~has_accents(c, accent_class)


def clean_comments(c) -> Column:
    """Remove break tags in any spelling, then trim surrounding whitespace."""
    return F.regexp_replace(F.regexp_replace(col_of(c), BREAK_TAG_ANY, ""), EDGE_SPACE, "")


def clean_comments_compat(c) -> Column:
    """Old behaviour: drop every 'br' letter pair (also inside words), trim."""
    return F.regexp_replace(F.replace(col_of(c), F.lit("br"), F.lit("")), EDGE_SPACE, "")


def tokens(c) -> Column:
    """Lower-cased words of two or more word characters, in text order."""
    return F.regexp_extract_all(F.lower(col_of(c)), F.lit(TOKEN), 0)


def without_words(token_array, stop_words: Iterable[str]) -> Column:
    """Drop stop words from a token array (row-local, no join)."""
    stops = F.array(*[F.lit(w) for w in sorted(set(stop_words))])
    return F.filter(col_of(token_array), lambda t: ~F.array_contains(stops, t))


# English function words (own list)
ENGLISH_STOP_WORDS = """
a about above after again against all almost alone along already also although always am among an and
another any anyone anything are around as at back be became because become been before behind being below
between both but by can cannot could did do does doing done down during each either else enough etc even
ever every everyone everything few for from further get give go had has have having he hence her here hers
herself him himself his how however i if in indeed into is it its itself just keep last least less made many
may me might mine more most mostly move much must my myself namely neither never nevertheless next no nobody
none nor not nothing now nowhere of off often on once one only onto or other others otherwise our ours
ourselves out over own per perhaps please put rather re same see seem seemed seeming seems several she should
since so some somehow someone something sometimes somewhere still such take than that the their theirs them
themselves then there thereby therefore these they this those though through throughout thus to together too
toward towards two under until up upon us very via was we well were what whatever when where whether which
while who whoever whole whom whose why will with within without would yet you your yours yourself yourselves
""".split()



def english_stop_words() -> list[str]:
    """The list that a vectoriser's ``stop_words='english'`` names, where scikit-learn is installed; an own one otherwise."""
    try:
        from sklearn.feature_extraction.text import ENGLISH_STOP_WORDS as named
    except ImportError:
        return ENGLISH_STOP_WORDS
    return sorted(named)


# Generic default lexicon (own values, English review vocabulary).
DEFAULT_LEXICON: dict[str, float] = {
    "amazing": 0.6, "annoying": -0.6, "attentive": 0.4, "awesome": 0.9, "awful": -1.0, "bad": -0.7, "beautiful": 0.85, "best": 1.0,
    "boring": -0.6, "bright": 0.5, "broken": -0.4, "charming": 0.7, "cheerful": 0.6, "clean": 0.37, "cold": -0.3, "comfortable": 0.4,
    "comfy": 0.4, "convenient": 0.35, "cozy": 0.4, "cramped": -0.4, "dated": -0.2, "delicious": 0.9, "delightful": 0.9, "dirty": -0.6,
    "disappointed": -0.7, "disappointing": -0.65, "disgusting": -1.0, "dusty": -0.4, "enjoyable": 0.5, "enjoyed": 0.5, "excellent": 1.0,
    "fabulous": 0.8, "fantastic": 0.85, "filthy": -0.8, "fine": 0.35, "friendly": 0.45, "fresh": 0.3, "fun": 0.3, "gorgeous": 0.8,
    "great": 0.8, "good": 0.7, "happy": 0.75, "hate": -0.8, "helpful": 0.45, "horrible": -1.0, "hospitable": 0.5, "ideal": 0.85,
    "impeccable": 0.75, "incredible": 0.85, "kind": 0.55, "leaking": -0.4, "lousy": -0.6, "love": 0.55, "loved": 0.65, "lovely": 0.5,
    "mediocre": -0.45, "modern": 0.25, "nice": 0.6, "noisy": -0.4, "outstanding": 0.75, "overpriced": -0.5, "peaceful": 0.45, "perfect": 1.0,
    "pleasant": 0.7, "poor": -0.45, "quiet": 0.2, "relaxing": 0.45, "rude": -0.3, "rusty": -0.3, "safe": 0.45, "small": -0.25,
    "smelly": -0.5, "spacious": 0.35, "spotless": 0.6, "stunning": 0.6, "superb": 0.95, "terrible": -1.0, "thoughtful": 0.4, "tidy": 0.35,
    "ugly": -0.7, "uncomfortable": -0.5, "unpleasant": -0.65, "unsafe": -0.5, "warm": 0.45, "welcoming": 0.5, "wonderful": 1.0, "worst": -1.0,
}
DEFAULT_NEGATORS = ["never", "no", "not"]

# Phrases and intensifiers (own values): a phrase counts as a whole, an intensifier multiplies what follows it.
DEFAULT_PHRASES: dict[str, float] = {
    "as described": 0.3, "far from clean": -0.6, "highly recommend": 0.9, "home away from home": 0.8, "not bad": 0.35,
    "waste of money": -0.9, "worth every penny": 0.9, "would not recommend": -0.9, "would not stay": -0.8,
}
DEFAULT_INTENSIFIERS: dict[str, float] = {
    "absolutely": 1.4, "barely": 0.5, "extremely": 1.5, "fairly": 0.9, "incredibly": 1.5, "quite": 1.1, "rather": 0.9,
    "really": 1.3, "slightly": 0.5, "so": 1.2, "somewhat": 0.6, "super": 1.4, "too": 1.2, "very": 1.3,
}


def sentiment_from_tokens(token_array, lexicon: Mapping[str, float] = DEFAULT_LEXICON,
                          negators: Iterable[str] = DEFAULT_NEGATORS) -> Column:
    """Mean polarity of the lexicon words in a token array.

    A word right after a negator counts with flipped sign.  No lexicon word
    -> 0.0.  One left-to-right ``aggregate`` over the array whose
    accumulator carries (sum, hits, previous token): the array is referenced
    once, so even when Catalyst inlines the tokenizer into a pushed-down
    filter the text is tokenized once per row, not once per token.
    """
    toks = col_of(token_array)
    lex = F.create_map(*[x for k in sorted(lexicon) for x in (F.lit(k), F.lit(float(lexicon[k])))])
    negs = F.array(*[F.lit(w) for w in sorted(set(negators))]) if negators else F.array().cast("array<string>")
    zero = F.struct(F.lit(0.0).alias("s"), F.lit(0).alias("n"), F.lit(None).cast("string").alias("p"))

    def step(acc, t):
        pol = lex[t]
        signed = F.when(F.array_contains(negs, acc["p"]), -pol).otherwise(pol)
        return F.struct(F.when(pol.isNull(), acc["s"]).otherwise(acc["s"] + signed).alias("s"),
                        (acc["n"] + F.when(pol.isNull(), 0).otherwise(1)).alias("n"),
                        t.alias("p"))

    def finish(acc):
        return F.when(acc["n"] > 0, acc["s"] / acc["n"]).otherwise(F.lit(0.0))

    return F.aggregate(toks, zero, step, finish)


def longest_phrase(lexicon: Iterable[str]) -> int:
    """Words of the longest entry of a lexicon."""
    return max((len(w.split(" ")) for w in lexicon), default=1)


def modifiers(negators: Iterable[str], intensifiers: Mapping[str, float], negation: float) -> dict[str, float]:
    """What a word in front multiplies a polarity with."""
    return {**{k: float(v) for k, v in intensifiers.items()}, **{w: float(negation) for w in negators}}


def number_map(values: Mapping[str, float]) -> Column:
    entries = [x for k in sorted(values) for x in (F.lit(k), F.lit(float(values[k])))]
    return F.create_map(*entries) if entries else F.create_map().cast("map<string,double>")


def clipped(polarity) -> Column:
    return F.greatest(F.lit(-1.0), F.least(F.lit(1.0), polarity))


# Symbols of words in a marked text: private use characters, which no pattern and no token gives a meaning to.
_SYMBOLS = [*range(0xE000, 0xF900), *range(0xF0000, 0xFFFFE), *range(0x100000, 0x10FFFE)]


def phrase_sentiment_from_tokens(token_array, lexicon: Mapping[str, float], mods: Mapping[str, float]) -> Column:
    """Mean polarity of the lexicon's words and phrases (words with one space between them) in a token array.

    From left to right, at each token the longest entry that begins there counts and its tokens are passed over.
    The modifiers directly in front of it, as far as no other entry has taken them, multiply its polarity, which
    is then cut to -1 .. 1. No entry gives 0.0.

    Each token becomes one character: a symbol of its own for a word of an entry or a modifier, a space for any
    other. One pattern then goes through the text: modifiers, as few as it takes, and behind them the longest
    entry, or else what ends the run of modifiers. Every match begins where the last one ended, so a text takes
    time in proportion to its length. Only the matches are looked at one by one, and the array is referenced once.
    """
    if not lexicon:
        return F.when(col_of(token_array).isNotNull(), F.lit(0.0))
    words = sorted({w for entry in lexicon for w in entry.split(" ")} | set(mods))
    symbol = {w: chr(c) for w, c in zip(words, _SYMBOLS, strict=False)}
    if len(symbol) < len(words):
        raise ValueError(f"a lexicon of more than {len(_SYMBOLS)} words is to be joined in as a table")
    spelled = {"".join(symbol[w] for w in entry.split(" ")): float(v) for entry, v in lexicon.items()}
    kinds = "".join(symbol[w] for w in sorted(mods))
    before, other = (f"[{kinds}]*?", f"[^{kinds}]") if mods else ("", ".")
    entries = "|".join(sorted(spelled, key=lambda e: (-len(e), e)))
    names = F.create_map(*[F.lit(x) for w in words for x in (w, symbol[w])])
    polarity, factor = number_map(spelled), number_map({symbol[w]: v for w, v in mods.items()})

    marked = F.array_join(F.transform(col_of(token_array), lambda t: F.coalesce(names[t], F.lit(" "))), "")
    # a space behind each match and a comma between modifiers and entry; matches without an entry are left out
    matches = F.split(F.regexp_replace(marked, f"({before})(?:({entries})| +|{other}|$)", "$1,$2 "), " ")
    found = F.filter(matches, lambda m: (m != "") & ~F.endswith(m, F.lit(",")))
    zero = F.struct(F.lit(0.0).alias("s"), F.lit(0).alias("n"))

    def step(acc, m):
        run = F.aggregate(F.regexp_extract_all(F.substring_index(m, ",", 1), F.lit("."), F.lit(0)), F.lit(1.0), lambda f, w: f * factor[w])
        return F.struct((acc["s"] + clipped(polarity[F.substring_index(m, ",", -1)] * run)).alias("s"), (acc["n"] + 1).alias("n"))

    return F.aggregate(found, zero, step, lambda acc: F.when(acc["n"] > 0, acc["s"] / acc["n"]).otherwise(F.lit(0.0)))


def sentiment_category(score, upper: float = 0.2, lower: float = -0.2) -> Column:
    """'positive' above ``upper``, 'negative' below ``lower``, else 'neutral'."""
    s = col_of(score)
    return (F.when(s > upper, F.lit("positive"))
            .when(s < lower, F.lit("negative"))
            .otherwise(F.lit("neutral")))
