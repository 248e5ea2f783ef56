"""Oracle SQL per query key (DuckDB, on the driver's parquet views)."""

from __future__ import annotations

import re

from hostlens.sources.schemas import LISTINGS_RAW

from .ctes import ACCENT_CLASS, CTES, DEFAULT_MARKER_PATTERN, LISTINGS_DROPPED, with_ctes

PANEL_COLS = ("id, host_id, neighbourhood_cleansed, property_type, room_type, accommodates, "
              "minimum_nights, maximum_nights, date, available, price, label, is_weekend, "
              "total_days, cumulative_rentout, occupancy_rate, high_demand")

ORACLE: dict[str, str] = {}


def oracle(name: str, body: str, *needs: str) -> None:
    ORACLE[name] = with_ctes(body, *needs)


oracle("region_occupancy",
       "SELECT neighbourhood_cleansed, round(avg_occupancy_rate, 6) AS avg_occupancy_rate FROM regions",
       "regions")

oracle("occupancy_panel",
       f"SELECT {PANEL_COLS.replace('occupancy_rate', 'round(occupancy_rate, 6) AS occupancy_rate')}, "
       "round(avg_occupancy_rate, 6) AS avg_occupancy_rate, hot_region FROM panel",
       "panel")

# ---- 2.1 scans, sources, sinks ----------------------------------------------
oracle("csv_scan_quoted", "SELECT * FROM listings_raw", "listings_raw")
oracle("csv_scan_plain", "SELECT * FROM reviews_raw", "reviews_raw")
oracle("csv_permissive", """
SELECT listing_id,
       CASE WHEN minimum_nights = 7 THEN NULL ELSE date END AS date,
       available, price, CAST(NULL AS BOOLEAN) AS adjusted_price, minimum_nights,
       CASE WHEN maximum_nights >= 49 OR maximum_nights = 1 THEN NULL ELSE maximum_nights END AS maximum_nights
FROM calendar_raw""", "calendar_raw")
oracle("parquet_scan", """
SELECT l_partkey, CAST(l_shipdate AS DATE) AS ship_date, l_extendedprice
FROM lineitem WHERE l_shipdate >= TIMESTAMP '1998-01-01 00:00:00'""")
oracle("parquet_sink_roundtrip", "SELECT * FROM calendar_c", "calendar_c")

_PANEL_OUT = (f"SELECT {PANEL_COLS.replace('occupancy_rate', 'round(occupancy_rate, 6) AS occupancy_rate')}, "
              "round(avg_occupancy_rate, 6) AS avg_occupancy_rate, hot_region FROM panel")
oracle("partitioned_sink_roundtrip", _PANEL_OUT, "panel")
oracle("segment_scan", _PANEL_OUT + " WHERE high_demand = 1 AND is_weekend = 0 AND hot_region = 1", "panel")

# ---- 2.2 projections ----------------------------------------------------------
oracle("project_drop", "SELECT " + ", ".join(
    f.name for f in LISTINGS_RAW.fields
    if f.name not in LISTINGS_DROPPED)
    + " FROM listings_raw", "listings_raw")
oracle("join_disambiguate", """
SELECT l.id, l.room_type, c.date, c.price
FROM listings_c l JOIN calendar_c c ON l.id = c.listing_id""", "listings_c", "calendar_c")
oracle("project_rename", """
SELECT id, price AS listing_price, neighbourhood_cleansed AS neighbourhood,
       bedrooms AS num_bedrooms, beds AS num_beds FROM listings_c""", "listings_c")
oracle("project_select", """
SELECT id, review_scores_rating, review_scores_communication, review_scores_accuracy,
       review_scores_cleanliness, review_scores_location, review_scores_value,
       review_scores_checkin, reviews_per_month, latitude, longitude, room_type FROM listings_c""", "listings_c")
oracle("parse_flag", """
SELECT listing_id, date, available AS raw,
       CASE WHEN available = 't' THEN true WHEN available = 'f' THEN false END AS flag
FROM calendar_raw""", "calendar_raw")
oracle("parse_money", """
SELECT listing_id, date, price AS raw,
       TRY_CAST(regexp_replace(price, '[$]', '', 'g') AS FLOAT) AS price_value FROM calendar_raw""", "calendar_raw")
oracle("parse_money_thousands", """
SELECT listing_id, date, price AS raw,
       TRY_CAST(regexp_replace(price, '[$,]', '', 'g') AS FLOAT) AS price_value FROM calendar_raw""", "calendar_raw")
oracle("rental_label", """
SELECT listing_id, date, available, CASE WHEN available THEN 0 ELSE 1 END AS label
FROM calendar_c""", "calendar_c")
oracle("threshold_flag", """
SELECT id, date, round(occupancy_rate, 6) AS occupancy_rate, high_demand FROM panel_occ""", "panel_occ")
oracle("weekend_flag", """
SELECT listing_id, date, CASE WHEN dayofweek(date) IN (5, 6) THEN 1 ELSE 0 END AS is_weekend
FROM calendar_c""", "calendar_c")
oracle("null_normalise", """
SELECT id, CASE WHEN amenities = '[]' THEN NULL ELSE amenities END AS amenities,
       coalesce(bathrooms_text, '') AS bathrooms_text FROM listings_raw""", "listings_raw")

# ---- 2.3 filters ----------------------------------------------------------------
oracle("filter_not_null_keys", """
SELECT listing_id, id, date FROM reviews_raw WHERE listing_id IS NOT NULL AND id IS NOT NULL""", "reviews_raw")
oracle("filter_date_range", """
SELECT * FROM calendar_c WHERE date BETWEEN DATE '1996-01-01' AND DATE '1999-12-31'""", "calendar_c")
oracle("filter_dropna", "SELECT * FROM panel_days", "panel_days")
_ASCII = "comments IS NOT NULL AND NOT regexp_matches(regexp_replace(comments, '<[^>]*>', '', 'g'), '[^\\x00-\\x7F]')"
oracle("filter_ascii", f"SELECT id, listing_id FROM reviews_raw WHERE {_ASCII}", "reviews_raw")
oracle("filter_stopword_lang", f"""
SELECT id, listing_id FROM reviews_raw
WHERE {_ASCII} AND NOT regexp_matches(comments, '{DEFAULT_MARKER_PATTERN}')""",
       "reviews_raw")
oracle("filter_accents", f"""
SELECT id, listing_id FROM reviews_raw
WHERE comments IS NOT NULL AND NOT regexp_matches(comments, '{ACCENT_CLASS}')""",
       "reviews_raw")
oracle("english_filter", "SELECT id, listing_id, date FROM reviews_en", "reviews_en")
oracle("bath_flags", """
SELECT id, bathrooms_text,
       CASE WHEN bathrooms_text LIKE '%private%' THEN 1 ELSE 0 END AS is_private_bath,
       CASE WHEN bathrooms_text LIKE '%shared%' THEN 1 ELSE 0 END AS is_shared_bath
FROM listings_raw""", "listings_raw")
_BUCKET = ("((CAST(listing_id AS BIGINT) * 2654435761 + "
           "CAST(date - DATE '1970-01-01' AS BIGINT) * 40503 + 17) % 10000)")
oracle("key_sample", f"SELECT * FROM calendar_c WHERE {_BUCKET} < 1000", "calendar_c")
oracle("key_split", f"""
SELECT listing_id, date, CASE WHEN {_BUCKET} < 8000 THEN 'train' ELSE 'test' END AS split
FROM calendar_c""", "calendar_c")

# ---- 2.9 scalar functions ----------------------------------------------------------
oracle("strip_breaks", "SELECT id, regexp_replace(comments, '<br/?\\s*>', '', 'g') AS comments FROM reviews_raw",
       "reviews_raw")
oracle("bathroom_count", """
SELECT id, bathrooms_text,
       TRY_CAST(regexp_extract(bathrooms_text, '(\\d+\\.?\\d*)', 1) AS FLOAT) AS num_bathrooms
FROM listings_raw""", "listings_raw")
_AMEN = "CASE WHEN amenities = '[]' THEN NULL ELSE amenities END"
oracle("amenity_list", f"""
SELECT id, string_split(regexp_replace({_AMEN}, '[\\[\\]"]', '', 'g'), ', ') AS amenities_list
FROM listings_c""", "listings_c")
oracle("amenity_list_json", f"""
SELECT id, from_json({_AMEN}, '["VARCHAR"]') AS amenities_list FROM listings_c""", "listings_c")
oracle("amenity_count", f"""
SELECT id,
       CAST(coalesce(len(string_split(regexp_replace({_AMEN}, '[\\[\\]"]', '', 'g'), ', ')), -1) AS INTEGER)
         AS amenities_count,
       CAST(coalesce(len(from_json({_AMEN}, '["VARCHAR"]')), -1) AS INTEGER) AS amenities_count_json
FROM listings_c""", "listings_c")
oracle("clean_comments", """
SELECT id, regexp_replace(regexp_replace(comments, '(?i)<br\\s*/?\\s*>', '', 'g'), '^\\s+|\\s+$', '', 'g')
       AS cleaned_comments FROM reviews_c""", "reviews_c")
oracle("clean_comments_compat", """
SELECT id, regexp_replace(replace(comments, 'br', ''), '^\\s+|\\s+$', '', 'g') AS cleaned_comments
FROM reviews_c""", "reviews_c")
oracle("log_price", """
SELECT listing_id, date, price,
       round(CASE WHEN price > 0 THEN ln(CAST(price AS DOUBLE)) END, 6) AS log_price FROM calendar_c""",
       "calendar_c")
_HAV = """6371.0 * (2 * atan2(sqrt(a), sqrt(1 - a)))"""
oracle("haversine", f"""
SELECT id, round({_HAV}, 6) AS distance_to_center_km
FROM (SELECT id, pow(sin((radians(49.2827) - radians(CAST(latitude AS DOUBLE))) / 2), 2)
             + cos(radians(CAST(latitude AS DOUBLE))) * cos(radians(49.2827))
             * pow(sin((radians(-123.1207) - radians(CAST(longitude AS DOUBLE))) / 2), 2) AS a
      FROM listings_c)""", "listings_c")

# ---- review analysis CTEs ------------------------------------------------------------
# fixed values: the fixture's lexicon, negators and stop words
_LEXICON = {"ble": 0.8, "thing": 0.9, "ing": 0.6, "ly": 0.5, "tion": 0.4, "rewh": 0.7, "ed": -0.7, "ha": -0.9,
            "he": -0.6, "than": -0.8, "then": -1.0, "orre": -0.9}
_NEGATORS = ["it"]
_STOP_WORDS = "a an and are as at be by for from in is it of on that the this to was with".split()

from .ctes import register  # noqa: E402

_LEX = "MAP {" + ", ".join(f"'{k}': {float(v)!r}::DOUBLE" for k, v in sorted(_LEXICON.items())) + "}"
_NEGS = "[" + ", ".join(f"'{w}'" for w in sorted(set(_NEGATORS))) + "]"
_STOPS = "[" + ", ".join(f"'{w}'" for w in sorted(set(_STOP_WORDS))) + "]"
_TOKENS = "regexp_extract_all(lower({c}), '[\\p{{L}}\\p{{N}}_]{{2,}}')"

register("comments", f"""
SELECT l.id, l.review_scores_rating, l.review_scores_communication, l.review_scores_accuracy,
       l.review_scores_cleanliness, l.review_scores_location, l.review_scores_value,
       l.review_scores_checkin, l.reviews_per_month, l.latitude, l.longitude, l.room_type,
       cnt.review_count, r.id AS review_id, coalesce(r.comments, '') AS comments, r.date,
       regexp_replace(regexp_replace(r.comments, '(?i)<br\\s*/?\\s*>', '', 'g'), '^\\s+|\\s+$', '', 'g')
         AS cleaned_comments
FROM listings_c l
LEFT JOIN (SELECT listing_id, count(listing_id) AS review_count FROM reviews_c GROUP BY listing_id) cnt
  ON l.id = cnt.listing_id
JOIN reviews_c r ON l.id = r.listing_id""", ["listings_c", "reviews_c"])

register("scored", f"""
SELECT *, CASE WHEN sentiment_score > 0.2 THEN 'positive' WHEN sentiment_score < -0.2 THEN 'negative'
               ELSE 'neutral' END AS sentiment_category
FROM (SELECT * EXCLUDE (hits__),
             CASE WHEN len(hits__) > 0 THEN list_reduce(hits__, lambda a, b: a + b) / len(hits__)
                  ELSE 0.0 END AS sentiment_score
      FROM (SELECT * EXCLUDE (toks__),
                   list_filter(list_transform(toks__, lambda x, i:
                       CASE WHEN i > 1 AND list_contains({_NEGS}, toks__[i - 1]) THEN -({_LEX}[x])
                            ELSE {_LEX}[x] END), lambda y: y IS NOT NULL) AS hits__
            FROM (SELECT *, {_TOKENS.format(c='comments')} AS toks__ FROM comments)))""", ["comments"])


def tfidf_sql(source: str, text: str, group: str, k: int = 20) -> str:
    """TF-IDF keyword twin: (group, term, score)."""
    return f"""
WITH docs__ AS (SELECT {group} AS g, review_id AS doc,
                       list_filter({_TOKENS.format(c=text)}, lambda x: NOT list_contains({_STOPS}, x)) AS toks
                FROM {source}),
tok__ AS (SELECT g, doc, unnest(toks) AS term FROM docs__),
vocab__ AS (SELECT g, term FROM (SELECT g, term, row_number() OVER (PARTITION BY g
                 ORDER BY count(*) DESC, term ASC) AS r FROM tok__ GROUP BY g, term) WHERE r <= {k}),
tf__ AS (SELECT t.g, t.doc, t.term, count(*) AS tf FROM tok__ t JOIN vocab__ v ON t.g = v.g AND t.term = v.term
         GROUP BY t.g, t.doc, t.term),
n__ AS (SELECT g, count(*) AS n FROM docs__ GROUP BY g),
df__ AS (SELECT g, term, count(*) AS df FROM tf__ GROUP BY g, term),
w__ AS (SELECT tf__.g, tf__.doc, tf__.term, tf__.tf * (ln((1 + n) / (1 + df)) + 1) AS w
        FROM tf__ JOIN df__ ON tf__.g = df__.g AND tf__.term = df__.term JOIN n__ ON tf__.g = n__.g)
SELECT g, term, round(sum(w / sqrt(ss)), 6) AS score
FROM (SELECT *, sum(w * w) OVER (PARTITION BY g, doc) AS ss FROM w__) GROUP BY g, term"""


def _tfidf(name: str, source_sql: str, needs: list[str], text: str, grouped: bool) -> None:
    from .ctes import CTES
    register(f"{name}_src", source_sql, needs)
    body = tfidf_sql(f"{name}_src", text, "sentiment_category" if grouped else "'all'")
    if grouped:
        body = body.replace("SELECT g, term, round(", "SELECT g AS sentiment_category, term, round(")
    else:
        body = body.replace("SELECT g, term, round(", "SELECT term, round(")
    # the inner WITH of the twin joins the outer CTE list
    outer = with_ctes("SELECT 1", f"{name}_src")
    ORACLE[name] = outer[: outer.rindex("\nSELECT 1")] + ",\n" + body.strip()[len("WITH "):]
    del CTES[f"{name}_src"]


_tfidf("tfidf_terms", "SELECT * FROM scored", ["scored"], "cleaned_comments", False)
_tfidf("keywords_by_category", "SELECT * FROM scored", ["scored"], "cleaned_comments", True)
_tfidf("keywords_negative", "SELECT * FROM scored WHERE sentiment_score < -0.6", ["scored"], "comments", False)

# ---- 2.4 joins -------------------------------------------------------------------------
oracle("join_listing_calendar", """
SELECT l.id, l.room_type, l.accommodates, c.date, c.price, c.available
FROM listings_c l JOIN calendar_c c ON l.id = c.listing_id""", "listings_c", "calendar_c")
oracle("join_listing_reviews", """
SELECT l.id, l.review_scores_rating, l.review_scores_communication, l.review_scores_accuracy,
       l.review_scores_cleanliness, l.review_scores_location, l.review_scores_value,
       l.review_scores_checkin, l.reviews_per_month, l.latitude, l.longitude, l.room_type, r.comments, r.date
FROM listings_c l JOIN reviews_c r ON l.id = r.listing_id""", "listings_c", "reviews_c")
oracle("join_left_count", "SELECT review_id, id, date, review_count FROM comments", "comments")
_LOGP = ("SELECT listing_id, date, CASE WHEN price > 0 THEN ln(CAST(price AS DOUBLE)) END AS log_price "
         "FROM calendar_c")
register("log_prices", _LOGP, ["calendar_c"])
oracle("agg_join_back", """
SELECT p.listing_id, p.date, round(p.log_price, 6) AS log_price, round(a.average_log_price, 6) AS average_log_price
FROM log_prices p JOIN (SELECT listing_id, avg(log_price) AS average_log_price FROM log_prices GROUP BY listing_id) a
  ON p.listing_id = a.listing_id""", "log_prices")
oracle("agg_over_partition", """
SELECT listing_id, date, round(log_price, 6) AS log_price,
       round(avg(log_price) OVER (PARTITION BY listing_id), 6) AS average_log_price FROM log_prices""", "log_prices")

# ---- 2.5 aggregations ---------------------------------------------------------------------
oracle("dedup_keys", "SELECT * FROM calendar_c", "calendar_c")
oracle("distinct_rows", "SELECT DISTINCT * FROM calendar_raw", "calendar_raw")
oracle("count_per_key", "SELECT listing_id, count(listing_id) AS review_count FROM reviews_c GROUP BY listing_id",
       "reviews_c")
oracle("avg_log_price", """
SELECT listing_id, round(avg(log_price), 6) AS average_log_price FROM log_prices GROUP BY listing_id""", "log_prices")
_ROLL_ATTR = ["review_scores_rating", "review_scores_communication", "review_scores_accuracy",
              "review_scores_cleanliness", "review_scores_location", "review_scores_value",
              "review_scores_checkin", "reviews_per_month", "latitude", "longitude", "room_type", "review_count"]
_ROUNDED = {"review_scores_rating", "review_scores_communication", "review_scores_accuracy",
            "review_scores_cleanliness", "review_scores_location", "review_scores_value",
            "review_scores_checkin", "reviews_per_month"}
register("rollup", "SELECT id, " + ", ".join(f"min({c}) AS {c}" for c in _ROLL_ATTR)
         + ", avg(sentiment_score) AS sentiment_score_mean, var_samp(sentiment_score) AS sentiment_score_variance"
         + " FROM scored GROUP BY id", ["scored"])
oracle("listing_sentiment_rollup", "SELECT id, " + ", ".join(
    f"round({c}, 6) AS {c}" if c in _ROUNDED else c for c in _ROLL_ATTR)
    + ", round(sentiment_score_mean, 6) AS sentiment_score_mean"
    + ", round(sentiment_score_variance, 6) AS sentiment_score_variance FROM rollup", "rollup")


def _exact_mean(c):
    """Half-up mean of 2-decimal values at 6 places, by integer arithmetic."""
    s_, n_ = f"sum(CAST(round({c} * 100) AS BIGINT))", f"count({c})"
    return f"CASE WHEN {n_} > 0 THEN CAST((2 * {s_} * 10000 + {n_}) // (2 * {n_}) AS DOUBLE) / 1000000 END"


oracle("category_score_means", f"""
SELECT sentiment_category, {_exact_mean('review_scores_communication')} AS avg_communication,
       {_exact_mean('review_scores_location')} AS avg_location, {_exact_mean('review_scores_value')} AS avg_value,
       {_exact_mean('review_scores_rating')} AS avg_rating, {_exact_mean('review_scores_checkin')} AS avg_checkin,
       {_exact_mean('review_scores_cleanliness')} AS avg_cleanliness, count(sentiment_score) AS comment_count
FROM scored GROUP BY sentiment_category""", "scored")
oracle("global_avg", "SELECT round(avg(price), 6) AS avg_price FROM calendar_c", "calendar_c")
oracle("hot_region_median", """
SELECT neighbourhood_cleansed, round(avg_occupancy_rate, 6) AS avg_occupancy_rate,
       CASE WHEN avg_occupancy_rate > (SELECT quantile_cont(avg_occupancy_rate, 0.5) FROM regions) THEN 1 ELSE 0 END
         AS hot_region FROM regions""", "regions")
oracle("hot_region_fixed", """
SELECT neighbourhood_cleansed, round(avg_occupancy_rate, 6) AS avg_occupancy_rate,
       CASE WHEN avg_occupancy_rate > 0.542 THEN 1 ELSE 0 END AS hot_region FROM regions""", "regions")
_CORR_COLS = ["sentiment_score_mean", "review_scores_rating", "review_scores_communication",
              "review_scores_accuracy", "review_scores_cleanliness", "review_scores_location",
              "review_scores_value", "review_scores_checkin", "reviews_per_month", "review_count"]
oracle("corr_matrix", " UNION ALL ".join(
    f"SELECT '{a}' AS x, '{b}' AS y, round(corr(CAST({a} AS DOUBLE), CAST({b} AS DOUBLE)), 6) AS r FROM rollup"
    for a in _CORR_COLS for b in _CORR_COLS), "rollup")
oracle("geo_sentiment_grid", """
SELECT round(CAST(latitude AS DOUBLE), 2) AS lat_cell, round(CAST(longitude AS DOUBLE), 2) AS lon_cell,
       count(*) FILTER (WHERE sentiment_category = 'positive') AS positive,
       count(*) FILTER (WHERE sentiment_category = 'neutral') AS neutral,
       count(*) FILTER (WHERE sentiment_category = 'negative') AS negative
FROM scored GROUP BY 1, 2""", "scored")

# ---- 2.6 windows ---------------------------------------------------------------------------
oracle("running_rentals", "SELECT id, date, label, cumulative_rentout FROM panel_occ", "panel_occ")
oracle("day_ordinal", "SELECT id, date, total_days FROM panel_occ", "panel_occ")
oracle("cumulative_occupancy", "SELECT id, date, round(occupancy_rate, 6) AS occupancy_rate FROM panel_occ",
       "panel_occ")

# ---- 2.7 ordering ----------------------------------------------------------------------------
oracle("lowest_sentiment", """
SELECT id, date, comments, round(score__, 6) AS sentiment_score
FROM (SELECT id, date, comments, sentiment_score AS score__ FROM scored
      ORDER BY sentiment_score ASC NULLS FIRST, id ASC NULLS FIRST, date ASC NULLS FIRST, comments ASC NULLS FIRST
      LIMIT 5)""", "scored")
oracle("region_rank", """
SELECT neighbourhood_cleansed, round(avg__, 6) AS avg_occupancy_rate, rank
FROM (SELECT neighbourhood_cleansed, avg_occupancy_rate AS avg__,
             CAST(row_number() OVER (ORDER BY avg_occupancy_rate DESC, neighbourhood_cleansed) AS INTEGER) AS rank
      FROM regions)""", "regions")

# ---- text ----------------------------------------------------------------------------------------
oracle("tokenize", f"""
SELECT id, token, count(*) AS n
FROM (SELECT id, unnest(list_filter({_TOKENS.format(c='comments')}, lambda x: NOT list_contains({_STOPS}, x)))
        AS token FROM reviews_c)
GROUP BY id, token""", "reviews_c")
oracle("sentiment_score", "SELECT review_id, id, round(sentiment_score, 6) AS sentiment_score FROM scored", "scored")
oracle("sentiment_category", "SELECT review_id, sentiment_category FROM scored", "scored")
oracle("filter_threshold", """
SELECT review_id, round(sentiment_score, 6) AS sentiment_score FROM scored WHERE sentiment_score < -0.6""", "scored")
oracle("category_weight", """
SELECT review_id, sentiment_category,
       CASE WHEN sentiment_category = 'negative' THEN 200 ELSE 50 END AS size,
       CASE WHEN sentiment_category = 'negative' THEN 0.8::DOUBLE ELSE 0.5::DOUBLE END AS alpha FROM scored""", "scored")

# ---- 2.12 price recommendation ------------------------------------------------------------
_ACTIONS = [0.5, 0.6, 0.7, 0.8, 0.9, 1.0, 1.1, 1.2, 1.3, 1.4, 1.5]  # fixed values

_SEG = ("concat_ws('_', CASE WHEN high_demand = 1 THEN 'highdemand' ELSE 'lowdemand' END, "
        "CASE WHEN is_weekend = 1 THEN 'weekend' ELSE 'weekday' END, "
        "CASE WHEN hot_region = 1 THEN 'hotregion' ELSE 'nothotregion' END)")
_ACTS = "[" + ", ".join(f"{a!r}::DOUBLE" for a in _ACTIONS) + "]"
_NEXT = ("concat_ws('_', CASE WHEN action > 1.0 THEN 'highdemand' ELSE 'lowdemand' END, "
         "CASE WHEN split_part(segment, '_', 2) = 'weekday' THEN 'weekend' ELSE 'weekday' END, "
         "split_part(segment, '_', 3))")
register("segs", f"""
SELECT p.*, rp.region_avg_price, {_SEG} AS segment
FROM panel p JOIN (SELECT neighbourhood_cleansed, avg(CAST(price AS DOUBLE)) AS region_avg_price
                   FROM panel GROUP BY neighbourhood_cleansed) rp
  ON p.neighbourhood_cleansed = rp.neighbourhood_cleansed""", ["panel"])
register("rew", f"""
SELECT *, CASE WHEN high_demand = 1 THEN
            CASE WHEN prediction = 1 THEN new_price * prediction - CAST(price AS DOUBLE) * label ELSE -new_price END
          ELSE
            CASE WHEN label = 0 AND prediction = 1
                 THEN (new_price * prediction - CAST(price AS DOUBLE) * label) * k ELSE -new_price * k END
          END AS reward
FROM (SELECT *, CASE WHEN new_price <= region_avg_price THEN 1 ELSE 0 END AS prediction,
             CASE WHEN is_weekend = 0 AND hot_region = 0 THEN 4 WHEN is_weekend = 0 AND hot_region = 1 THEN 3
                  WHEN is_weekend = 1 AND hot_region = 0 THEN 3 ELSE 2 END AS k
      FROM (SELECT *, CAST(price AS DOUBLE) * action AS new_price
            FROM (SELECT *, unnest({_ACTS}) AS action FROM segs)))""", ["segs"])
register("grid", "SELECT segment, action, avg(reward) AS avg_reward FROM rew GROUP BY segment, action", ["rew"])
register("look", f"""
SELECT g.segment, g.action, g.next_segment, g.avg_reward,
       g.avg_reward + 0.9 * coalesce(nb.best, 0.0) AS value
FROM (SELECT *, {_NEXT} AS next_segment FROM grid) g
LEFT JOIN (SELECT segment, max(avg_reward) AS best FROM grid GROUP BY segment) nb ON g.next_segment = nb.segment""",
         ["grid"])
register("best", """
SELECT segment AS state, action AS best_action
FROM (SELECT *, row_number() OVER (PARTITION BY segment ORDER BY value DESC, action ASC) AS r FROM look)
WHERE r = 1""", ["look"])

oracle("segment_key", f"SELECT id, date, {_SEG} AS segment FROM panel", "panel")
oracle("action_grid", f"""
SELECT id, date, action, round(CAST(price AS DOUBLE) * action, 6) AS new_price
FROM (SELECT id, date, price, unnest({_ACTS}) AS action FROM panel)""", "panel")
oracle("segment_transition", f"""
SELECT segment, action, {_NEXT} AS next_segment
FROM (SELECT segment, unnest({_ACTS}) AS action FROM (SELECT DISTINCT {_SEG} AS segment FROM panel))""", "panel")
oracle("reward_rows", "SELECT id, date, segment, action, prediction, round(reward, 6) AS reward FROM rew", "rew")
oracle("reward_grid", "SELECT segment, action, round(avg_reward, 6) AS avg_reward FROM grid", "grid")
oracle("lookahead_value", """
SELECT segment, action, next_segment, round(avg_reward, 6) AS avg_reward, round(value, 6) AS value FROM look""",
       "look")
oracle("best_action", "SELECT * FROM best", "best")
oracle("csv_sink_roundtrip", "SELECT * FROM best", "best")
register("rrew_src", "SELECT * FROM rew", ["rew"])
_MED = with_ctes("SELECT 1", "rrew_src")
ORACLE["median_best_action"] = _MED[: _MED.rindex("\nSELECT 1")] + ",\n" + f"""
rrew AS (SELECT *, (CAST(id AS BIGINT) * 7919 + CAST(date - DATE '1970-01-01' AS BIGINT) * 104729) % 5
                        AS replicate FROM rew),
rgrid AS (SELECT replicate, segment, action, avg(reward) AS avg_reward FROM rrew GROUP BY 1, 2, 3),
rlook AS (SELECT g.replicate, g.segment, g.action, g.avg_reward + 0.9 * coalesce(nb.best, 0.0) AS value
          FROM (SELECT *, {_NEXT} AS next_segment FROM rgrid) g
          LEFT JOIN (SELECT replicate, segment, max(avg_reward) AS best FROM rgrid GROUP BY 1, 2) nb
            ON g.replicate = nb.replicate AND g.next_segment = nb.segment),
rbest AS (SELECT replicate, segment AS state, action AS best_action
          FROM (SELECT *, row_number() OVER (PARTITION BY replicate, segment ORDER BY value DESC, action ASC) AS r
                FROM rlook) WHERE r = 1)
SELECT state, round(quantile_cont(best_action, 0.5), 6) AS best_action FROM rbest GROUP BY state"""

# ---- 2.11 features and ML ---------------------------------------------------------------------
_NUM = ["accommodates", "num_bedrooms", "num_beds", "num_bathrooms", "number_of_reviews",
        "review_scores_rating", "reviews_per_month", "distance_to_center_km", "amenities_count", "minimum_nights"]
_CAT = ["neighbourhood", "property_type", "is_private_bath", "is_shared_bath", "room_type"]
_HAV_FEAT = """6371.0 * (2 * atan2(sqrt(a__), sqrt(1 - a__)))"""
register("feat", f"""
SELECT id, accommodates, num_bedrooms, num_beds, num_bathrooms, number_of_reviews, review_scores_rating,
       reviews_per_month, {_HAV_FEAT} AS distance_to_center_km, amenities_count, minimum_nights,
       neighbourhood, property_type, is_private_bath, is_shared_bath, room_type, average_log_price
FROM (SELECT l.id, CAST(l.accommodates AS DOUBLE) AS accommodates, CAST(l.bedrooms AS DOUBLE) AS num_bedrooms,
             CAST(l.beds AS DOUBLE) AS num_beds,
             CAST(TRY_CAST(regexp_extract(l.bathrooms_text, '(\\d+\\.?\\d*)', 1) AS FLOAT) AS DOUBLE) AS num_bathrooms,
             CAST(l.number_of_reviews AS DOUBLE) AS number_of_reviews, l.review_scores_rating, l.reviews_per_month,
             pow(sin((radians(49.2827) - radians(CAST(l.latitude AS DOUBLE))) / 2), 2)
               + cos(radians(CAST(l.latitude AS DOUBLE))) * cos(radians(49.2827))
               * pow(sin((radians(-123.1207) - radians(CAST(l.longitude AS DOUBLE))) / 2), 2) AS a__,
             CAST(coalesce(len(string_split(regexp_replace({_AMEN}, '[\\[\\]"]', '', 'g'), ', ')), -1) AS DOUBLE)
               AS amenities_count,
             CAST(t.minimum_nights AS DOUBLE) AS minimum_nights,
             l.neighbourhood_cleansed AS neighbourhood, l.property_type,
             CASE WHEN l.bathrooms_text LIKE '%private%' THEN 1 ELSE 0 END AS is_private_bath,
             CASE WHEN l.bathrooms_text LIKE '%shared%' THEN 1 ELSE 0 END AS is_shared_bath,
             l.room_type, t.average_log_price
      FROM listings_c l
      JOIN (SELECT listing_id, avg(CASE WHEN price > 0 THEN ln(CAST(price AS DOUBLE)) END) AS average_log_price,
                   arg_min(minimum_nights, date) AS minimum_nights
            FROM calendar_c GROUP BY listing_id) t ON l.id = t.listing_id
      WHERE t.average_log_price IS NOT NULL)""", ["listings_c", "calendar_c"])
register("imputed", "SELECT id, " + ", ".join(f"coalesce({c}, avg({c}) OVER ()) AS {c}" for c in _NUM)
         + f", {', '.join(_CAT)}, average_log_price FROM feat", ["feat"])
oracle("impute_mean", "SELECT id, " + ", ".join(f"round({c}, 6) AS {c}_imputed" for c in _NUM) + " FROM imputed",
       "imputed")
oracle("scale_std", "SELECT id, " + ", ".join(
    f"round({c} / stddev_samp({c}) OVER (), 6) AS {c}_scaled" for c in _NUM) + " FROM imputed", "imputed")
_ID_BUCKET = "((CAST(id AS BIGINT) * 2654435761 + 17) % 10000)"
register("feat_train", f"SELECT * FROM feat WHERE {_ID_BUCKET} < 8000", ["feat"])
register("feat_test", f"SELECT * FROM feat WHERE {_ID_BUCKET} >= 8000", ["feat"])
for _c in _CAT:
    register(f"lab_{_c}", f"""
SELECT CAST({_c} AS VARCHAR) AS v,
       row_number() OVER (ORDER BY count(*) DESC, CAST({_c} AS VARCHAR) ASC) - 1 AS idx
FROM feat_train WHERE {_c} IS NOT NULL GROUP BY 1""", ["feat_train"])
oracle("index_keep", "SELECT f.id, " + ", ".join(
    f"CAST(coalesce(j_{c}.idx, (SELECT count(*) FROM lab_{c})) AS DOUBLE) AS {c}_index" for c in _CAT)
    + " FROM feat f " + " ".join(
    f"LEFT JOIN lab_{c} j_{c} ON CAST(f.{c} AS VARCHAR) = j_{c}.v" for c in _CAT),
    "feat", *[f"lab_{c}" for c in _CAT])
register("base_pred", """
SELECT neighbourhood, avg(average_log_price) AS prediction FROM feat_train GROUP BY neighbourhood""", ["feat_train"])


def _metrics(split, table):
    return f"""
SELECT '{split}' AS split,
       round(1 - sum(pow(average_log_price - prediction, 2)) / (count(average_log_price) * var_pop(average_log_price)), 6)
         AS r2,
       round(sqrt(avg(pow(average_log_price - prediction, 2))), 6) AS rmse, count(*) AS n
FROM {table} t JOIN base_pred b ON t.neighbourhood = b.neighbourhood"""


oracle("regression_metrics", _metrics("train", "feat_train") + " UNION ALL " + _metrics("test", "feat_test"),
       "feat_train", "feat_test", "base_pred")
oracle("accuracy_metric", """
SELECT segment,
       round(avg(CASE WHEN CAST(label AS DOUBLE) = CAST(prediction AS DOUBLE) THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END), 6)
         AS accuracy,
       count(*) AS n
FROM rew WHERE action = 1.0 GROUP BY segment""", "rew")

# ---- streaming ---------------------------------------------------------------------------------
oracle("calendar_stream_ingest", "SELECT * FROM calendar_c", "calendar_c")

# ---- end-to-end cleaning outputs and the model's feature table ------------------------------
oracle("etl_listings", "SELECT * FROM listings_c", "listings_c")
oracle("etl_calendar", "SELECT * FROM calendar_c", "calendar_c")
oracle("etl_reviews", "SELECT * FROM reviews_c", "reviews_c")
oracle("price_features", """
SELECT id, accommodates, num_bedrooms, num_beds, num_bathrooms, number_of_reviews, review_scores_rating,
       reviews_per_month, round(distance_to_center_km, 6) AS distance_to_center_km, amenities_count, minimum_nights,
       neighbourhood, property_type, is_private_bath, is_shared_bath, room_type,
       round(average_log_price, 6) AS average_log_price
FROM (SELECT f.* REPLACE (CAST(f.accommodates AS INTEGER) AS accommodates,
                          CAST(f.num_bedrooms AS INTEGER) AS num_bedrooms,
                          CAST(f.num_beds AS INTEGER) AS num_beds,
                          CAST(f.num_bathrooms AS FLOAT) AS num_bathrooms,
                          CAST(f.number_of_reviews AS INTEGER) AS number_of_reviews,
                          CAST(f.amenities_count AS INTEGER) AS amenities_count,
                          CAST(f.minimum_nights AS INTEGER) AS minimum_nights)
      FROM feat f)""", "feat")


# ---- rounding semantics ----------------------------------------------------------------------
def _spark_like_round(sql: str) -> str:
    """``round(x, 6)`` -> ``(round(x, 6) + 0.0)``.

    Spark rounds through BigDecimal, which has no negative zero; DuckDB's
    ``round`` of a tiny negative value gives -0.0.  Adding +0.0 maps -0.0 to
    +0.0 and leaves every other value unchanged.
    """
    out, i, key = [], 0, "round("
    while True:
        j = sql.find(key, i)
        if j < 0 or (j > 0 and (sql[j - 1].isalnum() or sql[j - 1] == "_")):
            if j < 0:
                out.append(sql[i:])
                return "".join(out)
            out.append(sql[i:j + len(key)])
            i = j + len(key)
            continue
        depth, k = 0, j + len(key) - 1
        while True:
            if sql[k] == "(":
                depth += 1
            elif sql[k] == ")":
                depth -= 1
                if depth == 0:
                    break
            k += 1
        inner = _spark_like_round(sql[j + len(key):k])
        out.append(sql[i:j] + f"(round({inner}) + 0.0)")
        i = k + 1


for _k in list(ORACLE):
    ORACLE[_k] = _spark_like_round(ORACLE[_k])


# ---- ML keys whose results SQL can state -------------------------------------------------------
for _c in _CAT:
    register(f"laball_{_c}", f"""
SELECT CAST({_c} AS VARCHAR) AS v,
       row_number() OVER (ORDER BY count(*) DESC, CAST({_c} AS VARCHAR) ASC) - 1 AS idx
FROM feat WHERE {_c} IS NOT NULL GROUP BY 1""", ["feat"])
# fitted on every row: no unseen labels; 'keep' adds one slot that dropLast removes again
ORACLE["one_hot"] = _spark_like_round(with_ctes("SELECT f.id, " + ", ".join(
    f"list_transform(range((SELECT count(*) FROM laball_{c})), lambda i: CASE WHEN i = j_{c}.idx "
    f"THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END) AS {c}_ohe" for c in _CAT)
    + " FROM feat f " + " ".join(f"JOIN laball_{c} j_{c} ON CAST(f.{c} AS VARCHAR) = j_{c}.v" for c in _CAT),
    "feat", *[f"laball_{c}" for c in _CAT]))

_SEG_COLS = ["neighbourhood_cleansed", "property_type", "room_type"]
for _c in _SEG_COLS:
    register(f"labseg_{_c}", f"""
SELECT segment, {_c} AS v,
       row_number() OVER (PARTITION BY segment ORDER BY count(*) DESC, {_c} ASC) - 1 AS idx
FROM segs GROUP BY 1, 2""", ["segs"])
oracle("index_error", "SELECT s.id, s.date, " + ", ".join(
    f"CAST(j_{c}.idx AS DOUBLE) AS {c}_indexed" for c in _SEG_COLS)
    + ", s.segment FROM segs s " + " ".join(
    f"JOIN labseg_{c} j_{c} ON s.{c} = j_{c}.v AND s.segment = j_{c}.segment" for c in _SEG_COLS),
    "segs", *[f"labseg_{c}" for c in _SEG_COLS])
oracle("model_save_load", "SELECT segment, count(*) AS n, count(*) AS n_equal FROM segs GROUP BY segment", "segs")

# ---- facts of sampled and fitted results ---------------------------------------------------------
oracle("bernoulli_sample", "SELECT count(*) AS n_rows, true AS is_subset, true AS size_fits FROM calendar_c", "calendar_c")
oracle("random_split", "SELECT listing_id, date, 1::BIGINT AS n_parts FROM calendar_c", "calendar_c")
oracle("price_model", """
SELECT split, count(*) AS n, true AS r2_defined, true AS rmse_defined, true AS beats_mean, true AS error_fits
FROM (SELECT 'train' AS split FROM feat_train UNION ALL SELECT 'test' FROM feat_test) GROUP BY split""",
       "feat_train", "feat_test")
oracle("feature_importance", "SELECT unnest([" + ", ".join(f"'{c}'" for c in _NUM + _CAT)
       + "]) AS feature, true AS in_range, 1.0::DOUBLE AS total FROM (SELECT count(*) FROM feat)", "feat")
_DAY_BUCKET = ("((CAST(id AS BIGINT) * 2654435761 + "
               "CAST(date - DATE '1970-01-01' AS BIGINT) * 40503 + 17) % 10000)")
_LEARNT = f"segment IN (SELECT segment FROM segs WHERE {_DAY_BUCKET} < 7500)"
oracle("occupancy_model", f"""SELECT id, date, segment, true AS is_label, true AS beats_constant FROM segs
WHERE {_DAY_BUCKET} >= 7500 AND {_LEARNT}""", "segs")
oracle("score_batch", f"SELECT id, date, segment, true AS is_label, true AS beats_constant FROM segs WHERE {_LEARNT}", "segs")
oracle("segment_models", f"""
SELECT n.segment, CASE WHEN count(s.id) FILTER (s.b < 7500) > 0 THEN 'fitted' WHEN count(s.id) > 0 THEN 'no training rows' ELSE 'no rows' END AS status,
       true AS accuracy_fits, true AS not_below_constant, true AS beats_constant
FROM (SELECT d || '_' || w || '_' || h AS segment
      FROM (SELECT unnest(['highdemand', 'lowdemand']) AS d), (SELECT unnest(['weekend', 'weekday']) AS w),
           (SELECT unnest(['hotregion', 'nothotregion']) AS h)) n
LEFT JOIN (SELECT *, {_DAY_BUCKET} AS b FROM segs) s ON n.segment = s.segment GROUP BY n.segment""", "segs")
_ENDS = """
SELECT segment, action,
       CASE WHEN high_demand = 1 THEN -new_price ELSE -new_price * k END AS r0,
       CASE WHEN high_demand = 1 THEN new_price - CAST(price AS DOUBLE) * label
            WHEN label = 0 THEN new_price * k ELSE -new_price * k END AS r1
FROM rew"""
ORACLE["reward_grid_model"] = _spark_like_round(with_ctes(f"""
SELECT segment, action, round(avg(least(r0, r1)), 6) AS low, round(avg(greatest(r0, r1)), 6) AS high, true AS inside
FROM ({_ENDS}) GROUP BY segment, action""", "rew"))

# ---- forests of one tree with one split: the best split of all rows, in SQL --------------------


def _best_split(train: str, features: list[str], label: str, by: str, gain: str) -> str:
    """CTEs: ``best`` has the split of each ``by`` (feature, threshold) and its sides' sums; of equal gains the first
    feature and the lowest threshold count."""
    values = " UNION ALL ".join(f"SELECT {by} AS b, {i} AS f, CAST({c} AS DOUBLE) AS v, CAST({label} AS DOUBLE) AS y FROM {train}" for i, c in enumerate(features))
    return f"""
vals AS (SELECT b, f, v, count(*) AS n, sum(y) AS s FROM ({values}) GROUP BY ALL),
upto AS (SELECT b, f, v, sum(n) OVER w AS nl, sum(s) OVER w AS sl, sum(n) OVER (PARTITION BY b, f) AS n, sum(s) OVER (PARTITION BY b, f) AS s,
                (v + lead(v) OVER w) / 2 AS t FROM vals WINDOW w AS (PARTITION BY b, f ORDER BY v)),
best AS (SELECT *, {gain} AS gain FROM upto WHERE t IS NOT NULL
         QUALIFY row_number() OVER (PARTITION BY b ORDER BY round(gain, 9) DESC, f, t) = 1)"""


def _split_value(features: list[str], row: str) -> str:
    return "CASE f " + " ".join(f"WHEN {i} THEN CAST({row}.{c} AS DOUBLE)" for i, c in enumerate(features)) + " END"


_STUMP = ["accommodates", "number_of_reviews", "amenities_count", "minimum_nights"]
_base = with_ctes("SELECT 1", "feat_train", "feat")
ORACLE["price_model_one_split"] = _base[: _base.rindex("SELECT 1")].rstrip().rstrip(",") + "," + _best_split(
    "feat_train", _STUMP, "average_log_price", "1", "sl * sl / nl + (s - sl) * (s - sl) / (n - nl)") + f"""
SELECT id, round(CASE WHEN {_split_value(_STUMP, 'feat')} <= t THEN sl / nl ELSE (s - sl) / (n - nl) END, 6) AS prediction FROM feat, best"""
_STUMP_DAYS = ["accommodates", "minimum_nights", "maximum_nights"]
register("seg_train", f"SELECT * FROM segs WHERE {_DAY_BUCKET} < 7500", ["segs"])
_SIDES = _best_split("seg_train", _STUMP_DAYS, "label", "segment",
                     "(sl * sl + (nl - sl) * (nl - sl)) / nl + ((s - sl) * (s - sl) + (n - nl - s + sl) * (n - nl - s + sl)) / (n - nl)") + f""",
sides AS (SELECT *, sl / nl AS pl, (s - sl) / (n - nl) AS pr, s / n AS p FROM best),
told AS (SELECT segs.id, segs.date, segs.segment,
                CASE WHEN (pl > 0.5) = (pr > 0.5) THEN p WHEN {_split_value(_STUMP_DAYS, 'segs')} <= t THEN pl ELSE pr END AS p
         FROM segs JOIN sides ON segs.segment = sides.b)"""
_base = with_ctes("SELECT 1", "seg_train", "segs")
ORACLE["occupancy_model_one_split"] = _base[: _base.rindex("SELECT 1")].rstrip().rstrip(",") + "," + _SIDES + """
SELECT id, date, CAST(p > 0.5 AS INTEGER)::DOUBLE AS prediction, round(p, 6) AS p_rented, segment FROM told"""
_base = with_ctes("SELECT 1", "seg_train", "segs", "rew")
ORACLE["reward_grid_one_split"] = _spark_like_round(_base[: _base.rindex("SELECT 1")].rstrip().rstrip(",") + "," + _SIDES + """
SELECT x.segment, action, round(avg(CASE WHEN told.p > 0.5 THEN r1 ELSE r0 END), 6) AS avg_reward
FROM (SELECT segment, id, date, action,
             CASE WHEN high_demand = 1 THEN -new_price ELSE -new_price * k END AS r0,
             CASE WHEN high_demand = 1 THEN new_price - CAST(price AS DOUBLE) * label
                  WHEN label = 0 THEN new_price * k ELSE -new_price * k END AS r1 FROM rew) x
JOIN told ON x.id = told.id AND x.date = told.date AND x.segment = told.segment GROUP BY x.segment, action""")

# ---- the panel without lost nights --------------------------------------------------------------
_THOUSANDS = {n: (CTES[n][0].replace("'[$]'", "'[$,]'") if n == "calendar_c" else CTES[n][0], CTES[n][1])
              for n in ("calendar_c", "panel_days", "panel_occ", "regions", "panel")}


def _renamed(sql: str) -> str:
    for n in _THOUSANDS:
        sql = re.sub(rf"\b{n}\b", f"{n}_t", sql)
    return sql


for _n, (_sql, _needs) in _THOUSANDS.items():
    register(f"{_n}_t", _renamed(_sql), [f"{x}_t" if x in _THOUSANDS else x for x in _needs])
ORACLE["occupancy_panel_thousands"] = _spark_like_round(with_ctes(_renamed(_PANEL_OUT), "panel_t"))
oracle("rejected_prices", """
SELECT count(price) AS prices, count(*) FILTER (price IS NOT NULL AND p IS NULL) AS rejected, thousands
FROM (SELECT price, false AS thousands, TRY_CAST(regexp_replace(price, '[$]', '', 'g') AS FLOAT) AS p FROM calendar_raw
      UNION ALL
      SELECT price, true, TRY_CAST(regexp_replace(price, '[$,]', '', 'g') AS FLOAT) FROM calendar_raw)
GROUP BY thousands""", "calendar_raw")

# ---- the same results by other ways of storing and reading ----------------------------------
ORACLE["csv_split_quoted"] = ORACLE["csv_scan_quoted"]
ORACLE["csv_split_multiline"] = ORACLE["csv_scan_spread"] = ORACLE["csv_scan_plain"]
ORACLE["occupancy_appended"] = ORACLE["occupancy_bucketed"] = ORACLE["occupancy_panel"]
ORACLE["index_keep_table"] = ORACLE["index_keep"]
ORACLE["index_error_table"] = ORACLE["index_error"]
ORACLE["sentiment_join"] = ORACLE["sentiment_score"]
oracle("median_price", """
SELECT l.neighbourhood_cleansed, c.available, round(quantile_cont(CAST(c.price AS DOUBLE), 0.5), 6) AS median_price
FROM listings_c l JOIN calendar_c c ON l.id = c.listing_id WHERE c.price IS NOT NULL GROUP BY ALL""", "listings_c", "calendar_c")

# ---- phrases and modifiers: modifiers lazily, then the longest entry, left to right ----------
_PHRASES = _LEXICON | {"the and": 0.3, "the the": -0.4, "of the": 0.5, "it was": -0.6, "the and attion": 0.9,
                       "anea eriner thanea": -0.7, "is the is": 0.2}
_FACTORS = {"for": 1.5, "is": 0.5, "the": 1.1, "was": 1.2, "it": -1.0}


def _marked(phrase: str) -> str:
    return "".join(f"<{w}>" for w in phrase.split(" "))


def _sql_map(values: dict, key=str) -> str:
    return "MAP {" + ", ".join(f"'{key(k)}': {float(v)!r}::DOUBLE" for k, v in values.items()) + "}"


_ENTRY = (f"((?:<(?:{'|'.join(_FACTORS)})>)*?)("
          + "|".join(_marked(p) for p in sorted(_PHRASES, key=lambda p: (-p.count(" "), p))) + ")")
oracle("sentiment_phrases", f"""
SELECT id AS review_id, round(CASE WHEN len(hits) = 0 THEN 0.0 ELSE list_aggregate(hits, 'sum') / len(hits) END, 6) + 0.0 AS sentiment_score
FROM (SELECT id, list_transform(regexp_extract_all(marked, '{_ENTRY}'), lambda m:
               greatest(-1.0, least(1.0, {_sql_map(_PHRASES, _marked)}[regexp_extract(m, '{_ENTRY}', 2)]
                 * coalesce(list_aggregate(list_transform(regexp_extract_all(regexp_extract(m, '{_ENTRY}', 1), '<([^>]*)>', 1),
                                                          lambda w: {_sql_map(_FACTORS)}[w]), 'product'), 1.0)))) AS hits
      FROM (SELECT id, array_to_string(list_transform({_TOKENS.format(c='comments')}, lambda t: '<' || t || '>'), '') AS marked
            FROM reviews_c))""", "reviews_c")
ORACLE["sentiment_phrases_join"] = ORACLE["sentiment_phrases"]
