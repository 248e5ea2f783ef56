"""DuckDB twins of the role bindings and of the shared cleaning steps.

Each entry is one CTE; :func:`with_ctes` prepends the CTEs a query needs
(with their dependencies, in definition order).
"""

from __future__ import annotations

from hostlens.sources.schemas import LISTINGS_RAW

# fixed values, spelt out here so that a wrong constant in the library shows
DEFAULT_MARKER_PATTERN = (r"\b(el|la|los|las|un|muy|es|y|por|el|porque|pero|der|die|das|ein|eine|und|weil|aber|von|"
                          r"le|la|les|un|une|est|et|par|pour|mais)\b")
ACCENT_CLASS = "[áéíóúñü¿¡äöüßàâæçèéêëîïôùûüÿœ]"
HOSTS_MODULUS, REVIEW_LISTINGS = 400, 97
PANEL_START, PANEL_END = "1996-01-01", "1999-12-31"
LISTINGS_DROPPED = """
scrape_id last_scraped source host_url host_since host_location host_about host_response_time
host_response_rate host_acceptance_rate host_is_superhost host_thumbnail_url host_picture_url
host_neighbourhood host_listings_count host_total_listings_count host_verifications
host_has_profile_pic host_identity_verified neighbourhood neighbourhood_group_cleansed
minimum_nights maximum_nights maximum_minimum_nights minimum_maximum_nights minimum_nights_avg_ntm
maximum_nights_avg_ntm calendar_updated availability_30 availability_60 availability_90
calendar_last_scraped number_of_reviews_ltm number_of_reviews_l30d first_review last_review license
instant_bookable calculated_host_listings_count calculated_host_listings_count_entire_homes
calculated_host_listings_count_private_rooms calculated_host_listings_count_shared_rooms
""".split()

_SQL_TYPE = {"StringType()": "VARCHAR", "IntegerType()": "INTEGER", "DateType()": "DATE",
             "FloatType()": "FLOAT", "DoubleType()": "DOUBLE", "BooleanType()": "BOOLEAN"}


def _score(null_mod, mult, span, base):
    return (f"CASE WHEN p_partkey % {null_mod} = 0 THEN NULL "
            f"ELSE CAST((p_partkey * {mult}) % {span} + {base} AS DOUBLE) / 100 END")


_W1 = "split_part(p_name, ' ', 1)"
_W2 = "split_part(p_name, ' ', 2)"
_H = HOSTS_MODULUS
_LISTING_EXPR = {
    "id": "CAST(p_partkey AS VARCHAR)",
    "listing_url": "'listing/' || CAST(p_partkey AS VARCHAR)",
    "name": "p_name",
    "description": "p_type || '<br/>' || p_name",
    "neighborhood_overview": "p_brand || '<br />' || p_type",
    "host_id": f"CAST(p_partkey % {_H} AS VARCHAR)",
    "host_name": f"'host ' || CAST(p_partkey % {_H} AS VARCHAR)",
    "neighbourhood_cleansed": "p_brand",
    "latitude": "CAST(CAST(p_partkey % 100 + 49200 AS DOUBLE) / 1000 AS FLOAT)",
    "longitude": "CAST(CAST(p_partkey % 173 - 123200 AS DOUBLE) / 1000 AS FLOAT)",
    "property_type": "p_type",
    "room_type": _W1,
    "accommodates": "CAST(p_size AS INTEGER)",
    "bathrooms": "CAST(p_partkey % 3 + 1 AS DOUBLE)",
    "bathrooms_text": ("CASE p_partkey % 6 WHEN 0 THEN '1 bath' WHEN 1 THEN '1.5 shared baths' "
                       "WHEN 2 THEN '2 private baths' WHEN 3 THEN 'Half-bath' "
                       "WHEN 4 THEN 'Private half-bath' END"),
    "bedrooms": "CAST(CASE WHEN p_partkey % 9 = 0 THEN NULL ELSE p_partkey % 5 + 1 END AS INTEGER)",
    "beds": "CAST(CASE WHEN p_partkey % 13 = 0 THEN NULL ELSE p_partkey % 4 + 1 END AS INTEGER)",
    "amenities": (f"CASE p_partkey % 5 WHEN 0 THEN '[]' "
                  f"WHEN 2 THEN '[\"' || {_W1} || '\", \"' || {_W2} || '\"]' "
                  f"WHEN 3 THEN '[\"' || p_name || '\", \"Wifi\"]' "
                  f"WHEN 4 THEN '[\"' || {_W1} || ', ' || {_W2} || '\", \"TV\"]' END"),
    "price": ("'$' || CAST(CAST(round(p_retailprice * 100) AS BIGINT) // 100 AS VARCHAR) || '.' || "
              "lpad(CAST(CAST(round(p_retailprice * 100) AS BIGINT) % 100 AS VARCHAR), 2, '0')"),
    "minimum_nights": "CAST(p_partkey % 7 + 1 AS INTEGER)",
    "maximum_nights": "CAST(p_partkey % 60 + 30 AS INTEGER)",
    "minimum_minimum_nights": "CAST(p_partkey % 3 + 1 AS INTEGER)",
    "maximum_maximum_nights": "CAST(365 AS INTEGER)",
    "has_availability": "CASE p_partkey % 3 WHEN 0 THEN 't' WHEN 1 THEN 'f' ELSE 'x' END",
    "availability_365": "CAST(p_partkey % 366 AS INTEGER)",
    "number_of_reviews": "CAST(p_partkey % 50 AS INTEGER)",
    "review_scores_rating": _score(11, 7, 201, 300),
    "review_scores_accuracy": _score(13, 11, 251, 250),
    "review_scores_cleanliness": _score(17, 13, 231, 270),
    "review_scores_checkin": _score(19, 17, 211, 290),
    "review_scores_communication": _score(23, 19, 241, 260),
    "review_scores_location": _score(29, 23, 221, 280),
    "review_scores_value": _score(31, 29, 251, 250),
    "reviews_per_month": ("CASE WHEN p_partkey % 7 = 0 THEN NULL "
                          "ELSE CAST((p_partkey * 37) % 500 AS DOUBLE) / 100 END"),
}

LISTINGS_RAW_SQL = "SELECT " + ",\n  ".join(
    f"{_LISTING_EXPR.get(f.name, 'NULL')}::{_SQL_TYPE[repr(f.dataType)]} AS {f.name}"
    for f in LISTINGS_RAW.fields) + "\nFROM part"

CALENDAR_RAW_SQL = """
SELECT CAST(l_partkey AS VARCHAR) AS listing_id,
       CAST(l_shipdate AS DATE) AS date,
       CASE l_returnflag WHEN 'A' THEN 't' WHEN 'R' THEN 'f' END AS available,
       '$' || format('{:,}', c // 100) || '.' || lpad(CAST(c % 100 AS VARCHAR), 2, '0') AS price,
       CAST(NULL AS BOOLEAN) AS adjusted_price,
       CAST(l_linenumber AS INTEGER) AS minimum_nights,
       CAST(trunc(l_quantity) AS INTEGER) AS maximum_nights
FROM (SELECT *, CAST(round(l_extendedprice * 2) AS BIGINT) AS c FROM lineitem)
"""

REVIEWS_RAW_SQL = f"""
SELECT CAST(doc_id % {REVIEW_LISTINGS} AS VARCHAR) AS listing_id,
       CAST(doc_id AS VARCHAR) AS id,
       CAST(DATE '2024-01-01' + CAST(doc_id % 300 AS INTEGER) AS DATE) AS date,
       CAST(doc_id % 50 AS INTEGER) AS reviewer_id,
       'guest ' || CAST(doc_id % 50 AS VARCHAR) AS reviewer_name,
       CASE doc_id % 4 WHEN 1 THEN '<br/>' WHEN 2 THEN '<br>' WHEN 3 THEN '<br />' ELSE '' END
         || text AS comments
FROM documents
"""

_KEPT = [f.name for f in LISTINGS_RAW.fields if f.name not in LISTINGS_DROPPED]
_BREAKS = "'<br/?\\s*>'"


def _dedup_order(cols):
    return ", ".join(f"{c} ASC NULLS FIRST" for c in cols)


def _listing_out(c):
    if c == "price":
        return "TRY_CAST(regexp_replace(price, '[$]', '', 'g') AS FLOAT) AS price"
    if c == "has_availability":
        return ("CASE WHEN has_availability = 't' THEN true WHEN has_availability = 'f' THEN false "
                "END AS has_availability")
    if c in ("name", "description", "neighborhood_overview", "amenities"):
        return f"regexp_replace({c}, {_BREAKS}, '', 'g') AS {c}"
    return c


LISTINGS_C_SQL = f"""
SELECT {', '.join(_listing_out(c) for c in _KEPT)}
FROM (SELECT *, row_number() OVER (PARTITION BY id, host_id
                 ORDER BY {_dedup_order([c for c in _KEPT if c not in ('id', 'host_id')])}) AS rn__
      FROM listings_raw WHERE id IS NOT NULL AND host_id IS NOT NULL)
WHERE rn__ = 1
"""

CALENDAR_C_SQL = f"""
SELECT listing_id, date, available, price, minimum_nights, maximum_nights
FROM (SELECT *, row_number() OVER (PARTITION BY listing_id, date
                 ORDER BY {_dedup_order(['available', 'price', 'minimum_nights', 'maximum_nights'])}) AS rn__
      FROM (SELECT listing_id, date,
                   CASE WHEN available = 't' THEN true WHEN available = 'f' THEN false END AS available,
                   TRY_CAST(regexp_replace(price, '[$]', '', 'g') AS FLOAT) AS price,
                   minimum_nights, maximum_nights
            FROM calendar_raw WHERE listing_id IS NOT NULL AND date IS NOT NULL))
WHERE rn__ = 1
"""

ENGLISH_PRED = (
    "comments IS NOT NULL "
    "AND NOT regexp_matches(regexp_replace(comments, '<[^>]*>', '', 'g'), '[^\\x00-\\x7F]') "
    f"AND NOT regexp_matches(comments, '{DEFAULT_MARKER_PATTERN}') "
    f"AND NOT regexp_matches(comments, '{ACCENT_CLASS}')"
)

REVIEWS_EN_SQL = f"""
SELECT * FROM reviews_raw
WHERE listing_id IS NOT NULL AND id IS NOT NULL AND {ENGLISH_PRED}
"""

REVIEWS_C_SQL = f"""
SELECT listing_id, id, date, reviewer_id, reviewer_name,
       regexp_replace(comments, {_BREAKS}, '', 'g') AS comments
FROM (SELECT *, row_number() OVER (PARTITION BY id
                 ORDER BY {_dedup_order(['listing_id', 'date', 'reviewer_id', 'reviewer_name', 'comments'])}) AS rn__
      FROM reviews_en)
WHERE rn__ = 1
"""

PANEL_DAYS_SQL = f"""
SELECT l.id, l.host_id, l.neighbourhood_cleansed, l.property_type, l.room_type, l.accommodates,
       c.minimum_nights, c.maximum_nights, c.date, c.available, c.price,
       CASE WHEN c.available THEN 0 ELSE 1 END AS label,
       CASE WHEN dayofweek(c.date) IN (5, 6) THEN 1 ELSE 0 END AS is_weekend
FROM listings_c l JOIN calendar_c c ON l.id = c.listing_id
WHERE c.date BETWEEN DATE '{PANEL_START}' AND DATE '{PANEL_END}'
  AND l.id IS NOT NULL AND l.host_id IS NOT NULL AND l.neighbourhood_cleansed IS NOT NULL
  AND l.property_type IS NOT NULL AND l.room_type IS NOT NULL AND l.accommodates IS NOT NULL
  AND c.minimum_nights IS NOT NULL AND c.maximum_nights IS NOT NULL AND c.date IS NOT NULL
  AND c.available IS NOT NULL AND c.price IS NOT NULL
"""

PANEL_OCC_SQL = """
SELECT *, cumulative_rentout / total_days AS occupancy_rate,
       CASE WHEN cumulative_rentout / total_days > 0.5 THEN 1 ELSE 0 END AS high_demand
FROM (SELECT *,
        CAST(row_number() OVER (PARTITION BY id ORDER BY date, host_id) AS BIGINT) AS total_days,
        CAST(sum(label) OVER (PARTITION BY id ORDER BY date
             RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS cumulative_rentout
      FROM panel_days)
"""

REGIONS_SQL = """
SELECT neighbourhood_cleansed, avg(occupancy_rate) AS avg_occupancy_rate
FROM panel_occ GROUP BY neighbourhood_cleansed
"""


def panel_sql(cut_expr: str) -> str:
    return f"""
SELECT o.*, r.avg_occupancy_rate,
       CASE WHEN r.avg_occupancy_rate > {cut_expr} THEN 1 ELSE 0 END AS hot_region
FROM panel_occ o JOIN regions r ON o.neighbourhood_cleansed = r.neighbourhood_cleansed
"""


CTES: dict[str, tuple[str, list[str]]] = {
    "listings_raw": (LISTINGS_RAW_SQL, []),
    "calendar_raw": (CALENDAR_RAW_SQL, []),
    "reviews_raw": (REVIEWS_RAW_SQL, []),
    "listings_c": (LISTINGS_C_SQL, ["listings_raw"]),
    "calendar_c": (CALENDAR_C_SQL, ["calendar_raw"]),
    "reviews_en": (REVIEWS_EN_SQL, ["reviews_raw"]),
    "reviews_c": (REVIEWS_C_SQL, ["reviews_en"]),
    "panel_days": (PANEL_DAYS_SQL, ["listings_c", "calendar_c"]),
    "panel_occ": (PANEL_OCC_SQL, ["panel_days"]),
    "regions": (REGIONS_SQL, ["panel_occ"]),
    "panel": (panel_sql("(SELECT quantile_cont(avg_occupancy_rate, 0.5) FROM regions)"), ["regions"]),
    "panel_fixed": (panel_sql("0.542"), ["regions"]),
}


def register(name: str, sql: str, needs: list[str]) -> None:
    CTES[name] = (sql, needs)


def with_ctes(body: str, *needs: str) -> str:
    """Prefix ``body`` with the named CTEs and everything they depend on."""
    chosen: set[str] = set()

    def visit(n):
        if n in chosen:
            return
        for d in CTES[n][1]:
            visit(d)
        chosen.add(n)

    for n in needs:
        visit(n)
    ordered = [n for n in CTES if n in chosen]
    if not ordered:
        return body
    return "WITH " + ",\n".join(f"{n} AS (\n{CTES[n][0]}\n)" for n in ordered) + "\n" + body
