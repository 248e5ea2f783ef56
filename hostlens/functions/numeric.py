"""Numeric, geographic and calendar column functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ._util import col_of

EARTH_RADIUS_KM = 6371.0
# fixed values: the city centre distances are measured from
CENTRE_LAT = 49.2827
CENTRE_LON = -123.1207


def log_price(c) -> Column:
    """Natural log; zero or negative prices give NULL."""
    return F.log(col_of(c).cast("double"))


def haversine_km(lat, lon, centre_lat: float = CENTRE_LAT,
                 centre_lon: float = CENTRE_LON,
                 radius_km: float = EARTH_RADIUS_KM) -> Column:
    """Great-circle distance in km from (lat, lon) to a fixed centre."""
    lat_r = F.radians(col_of(lat).cast("double"))
    lon_r = F.radians(col_of(lon).cast("double"))
    c_lat = F.radians(F.lit(centre_lat))
    c_lon = F.radians(F.lit(centre_lon))
    a = (F.pow(F.sin((c_lat - lat_r) / 2), 2)
         + F.cos(lat_r) * F.cos(c_lat) * F.pow(F.sin((c_lon - lon_r) / 2), 2))
    return F.lit(radius_km) * (2 * F.atan2(F.sqrt(a), F.sqrt(1 - a)))


def weekend_flag(d) -> Column:
    """1 for Friday or Saturday (``dayofweek`` 6, 7 with 1 = Sunday), else 0."""
    return F.when(F.dayofweek(col_of(d)).isin(6, 7), 1).otherwise(0)


def rental_label(available) -> Column:
    """available -> 0 (not rented), anything else -> 1 (rented out)."""
    return F.when(col_of(available) == F.lit(True), 0).otherwise(1)


def threshold_flag(c, threshold: float) -> Column:
    """1 when the value is strictly above ``threshold`` else 0."""
    return F.when(col_of(c) > F.lit(threshold), 1).otherwise(0)


def category_weight(category, match: str, when_match, otherwise) -> Column:
    """Constant chosen by a category value (plot point size / alpha)."""
    return F.when(col_of(category) == match, F.lit(when_match)).otherwise(F.lit(otherwise))
