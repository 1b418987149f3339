"""Great-circle distance as a column expression (haversine)."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# fixed value: mean Earth radius in statute miles
EARTH_RADIUS_MILES = 3958.8


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def great_circle_miles(lat1, lon1, lat2, lon2) -> Column:
    p1, p2 = F.radians(_c(lat1)), F.radians(_c(lat2))
    dp = p2 - p1
    dl = F.radians(_c(lon2)) - F.radians(_c(lon1))
    h = F.pow(F.sin(dp / 2), 2) + F.cos(p1) * F.cos(p2) * F.pow(F.sin(dl / 2), 2)
    return F.lit(2 * EARTH_RADIUS_MILES) * F.asin(F.sqrt(F.least(h, F.lit(1.0))))
