"""Great-circle distance."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

EARTH_RADIUS_KM = 6371.0


def haversine_km(
    home_lat: Column, home_long: Column, shop_lat: Column, shop_long: Column
) -> Column:
    """Distance in kilometres, two decimals; NULL when any coordinate is NULL."""

    def half_angle_squared(delta: Column) -> Column:
        sine = F.sin(F.radians(delta) / 2)
        return sine * sine

    chord = half_angle_squared(shop_lat - home_lat) + (
        F.cos(F.radians(home_lat))
        * F.cos(F.radians(shop_lat))
        * half_angle_squared(shop_long - home_long)
    )
    # Rounding can push the chord a hair past 1 for antipodes; greatest() keeps the root real.
    angle = 2 * F.atan2(F.sqrt(chord), F.sqrt(F.greatest(1 - chord, F.lit(0.0))))
    return F.round(EARTH_RADIUS_KM * angle, 2)
