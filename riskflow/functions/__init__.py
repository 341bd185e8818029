"""Column functions; all of them compile to native Spark expressions."""

from riskflow.functions.bands import threshold_band
from riskflow.functions.dates import (
    completed_years,
    date_key,
    day_of_week,
    hour_of_day,
    is_weekend,
    padded_day_name,
    padded_month_name,
    parse_event_time,
)
from riskflow.functions.geo import haversine_km
from riskflow.functions.measures import average, percentage
from riskflow.functions.scoring import (
    alert_reason,
    amount_band,
    category_band,
    distance_band,
    is_alert,
    risk_score,
)
from riskflow.functions.text import (
    full_name,
    iso_utc,
    normalised_category,
    row_as_json,
    two_decimals,
    whole_number,
)

__all__ = [
    "alert_reason",
    "amount_band",
    "average",
    "category_band",
    "completed_years",
    "date_key",
    "day_of_week",
    "distance_band",
    "full_name",
    "haversine_km",
    "hour_of_day",
    "is_alert",
    "is_weekend",
    "iso_utc",
    "normalised_category",
    "padded_day_name",
    "padded_month_name",
    "parse_event_time",
    "percentage",
    "risk_score",
    "row_as_json",
    "threshold_band",
    "two_decimals",
    "whole_number",
]
