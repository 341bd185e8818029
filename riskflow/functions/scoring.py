"""Weighted risk score, alert predicate and alert reason.

A NULL amount or distance gives a NULL score: such rows are rejected upstream, they must not
slide into the lowest band.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from riskflow.functions.text import stripped, two_decimals, whole_number

# Exclusive lower bounds with the band value above them, highest first.
AMOUNT_BANDS = ((1000.0, 1.0), (500.0, 0.7), (200.0, 0.4))
AMOUNT_FLOOR = 0.1
DISTANCE_BANDS = ((500.0, 1.0), (200.0, 0.7), (50.0, 0.3))
DISTANCE_FLOOR = 0.0
HIGH_RISK = ("shopping_net", "misc_net", "grocery_pos", "shopping_pos", "misc_pos")
MEDIUM_RISK = ("entertainment", "gas_transport", "food_dining")
HIGH_BAND, MEDIUM_BAND, CATEGORY_FLOOR = 0.6, 0.3, 0.1
AMOUNT_WEIGHT, DISTANCE_WEIGHT, CATEGORY_WEIGHT = 0.4, 0.4, 0.2
ALERT_THRESHOLD = 0.7
REASON_DISTANCE_KM, REASON_AMOUNT = 200.0, 500.0
REASON_SEPARATOR, REASON_DEFAULT = " | ", "rule-based flag"


def _band(value: Column, bands: tuple[tuple[float, float], ...], floor: float) -> Column:
    chain = F.when(value.isNull(), F.lit(None).cast("double"))
    for bound, level in bands:
        chain = chain.when(value > bound, level)
    return chain.otherwise(floor)


def _risk_class(category: Column) -> Column:
    return stripped(F.lower(F.coalesce(category, F.lit(""))))


def amount_band(amount: Column) -> Column:
    return _band(amount, AMOUNT_BANDS, AMOUNT_FLOOR)


def distance_band(distance_km: Column) -> Column:
    return _band(distance_km, DISTANCE_BANDS, DISTANCE_FLOOR)


def category_band(category: Column) -> Column:
    name = _risk_class(category)
    return (
        F.when(name.isin(*HIGH_RISK), HIGH_BAND)
        .when(name.isin(*MEDIUM_RISK), MEDIUM_BAND)
        .otherwise(CATEGORY_FLOOR)
    )


def risk_score(amount: Column, distance_km: Column, category: Column) -> Column:
    """Score in 0..1, four decimals."""
    weighted = (
        AMOUNT_WEIGHT * amount_band(amount)
        + DISTANCE_WEIGHT * distance_band(distance_km)
        + CATEGORY_WEIGHT * category_band(category)
    )
    # least() skips NULLs, hence the explicit test.
    known = amount.isNotNull() & distance_km.isNotNull()
    return F.when(known, F.round(F.least(weighted, F.lit(1.0)), 4))


def is_alert(is_fraud: Column, score: Column, score_type: str = "double") -> Column:
    """Labelled fraud, or a score at the threshold.

    ``score_type="float"`` narrows the score first, where 0.70 falls just short of 0.7.
    """
    if score_type not in ("double", "float"):
        raise ValueError(f"score_type must be double or float, not {score_type!r}")
    return (is_fraud == 1) | (score.cast(score_type) >= F.lit(ALERT_THRESHOLD))


def alert_reason(amount: Column, distance_km: Column, category: Column) -> Column:
    """Readable reason; the category appears as it was sent."""
    far = F.when(
        distance_km > REASON_DISTANCE_KM,
        F.concat(F.lit("distance "), whole_number(distance_km), F.lit("km from home")),
    )
    large = F.when(
        amount > REASON_AMOUNT, F.concat(F.lit("high amount $"), two_decimals(amount))
    )
    risky = F.when(
        _risk_class(category).isin(*HIGH_RISK),
        F.concat(F.lit("high-risk category: "), category),
    )
    joined = F.concat_ws(REASON_SEPARATOR, far, large, risky)
    return F.when(
        amount.isNotNull() & distance_km.isNotNull(),
        F.coalesce(F.nullif(joined, F.lit("")), F.lit(REASON_DEFAULT)),
    )
