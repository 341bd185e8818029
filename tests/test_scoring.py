"""Distance, score, alert predicate and reason."""

import itertools
import math

import pytest
from pyspark.sql import functions as F

from riskflow.functions import (
    alert_reason,
    category_band,
    haversine_km,
    is_alert,
    risk_score,
    threshold_band,
    two_decimals,
    whole_number,
)


def value(spark, column):
    return spark.range(1).select(column.alias("v")).first()["v"]


def distance(spark, *degrees):
    return value(spark, haversine_km(*[F.lit(d).cast("double") for d in degrees]))


def score(spark, amount, km, category):
    literals = F.lit(amount).cast("double"), F.lit(km).cast("double")
    return value(spark, risk_score(*literals, F.lit(category).cast("string")))


def reason(spark, amount, km, category):
    literals = F.lit(amount).cast("double"), F.lit(km).cast("double")
    return value(spark, alert_reason(*literals, F.lit(category).cast("string")))


@pytest.mark.parametrize(
    ("degrees", "share"),
    [((0, 179, 0, -179), 2 / 360), ((90, 0, 90, 123), 0.0), ((-90, 5, 90, 77), 0.5), ((0, 10, 0, 100), 0.25), ((10, 3, 40, 3), 30 / 360)],
)
def test_distance_is_a_share_of_the_circumference(spark, degrees, share):
    """The date line, both poles, a quarter of the equator and part of a meridian."""
    assert distance(spark, *degrees) == pytest.approx(share * 2 * math.pi * 6371.0, abs=0.006)


def test_antipodes_are_half_the_circumference(spark):
    assert distance(spark, 0, 0, 0, 180) == round(math.pi * 6371.0, 2)


@pytest.mark.parametrize("missing", range(4))
def test_missing_coordinate_gives_null(spark, missing):
    degrees = [30.0, 31.0, 32.0, 33.0]
    degrees[missing] = None
    assert distance(spark, *degrees) is None


def test_every_band_combination(spark):
    """All 48 combinations against the weighted sum, with 9 scores at 0.70 or more."""
    amounts = {100.0: 0.1, 300.0: 0.4, 700.0: 0.7, 2000.0: 1.0}
    kilometres = {10.0: 0.0, 100.0: 0.3, 300.0: 0.7, 900.0: 1.0}
    categories = {"travel": 0.1, "entertainment": 0.3, "misc_net": 0.6}
    rows = list(itertools.product(amounts, kilometres, categories))
    columns = F.col("a"), F.col("d"), F.col("c")
    found = (
        spark.createDataFrame(rows, "a double, d double, c string")
        .select("*", risk_score(*columns).alias("s"))
        .collect()
    )
    assert len(found) == 48
    for row in found:
        weighted = 0.4 * amounts[row.a] + 0.4 * kilometres[row.d] + 0.2 * categories[row.c]
        assert row.s == round(min(weighted, 1.0), 4), row
    scores = {row.s for row in found}
    assert (len(scores), min(scores), max(scores)) == (27, 0.06, 0.92)
    assert sum(s >= 0.7 for s in [row.s for row in found]) == 9


@pytest.mark.parametrize(
    ("amount", "above"), [(200, 200.01), (500, 500.01), (1000, 1000.01)]
)
def test_amount_bounds_are_exclusive(spark, amount, above):
    assert score(spark, amount, 0, "x") < score(spark, above, 0, "x")


@pytest.mark.parametrize(("km", "above"), [(50, 50.01), (200, 200.01), (500, 500.01)])
def test_distance_bounds_are_exclusive(spark, km, above):
    assert score(spark, 0, km, "x") < score(spark, 0, above, "x")


@pytest.mark.parametrize(
    ("name", "band"),
    [
        ("\tShopping_NET \n", 0.6),
        (" misc_pos ", 0.6),
        ("GAS_transport", 0.3),
        ("travel", 0.1),
        (None, 0.1),
        ("", 0.1),
    ],
)
def test_category_is_stripped_of_all_whitespace(spark, name, band):
    assert value(spark, category_band(F.lit(name).cast("string"))) == band


@pytest.mark.parametrize("row", [(None, 10.0, "x"), (10.0, None, "x")])
def test_missing_number_gives_no_score_and_no_reason(spark, row):
    assert score(spark, *row) is None
    assert reason(spark, *row) is None


@pytest.mark.parametrize(
    ("label", "points", "kind", "alert"),
    [
        (1, 0.1, "double", True),
        (0, 0.7, "double", True),
        (0, 0.7, "float", False),
        (0, 0.74, "float", True),
        (0, 0.69, "double", False),
        (1, None, "double", True),
        (0, None, "double", None),
    ],
)
def test_alert_threshold(spark, label, points, kind, alert):
    assert value(spark, is_alert(F.lit(label), F.lit(points).cast("double"), kind)) is alert


def test_unknown_score_type_is_refused():
    with pytest.raises(ValueError):
        is_alert(None, None, "half")


def test_reason_joins_what_applies_in_order(spark):
    parts = {"distance 201km from home": 201, "high amount $500.50": 500.5, "high-risk category: \tMISC_pos": "\tMISC_pos"}
    for wanted in itertools.product([False, True], repeat=3):
        (km, far), (amount, large), (category, risky) = zip((200, 500, "travel"), wanted)
        values = [v if w else u for (u, w), v in zip(((km, far), (amount, large), (category, risky)), parts.values())]
        text = " | ".join(t for t, w in zip(parts, wanted) if w) or "rule-based flag"
        assert reason(spark, values[1], values[0], values[2]) == text


@pytest.mark.parametrize(("km", "text"), [(250.5, "250"), (251.5, "252"), (0.4, "0")])
def test_whole_numbers_round_half_to_even(spark, km, text):
    assert value(spark, whole_number(F.lit(km))) == text


@pytest.mark.parametrize(
    ("amount", "text"), [(0.125, "0.12"), (0.375, "0.38"), (1234567.5, "1234567.50")]
)
def test_two_decimals_round_half_to_even(spark, amount, text):
    assert value(spark, two_decimals(F.lit(amount))) == text


def test_huge_amount_still_has_a_text(spark):
    assert value(spark, two_decimals(F.lit(1e40))).endswith(".00")


@pytest.mark.parametrize(
    ("rate", "label"), [(0.29, "green"), (0.3, "yellow"), (0.6, "red"), (None, None)]
)
def test_bands_include_their_lower_bound(spark, rate, label):
    column = threshold_band(F.lit(rate).cast("double"), (("yellow", 0.3), ("red", 0.6)))
    assert value(spark, column) == label
