"""Small inputs that several test files share."""

from __future__ import annotations

SMALL = "/root/testdata/sf0.001"


def event(number: str | None = "t1", **fields) -> dict:
    """A valid event with the given fields changed."""
    base = {
        "trans_num": number,
        "trans_date_trans_time": "2020-06-21 12:14:25",
        "unix_time": 1371816865,
        "amt": 25.5,
        "cc_num": 42,
        "merchant": "Kirlin and Sons",
        "category": "grocery_pos",
        "merch_lat": 40.0,
        "merch_long": -80.0,
        "lat": 40.1,
        "long": -80.1,
        "city_pop": 1000,
        "is_fraud": 0,
        "first": "Ada",
        "last": "Byron",
        "gender": "F",
        "dob": "1980-02-29",
        "job": "Engineer",
        "street": "1 Main St",
        "city": "York",
        "state": "SC",
        "zip": "01234",
        "produced_at": "2020-06-21T12:14:26+00:00",
    }
    return {**base, **fields}


def frame(spark, rows: list[dict], schema=None):
    from riskflow.schemas import RAW_EVENT

    schema = schema or RAW_EVENT
    return spark.createDataFrame([tuple(r.get(n) for n in schema.names) for r in rows], schema)
