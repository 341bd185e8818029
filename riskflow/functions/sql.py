"""The scoring functions for users of SQL: temporary functions whose bodies are native expressions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from riskflow.functions.geo import haversine_km
from riskflow.functions.scoring import alert_reason, is_alert, risk_score

_PLACES = {"home_lat": "double", "home_long": "double", "shop_lat": "double", "shop_long": "double"}
_PURCHASE = {"amount": "double", "distance_km": "double", "category": "string"}
_SCORED = {"is_fraud": "int", "score": "double"}

# Name -> parameters with their types, and the column function; results have the types of its columns.
FUNCTIONS: dict[str, tuple[dict[str, str], Callable[..., Column]]] = {
    "haversine_km": (_PLACES, haversine_km),
    "risk_score": (_PURCHASE, risk_score),
    "alert_reason": (_PURCHASE, alert_reason),
    "is_alert": (_SCORED, is_alert),
}


def definition(spark: SparkSession, name: str) -> str:
    """The statement that defines a function; its body is what the column function builds."""
    parameters, build = FUNCTIONS[name]
    none = spark.range(0).select(*[F.lit(None).cast(kind).alias(n) for n, kind in parameters.items()])
    built = none.select(build(*[F.col(n) for n in parameters]).alias("result"))
    body = built._jdf.queryExecution().analyzed().expressions().head().child().sql()
    declared = ", ".join(f"{n} {kind.upper()}" for n, kind in parameters.items())
    returned = built.schema["result"].dataType.simpleString().upper()
    return f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({declared}) RETURNS {returned} RETURN {body}"


def register(spark: SparkSession) -> None:
    """Define all functions in the session, for ``SELECT haversine_km(...)`` and the like."""
    for name in FUNCTIONS:
        spark.sql(definition(spark, name))
