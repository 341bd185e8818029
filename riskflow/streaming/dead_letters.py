"""Dead letters: the rejected row as JSON, with the reason and the time added."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskflow.functions import iso_utc, row_as_json, threshold_band
from riskflow.functions.bands import DEAD_LETTER_STEPS
from riskflow.streaming.events import CORRUPT

PEEK_ROWS = 20
DEPTH_THRESHOLD = 0


def to_dead_letters(
    rows: DataFrame, reason: Column | None = None, at: Column | None = None
) -> DataFrame:
    """(key, value, _dlq_reason, _dlq_at); rows bring ``_dlq_reason`` unless one is given.

    The conversion runs where the rows are; nothing is gathered on the driver.
    """
    tagged = rows
    if reason is not None:
        tagged = tagged.withColumn("_dlq_reason", reason)
    moment = iso_utc(F.current_timestamp()) if at is None else at
    tagged = tagged.withColumn("_dlq_at", moment)
    if CORRUPT in tagged.columns:
        payload = [c for c in tagged.columns if c != CORRUPT]
        value = F.when(
            F.col(CORRUPT).isNotNull(), row_as_json(CORRUPT, "_dlq_reason", "_dlq_at")
        ).otherwise(row_as_json(*payload))
    else:
        value = row_as_json(*tagged.columns)
    return tagged.select(
        F.col("trans_num").alias("key"), value.alias("value"), "_dlq_reason", "_dlq_at"
    )


def failure_reason(error: Exception) -> Column:
    return F.lit(f"{type(error).__name__}: {error}")


def peek(dead_letters: DataFrame, *order: str, limit: int = PEEK_ROWS) -> DataFrame:
    """The first messages, oldest first."""
    return dead_letters.orderBy(*(order or ("_dlq_at", "key", "value"))).limit(limit)


def depth_status(depth: DataFrame, threshold: int = DEPTH_THRESHOLD) -> DataFrame:
    """Depth with the branch the monitor takes and the colour its panel shows."""
    action = F.when(F.col("depth") > threshold, "alert_team").otherwise("no_action")
    band = threshold_band(F.col("depth"), DEAD_LETTER_STEPS)
    return depth.withColumns({"action": action, "band": band})


def topic_depth(messages: DataFrame, topic: str) -> DataFrame:
    """``topic, depth`` of a file topic, which keeps all messages it was sent."""
    return messages.agg(F.count("*").alias("depth")).select(F.lit(topic).alias("topic"), "depth")
