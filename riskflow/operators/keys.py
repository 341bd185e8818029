"""Surrogate keys and their resolution."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def surrogate_key(natural_key: str) -> Column:
    """128-bit digest of a text key: no counter, no ordering, the same on every run.

    Wide enough that keys do not collide at any number of rows; card holders need none, as their card
    number is a key already.
    """
    return F.md5(F.col(natural_key).cast("binary"))


def resolve_keys(
    events: DataFrame, customers: DataFrame, merchants: DataFrame
) -> DataFrame:
    """Attach ``customer_id`` and ``merchant_id``; events missing either are dropped.

    No broadcast hint: both dimensions may grow, Catalyst broadcasts them by measured size.
    """
    return events.join(
        customers.select("cc_num", "customer_id"), "cc_num", "inner"
    ).join(
        merchants.select(F.col("merchant_name").alias("merchant"), "merchant_id"),
        "merchant",
        "inner",
    )


def unresolved_keys(
    events: DataFrame, customers: DataFrame, merchants: DataFrame
) -> DataFrame:
    """The complement of :func:`resolve_keys`, with a flag per missing side."""
    looked_up = lookup(
        lookup(
            events,
            customers.select("cc_num", F.lit(True).alias("_customer_known")),
            "cc_num",
            spread_by="trans_num",
        ),
        merchants.select(
            F.col("merchant_name").alias("merchant"), F.lit(True).alias("_merchant_known")
        ),
        "merchant",
        spread_by="trans_num",
    )
    return (
        looked_up.withColumns(
            {
                "customer_missing": F.col("_customer_known").isNull(),
                "merchant_missing": F.col("_merchant_known").isNull(),
            }
        )
        .filter("customer_missing or merchant_missing")
        .drop("_customer_known", "_merchant_known")
    )


def lookup(facts: DataFrame, dimension: DataFrame, key: str, spread_by: str) -> DataFrame:
    """Left join on ``key`` that stays balanced when many facts have a NULL key.

    Rows without a key can never match, yet a plain left join hashes all of them to one task.
    Here their join value is a hash of ``spread_by``, and the extra NOT NULL condition keeps such a
    row from matching whatever that value is. Hot non-NULL keys are left to AQE's skew split.
    """
    renamed = dimension.withColumnRenamed(key, "_dimension_key")
    key_type = facts.schema[key].dataType
    narrow = isinstance(key_type, T.IntegerType)
    spread = F.hash(spread_by) if narrow else F.xxhash64(spread_by).cast(key_type)
    condition = (F.coalesce(F.col(key), spread) == F.col("_dimension_key")) & F.col(
        key
    ).isNotNull()
    return facts.join(renamed, condition, "left").drop("_dimension_key")


def orphans(
    child: DataFrame, parent: DataFrame, child_key: str, parent_key: str | None = None
) -> DataFrame:
    """Child rows whose non-NULL foreign key has no parent."""
    parents = parent.select(F.col(parent_key or child_key).alias(child_key))
    return child.filter(F.col(child_key).isNotNull()).join(parents, child_key, "left_anti")
