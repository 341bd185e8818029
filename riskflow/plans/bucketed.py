"""Facts and customers stored alike, so that joining them moves no facts.

Both are bucketed by customer and slice. Customers with more than a small share of the rows are hot:
their facts are dealt over all slices and their own row stands once in each, so no bucket has more than
its share. Facts without a customer are dealt over the slices as well; they match nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskflow.operators.keys import lookup
from riskflow.plans.star import CUSTOMER_CONTEXT, merchant_context

SLICE = "customer_slice"
BUCKET_ROWS = 1_000_000  # facts beyond which a bucket is split
HOT_SHARE = 1_000  # a customer with more than this part of the facts is hot; fewer than that many are


class BucketedStar:
    """Two catalog tables, ``<prefix>_facts`` and ``<prefix>_customers``, below ``root``.

    ``buckets`` is their least number; it grows with the facts.
    """

    def __init__(self, spark: SparkSession, root: str, prefix: str, buckets: int = 64, slices: int = 64) -> None:
        self.spark = spark
        self.root = root.rstrip("/")
        self.prefix = prefix
        self.buckets = buckets
        self.slices = slices

    def _save(self, rows: DataFrame, name: str) -> None:
        """One file per bucket: rows are dealt by the hash that buckets are made by."""
        keys = ["customer_id", SLICE]
        dealt = rows.repartition(self.buckets, *keys).write.bucketBy(self.buckets, *keys).sortBy(*keys)
        dealt.option("path", f"{self.root}/{name}").mode("overwrite").saveAsTable(f"{self.prefix}_{name}")

    def store(self, facts: DataFrame, customers: DataFrame) -> None:
        """Store both; ``facts`` need ``trans_id`` and ``customer_id``."""
        counted = facts.groupBy("customer_id").agg(F.count("*").alias("n"))
        counted.write.mode("overwrite").parquet(f"{self.root}/_rows")
        rows = self.spark.read.parquet(f"{self.root}/_rows")
        known = F.col("customer_id").isNotNull()
        every_row, total = rows.agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.sum(F.when(known, F.col("n"))), F.lit(0))).first()
        self.buckets = max(self.buckets, -(-every_row // BUCKET_ROWS))
        hot = rows.filter(known & (F.col("n") > total // HOT_SHARE + 1)).select("customer_id", F.lit(True).alias("_hot"))
        hot = F.broadcast(hot)  # fewer than HOT_SHARE rows
        dealt = F.pmod(F.xxhash64("trans_id"), F.lit(self.slices)).cast("int")
        spread = F.col("_hot").isNotNull() | F.col("customer_id").isNull()
        sliced = facts.join(hot, "customer_id", "left").withColumn(SLICE, F.when(spread, dealt).otherwise(0))
        self._save(sliced.drop("_hot"), "facts")
        every = F.when(F.col("_hot").isNotNull(), F.sequence(F.lit(0), F.lit(self.slices - 1))).otherwise(F.array(F.lit(0)))
        repeated = customers.join(hot, "customer_id", "left").withColumn(SLICE, F.explode(every))
        self._save(repeated.drop("_hot"), "customers")

    def with_customers(self) -> DataFrame:
        """Stored facts with the customer columns of the joined view."""
        facts, customers = (self.spark.table(f"{self.prefix}_{name}") for name in ("facts", "customers"))
        renamed = [F.col(old).alias(new) for old, new in CUSTOMER_CONTEXT.items()]
        context = customers.select("customer_id", SLICE, *renamed)
        return facts.join(context, ["customer_id", SLICE], "left").drop(SLICE)

    def joined(self, merchants: DataFrame) -> DataFrame:
        """The joined view; merchants are looked up in rows that lie as the facts do."""
        return lookup(self.with_customers(), merchant_context(merchants), "merchant_id", "trans_id")

    def forget(self) -> None:
        """Take both tables out of the catalog; their files stay."""
        for name in ("facts", "customers"):
            self.spark.sql(f"DROP TABLE IF EXISTS {self.prefix}_{name}")
