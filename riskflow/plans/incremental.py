"""Facts and marts kept up to date load by load, without a rebuild."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskflow.operators.keys import lookup
from riskflow.plans import marts, staging, star
from riskflow.sources.tables import TableStore, children


class DailyWarehouse:
    """Facts and the daily mart by period, and the customer mart as mergeable states by load.

    Applying a load reads its rows and the stored facts of the periods (days, or another ``grain`` that
    dates are truncated to) these fall on, and replaces their partitions; all others stay as they are. The customer mart adds the state of the load
    to those of earlier loads and reads no facts. A load applied again replaces its own share.
    """

    def __init__(
        self,
        store: TableStore,
        root: str,
        as_of: Column | None = None,
        calendar: tuple[str, str] = (star.SPINE_START, star.SPINE_END),
        grain: str = "day",
    ) -> None:
        self.store = store
        self.spark = store.spark
        self.root = root.rstrip("/")
        self.as_of = as_of
        self.calendar = calendar
        self.grain = grain

    def _period(self, at: str) -> Column:
        return F.date_trunc(self.grain, F.col(at)).cast("date")

    def _customers(self) -> DataFrame:
        return staging.stg_customers(self.store.read("customers"), self.as_of)

    def _merchants(self) -> DataFrame:
        return staging.stg_merchants(self.store.read("merchants"))

    def _stored(self, name: str) -> DataFrame | None:
        path = f"{self.root}/{name}"
        return self.spark.read.parquet(path) if children(self.spark, path) else None

    def _replace(self, name: str, rows: DataFrame) -> None:
        """Replace the periods that occur in ``rows``; large ones get several files."""
        dealt = rows.hint("rebalance", "period").write.partitionBy("period").mode("overwrite")
        dealt.option("partitionOverwriteMode", "dynamic").parquet(f"{self.root}/{name}")

    def apply(self, load_id: str) -> list[dt.date]:
        """Bring facts and marts up to date with a stored load; returns the periods it touched."""
        stored = self.store.read("transactions", with_batch_id=True)
        load = staging.stg_transactions(stored.filter(F.col("batch_id") == load_id).drop("batch_id")).persist()
        try:
            touched = load.select(self._period("trans_at").alias("period")).distinct().collect()
            periods = sorted(row.period for row in touched)
            if periods:
                self._apply_facts(load, load_id, periods)
                summary = marts.mart_fraud_summary(self._stats(periods))
                self._replace("mart_fraud_summary", summary.withColumn("period", self._period("txn_date")))
            state = marts.customer_state(load, self._merchants())
            state.write.mode("overwrite").parquet(f"{self.root}/customer_state/load_id={load_id}")
        finally:
            load.unpersist()
        return periods

    def _apply_facts(self, load: DataFrame, load_id: str, periods: list[dt.date]) -> None:
        facts = star.fact_transactions(load, *self.calendar)
        facts = facts.withColumns({"load_id": F.lit(load_id), "period": self._period("trans_at")})
        before = self._stored("fact_transactions")
        if before is not None:
            others = before.filter(F.col("period").isin(periods) & (F.col("load_id") != load_id))
            facts = facts.unionByName(others)
        self._replace("fact_transactions", facts)

    def _stats(self, periods: list[dt.date]) -> DataFrame:
        """The columns of the joined view that the daily mart reads, of some periods."""
        facts = self._stored("fact_transactions").filter(F.col("period").isin(periods))
        states = self._customers().select("customer_id", F.col("state").alias("customer_state"))
        categories = self._merchants().select("merchant_id", F.col("category").alias("merchant_category"))
        return lookup(lookup(facts, states, "customer_id", "trans_id"), categories, "merchant_id", "trans_id")

    def facts(self) -> DataFrame:
        return self._stored("fact_transactions").drop("load_id", "period")

    def daily_summary(self) -> DataFrame:
        return self._stored("mart_fraud_summary").drop("period")

    def customer_mart(self) -> DataFrame:
        states = self._stored("customer_state").drop("load_id")
        return marts.customer_profiles(marts.merged_states(states), self._customers())
