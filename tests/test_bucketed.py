"""Facts and customers stored alike: the join moves no facts, hot customers are split."""

import uuid
from collections import Counter

import pytest
from pyspark.sql import functions as F

from riskflow.operators.keys import lookup
from riskflow.plans.bucketed import SLICE, BucketedStar
from riskflow.plans.star import CUSTOMER_CONTEXT, customer_context


@pytest.fixture
def tables(spark, tmp_path):
    out = BucketedStar(spark, str(tmp_path / "star"), f"star_{tmp_path.name.replace('-', '_')}", buckets=6, slices=8)
    yield out
    out.forget()


def rows(spark):
    """Four thousand facts: a third of one customer, a third of none, the rest of a thousand others."""
    customer = F.expr("CASE id % 3 WHEN 0 THEN 7 WHEN 1 THEN NULL ELSE 100 + id % 1000 END").cast("bigint")
    facts = spark.range(4_000).select(F.concat(F.lit("t"), "id").alias("trans_id"), customer.alias("customer_id"), F.col("id").alias("amount"))
    ids = spark.range(90, 900).unionByName(spark.createDataFrame([(7,)], "id long"))
    columns = [F.concat(F.lit(f"{old}-"), "id").alias(old) for old in CUSTOMER_CONTEXT]
    return facts, ids.select(F.col("id").alias("customer_id"), *columns)


def test_join_equals_the_lookup(spark, tables):
    facts, customers = rows(spark)
    tables.store(facts, customers)
    want = lookup(facts, customer_context(customers), "customer_id", "trans_id")
    got = tables.with_customers().select(*want.columns)
    assert Counter(map(tuple, got.collect())) == Counter(map(tuple, want.collect()))


def test_facts_stay_where_they_are(spark, tables):
    facts, customers = rows(spark)
    tables.store(facts, customers)
    held = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = tables.with_customers()
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Exchange" not in plan and plan.count("Bucketed: true") == 2
        assert joined.count() == 4_000
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", held)


def test_hot_customer_and_missing_ones_are_split(spark, tables):
    facts, customers = rows(spark)
    tables.store(facts, customers)
    stored = spark.table(f"{tables.prefix}_facts")
    for one in (F.col("customer_id") == 7, F.col("customer_id").isNull()):
        sizes = [r["count"] for r in stored.filter(one).groupBy(SLICE).count().collect()]
        assert len(sizes) == 8 and max(sizes) < 2 * min(sizes)
    assert spark.table(f"{tables.prefix}_customers").filter("customer_id = 7").count() == 8


def test_no_facts(spark, tables):
    facts, customers = rows(spark)
    tables.store(facts.limit(0), customers)
    assert tables.with_customers().count() == 0


def test_buckets_grow_with_the_facts(spark, tmp_path, monkeypatch):
    from riskflow.plans import bucketed

    monkeypatch.setattr(bucketed, "BUCKET_ROWS", 10)
    facts = spark.range(95).selectExpr("string(id) as trans_id", "if(id % 5 = 0, null, id % 7) as customer_id")
    customers = spark.range(7).selectExpr("id as customer_id")
    tables = bucketed.BucketedStar(spark, str(tmp_path / "star"), f"grow_{uuid.uuid4().hex}", buckets=2)
    tables.store(facts, customers)
    tables.forget()
    assert tables.buckets == 10
    assert spark.read.parquet(f"{tmp_path}/star/facts").count() == 95
