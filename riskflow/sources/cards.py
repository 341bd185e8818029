"""The star-schema test tables seen as card transactions.

``lineitem`` rows play the transactions, ``customer`` the card holders, ``supplier`` the merchants.
Each row carries the raw event fields plus the keys and audit columns of the stored tables.
``lineitem`` may be passed in, for example as a stream.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskflow.functions.text import iso_utc
from riskflow.operators.dedup import first_wins
from riskflow.schemas import RAW_EVENT

LINE_KEY = ("l_orderkey", "l_linenumber")
LINE_ORDER = (
    "l_shipdate",
    "l_partkey",
    "l_suppkey",
    "l_quantity",
    "l_extendedprice",
    "l_discount",
    "l_tax",
    "l_returnflag",
    "l_linestatus",
)
AS_OF = "2001-12-31"
DATE_RANGE = ("1995-01-01", "2001-12-31")
CATEGORY_OF_TYPE = {
    "ECONOMY": "shopping_net",
    "SMALL": "grocery_pos",
    "MEDIUM": "entertainment",
    "PROMO": "misc_net",
    "STANDARD": "food_dining",
    "LARGE": "health_fitness",
}

IS_FRAUD = "int(l_returnflag = 'R' and l_discount >= 0.09D and l_tax >= 0.07D)"
CITY_POP = "int(500 + c_custkey * 37 % 100000)"
GENDER = "if(c_custkey % 2 = 0, 'F', 'M')"
BIRTH = "date_add(date'1935-01-01', int(c_custkey * 97 % 16000))"
STREET = "string(c_custkey % 900 + 1) || ' Main St'"
ZIP = "lpad(string(c_custkey % 100000), 5, '0')"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def table_stream(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table as a file stream, be it one file or a folder of part files.

    The source wants a folder or a glob. A glob on the table's own name meets both shapes once; a
    filter on file names would pass over the part files of a folder.
    """
    schema = spark.read.parquet(f"{sf_dir}/{name}.parquet").schema
    return spark.readStream.schema(schema).parquet(f"{sf_dir}/{name}.parque[t]")


def unique_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``lineitem`` after first-wins on its key, before any join widens it.

    Few lines repeat, so merging them before the exchange would not pay for its sort. They are dealt by
    order, as the join with the orders needs them, so that it moves none of them again.
    """
    lines = table(spark, sf_dir, "lineitem")
    return first_wins(lines, LINE_KEY, LINE_ORDER, rare_repeats=True, deal_by=LINE_KEY[:1])


def card_events(
    spark: SparkSession, sf_dir: str, lines: DataFrame | None = None
) -> DataFrame:
    """Every event, repeated transaction numbers included (unless ``lines`` is unique)."""
    lines = table(spark, sf_dir, "lineitem") if lines is None else lines
    # Orders are few against lines: their customers are found before the lines are widened by both.
    placed = (
        table(spark, sf_dir, "orders")
        .join(table(spark, sf_dir, "customer"), F.expr("o_custkey = c_custkey"))
        .join(table(spark, sf_dir, "nation"), F.expr("c_nationkey = n_nationkey"))
    )
    sold = lines.join(
        table(spark, sf_dir, "part").select("p_partkey", "p_type"),
        F.expr("l_partkey = p_partkey"),
    ).join(
        table(spark, sf_dir, "supplier").select("s_suppkey", "s_name"),
        F.expr("l_suppkey = s_suppkey"),
    )
    named = placed.join(sold, F.expr("l_orderkey = o_orderkey"))
    batch = F.col("o_orderstatus") != "O"
    home_lat, home_long = _home_lat(), _home_long()
    trans_at = _hours_after(F.col("o_orderdate"), F.col("l_partkey"))
    shipped = _hours_after(F.col("l_shipdate"), F.col("l_suppkey"))
    events = named.select(
        _line_id().alias("trans_num"),
        F.date_format(trans_at, "yyyy-MM-dd HH:mm:ss").alias("trans_date_trans_time"),
        F.unix_timestamp(trans_at).alias("unix_time"),
        _amount().alias("amt"),
        F.col("o_custkey").alias("cc_num"),
        F.col("s_name").alias("merchant"),
        _category().alias("category"),
        (home_lat + (F.expr("l_partkey % 21") - 10) * 0.5).alias("merch_lat"),
        (home_long + (F.expr("l_suppkey % 21") - 10) * 0.5).alias("merch_long"),
        home_lat.alias("lat"),
        home_long.alias("long"),
        F.expr(CITY_POP).alias("city_pop"),
        F.expr(IS_FRAUD).alias("is_fraud"),
        _name_part(1).alias("first"),
        _name_part(2).alias("last"),
        F.expr(GENDER).alias("gender"),
        F.expr(BIRTH).cast("string").alias("dob"),
        F.col("c_mktsegment").alias("job"),
        F.expr(STREET).alias("street"),
        F.col("n_name").alias("city"),
        F.col("n_name").alias("state"),
        F.expr(ZIP).alias("zip"),
        iso_utc(shipped).alias("produced_at"),
        F.when(batch, "batch").otherwise("stream").alias("source"),
        F.when(batch, F.col("o_custkey")).alias("customer_id"),
        F.when(batch, F.col("l_suppkey")).alias("merchant_id"),
        trans_at.alias("trans_at"),
        shipped.alias("ingested_at"),
    )
    return events


def unique_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One event per transaction number."""
    return card_events(spark, sf_dir, unique_lines(spark, sf_dir))


def transactions(
    spark: SparkSession, sf_dir: str, lines: DataFrame | None = None
) -> DataFrame:
    """The stored transaction table: ``lineitem`` and ``orders`` alone, no dimension join."""
    lines = unique_lines(spark, sf_dir) if lines is None else lines
    placed = lines.join(table(spark, sf_dir, "orders"), F.expr("l_orderkey = o_orderkey"))
    trans_at = _hours_after(F.col("o_orderdate"), F.col("l_partkey"))
    batch = F.col("o_orderstatus") != "O"
    return placed.select(
        _line_id().alias("trans_id"),
        F.when(batch, F.col("o_custkey")).alias("customer_id"),
        F.when(batch, F.col("l_suppkey")).alias("merchant_id"),
        trans_at.alias("trans_at"),
        F.unix_timestamp(trans_at).alias("unix_time"),
        _amount().alias("amount"),
        F.expr(IS_FRAUD).alias("is_fraud"),
        F.when(batch, "batch").otherwise("stream").alias("source"),
        _hours_after(F.col("l_shipdate"), F.col("l_suppkey")).alias("ingested_at"),
    )


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``customer`` as the stored customer table."""
    return (
        table(spark, sf_dir, "customer")
        .join(table(spark, sf_dir, "nation"), F.expr("c_nationkey = n_nationkey"))
        .select(
            F.col("c_custkey").alias("customer_id"),
            F.col("c_custkey").alias("cc_num"),
            _name_part(1).alias("first_name"),
            _name_part(2).alias("last_name"),
            F.expr(GENDER).alias("gender"),
            F.expr(BIRTH).alias("dob"),
            F.col("c_mktsegment").alias("job"),
            F.expr(STREET).alias("street"),
            F.col("n_name").alias("city"),
            F.col("n_name").alias("state"),
            F.expr(ZIP).alias("zip"),
            _home_lat().alias("lat"),
            _home_long().alias("long"),
            F.expr(CITY_POP).alias("city_pop"),
            _created_at("c_custkey").alias("created_at"),
        )
    )


def merchants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``supplier`` as the stored merchant table; some categories need normalising."""
    names = F.array(*[F.lit(name) for name in CATEGORY_OF_TYPE.values()])
    category = F.element_at(names, F.expr("int(s_suppkey % 6) + 1"))
    return table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("merchant_id"),
        F.col("s_name").alias("merchant_name"),
        F.when(F.expr("s_suppkey % 2 = 1"), F.concat(F.lit(" "), F.upper(category)))
        .otherwise(category)
        .alias("category"),
        (25 + F.expr("s_suppkey * 31 % 240") / F.lit(10.0)).alias("merch_lat"),
        (-120 + F.expr("s_suppkey * 59 % 500") / F.lit(10.0)).alias("merch_long"),
        _created_at("s_suppkey").alias("created_at"),
    )


def raw_fields(events: DataFrame) -> DataFrame:
    """Only the 23 payload fields, in payload order and type."""
    return events.select(
        *[F.col(field.name).cast(field.dataType) for field in RAW_EVENT.fields]
    )


def _line_id() -> Column:
    return F.concat_ws("-", "l_orderkey", "l_linenumber")


def _home_lat() -> Column:
    return 25 + F.expr("c_custkey * 41 % 240") / F.lit(10.0)


def _home_long() -> Column:
    return -120 + F.expr("c_custkey * 53 % 500") / F.lit(10.0)


def _name_part(number: int) -> Column:
    return F.split_part("c_name", F.lit("#"), F.lit(number))


def _created_at(key: str) -> Column:
    return F.timestamp_seconds(788918400 + F.col(key) * 3600)  # hours from 1995-01-01


def _hours_after(day: Column, key: Column) -> Column:
    """``day`` plus ``key % 24`` hours, as an instant."""
    hours = F.make_dt_interval(hours=(key % 24).cast("int"))
    return day.cast("timestamp") + hours


def _amount() -> Column:
    """Discounted price scaled to card-payment size; decimal all the way to keep cents exact."""
    price = F.col("l_extendedprice").cast("decimal(12,2)")
    discount = F.col("l_discount").cast("decimal(4,2)")
    scale = F.lit("0.01").cast("decimal(4,2)")
    return F.round(price * (1 - discount) * scale, 2).cast("decimal(12,2)")


def _category() -> Column:
    chain = None
    for part_type, category in CATEGORY_OF_TYPE.items():
        test = F.col("p_type") == part_type
        chain = F.when(test, category) if chain is None else chain.when(test, category)
    return chain
