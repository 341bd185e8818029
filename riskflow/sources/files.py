"""CSV scans with declared schemas; Spark splits the files, so no chunking is needed."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskflow.functions import iso_utc, parse_event_time, row_as_json
from riskflow.schemas import RAW_EVENT

# The columns each load reads from the transaction CSV.
CUSTOMER_COLUMNS = (
    "cc_num", "first", "last", "gender", "dob", "job", "street", "city", "state", "zip", "lat", "long",
    "city_pop",
)
MERCHANT_COLUMNS = ("merchant", "category", "merch_lat", "merch_long")
TRANSACTION_COLUMNS = (
    "trans_num", "trans_date_trans_time", "unix_time", "amt", "is_fraud", "cc_num", "merchant",
)
ORDER_COLUMNS = ("unix_time", "trans_num")


def read_csv_events(spark: SparkSession, path: str) -> DataFrame:
    """The whole CSV as text columns, matched to the header by name."""
    return spark.read.option("header", True).option("escape", '"').csv(path)


def land(events: DataFrame, path: str) -> DataFrame:
    """Parse the text once into typed Parquet; the loads then read only their columns."""
    names = [*CUSTOMER_COLUMNS, *MERCHANT_COLUMNS, *TRANSACTION_COLUMNS]
    _typed(events, names).write.mode("overwrite").parquet(path)
    return events.sparkSession.read.parquet(path)


def _typed(events: DataFrame, names: list[str]) -> DataFrame:
    """Select and cast by the declared payload types; text that does not parse becomes NULL."""
    wanted = list(dict.fromkeys([*names, *ORDER_COLUMNS]))
    return events.select(
        *[F.col(name).try_cast(RAW_EVENT[name].dataType).alias(name) for name in wanted]
    )


def scan_customers(events: DataFrame) -> DataFrame:
    """Card-holder columns plus the two columns that define which row came first."""
    return _typed(events, CUSTOMER_COLUMNS).withColumn("dob", F.col("dob").try_cast("date"))


def scan_merchants(events: DataFrame) -> DataFrame:
    return _typed(events, MERCHANT_COLUMNS)


def scan_transactions(events: DataFrame) -> DataFrame:
    """Transaction columns; the event time is parsed, the amount becomes decimal."""
    return (
        _typed(events, TRANSACTION_COLUMNS)
        .withColumn("trans_at", parse_event_time(F.col("trans_date_trans_time")))
        .withColumn("amt", F.round("amt", 2).try_cast("decimal(12,2)"))
        .drop("trans_date_trans_time")
    )


def to_payload(rows: DataFrame, produced_at=None) -> DataFrame:
    """Rows to the 23 typed payload fields; dates and zip are text.

    A number that the rows have no column for is 0. One that is null or does not parse stays null, so
    that :func:`riskflow.streaming.events.rejection` finds it.
    """
    names = set(rows.columns)
    stringly = {"trans_date_trans_time", "dob", "zip"}
    produced = iso_utc(F.current_timestamp()) if produced_at is None else produced_at
    columns = []
    for field in RAW_EVENT.fields:
        if field.name == "produced_at":
            column = produced
        else:
            absent = field.name not in names
            text = isinstance(field.dataType, T.StringType)
            column = F.lit(None if text else 0) if absent else F.col(field.name)
            column = column.try_cast(field.dataType)
            if field.name in stringly:
                column = F.coalesce(column, F.lit("None"))
        columns.append(column.alias(field.name))
    return rows.select(*columns)


def to_messages(payload: DataFrame) -> DataFrame:
    """Payload rows to (key, value) messages; the key keeps one card event on one partition.

    A row without a transaction number still gets a key: a hash of the row spreads such rows.
    """
    fallback = F.xxhash64(*payload.columns).cast("string")
    key = F.coalesce(F.nullif("trans_num", F.lit("")), fallback)
    return payload.select(key.alias("key"), row_as_json(*payload.columns).alias("value"))


def write_replay(payload: DataFrame, path: str, key: str = "unix_time", compression: str = "none") -> None:
    """Replay files in event-time order: range-partitioned, sorted inside each file."""
    ordered = payload.repartitionByRange(key, "trans_num").sortWithinPartitions(
        key, "trans_num"
    )
    ordered.select(row_as_json(*payload.columns).alias("value")).write.mode(
        "overwrite"
    ).text(path, compression=compression)


def replay_measures(spark: SparkSession, path: str, key: str = "unix_time") -> DataFrame:
    """``measure, value`` of replay files: their messages, how often time falls from a line to the next that has a
    time, anywhere within a file, and how many files begin before one that begins earlier has ended.

    Tasks compare the lines where they lie, in their order; what is shuffled is one row per piece of a file.
    """
    names = ["file", "start", "lines", "falls", "opens", "closes", "first", "last"]

    def pieces(batches):
        """What a task read of each file as one row: times at both ends, the least and the largest."""
        import numpy as np
        import pyarrow as pa

        def row(piece: dict) -> pa.RecordBatch:
            columns = [pa.array([piece[n]], pa.int64() if n != "file" else pa.string()) for n in names]
            return pa.RecordBatch.from_arrays(columns, names)

        piece = None
        for batch in batches:
            file, start, at = batch.columns
            number, begin = file.dictionary_encode().indices.to_numpy(), start.to_numpy()
            cuts = np.flatnonzero((number[1:] != number[:-1]) | (begin[1:] != begin[:-1])) + 1
            for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), batch.num_rows]):
                if a == b:
                    continue
                if piece is None or (piece["file"], piece["start"]) != (file[a].as_py(), start[a].as_py()):
                    if piece is not None:
                        yield row(piece)
                    piece = {**dict.fromkeys(names), "file": file[a].as_py(), "start": start[a].as_py(), "lines": 0, "falls": 0}
                piece["lines"] += b - a
                own = at.slice(a, b - a).drop_null().to_numpy()
                if not len(own):
                    continue
                piece["falls"] += int((own[1:] < own[:-1]).sum())
                if piece["opens"] is None:
                    piece |= {"opens": int(own[0]), "first": int(own.min()), "last": int(own.max())}
                else:
                    piece["falls"] += int(own[0] < piece["closes"])
                    piece |= {"first": min(piece["first"], int(own.min())), "last": max(piece["last"], int(own.max()))}
                piece["closes"] = int(own[-1])
        if piece is not None:
            yield row(piece)

    moment = F.get_json_object("value", f"$.{key}").cast("long")
    lines = spark.read.text(path).select(
        F.input_file_name().alias("file"), F.input_file_block_start().alias("start"), moment.alias("at")
    )
    shape = ", ".join(f"{n} {'string' if n == 'file' else 'long'}" for n in names)
    before = Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    between = F.last("closes", ignorenulls=True).over(before) > F.col("opens")
    spans = lines.mapInArrow(pieces, shape).withColumn("between", between.cast("int")).groupBy("file").agg(
        F.sum("lines").alias("messages"),
        (F.sum("falls") + F.coalesce(F.sum("between"), F.lit(0))).alias("falls"),
        F.min("first").alias("first"),
        F.max("last").alias("last"),
    )
    earlier = Window.orderBy("first", "last").rowsBetween(Window.unboundedPreceding, -1)  # one row per file
    overlap = F.max("last").over(earlier) > F.col("first")
    counts = spans.withColumn("overlaps", overlap.cast("int")).agg(
        *[F.coalesce(F.sum(name), F.lit(0)).alias(name) for name in ("messages", "falls", "overlaps")]
    )
    return counts.selectExpr(
        "stack(3, 'messages', messages, 'falls', falls, 'overlaps', overlaps) as (measure, value)"
    )
