"""Sampled rates against a plain loop, offsets and depth."""

import datetime as dt
import random

from riskflow.operators import rates

START = dt.datetime(2024, 1, 1, 23, 0)


def test_rate_continues_over_midnight_and_silent_days(spark):
    draw = random.Random(3)
    rows, expected = [], {}
    for topic in ("a", "b"):
        at, offset, before = START, 100, None
        for _ in range(40):
            rows.append((topic, 0, at, 100 if before is None else before[1], offset))
            seconds = None if before is None else (at - before[0]).total_seconds()
            rate = 0.0 if before is None else (offset - before[1]) / seconds
            expected[(topic, at)] = rate
            before = (at, offset)
            at += dt.timedelta(seconds=15 * draw.choice([1, 40, 500, 20000]))
            offset += draw.randrange(50)
    schema = "topic string, partition int, sampled_at timestamp, first_offset long, end_offset long"
    found = rates.sampled_rate(spark.createDataFrame(rows, schema)).collect()
    assert len(found) == len(expected)
    for row in found:
        assert abs(row.events_per_second - expected[(row.topic, row.sampled_at)]) < 1e-9


def test_rate_sums_the_growth_of_all_partitions(spark):
    """Partition 0 goes from 5 to 25 and partition 1 from 100 to 101 within 15 seconds."""
    early, late, last = (START + dt.timedelta(seconds=s) for s in (1, 16, 31))
    rows = [("raw", 0, o, early) for o in range(5)] + [("raw", 0, o, late) for o in range(5, 25)]
    rows += [("raw", 1, 99, early), ("raw", 1, 100, late)]
    rows += [("raw", 2, o, last) for o in range(40, 46)]  # appears late: counts from offset 40
    log = spark.createDataFrame(rows, "topic string, partition int, offset long, timestamp timestamp")
    found = rates.sampled_rate(rates.offset_samples(log)).orderBy("sampled_at").collect()
    assert [(r.messages, round(r.events_per_second, 6)) for r in found] == [(6, 0.0), (21, 1.4), (6, 0.4)]


def test_depth_sums_all_partitions(spark):
    rows = [("dlq", 0, 5), ("dlq", 0, 9), ("dlq", 1, 2), ("raw", 0, 0)]
    log = spark.createDataFrame(rows, "topic string, partition int, offset long")
    ranges = rates.offset_ranges(log)
    assert {(r.topic, r.partition, r.begin_offset, r.end_offset) for r in ranges.collect()} == {
        ("dlq", 0, 5, 10),
        ("dlq", 1, 2, 3),
        ("raw", 0, 0, 1),
    }
    depth = {r.topic: r.depth for r in rates.topic_depth(ranges).collect()}
    assert depth == {"dlq": 6, "raw": 1}


def test_windows_hold_fifteen_seconds(spark):
    rows = [(START + dt.timedelta(seconds=s),) for s in (0, 14, 15, 44)]
    found = rates.windowed_rate(spark.createDataFrame(rows, "at timestamp"), "at")
    assert sorted((r.window_start, r.events) for r in found.collect()) == [
        (START, 2),
        (START + dt.timedelta(seconds=15), 1),
        (START + dt.timedelta(seconds=30), 1),
    ]
