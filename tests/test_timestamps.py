import pytest
from pyspark.sql import functions as F

from tributary.functions.timestamps import delivery_ts_ms, effective_ts_ms
from tributary.operators.enrich import with_event_time, with_json_event_time, with_text_event_time

AS_OF = 1_756_550_000_000  # 2025-08-30
PRIOR = 1_000_000


def event_ms(spark, step, messages):
    rows = [(i, m) for i, m in enumerate(messages)]
    df = spark.createDataFrame(rows, "i int, message string").withColumn("timestamp", F.timestamp_millis(F.lit(PRIOR)))
    done = df.transform(step).select("i", F.unix_millis("timestamp").alias("ms")).collect()
    return [r.ms for r in sorted(done)]


def test_delivery_timestamp(spark):
    cases = {
        '"2024-01-01T12:00:00Z"': 1704110400000,
        '"2024-01-01T12:00:00-05:00"': 1704128400000,
        "1704110400": 1704110400000,
        "1704110400000": 1704110400000,
        "999999999999": 999999999999000,
        "1000000000000": 1000000000000000,
        "1000000000001": 1000000000001,
        "1704110400.123": 1704110400123,
        '"2024-01-15T10:30:00.123456789Z"': 1705314600123,
        '"2024-01-15T10:30:00,5+01:00"': 1705311000500,
        '"2024-01-01"': 7,
        '"2024-01-01T12:00:00"': 7,
        '"2024-13-01T12:00:00Z"': 7,
        '"Europe/Paris"': 7,
        "null": 7,
        "true": 7,
        "{}": 7,
    }
    df = spark.createDataFrame(list(cases.items()), "j string, want bigint")
    got = df.select("j", "want", delivery_ts_ms(F.try_parse_json("j"), 7).alias("got")).collect()
    assert {r.j: r.got for r in got} == cases
    absent = spark.range(1).select(delivery_ts_ms(F.lit(None).cast("variant"), 7).alias("ms"))
    assert absent.first().ms == 7


def test_effective_time_scales_small_values_again(spark):
    rows = [(None, 5_000_000_000_000), (0, 5_000_000_000_000), (1704110400000, 1), (915148800000, 1), (None, None)]
    df = spark.createDataFrame(rows, "ts bigint, up bigint")
    got = [r.t for r in df.select(effective_ts_ms(F.col("ts"), F.col("up")).alias("t")).collect()]
    assert got == [5_000_000_000_000, 5_000_000_000_000, 1704110400000, 915148800000000, None]


def test_json_event_time(spark):
    cases = {
        '{"ts":"2025-08-30T06:11:26.816Z"}': 1756534286816,
        '{"ts":"1724999486"}': 1724999486000,
        '{"ts":1724999486816}': 1724999486000,
        '{"ts":1724999486.9}': 1724999486000,
        '{"ts":"1724999486816"}': 1724999486000,
        '{"ts":1000000000000}': 1000000000000,
        '{"time":"2025-08-30T09:21:21Z"}': 1756545681000,
        '{"time":1724999486}': PRIOR,
        '{"ts":"invalid-timestamp"}': PRIOR,
        '{"ts":null,"time":"2025-08-30T09:21:21Z"}': PRIOR,
        '{"ts":"2025-08-30T06:11:26.816Z","time":"2025-08-30T09:21:21Z"}': 1756534286816,
        '{"stageTimestamp":"2025-08-30T09:21:21.5Z","requestReceivedTimestamp":"2020-01-01T00:00:00Z"}': 1756545681500,
        '{"requestReceivedTimestamp":"2025-08-30T09:21:21Z"}': 1756545681000,
        '{"ts":1e30}': PRIOR,
        '{"ts":true}': PRIOR,
        '{"ts":1724999486} trailing': PRIOR,
        '{"ts":1724999486}{"ts":1}': PRIOR,
        ' {"ts":1724999486}': PRIOR,
        '[{"ts":1724999486}]': PRIOR,
        '{"ts":1724999486}\r': 1724999486000,
        "plain": PRIOR,
    }
    assert dict(zip(cases, event_ms(spark, with_json_event_time, list(cases)))) == cases


def test_text_event_time(spark):
    cases = {
        "2025-08-30T06:11:26.816Z Message": 1756534286816,
        "2025-08-30T06:11:26 no zone": 1756534286000,
        "2025-08-30T06:11:26.816+05:00 cut off": 1756534286816,
        'time="2025-08-30T09:21:21Z" level=info': 1756545681000,
        'level=info time="2025-08-30T09:21:21Z"': 1756545681000,
        "I0830 11:27:01.564974       1 controller.go:231] x": 1756553221564,
        "I0830 11:27:01.564 three digits": PRIOR,
        "2025/08/30 10:33:20 server": 1756550000000,
        'I0830 11:27:01.564974 1 x time="2020-01-01T00:00:00Z"': 1756553221564,
        'I1340 25:61:61.999999 x time="2025-08-30T09:21:21Z"': 1756545681000,
        '2025/13/45 10:33:20 time="2025-08-30T09:21:21Z"': 1756545681000,
        "2025-13-45T25:61:61.999Z x": PRIOR,
        '2025-13-45T25:61:61.999Z time="2025-08-30T09:21:21Z"': PRIOR,
        "I1340 25:61:61.999999 x": PRIOR,
        "W0830\t11:27:01.564974 tab\nsecond line": 1756553221564,
        "no time at all": PRIOR,
        "": PRIOR,
    }
    got = event_ms(spark, lambda d: with_text_event_time(d, AS_OF), list(cases))
    assert dict(zip(cases, got)) == cases


def test_zone_can_be_required(spark):
    strict = event_ms(spark, lambda d: with_text_event_time(d, AS_OF, assume_utc=False), ["2025-08-30T06:11:26 x"])
    assert strict == [PRIOR]


def test_six_formats_in_one_batch(spark):
    messages = [
        '{"ts":"2025-08-30T06:11:00Z"}',
        '{"time":"2025-08-30T06:12:00Z"}',
        "2025-08-30T06:13:00Z x",
        'time="2025-08-30T06:14:00Z" x',
        "I0830 06:15:00.000000 1 x",
        "2025/08/30 06:16:00 x",
    ]
    got = event_ms(spark, lambda d: with_event_time(d, AS_OF), messages)
    assert [ms // 60000 % 60 for ms in got] == [11, 12, 13, 14, 15, 16]


@pytest.mark.parametrize("zone", ["America/New_York", "Asia/Tokyo"])
def test_session_zone_does_not_matter(spark, zone):
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        messages = ["I0830 06:15:00.000000 1 x", "2025-08-30T06:13:00 x", "2025/08/30 06:16:00 x"]
        got = event_ms(spark, lambda d: with_event_time(d, AS_OF), messages)
        assert got == [1756534500000, 1756534380000, 1756534560000]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
