from datetime import datetime, timedelta

from helpers import d, rows

from candlewick import schemas as S
from candlewick.operators.writes import read_or_empty
from candlewick.sources.bindings import ticks
from candlewick.streaming.alerts import stream_alert_log
from candlewick.streaming.candles import CANDLE_SCHEMA, stream_candles, tick_candles


def t(text):
    return datetime.fromisoformat(text)


def land(spark, table, path, *events):
    table("id bigint, ts timestamp_ntz, event_type string, value double", *events).coalesce(1).write.mode("append").parquet(path)


def stream(spark, path):
    return ticks(spark.readStream.schema("id bigint, ts timestamp_ntz, event_type string, value double").parquet(path))


def test_late_ticks_within_the_look_back_correct_their_candle(spark, table, tmp_path):
    source, sink, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    run = lambda: stream_candles(stream(spark, source), sink=sink, checkpoint=state).awaitTermination()
    land(spark, table, source, (1, t("2024-01-01 10:00:00"), "A", 10.0), (2, t("2024-01-01 12:00:00"), "A", 12.0),
         (3, t("2024-01-03 10:00:00"), "A", 9.0))
    run()
    got = read_or_empty(spark, sink, CANDLE_SCHEMA)
    assert rows(got, "date", "open_price", "close_price", "number_of_trades") == [
        (d("2024-01-01"), 10.0, 12.0, 2), (d("2024-01-03"), 9.0, 9.0, 1)
    ]
    # an earlier open arrives two days late; much later days push the watermark on
    land(spark, table, source, (4, t("2024-01-01 09:00:00"), "A", 8.0), (5, t("2024-01-20 09:00:00"), "A", 20.0))
    run()
    # far too late now: dropped
    land(spark, table, source, (6, t("2024-01-01 08:00:00"), "A", 1.0))
    run()
    run()  # nothing new
    got = read_or_empty(spark, sink, CANDLE_SCHEMA)
    assert rows(got, "date", "open_price", "low_price", "number_of_trades") == [
        (d("2024-01-01"), 8.0, 8.0, 3), (d("2024-01-03"), 9.0, 9.0, 1), (d("2024-01-20"), 20.0, 20.0, 1)
    ]


def test_stream_equals_batch(spark, table, tmp_path):
    source, sink = str(tmp_path / "in"), str(tmp_path / "out")
    start = t("2024-01-01")
    events = [(i, start + timedelta(minutes=37 * i), "AB"[i % 2], float(i % 17)) for i in range(300)]
    land(spark, table, source, *events)
    stream_candles(stream(spark, source), sink=sink, checkpoint=str(tmp_path / "state")).awaitTermination()
    batch = tick_candles(ticks(spark.read.parquet(source)))
    columns = read_or_empty(spark, sink, CANDLE_SCHEMA).columns
    assert rows(read_or_empty(spark, sink, CANDLE_SCHEMA)) == rows(batch, *columns)


def test_alerts_are_logged_once_over_batches(spark, table, tmp_path):
    source, sink, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    schema = "asset_id string, alert_date date, alert_type string, alert_message string, seq int"

    def land_alerts(*alerts):
        table(schema, *alerts).coalesce(1).write.mode("append").parquet(source)

    def run(checkpoint):
        alerts = spark.readStream.schema(schema).parquet(source)
        stream_alert_log(alerts, sink=sink, order_by="seq", checkpoint=checkpoint).awaitTermination()

    land_alerts(("a", d("2024-01-01"), "x", "second", 2), ("a", d("2024-01-01"), "x", "first", 1))
    run(state)
    land_alerts(("a", d("2024-01-01"), "x", "again", 0), ("b", d("2024-02-01"), "x", "new", 5))
    run(state)
    run(str(tmp_path / "lost"))  # progress lost: everything is raised again
    log = read_or_empty(spark, sink, S.ALERT_LOG)
    assert rows(log, "asset_id", "alert_message") == [("a", "first"), ("b", "new")]
