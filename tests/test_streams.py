"""Topics to tables: restart from the checkpoint, quarantine, replay, alerts once."""

import json
from datetime import datetime

import pytest
from helpers import at, tuples
from pyspark.sql import functions as F

from skyloom import schemas
from skyloom.config import Settings
from skyloom.sources import bronze
from skyloom.streaming import pipeline
from test_engine import LIVE, metar, places

NOW = datetime(2025, 3, 1)
TOPIC = "weather.forecast.raw.v1"


def send(spark, lake, texts, start, topic=TOPIC):
    data = [(topic, at(0).date(), 0, start + i, 1000 + start + i, None, t.encode()) for i, t in enumerate(texts)]
    bronze.append_bronze(spark.createDataFrame(data, schemas.BRONZE).coalesce(1), lake)


def run_message(event, init, value, hours=72, model="m"):
    t = [at(init + i).strftime("%Y-%m-%dT%H:%M") for i in range(1, hours + 1)]
    return json.dumps({"event_id": event, "event_type": "forecast.raw", "ingestion_mode": "live", "payload": {"model": model, "location_id": "p1", "run": at(init).isoformat() + "+00:00", "api_response": {"hourly": {"time": t, "temperature_2m": [value] * hours}}}})


def test_restart_and_quarantine(spark, tmp_path):
    lake, t = f"{tmp_path}/lake", pipeline.Tables(spark, f"{tmp_path}/tables")

    def drain():
        pipeline.start_forecasts(bronze.topic_stream(spark, TOPIC, lake=lake), t, f"{tmp_path}/cp", True, clock=lambda: NOW).awaitTermination()

    send(spark, lake, [LIVE, "{broken", LIVE.replace("[36]", "[3600]").replace("e1", "e9")], 0)
    drain()
    assert t.forecast.read().count() == 6 and tuples(t.dead_letter.read(), "source_offset", "error_type") == [(1, "JSONDecodeError"), (2, "QualityError")]
    before = t.forecast.manifest()
    drain()
    assert t.forecast.manifest() == before
    send(spark, lake, [LIVE, LIVE.replace("1.5", "2.5").replace("e1", "e2")], 10)
    drain()
    got = t.forecast.read().where("variable = 'temperature_2m' and lead_hours = 1").collect()
    assert [(r["source_event_id"], round(r["value"], 2)) for r in got] == [("e2", 275.65)]
    # a rebuild from the lake gives the same rows, and is refused while stored rows would be lost
    rows_before = tuples(t.forecast.read(), "variable", "valid_time", "value", "source_event_id")
    messages = bronze.read_bronze(spark, lake, TOPIC).drop("seq")
    pipeline.replay(t, messages, "forecast", places(spark), Settings(), NOW)
    assert tuples(t.forecast.read(), "variable", "valid_time", "value", "source_event_id") == rows_before
    with pytest.raises(RuntimeError):
        pipeline.replay(t, messages.where("kafka_offset < 0"), "forecast", places(spark), Settings(), NOW)
    assert bronze.find_event(bronze.read_bronze(spark, lake), "e2").count() == 1 and bronze.sample_event_id(bronze.read_bronze(spark, lake)) in ("e1", "e2")


def test_observation_stream(spark, tmp_path):
    lake, t = f"{tmp_path}/lake", pipeline.Tables(spark, f"{tmp_path}/tables")
    topic = "weather.observation.raw.v1"
    for i, texts in enumerate(([metar("o1", raw="METAR COR AAAA", temp="11")], [metar("o2", temp="10"), metar("o3", "BBBB", temp='"x"')])):
        send(spark, lake, texts, 10 * i, topic)
        pipeline.start_observations(bronze.topic_stream(spark, topic, lake=lake), t, places(spark), f"{tmp_path}/cp", True, clock=lambda: NOW).awaitTermination()
    got = t.observation.read().where("variable = 'temperature_2m'").collect()
    assert [(r["source_event_id"], r["value"], r["is_corrected"]) for r in got] == [("o1", 284.15, True)]
    assert t.dead_letter.read().count() == 1


def test_bronze_stream_copies_messages(spark, tmp_path):
    send(spark, f"{tmp_path}/topic", [LIVE, "{broken"], 0)
    pipeline.start_bronze(bronze.topic_stream(spark, TOPIC, lake=f"{tmp_path}/topic"), f"{tmp_path}/lake", f"{tmp_path}/cp", True).awaitTermination()
    assert bronze.read_bronze(spark, f"{tmp_path}/lake", TOPIC).count() == 2


def test_alerts_are_sent_once_and_refreshed(spark, tmp_path):
    lake, t, sent = f"{tmp_path}/lake", pipeline.Tables(spark, f"{tmp_path}/tables"), []

    def step(texts, start):
        send(spark, lake, texts, start)
        s = lambda: bronze.topic_stream(spark, TOPIC, lake=lake)
        pipeline.start_forecasts(s(), t, f"{tmp_path}/cp1", True, clock=lambda: NOW).awaitTermination()
        pipeline.start_detector(s(), t, places(spark), f"{tmp_path}/cp2", True, lambda d: sent.append(d.count()), clock=lambda: NOW).awaitTermination()

    step([run_message("a", 0, 10.0)], 0)
    assert sent == []
    step([run_message("b", 6, 14.0)], 10)
    a = t.alert.read().collect()
    assert sent == [1] and [(r["rule"], r["severity"], r["metric"]) for r in a] == [("run_change", "warning", 4.0)] and a[0]["published_at"] == NOW
    step([run_message("b2", 6, 17.0)], 20)
    a = t.alert.read().collect()
    assert sent == [1] and [(r["severity"], r["metric"], r["detected_at"]) for r in a] == [("critical", 7.0, NOW)]


def test_lag_and_offsets(spark):
    ends = spark.createDataFrame([("t", 0, 5, 10), ("t", 1, 0, 4)], "topic string, partition int, low bigint, high bigint")
    done = spark.createDataFrame([("g", "t", 0, 7), ("g", "t", 1, None), ("h", "t", 0, 12)], "group string, topic string, partition int, offset bigint")
    assert tuples(bronze.consumer_lag(ends, done), "group", "lag") == [("g", 7), ("h", 0)]
    b = spark.createDataFrame([("t", 0, 3, 100), ("t", 0, 4, 200), ("t", 1, 0, 50)], "topic string, kafka_partition int, kafka_offset bigint, kafka_timestamp_ms bigint")
    assert tuples(bronze.offset_targets(b), "kafka_partition", "target") == [(0, 3), (1, 0)]
    assert tuples(bronze.offset_targets(b, 150), "kafka_partition", "target") == [(0, 4), (1, 1)]
    assert not bronze.has_kafka(spark) and F is not None
