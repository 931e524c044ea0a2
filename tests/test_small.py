from datetime import datetime

from helpers import at, tuples

from skyloom.config import load_dimension
from skyloom.operators import alerts, briefing
from skyloom.sources import bronze
from skyloom.sources.files import Files


def test_dimensions_from_files(spark, tmp_path):
    (tmp_path / "d.yaml").write_text("places:\n- {id: a, x: 1}\n- {id: b, x: 2}\n- {id: b, x: 2}\n")
    assert tuples(load_dimension(spark, str(tmp_path / "d.yaml"), "id"), "id", "x") == [("a", 1), ("b", 2)]
    (tmp_path / "d.csv").write_text("id,x\na,1\n")
    assert tuples(load_dimension(spark, str(tmp_path / "d.csv"), "id"), "id", "x") == [("a", "1")]


def test_latest_alert_per_location(spark):
    rows = [("p", "a", at(1), at(5), 1), ("p", "b", at(2), at(3), 2), ("p", "c", at(2), at(3), 3), ("q", "d", at(0), at(0), 4), (None, "e", at(9), at(9), 5)]
    df = spark.createDataFrame(rows, "location_id string, alert_id string, event_time timestamp, detected_at timestamp, seq int")
    assert tuples(alerts.latest_per_location(df, "seq"), "location_id", "alert_id") == [("p", "c"), ("q", "d")]


def test_streams_stop_on_a_signal_between_batches():
    import os
    import signal

    from skyloom.streaming import pipeline

    class Query:
        def __init__(self, busy):
            self.busy, self.isActive, self.stopped_busy = busy, True, None

        @property
        def status(self):
            self.busy -= 1
            return {"isTriggerActive": self.busy > 0}

        def stop(self):
            self.isActive, self.stopped_busy = False, self.busy > 0

    before = signal.getsignal(signal.SIGUSR1)
    queries = [Query(3), Query(0)]
    stop = pipeline.on_signal(signal.SIGUSR1)
    os.kill(os.getpid(), signal.SIGUSR1)
    pipeline.run_until(queries, stop)
    signal.signal(signal.SIGUSR1, before)
    assert stop.is_set() and [q.stopped_busy for q in queries] == [False, False]
    stuck = Query(10**9)
    pipeline.run_until([stuck], stop, grace_seconds=0.1)
    assert stuck.stopped_busy


def test_topics_to_create():
    assert [t for t, _, _ in bronze.missing_topics(["weather.dlq.v1"])] == ["weather.forecast.raw.v1", "weather.observation.raw.v1", "weather.alert.v1", "weather.briefing.v1"]
    assert bronze.missing_topics([])[1][1:] == (6, 604_800_000)


def test_messages_go_to_the_lake_without_kafka(spark, tmp_path):
    df = spark.createDataFrame([(datetime(2025, 2, 1).date(), 0, 7, 1000, b"k", b"v")], "dt date, kafka_partition int, kafka_offset bigint, kafka_timestamp_ms bigint, key binary, value binary")
    bronze.write_messages(df, "weather.alert.v1", lake=f"{tmp_path}/lake")
    assert [bytes(r["value"]) for r in bronze.read_bronze(spark, f"{tmp_path}/lake", "weather.alert.v1").collect()] == [b"v"]


def test_files_are_replaced_whole(spark, tmp_path):
    f = Files(spark)
    p = f"file://{tmp_path}/a/b.json"
    assert f.read(p) is None and f.names(f"{tmp_path}/a") == []
    f.write(p, "one")
    f.write(p, "zwei é")
    assert f.read(p) == "zwei é" and "b.json.new" not in f.names(f"{tmp_path}/a")
    f.delete(f"{tmp_path}/a")
    assert not f.exists(p)


def test_cache_key_depends_on_all_parts():
    assert len({briefing.cache_key(*k) for k in (("a", "b", "c"), ("a", "b", "d"), ("a", "x", "c"), ("y", "b", "c"))}) == 4
