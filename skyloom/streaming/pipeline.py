"""Streams from topics to tables: micro-batches that parse, gate, upsert and set aside what cannot be used.

Every sink is idempotent, because ``foreachBatch`` repeats a batch after a crash: upserts by key, dead letters by topic,
partition and offset, the lake by its checkpointed file sink.
"""

from __future__ import annotations

import signal
import threading
import time
from collections.abc import Callable, Sequence
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from skyloom import schemas
from skyloom.config import Settings
from skyloom.operators import alerts as rules
from skyloom.operators import quality, upsert
from skyloom.session import shared_dir
from skyloom.sources import bronze, parse
from skyloom.sources.versioned import VersionedTable

Clock = Callable[[], datetime]


def now() -> datetime:
    return datetime.now(timezone.utc).replace(tzinfo=None)


class Tables:
    """The tables of the silver and alert layers under one folder."""

    def __init__(self, spark: SparkSession, root: str):
        t = lambda name, part, schema: VersionedTable(spark, f"{root}/{name}", F.col(part) if isinstance(part, str) else part, schema)
        self.forecast = t("forecast", F.to_date("valid_time"), schemas.FORECAST)
        self.observation = t("observation", F.to_date("observed_at"), schemas.OBSERVATION)
        self.dead_letter = t("dead_letter", F.to_date("failed_at"), schemas.DEAD_LETTER)
        self.alert = t("alert", F.to_date("event_time"), schemas.ALERT)
        shared_dir(spark)


def start(stream: DataFrame, handle: Callable[[DataFrame, int], None], checkpoint: str, drain: bool, seconds: float = 5) -> StreamingQuery:
    """Run ``handle`` on micro-batches; offsets are committed after it succeeds. ``drain`` ends the query once it has caught up."""
    w = stream.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint)
    return (w.trigger(availableNow=True) if drain else w.trigger(processingTime=f"{seconds} seconds")).start()


def run_until(queries: Sequence[StreamingQuery], stop: threading.Event, grace_seconds: float = 60) -> None:
    """Let streams run until ``stop`` is set (see ``on_signal``) or one of them ends, then stop them all, each between two batches if it can.

    A batch that does not end within the grace is interrupted; its sinks are idempotent and it runs again after a restart.
    """
    while not stop.wait(0.2) and all(q.isActive for q in queries):
        pass
    for q in queries:
        end = time.monotonic() + grace_seconds
        while q.isActive and q.status["isTriggerActive"] and time.monotonic() < end:
            time.sleep(0.05)
        q.stop()


def on_signal(*signals: int) -> threading.Event:
    """An event that SIGTERM and SIGINT (or the given signals) set."""
    stop = threading.Event()
    for s in signals or (signal.SIGTERM, signal.SIGINT):
        signal.signal(s, lambda *_: stop.set())
    return stop


def start_bronze(stream: DataFrame, lake: str, checkpoint: str, drain: bool) -> StreamingQuery:
    w = stream.writeStream.format("parquet").option("path", lake).option("checkpointLocation", checkpoint).partitionBy("topic", "dt")
    return (w.trigger(availableNow=True) if drain else w.trigger(processingTime="5 seconds")).start()


def write_dead_letters(tables: Tables, bad: DataFrame, at: datetime) -> int:
    letters = bronze.dead_letters(bad, at)
    return upsert.insert_absent(tables.dead_letter, letters, ("source_topic", "source_partition", "source_offset", "failed_at"))


def _quarantined(batch: DataFrame, blocked: DataFrame) -> DataFrame:
    """Every copy of a message whose event is blocked."""
    m = batch.withColumn("source_event_id", F.get_json_object(F.col("value").cast("string"), "$.event_id"))
    return m.join(blocked, "source_event_id", "left_semi").drop("source_event_id").withColumns({"error_type": F.lit("QualityError"), "error_message": F.lit("a row of the message failed a blocking check")})


def load_forecasts(tables: Tables, batch: DataFrame, settings: Settings, at: datetime) -> dict[str, int]:
    """One micro-batch of the forecast topic into its table; one bad row sets the whole message aside, the rest loads."""
    good, bad = parse.split_forecasts(batch)
    good = good.checkpoint()  # messages are parsed once for the gate, the dead letters and the table
    clean, blocked = quality.gate(good, quality.forecast_contract(settings))
    last = upsert.keep_last(clean, schemas.FORECAST_KEY, ["kafka_timestamp_ms", "kafka_partition", "kafka_offset"])
    last = last.select(*[c for c in schemas.FORECAST.names if c not in ("inserted_at", "updated_at")]).checkpoint()
    letters = bad.unionByName(_quarantined(batch, blocked))
    n = write_dead_letters(tables, letters, at)
    values = ("value", "lead_hours", "ingestion_mode", "source_event_id")
    done = upsert.upsert(tables.forecast, last, schemas.FORECAST_KEY, values, at, created=("inserted_at",), touched=("updated_at",))
    return done | {"dead_letters": n}


def load_observations(tables: Tables, batch: DataFrame, stations: DataFrame, settings: Settings, at: datetime) -> dict[str, int]:
    """One micro-batch of the observation topic; a correction wins over an original whichever comes first."""
    good, bad = parse.split_observations(batch, stations, settings.max_elevation_m)
    good = good.checkpoint()
    clean, blocked = quality.gate(good, quality.observation_contract(settings))
    last = upsert.last_observations(clean, ["kafka_timestamp_ms", "kafka_partition", "kafka_offset"])
    last = last.select(*[c for c in schemas.OBSERVATION.names if c not in ("inserted_at", "updated_at")]).checkpoint()
    n = write_dead_letters(tables, bad.unionByName(_quarantined(batch, blocked)), at)
    values = ("value", "raw_text", "is_corrected", "ingestion_mode", "source_event_id")
    done = upsert.upsert(tables.observation, last, schemas.OBSERVATION_KEY, values, at, guard=upsert.correction_guard(), created=("inserted_at",), touched=("updated_at",))
    return done | {"dead_letters": n}


def start_forecasts(stream: DataFrame, tables: Tables, checkpoint: str, drain: bool, settings: Settings | None = None, clock: Clock = now) -> StreamingQuery:
    return start(stream, lambda b, _: load_forecasts(tables, b, settings or Settings(), clock()), checkpoint, drain)


def start_observations(stream: DataFrame, tables: Tables, stations: DataFrame, checkpoint: str, drain: bool, settings: Settings | None = None, clock: Clock = now) -> StreamingQuery:
    return start(stream, lambda b, _: load_observations(tables, b, stations, settings or Settings(), clock()), checkpoint, drain)


def _days(tables: Tables, rows: DataFrame, days) -> DataFrame:
    """The forecast table's rows of the given days (an array of dates a row): other partitions are not opened."""
    want = [str(r[0]) for r in rows.select(F.explode(days)).distinct().collect()]  # days, not rows
    return tables.forecast.read(want).withColumn("forecast_id", F.lit(0))


def detect(tables: Tables, batch: DataFrame, location: DataFrame, settings: Settings) -> DataFrame:
    """Alerts that follow from a batch of live messages, looked up in the forecast table: the detector keeps no state of its own.

    Of the table only the days are read that the rules look at: those of the horizons of the batch's runs, and those of its
    observations; of the runs only those of the batch's places are numbered. A run without an hour in these days is no previous run.
    """
    good, _ = parse.split_forecasts(batch.where(parse.event_type(F.col("value")) == "forecast.raw"))
    clean, _ = quality.gate(good, quality.forecast_contract(settings))
    touched = clean.where("ingestion_mode = 'live'").select("model", "location_id", "init_time").distinct().checkpoint()
    places = touched.select("location_id").distinct()
    runs = rules.live_runs(_days(tables, touched, F.sequence(F.to_date(F.col("init_time") - F.make_dt_interval(hours=F.lit(settings.cadence_hours))), F.to_date(F.col("init_time") + F.make_dt_interval(hours=F.lit(settings.horizon_hours))))).join(places, "location_id", "left_semi"))
    high = rules.high_places(location, settings)
    change = rules.as_alerts(rules.run_change(runs, settings).join(touched, ["model", "location_id", "init_time"], "left_semi"), "run_change")
    spread = rules.as_alerts(rules.model_spread(runs, settings, high), "model_spread")
    obs, _ = parse.split_observations(batch.where(parse.event_type(F.col("value")) == "observation.raw"), location, settings.max_elevation_m)
    fresh, _ = quality.gate(obs, quality.observation_contract(settings))
    fresh = upsert.keep_last(fresh, schemas.OBSERVATION_KEY, ["kafka_timestamp_ms", "kafka_partition", "kafka_offset"])  # of an alert the last one counts
    fresh = fresh.checkpoint()
    around = F.sequence(F.to_date(F.col("observed_at") - F.make_dt_interval(hours=F.lit(1))), F.to_date(F.col("observed_at") + F.make_dt_interval(hours=F.lit(1))))
    near = rules.live_runs(_days(tables, fresh, around))
    miss = rules.as_alerts(rules.observation_miss(fresh, near, location, settings, high), "observation_miss")
    return change.unionByName(spread).unionByName(miss)


def publish_alerts(tables: Tables, found: DataFrame, at: datetime, send: Callable[[DataFrame], None]) -> dict[str, int]:
    """Store alerts, send those not yet published, then mark them: sent at least once, and once where nothing fails."""
    how = {k: v for k, v in rules.ALERT_UPSERT.items() if k not in ("key", "values")}
    one = found.dropDuplicates(["alert_id"]).withColumn("published_at", F.lit(None).cast("timestamp"))
    done = upsert.upsert(tables.alert, one, rules.ALERT_UPSERT["key"], rules.ALERT_UPSERT["values"], at, **how)
    waiting = tables.alert.read().where("published_at is null").checkpoint()
    if not waiting.isEmpty():
        send(waiting.select(F.col("location_id").alias("key"), F.to_json(F.struct(*[c for c in waiting.columns if c != "published_at"])).alias("value")))
        parts = [r[0] for r in waiting.select(tables.alert.part()).distinct().collect()]
        ids = waiting.select("alert_id", F.lit(True).alias("_sent"))
        marked = tables.alert.read(parts).join(ids, "alert_id", "left").withColumn("published_at", F.when(F.col("_sent"), F.lit(at).cast("timestamp")).otherwise(F.col("published_at")))
        tables.alert.replace(marked.select(*schemas.ALERT.names), parts)
    return done


def start_detector(stream: DataFrame, tables: Tables, location: DataFrame, checkpoint: str, drain: bool, send: Callable[[DataFrame], None], settings: Settings | None = None, clock: Clock = now) -> StreamingQuery:
    s = settings or Settings()

    def handle(batch: DataFrame, _: int) -> None:
        publish_alerts(tables, detect(tables, batch, location, s), clock(), send)

    return start(stream, handle, checkpoint, drain, 1)


def replay(tables: Tables, lake: DataFrame, kind: str, stations: DataFrame, settings: Settings, at: datetime, force: bool = False) -> dict[str, int]:
    """Rebuild a table from the lake through the same load function; refuses if stored rows would not come back."""
    from skyloom.operators.ops import unexplained

    table = tables.forecast if kind == "forecast" else tables.observation
    key = schemas.FORECAST_KEY if kind == "forecast" else schemas.OBSERVATION_KEY
    good, _ = parse.split_forecasts(lake) if kind == "forecast" else parse.split_observations(lake, stations, settings.max_elevation_m)
    lost = unexplained(table.read(), good, key)
    if not force and not lost.isEmpty():
        raise RuntimeError("stored rows are not in the lake; use force to lose them")
    table.drop(table.partitions())
    return load_forecasts(tables, lake, settings, at) if kind == "forecast" else load_observations(tables, lake, stations, settings, at)
