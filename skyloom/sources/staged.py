"""Poll cycles over staged responses: what a fetcher has put into files becomes messages, with an account of every unit.

There is no network here: a fetcher of any kind writes its responses as JSON or CSV files, and these cycles turn them into the messages
that the topics expect. A unit (a model, a station) without a response counts as failed and loses nothing but itself.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skyloom.functions.columns import event_key, iso_text
from skyloom.operators.audit import Audit
from skyloom.sources import bronze, parse


@dataclass(frozen=True)
class Cycle:
    """``messages`` (``event_id``, ``key``, ``value`` and what identifies them) and the ``missing`` units."""

    source: str
    topic: str
    messages: DataFrame
    missing: DataFrame

    def send(self, audit: Audit, started: datetime, finished: datetime, **to) -> tuple[int, int]:
        """Write the messages to the topic (see ``bronze.write_messages``) and one row of account; returns produced and failed units."""
        sent = self.messages.checkpoint()
        bronze.write_messages(sent.select("key", F.col("value").cast("binary").alias("value")), self.topic, **to)
        produced, failed = sent.count(), self.missing.count()
        audit.ingestion_run(self.source, "live", started, finished, produced, failed)
        return produced, failed


def read_json(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Staged responses: JSON lines, or files that hold one object or an array of them; broken files give no rows."""
    return spark.read.schema(schema).option("mode", "DROPMALFORMED").option("multiLine", True).json(path)


def _envelope(source: str, kind: str, produced_at: datetime, payload: Column) -> Column:
    return F.to_json(F.struct(
        F.col("event_id"), F.lit(1).alias("schema_version"), F.lit(source).alias("source"), F.lit(kind).alias("event_type"), iso_text(F.lit(produced_at)).alias("produced_at"),
        F.lit("live").alias("ingestion_mode"), payload.alias("payload"),
    ), {"ignoreNullFields": "false"})


def forecast_cycle(responses: DataFrame, models: Sequence[str], now: datetime, cadence_hours: int = 6, lookback_steps: int = 8) -> Cycle:
    """One message per place for the latest run of each model among those of the last ``lookback_steps`` cadences.

    ``responses`` has ``model``, ``location_id``, ``run`` (ISO text) and ``api_response``. Repeated responses of a model, place and run are one
    message; a model without a run in reach is missing. Models are a short list of settings.
    """
    spark = responses.sparkSession
    at = parse.instant(F.col("run"))
    newest = F.unix_seconds(F.lit(now).cast("timestamp"))
    newest = newest - F.pmod(newest, F.lit(cadence_hours * 3600))
    oldest = newest - (lookback_steps - 1) * cadence_hours * 3600
    known = spark.createDataFrame([(m,) for m in models], "model string")
    reach = responses.withColumn("_run", at).where(F.unix_seconds("_run").between(oldest, newest)).join(F.broadcast(known), "model", "left_semi")
    latest = reach.groupBy("model").agg(F.max("_run").alias("_run"))
    one = reach.join(latest, ["model", "_run"]).where(F.col("location_id").isNotNull()).groupBy("model", "location_id", "_run").agg(F.first("api_response").alias("api_response"))
    e = one.withColumn("event_id", event_key("model", "location_id", iso_text("_run")))
    payload = F.struct("model", "location_id", iso_text("_run").alias("run"), "api_response")
    sent = e.select("event_id", "model", "location_id", F.col("location_id").cast("binary").alias("key"), _envelope("forecast_producer", "forecast.raw", now, payload).alias("value"))
    return Cycle("forecast_producer", "weather.forecast.raw.v1", sent, known.join(latest, "model", "left_anti"))


def observation_cycle(reports: DataFrame, stations: DataFrame, now: datetime) -> Cycle:
    """One message per report with a station and a time; configured stations that no report names are missing.

    ``reports`` is as ``parse.archive_reports`` gives it (``station``, ``observed_at``, ``rawOb`` and the cells).
    """
    e = parse.observation_event_id(reports).withColumn("observed_at", iso_text("observed_at"))
    cells = F.struct(F.col("station").alias("icaoId"), *[F.col(c).cast("string").alias(c) for c in ("temp", "dewp", "wspd", "slp", "altim")], "rawOb")
    payload = F.struct("station", "observed_at", cells.alias("api_response"))
    sent = e.select("event_id", "station", F.col("station").cast("binary").alias("key"), _envelope("observation_producer", "observation.raw", now, payload).alias("value"))
    configured = stations.where(F.col("station").isNotNull()).select("station").distinct()
    return Cycle("observation_producer", "weather.observation.raw.v1", sent, configured.join(e.select("station").distinct(), "station", "left_anti"))
