"""Incremental build of verification and accuracy: only days whose inputs changed, all of them in one job."""

from __future__ import annotations

import json
from dataclasses import dataclass, field
from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyloom import schemas
from skyloom.config import Settings
from skyloom.operators import accuracy, asof, quality, upsert
from skyloom.session import shared_dir
from skyloom.sources.files import Files
from skyloom.sources.versioned import VersionedTable

VERIFICATION_VALUES = ("lead_hours", "lead_day", "forecast_value", "observed_value", "observed_at", "obs_offset_seconds", "error", "ingestion_mode", "valid_date")
ACCURACY_VALUES = ("n", "bias", "mae", "rmse")


@dataclass
class BuildResult:
    kind: str
    days: list[str] = field(default_factory=list)
    verification: dict[str, int] = field(default_factory=dict)
    accuracy: dict[str, int] = field(default_factory=dict)
    watermark: str | None = None


class JobState:
    """Small named values beside the tables, each replaced atomically."""

    def __init__(self, spark: SparkSession, root: str):
        self.root, self.files = root, Files(spark)

    def get(self, job: str) -> str | None:
        text = self.files.read(f"{self.root}/{job}.json")
        return json.loads(text)["watermark"] if text else None

    def set(self, job: str, watermark: str) -> None:
        self.files.write(f"{self.root}/{job}.json", json.dumps({"watermark": watermark}))


def dirty_days(forecast: DataFrame, observation: DataFrame, since: str | None, tolerance_minutes: int = 30) -> DataFrame:
    """Days to build: of changed forecasts their day, of changed observations their day and both neighbours.

    No day lies beyond the last observation plus the tolerance. Without ``since`` every day from the first forecast on is dirty.
    """
    limit = observation.agg(F.to_date(F.max("observed_at") + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(tolerance_minutes)))).scalar()
    if since is None:
        span = forecast.agg(F.to_date(F.min("valid_time")).alias("lo"), F.to_date(F.max("valid_time")).alias("hi")).withColumn("hi", F.least(F.col("hi"), limit))
        return span.where("lo <= hi").select(F.explode(F.sequence("lo", "hi")).alias("valid_date"))
    at = F.lit(since).cast("timestamp")
    f = forecast.where(F.col("updated_at") >= at).select(F.to_date("valid_time").alias("valid_date")).distinct()
    o = observation.where(F.col("updated_at") >= at).select(F.to_date("observed_at").alias("d")).distinct().select(F.explode(F.array(F.date_add("d", -1), F.col("d"), F.date_add("d", 1))).alias("valid_date"))
    return f.union(o).distinct().where(F.col("valid_date") <= limit)


class Gold:
    def __init__(self, spark: SparkSession, root: str, settings: Settings | None = None):
        self.spark, self.root, self.settings = spark, root, settings or Settings()
        self.verification = VersionedTable(spark, f"{self.root}/forecast_verification", F.col("valid_date"), schemas.VERIFICATION)
        self.accuracy = VersionedTable(spark, f"{self.root}/accuracy_daily", F.col("valid_date"), schemas.ACCURACY)
        self.state = JobState(spark, f"{self.root}/job_state")
        shared_dir(spark)

    def build(self, forecast: DataFrame, observation: DataFrame, location: DataFrame, now: datetime, full: bool = False) -> BuildResult:
        """Bring both tables up to date with their inputs.

        The watermark's name holds the fingerprint of the rules, so changed rules build everything anew. Rows whose values did not
        change keep their ``computed_at``, and a day without changes is not written. A day without forecasts in the inputs is
        left alone (they may have been retired); a day with forecasts but no match loses its rows. A blocking quality failure
        raises before anything is written; verification, accuracy, log and watermark follow each other, and what a crash
        leaves undone the next run repairs because the watermark has not moved.
        """
        s = self.settings
        stations = {r["location_id"]: r["station"] for r in location.where("station is not null").select("location_id", "station").collect()}  # a fixed dimension
        job = f"gold_{s.fingerprint(stations)}"
        mark = None if full else self.state.get(job)
        since = None if mark is None else str(datetime.fromisoformat(mark) - timedelta(hours=s.lookback_hours))
        r = BuildResult("full" if since is None else "incremental")
        days = [d["valid_date"] for d in dirty_days(forecast, observation, since, s.tolerance_minutes).collect()]  # one row a day
        present = forecast.where(F.to_date("valid_time").isin(days)).select(F.to_date("valid_time").alias("d")).distinct() if days else None
        r.days = sorted(str(d["d"]) for d in present.collect()) if days else []
        if r.days:
            lo, hi = min(r.days), max(r.days)
            pad = timedelta(minutes=s.tolerance_minutes)
            f = forecast.where((F.col("valid_time") >= F.lit(lo).cast("timestamp")) & (F.col("valid_time") < F.date_add(F.lit(hi).cast("date"), 1)) & F.to_date("valid_time").cast("string").isin(r.days))
            o = observation.where((F.col("observed_at") >= F.lit(str(datetime.fromisoformat(lo) - pad)).cast("timestamp")) & (F.col("observed_at") <= F.lit(str(datetime.fromisoformat(hi) + timedelta(days=1) + pad)).cast("timestamp")))
            v = asof.verify(f, o, location, s.tolerance_minutes, s.min_lead_hours).drop("forecast_id", "source_event_id").checkpoint()
            a = accuracy.daily(v).checkpoint()
            for frame, contract in ((v, quality.verification_contract(s)), (a, quality.accuracy_contract())):
                bad = quality.validate(frame, contract).where("severity = 'blocking' and not passed").select("check_name", "rows_failed").collect()
                if bad:
                    raise quality.QualityError(f"{contract.table}: " + ", ".join(f"{b[0]} failed for {b[1]} rows" for b in bad))
            r.verification = self._sync(self.verification, v, schemas.FORECAST_KEY, VERIFICATION_VALUES, r.days, now)
            r.accuracy = self._sync(self.accuracy, a, schemas.ACCURACY_KEY, ACCURACY_VALUES, r.days, now)
            self._log(f, v, r, now)
        r.watermark = str(now)
        self.state.set(job, r.watermark)
        return r

    def _sync(self, table: VersionedTable, new: DataFrame, key: tuple[str, ...], values: tuple[str, ...], days: list[str], now: datetime) -> dict[str, int]:
        rows = upsert.diff(table.read(days), new, key, values, now, touched=("computed_at",), sync=True).select(*table.schema.names, "action").checkpoint()
        return upsert.apply(table, rows, rows)

    def _log(self, forecast: DataFrame, verification: DataFrame, r: BuildResult, now: datetime) -> None:
        n = asof.eligible(forecast, self.settings.min_lead_hours).groupBy(F.to_date("valid_time").alias("valid_date")).agg(F.count(F.lit(1)).alias("eligible_forecasts"))
        m = verification.groupBy("valid_date").agg(F.count(F.lit(1)).alias("matched"))
        log = n.join(m, "valid_date", "left").select(F.lit(now).cast("timestamp").alias("built_at"), F.lit(r.kind).alias("run_kind"), "valid_date", "eligible_forecasts", F.coalesce("matched", F.lit(0)).cast("bigint").alias("matched"))
        log.coalesce(1).write.mode("append").parquet(f"{self.root}/gold_build_log")
