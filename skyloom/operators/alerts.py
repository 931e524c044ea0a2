"""The three anomaly rules as set operations over many runs at once, and alerts with deterministic ids."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skyloom.config import Settings
from skyloom.functions.columns import event_key, half_even_hour, iso_text, number


def by_variable(table: dict[str, float]) -> Column:
    return F.element_at(F.create_map(*[F.lit(x) for kv in table.items() for x in kv]), F.col("variable"))


def classify(metric: Column, threshold: Column, factor: float) -> Column:
    """NULL below the threshold, warning from it on, critical from ``factor`` times it on; bounds belong to the higher class."""
    return F.when(metric >= threshold * factor, "critical").when(metric >= threshold, "warning")


def live_runs(forecast: DataFrame) -> DataFrame:
    """One row per hour of each live run; a missing value is no hour of it."""
    f = forecast.where((F.col("ingestion_mode") == "live") & number("value").isNotNull())
    return f.groupBy("model", "location_id", "variable", "init_time", "valid_time").agg(F.max_by("value", F.struct("inserted_at", *([F.col("forecast_id")] if "forecast_id" in f.columns else []))).alias("value"))


def _window(runs: DataFrame, hours: int) -> DataFrame:
    lead = F.unix_seconds("valid_time") - F.unix_seconds("init_time")
    return runs.where((lead > 0) & (lead <= hours * 3600))


def run_change(runs: DataFrame, s: Settings) -> DataFrame:
    """Mean absolute change of a run against the previous run of its model and place, over the hours of its horizon both have.

    Every run meets its previous one in one pass: starts are numbered per series, and the hours of run i are joined with those of
    run i - 1 by valid time. At least ``min_overlap_hours`` shared hours.
    """
    series = ["model", "location_id", "variable"]
    starts = runs.select("model", "location_id", "init_time").distinct().withColumn("prev_init", F.lag("init_time").over(Window.partitionBy("model", "location_id").orderBy("init_time")))
    new = _window(runs, s.horizon_hours).join(starts.where("prev_init is not null"), ["model", "location_id", "init_time"])
    old = runs.select(*series, F.col("init_time").alias("prev_init"), "valid_time", F.col("value").alias("prev_value"))
    both = new.join(old, [*series, "prev_init", "valid_time"])
    d = F.col("value") - F.col("prev_value")
    g = both.groupBy(*series, "init_time", "prev_init").agg(F.count(F.lit(1)).alias("hours"), F.avg(F.abs(d)).alias("metric"), F.avg(d).alias("mean_change"), F.max(F.abs(d)).alias("max_change")).where(F.col("hours") >= s.min_overlap_hours)
    return _found(g, "run_change", s.run_change, s)


def model_spread(runs: DataFrame, s: Settings, high: DataFrame | None = None) -> DataFrame:
    """Mean over hours of the span between models whose runs belong to one cycle of ``cadence_hours``; at least two models an hour.

    ``high``: places left out for pressure (their sea-level pressure is a reduction over too much height).
    """
    width = s.cadence_hours * 3600
    cycle = F.timestamp_seconds(F.unix_seconds("init_time") - F.pmod(F.unix_seconds("init_time"), F.lit(width)))
    w = _window(runs, s.horizon_hours).withColumn("cycle", cycle)
    newest = w.groupBy("location_id", "variable", "cycle", "model", "valid_time").agg(F.max_by("value", "init_time").alias("value"))
    hour = newest.groupBy("location_id", "variable", "cycle", "valid_time").agg((F.max("value") - F.min("value")).alias("span"), F.count(F.lit(1)).alias("models")).where("models >= 2")
    g = hour.groupBy("location_id", "variable", "cycle").agg(F.count(F.lit(1)).alias("hours"), F.avg("span").alias("metric"), F.max("span").alias("max_spread"), F.max("models").alias("models")).where(F.col("hours") >= s.min_overlap_hours)
    return _found(_not_high(g, high), "model_spread", s.model_spread, s)


def observation_miss(observation: DataFrame, runs: DataFrame, location: DataFrame, s: Settings, high: DataFrame | None = None) -> DataFrame:
    """Observation against the mean of the models' latest short forecasts for its (half-even) hour, started at or before it."""
    place = location.where(F.col("station").isNotNull()).select("location_id", "station")
    o = observation.where(number("value").isNotNull() & (F.col("ingestion_mode") == "live")).join(place, "station")
    o = o.select("location_id", "station", "variable", "observed_at", "value", half_even_hour("observed_at").alias("valid_time")).distinct()
    lead = F.unix_seconds("valid_time") - F.unix_seconds("init_time")
    short = runs.where((lead >= 3600) & (lead <= s.miss_max_lead_hours * 3600))
    latest = short.groupBy("location_id", "variable", "valid_time", "model").agg(F.max_by("value", "init_time").alias("f"))
    mean = latest.groupBy("location_id", "variable", "valid_time").agg(F.avg("f").alias("expected"), F.count(F.lit(1)).alias("models"))
    g = o.join(mean, ["location_id", "variable", "valid_time"]).withColumn("metric", F.abs(F.col("value") - F.col("expected")))
    return _found(_not_high(g, high), "observation_miss", s.observation_miss, s)


def _not_high(g: DataFrame, high: DataFrame | None) -> DataFrame:
    if high is None:
        return g
    h = high.select("location_id").withColumn("variable", F.lit("pressure_msl"))
    return g.join(h, ["location_id", "variable"], "left_anti")


def high_places(location: DataFrame, s: Settings) -> DataFrame:
    return location.where(F.col("elevation_m") > s.max_elevation_m).select("location_id")


def _found(g: DataFrame, rule: str, thresholds: dict[str, float], s: Settings) -> DataFrame:
    t = by_variable(thresholds)
    return g.withColumns({"rule": F.lit(rule), "threshold": t, "severity": classify(F.col("metric"), t, s.critical_factor)}).where("severity is not null")


def alert_id(rule: str) -> Column:
    """The id of an alert depends on what it is about only, so a later, fuller evaluation refreshes it."""
    if rule == "run_change":
        return event_key(F.lit(rule), "model", "location_id", iso_text("init_time"), "variable")
    if rule == "model_spread":
        return event_key(F.lit(rule), "location_id", iso_text("cycle"), "variable")
    return event_key(F.lit(rule), "station", iso_text("observed_at"), "variable")


def as_alerts(found: DataFrame, rule: str, trigger: Column | None = None) -> DataFrame:
    has = set(found.columns)
    text = lambda c: F.col(c) if c in has else F.lit(None).cast("string")
    time = {"run_change": "init_time", "model_spread": "cycle", "observation_miss": "observed_at"}[rule]
    details = [c for c in ("hours", "models", "mean_change", "max_change", "max_spread", "expected") if c in has]
    return found.select(
        alert_id(rule).alias("alert_id"), "rule", "severity", "location_id", "variable", text("model").alias("model"), text("station").alias("station"), F.col(time).alias("event_time"), "metric", "threshold",
        F.to_json(F.struct(*details)).alias("details"), (trigger if trigger is not None else F.lit(None)).cast("string").alias("triggered_by_event_id"),
    )


#: Upsert of alerts: a stored alert is refreshed only if severity, metric or details changed; a new threshold alone does not
#: count, and the times of detection and publication never change.
ALERT_UPSERT = {
    "key": ("alert_id",),
    "values": ("rule", "severity", "location_id", "variable", "model", "station", "event_time", "metric", "threshold", "details", "triggered_by_event_id"),
    "changed_by": ("severity", "metric", "details"), "created": ("detected_at",), "kept": ("published_at",),
}


def latest_per_location(alerts: DataFrame, arrival: str) -> DataFrame:
    """The latest alert of each place by event time, then detection, then arrival."""
    rest = [c for c in alerts.columns if c != "location_id"]
    return alerts.where(F.col("location_id").isNotNull()).groupBy("location_id").agg(F.max_by(F.struct(*rest), F.struct("event_time", "detected_at", arrival)).alias("x")).select("location_id", "x.*")
