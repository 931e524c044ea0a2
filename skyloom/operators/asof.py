"""Matching every forecast with the nearest observation, and the verification rows that follow from it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skyloom.functions.columns import DAY_US, int_floor_div, lead_day, micros, number

MINUTE_US = 60_000_000


def eligible(forecast: DataFrame, min_lead_hours: int = 1) -> DataFrame:
    """Forecast rows with a value and at least the least lead."""
    return forecast.where(number("value").isNotNull() & (F.col("lead_hours") >= min_lead_hours))


def nearest(left: DataFrame, right: DataFrame, by: tuple[str, ...], left_time: str, right_time: str, payload: tuple[str, ...], tolerance_us: int, rank: Column | None = None, block_us: int = DAY_US) -> DataFrame:
    """``left`` with the ``payload`` and ``right_time`` of the nearest right row of the same ``by`` keys, within the tolerance (inclusive).

    Equal distances go to the earlier right row, equal times to the smallest ``rank``. Left rows without a partner do not appear.

    Plan: one shuffle of the left side. Right rows are reduced map-side to one per key and time; both sides are united and sorted by time
    within a key and block of time, the last and the next right row are carried onto the left rows and the nearer one is taken. A
    right row near a block's edge goes into the neighbouring block too, so a key with very many rows spreads over its blocks.
    """
    block = max(block_us, tolerance_us, 1)
    names = [c for c in left.columns if c not in by]
    pick = F.struct(rank if rank is not None else F.lit(0), *[F.col(c) for c in payload])
    keyed = F.lit(True)
    for k in by:  # NULL keys meet nothing
        keyed = keyed & F.col(k).isNotNull()
    known = right.where(F.col(right_time).isNotNull() & keyed).select(*by, micros(right_time).alias("_t"), pick.alias("_p")).groupBy(*by, "_t").agg(F.min("_p").alias("_p"))
    record = F.struct(F.col("_t").alias("_r"), *[F.col(f"_p.{c}").alias(c) for c in payload])
    near = F.array_distinct(F.array(*[int_floor_div(F.col("_t") + d, block) for d in (-tolerance_us, 0, tolerance_us)]))
    types = dict(left.dtypes)
    r = known.select(*by, "_t", F.explode(near).alias("_b"), record.alias("_rec"), F.lit(0).alias("_side"), *[F.lit(None).cast(types[c]).alias(c) for c in names])
    timed = left.where(F.col(left_time).isNotNull() & keyed).withColumn("_t", micros(left_time))
    l = timed.select(*by, "_t", int_floor_div(F.col("_t"), block).alias("_b"), F.lit(None).cast(r.schema["_rec"].dataType).alias("_rec"), F.lit(1).alias("_side"), *names)
    back = Window.partitionBy(*by, "_b").orderBy("_t", "_side").rowsBetween(Window.unboundedPreceding, 0)
    ahead = Window.partitionBy(*by, "_b").orderBy(F.col("_t").desc(), "_side").rowsBetween(Window.unboundedPreceding, 0)
    both = l.unionByName(r).withColumns({"_last": F.last("_rec", ignorenulls=True).over(back), "_next": F.last("_rec", ignorenulls=True).over(ahead)}).where("_side = 1")
    since, until = F.col("_t") - F.col("_last._r"), F.col("_next._r") - F.col("_t")
    old, new = F.coalesce(since <= tolerance_us, F.lit(False)), F.coalesce(until <= tolerance_us, F.lit(False))
    met = both.withColumn("_m", F.when(old & (~new | (since <= until)), F.col("_last")).when(new, F.col("_next"))).where("_m is not null")
    return met.select(*left.columns, F.timestamp_micros("_m._r").alias(right_time), *[F.col(f"_m.{c}").alias(c) for c in payload])


def verify(forecast: DataFrame, observation: DataFrame, location: DataFrame, tolerance_minutes: int = 30, min_lead_hours: int = 1) -> DataFrame:
    """Verification rows: each eligible forecast row with the nearest observation of its place's station and quantity.

    Missing observations (NULL, NaN) are dropped before the match, so the next nearest counts. Places without a station and
    forecasts without a partner give no row. ``error`` is forecast less observed, ``obs_offset_seconds`` observation time less valid
    time. The places are a small dimension, which Spark broadcasts below its size limit.
    """
    place = location.where(F.col("station").isNotNull()).select("location_id", "station")
    f = eligible(forecast, min_lead_hours).join(place, "location_id").withColumnRenamed("value", "forecast_value")
    tie = F.struct(~F.coalesce("is_corrected", F.lit(False)), *([F.col("observation_id")] if "observation_id" in observation.columns else []))
    o = observation.where(number("value").isNotNull()).withColumn("observed_value", F.col("value"))
    m = nearest(f, o, ("station", "variable"), "valid_time", "observed_at", ("observed_value",), tolerance_minutes * MINUTE_US, rank=tie)
    offset = int_floor_div(micros("observed_at") - micros("valid_time"), 1_000_000)
    more = [c for c in ("forecast_id", "source_event_id") if c in forecast.columns]
    return m.select(
        "model", "location_id", "init_time", "valid_time", "variable", F.col("lead_hours").cast("int").alias("lead_hours"), lead_day("lead_hours").alias("lead_day"), "forecast_value", "observed_value", "observed_at",
        offset.alias("obs_offset_seconds"), (F.col("forecast_value") - F.col("observed_value")).alias("error"), "ingestion_mode", F.to_date("valid_time").alias("valid_date"), *more,
    )


def canonical(verification: DataFrame) -> DataFrame:
    """Verification rows in their order of presentation."""
    return verification.orderBy("valid_time", "location_id", "model", "variable", "init_time")


def unmatched(forecast: DataFrame, verification: DataFrame, key: str = "forecast_id", min_lead_hours: int = 1) -> DataFrame:
    """Eligible forecast rows without a verification row."""
    return eligible(forecast, min_lead_hours).join(verification.select(key), key, "left_anti")
