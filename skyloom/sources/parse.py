"""From raw messages and archive files to tidy rows in SI units; what cannot be read becomes a dead letter.

Numbers are read as text first and cast afterwards: a cell that is not a number is poison, a missing one is NULL, and a typed JSON
field could not tell the two apart.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skyloom import schemas
from skyloom.functions.columns import event_key, iso_text

#: Field -> scale and offset to SI.
FORECAST_SI = {"temperature_2m": (1.0, 273.15), "dew_point_2m": (1.0, 273.15), "wind_speed_10m": (1 / 3.6, 0.0), "pressure_msl": (100.0, 0.0)}
OBSERVATION_SI = {"temperature_2m": (1.0, 273.15), "dew_point_2m": (1.0, 273.15), "wind_speed_10m": (0.514444, 0.0), "pressure_msl": (100.0, 0.0)}
DISPLAY = {"temperature_2m": ("°C", 1.0, -273.15), "dew_point_2m": ("°C", 1.0, -273.15), "wind_speed_10m": ("m/s", 1.0, 0.0), "pressure_msl": ("hPa", 0.01, 0.0)}
INHG_TO_HPA = 33.8639
PREVIOUS_DAY = r"^(.+)_previous_day(\d+)$"


def linear(value: Column, variable: Column, table: dict[str, tuple[float, float]]) -> Column:
    out = F.lit(None).cast("double")
    for name, (scale, offset) in table.items():
        out = F.when(variable == name, value * scale + offset).otherwise(out)
    return out


def display(value: Column | str, variable: Column | str) -> Column:
    """A value in display units; unknown quantities stay as they are."""
    v, n = (F.col(x) if isinstance(x, str) else x for x in (value, variable))
    return F.coalesce(linear(v, n, {k: t[1:] for k, t in DISPLAY.items()}), v)


def display_error(value: Column | str, variable: Column | str) -> Column:
    """A difference in display units: scaled, never shifted."""
    v, n = (F.col(x) if isinstance(x, str) else x for x in (value, variable))
    return F.coalesce(linear(v, n, {k: (t[1], 0.0) for k, t in DISPLAY.items()}), v)


def display_unit(variable: Column | str) -> Column:
    v = F.col(variable) if isinstance(variable, str) else variable
    return F.element_at(F.create_map(*[F.lit(x) for k, t in DISPLAY.items() for x in (k, t[0])]), v)


def instant(text: Column) -> Column:
    """ISO text as an instant; without a zone it is UTC (the session's zone)."""
    return F.coalesce(*[F.try_to_timestamp(text, F.lit(p)) for p in ("yyyy-MM-dd'T'HH:mm", "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS][XXX]", "yyyy-MM-dd HH:mm[:ss]")])


def is_corrected(raw_text: Column | str) -> Column:
    """Whether a report carries the word COR."""
    c = F.col(raw_text) if isinstance(raw_text, str) else raw_text
    return F.coalesce(c.rlike(r"\bCOR\b"), F.lit(False))


def event_type(value: Column) -> Column:
    return F.get_json_object(value.cast("string"), "$.event_type")


def _bad(df: DataFrame, error: Column, message: Column) -> DataFrame:
    return df.withColumns({"error_type": error, "error_message": message})


def _numeric(c: Column) -> Column:
    """Whether text is a number or missing."""
    return c.isNull() | c.try_cast("double").isNotNull()


def split_forecasts(messages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Tidy rows and unreadable messages of forecast topics; ``messages`` has ``value`` and any columns to keep for dead letters.

    Live runs are melted hour by hour: an array shorter than ``time`` is padded with NULL, a longer one cut. Backfill columns name
    quantity and lead in days (``<quantity>_previous_day<N>``): start = valid time less N days, lead 24 N hours; other columns are
    skipped. Poison: broken JSON or event type, no ``hourly``, backfill without any such column or with arrays of unequal
    length, an unreadable start, a cell that is no number. An empty hourly block is not poison, it loads nothing.
    """
    keep = [c for c in messages.columns if c != "m"]
    m = messages.withColumn("m", F.from_json(F.col("value").cast("string"), schemas.FORECAST_MESSAGE))
    hourly = F.col("m.payload.api_response.hourly")
    kind = F.col("m.event_type")
    backfill = kind == "forecast.backfill.raw"
    columns = F.map_filter(hourly, lambda k, v: (k != "time") & (~backfill | k.rlike(PREVIOUS_DAY)))
    known = F.map_filter(columns, lambda k, v: backfill | k.isin(*FORECAST_SI))
    n = F.coalesce(F.size(F.element_at(hourly, "time")), F.lit(0))
    cells = F.flatten(F.map_values(known))
    numeric = F.forall(cells, _numeric)
    even = F.forall(F.map_values(known), lambda v: F.size(v) == n)
    run = instant(F.col("m.payload.run"))
    error = (
        F.when(F.col("m").isNull() | F.col("m.event_id").isNull() | F.col("m.payload").isNull(), F.lit("JSONDecodeError"))
        .when(~F.coalesce(kind.isin("forecast.raw", "forecast.backfill.raw"), F.lit(False)), F.lit("EventTypeError"))
        .when(F.col("m.payload.model").isNull() | F.col("m.payload.location_id").isNull(), F.lit("ValidationError"))
        .when(hourly.isNull() | F.element_at(hourly, "time").isNull(), F.lit("MissingHourlyError"))
        .when(~backfill & run.isNull(), F.lit("ValidationError"))
        .when(backfill & (F.size(columns) == 0), F.lit("NoLeadColumnsError"))
        .when(backfill & ~even, F.lit("UnequalArraysError"))
        .when(~numeric, F.lit("NotANumberError"))
    )
    judged = m.withColumn("error_type", error)
    bad = _bad(judged.where(F.col("error_type").isNotNull()), F.col("error_type"), F.concat(F.lit("forecast message: "), F.col("error_type"))).select(*keep, "error_type", "error_message")
    good = judged.where(F.col("error_type").isNull()).select(*[c for c in keep if c not in ("value", "key")], "m", F.explode(known).alias("column", "cells"))
    hours = good.select("*", F.posexplode(F.element_at("m.payload.api_response.hourly", "time")).alias("pos", "t"))
    name = F.when(F.col("m.event_type") == "forecast.backfill.raw", F.regexp_extract("column", PREVIOUS_DAY, 1)).otherwise(F.col("column"))
    days = F.when(F.col("m.event_type") == "forecast.backfill.raw", F.regexp_extract("column", PREVIOUS_DAY, 2).try_cast("int"))
    rows = hours.select(
        *[c for c in keep if c not in ("value", "key")], F.col("m.payload.model").alias("model"), F.col("m.payload.location_id").alias("location_id"), name.alias("variable"), days.alias("days"),
        instant(F.col("t")).alias("valid_time"), instant(F.col("m.payload.run")).alias("run"), F.get("cells", F.col("pos")).try_cast("double").alias("x"), F.col("m.event_id").alias("source_event_id"), F.col("m.ingestion_mode").alias("mode"),
    )
    init = F.when(F.col("days").isNotNull(), F.col("valid_time") - F.make_dt_interval(F.col("days"))).otherwise(F.col("run"))
    tidy = rows.withColumn("init_time", init)
    seconds = F.unix_seconds("valid_time") - F.unix_seconds("init_time")
    lead = F.when(F.col("days").isNotNull(), F.col("days") * 24).otherwise(F.floor(seconds / 3600)).cast("int")
    mode = F.when(F.col("days").isNotNull(), F.lit("backfill")).otherwise(F.coalesce("mode", F.lit("live")))
    return tidy.where(F.col("variable").isin(*FORECAST_SI) & F.col("valid_time").isNotNull()).select(
        "model", "location_id", "init_time", "valid_time", "variable", linear(F.when(~F.isnan("x"), F.col("x")), F.col("variable"), FORECAST_SI).alias("value"), lead.alias("lead_hours"), mode.alias("ingestion_mode"), "source_event_id", *[c for c in keep if c not in ("value", "key")],
    ), bad


def metar_rows(reports: DataFrame, stations: DataFrame, max_elevation_m: float = 300.0) -> DataFrame:
    """Four tidy rows per report (``temp, dewp, wspd, slp, altim`` as text or numbers, ``rawOb``, ``station``, ``observed_at``, any more to keep).

    A missing value stays as a NULL row. Sea-level pressure falls back to the altimeter only at stations known to lie at or
    below ``max_elevation_m``: ``stations`` (``station``, ``elevation_m``) is a dimension, joined on the left.
    """
    dim = stations.where(F.col("station").isNotNull()).select("station", F.col("elevation_m").alias("_elevation"))
    j = reports.join(dim, "station", "left")
    num = {c: F.col(c).try_cast("double") for c in ("temp", "dewp", "wspd", "slp", "altim")}
    pressure = F.coalesce(num["slp"], F.when(F.col("_elevation") <= max_elevation_m, num["altim"]))
    cells = F.array(*[F.struct(F.lit(v).alias("variable"), x.alias("x")) for v, x in zip(OBSERVATION_SI, (num["temp"], num["dewp"], num["wspd"], pressure))])
    more = [c for c in reports.columns if c not in ("temp", "dewp", "wspd", "slp", "altim", "rawOb", "station", "observed_at")]
    r = j.select("station", "observed_at", F.col("rawOb").alias("raw_text"), *more, F.explode(cells).alias("c"))
    return r.select("station", "observed_at", F.col("c.variable").alias("variable"), linear(F.when(~F.isnan("c.x"), F.col("c.x")), F.col("c.variable"), OBSERVATION_SI).alias("value"), "raw_text", is_corrected("raw_text").alias("is_corrected"), *more)


def split_observations(messages: DataFrame, stations: DataFrame, max_elevation_m: float = 300.0) -> tuple[DataFrame, DataFrame]:
    """Tidy rows and unreadable messages of the observation topic. Poison: broken JSON or event type, no station or time, a cell that is no number."""
    keep = [c for c in messages.columns if c != "m"]
    m = messages.withColumn("m", F.from_json(F.col("value").cast("string"), schemas.OBSERVATION_MESSAGE))
    a = "m.payload.api_response"
    at = instant(F.col("m.payload.observed_at"))
    numeric = [_numeric(F.col(f"{a}.{c}")) for c in ("temp", "dewp", "wspd", "slp", "altim")]
    ok = numeric[0]
    for x in numeric[1:]:
        ok = ok & x
    error = (
        F.when(F.col("m").isNull() | F.col("m.event_id").isNull() | F.col("m.payload").isNull(), F.lit("JSONDecodeError"))
        .when(~F.coalesce(F.col("m.event_type") == "observation.raw", F.lit(False)), F.lit("EventTypeError"))
        .when(F.col("m.payload.station").isNull() | at.isNull() | F.col(a).isNull(), F.lit("ValidationError"))
        .when(~ok, F.lit("NotANumberError"))
    )
    judged = m.withColumn("error_type", error)
    bad = _bad(judged.where(F.col("error_type").isNotNull()), F.col("error_type"), F.concat(F.lit("observation message: "), F.col("error_type"))).select(*keep, "error_type", "error_message")
    good = judged.where(F.col("error_type").isNull()).select(
        F.col("m.payload.station").alias("station"), at.alias("observed_at"), *[F.col(f"{a}.{c}").alias(c) for c in ("temp", "dewp", "wspd", "slp", "altim", "rawOb")],
        F.coalesce("m.ingestion_mode", F.lit("live")).alias("ingestion_mode"), F.col("m.event_id").alias("source_event_id"), *[c for c in keep if c not in ("value", "key")],
    )
    return metar_rows(good, stations, max_elevation_m), bad


def archive_csv(spark: SparkSession, path: str, station: str | None = None) -> DataFrame:
    """Archive CSV files as reports: blank and unreadable cells are NULL, rows without text or time are skipped, the altimeter goes from inHg to hPa.

    ``station`` (four letters) wins over the file's three-letter one; the original row is kept as JSON under ``_source``.
    """
    return archive_reports(spark.read.csv(path, header=True, inferSchema=False), station)


def archive_reports(raw: DataFrame, station: str | None = None) -> DataFrame:
    """``archive_csv`` for rows that are already a table of text cells."""
    cell = lambda c: F.nullif(F.trim(c), F.lit(""))
    num = lambda c: cell(c).try_cast("double")
    r = raw.select(
        F.lit(station).alias("station") if station else F.col("station"), F.try_to_timestamp("valid", F.lit("yyyy-MM-dd HH:mm")).alias("observed_at"), num("tmpc").alias("temp"), num("dwpc").alias("dewp"), num("sknt").alias("wspd"),
        num("mslp").alias("slp"), (num("alti") * INHG_TO_HPA).alias("altim"), cell("metar").alias("rawOb"), F.to_json(F.struct(*raw.columns)).alias("_source"),
    )
    return r.where(F.col("rawOb").isNotNull() & F.col("observed_at").isNotNull())


def observation_event_id(reports: DataFrame) -> DataFrame:
    """Reports with a station and a time, with their deterministic ``event_id`` over station, time and text."""
    return reports.where(F.col("station").isNotNull() & F.col("observed_at").isNotNull()).withColumn("event_id", event_key("station", iso_text("observed_at"), "rawOb"))


def date_chunks(spark: SparkSession, start: str, end: str, days: int) -> DataFrame:
    """Consecutive inclusive date ranges of at most ``days`` days from ``start`` to ``end``; none if end lies before start."""
    if days < 1:
        raise ValueError("a chunk has at least one day")
    s, e = F.lit(start).cast("date"), F.lit(end).cast("date")
    first = F.when(s <= e, F.sequence(s, e, F.make_dt_interval(F.lit(days)))).otherwise(F.array().cast("array<date>"))
    return spark.range(1).select(F.explode(first).alias("chunk_start")).select("chunk_start", F.least(F.date_add("chunk_start", days - 1), e).alias("chunk_end"))


def run_candidates(spark: SparkSession, now: str, cadence_hours: int = 6, steps: int = 8) -> DataFrame:
    """Starts of runs to probe, newest first: ``now`` floored to the cadence and back in its steps."""
    width = cadence_hours * 3600
    top = F.unix_seconds(F.lit(now).cast("timestamp"))
    top = top - F.pmod(top, F.lit(width))
    return spark.range(steps).select(F.timestamp_seconds(top - F.col("id") * width).alias("run"), F.col("id").alias("step"))
