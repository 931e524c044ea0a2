"""Queries of the load path: messages made of the driver's tables go through parsing, gate, dead letters, upserts, build and audit."""

from __future__ import annotations

import uuid
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyloom import schemas
from skyloom.operators import accuracy, alerts, audit, gold, ops, quality, upsert
from skyloom.plans import verification as v
from skyloom.session import shared_dir, table
from skyloom.sources import bronze, parse, staged
from skyloom.sources.files import Files
from skyloom.sources.versioned import VersionedTable
from skyloom.streaming import pipeline

S, AS_OF, CUT = v.S, v.AS_OF, v.CUT
NOW = datetime(2025, 3, 1)
FIELDS = tuple(parse.FORECAST_SI)
QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(sql: str):
    def add(f):
        QUERIES[f.__name__], SQL[f.__name__] = f, sql
        return f

    return add


def _folder(spark: SparkSession) -> str:
    return f"{shared_dir(spark)}/load-{uuid.uuid4().hex[:10]}"


def _kept(df: DataFrame, root: str) -> DataFrame:
    """The result without the folder it was read from."""
    out = df.checkpoint()
    Files(df.sparkSession).delete(root)
    return out


# ---- messages ----------------------------------------------------------------------------------------------------------------
def _messages(df: DataFrame, topic: str, ident: str, kind: str, payload) -> DataFrame:
    text = F.to_json(F.struct(F.col(ident).cast("string").alias("event_id"), F.lit(kind).alias("event_type"), F.lit("live").alias("ingestion_mode"), payload.alias("payload")), {"ignoreNullFields": "false"})
    return df.select(
        F.lit(topic).alias("topic"), F.lit(NOW.date()).alias("dt"), F.lit(0).alias("kafka_partition"), F.col(ident).alias("kafka_offset"), F.col(ident).alias("kafka_timestamp_ms"),
        F.lit(None).cast("binary").alias("key"), text.cast("binary").alias("value"),
    )


def forecast_messages(spark: SparkSession, d: str) -> DataFrame:
    """One live message per response: the run starts at the first hour."""
    hourly = F.struct(F.col("hourly.time").alias("time"), *[F.col(f"hourly.{f}").alias(f) for f in FIELDS])
    payload = F.struct("model", "location_id", F.get("hourly.time", F.lit(0)).alias("run"), F.struct(hourly.alias("hourly")).alias("api_response"))
    return _messages(table(spark, d, "open_meteo_forecast_response"), "weather.forecast.raw.v1", "response_id", "forecast.raw", payload)


def backfill_messages(spark: SparkSession, d: str) -> DataFrame:
    """The same hours as columns by lead, and one column that is none."""
    cells = [F.col("hourly.temperature_2m").alias("temperature_2m_previous_day1"), F.col("hourly.pressure_msl").alias("pressure_msl_previous_day3"), F.col("hourly.wind_speed_10m").alias("gusts")]
    payload = F.struct("model", "location_id", F.struct(F.struct(F.col("hourly.time").alias("time"), *cells).alias("hourly")).alias("api_response"))
    return _messages(table(spark, d, "open_meteo_forecast_response"), "weather.forecast.raw.v1", "response_id", "forecast.backfill.raw", payload)


def observation_messages(spark: SparkSession, d: str) -> DataFrame:
    """One message per archive row, its cells as they are: some are no numbers, and altimeter readings come in inches."""
    cell = lambda c: F.nullif(F.trim(c), F.lit(""))
    cells = F.struct(*[cell(a).alias(b) for a, b in (("tmpc", "temp"), ("dwpc", "dewp"), ("sknt", "wspd"), ("mslp", "slp"), ("alti", "altim"))], F.col("metar").alias("rawOb"))
    payload = F.struct(F.concat(F.lit("Q"), "station").alias("station"), F.col("valid").alias("observed_at"), cells.alias("api_response"))
    return _messages(table(spark, d, "iem_asos_sample"), "weather.observation.raw.v1", "record_id", "observation.raw", payload)


def _si(field: str, x: str) -> str:
    k, o = parse.FORECAST_SI[field]
    return f"CASE WHEN isnan({x}) THEN NULL ELSE {x} * {k!r} + {o!r} END"


_HOURS = "(SELECT *, unnest(range(1, len(hourly.time) + 1)) AS i FROM open_meteo_forecast_response)"
_AT = "strptime(hourly.time[{0}], '%Y-%m-%dT%H:%M')"
_MELT = "melt AS (" + " UNION ALL ".join(
    f"SELECT response_id, model, location_id, '{f}' AS variable, {_AT.format(1)} AS init_time, {_AT.format('i')} AS valid_time, {_si(f, f'hourly.{f}[i]')} AS value FROM {_HOURS}" for f in FIELDS
) + ")"
_TIMES = "strftime(init_time, '%Y-%m-%d %H:%M:%S') AS init_time, strftime(valid_time, '%Y-%m-%d %H:%M:%S') AS valid_time"
_LEAD = "CAST(floor((epoch(valid_time) - epoch(init_time)) / 3600) AS INTEGER) AS lead_hours"


def _shown(df: DataFrame, *cols) -> DataFrame:
    return df.select(*cols, v.ts("init_time").alias("init_time"), v.ts("valid_time").alias("valid_time"), "variable", "lead_hours", F.round("value", 6).alias("value"))


@query(f"WITH {_MELT} SELECT response_id, model, location_id, {_TIMES}, variable, {_LEAD}, round(value, 6) AS value FROM melt")
def melt_hourly(spark, d):
    good, _ = parse.split_forecasts(forecast_messages(spark, d))
    return _shown(good, F.col("source_event_id").cast("bigint").alias("response_id"), "model", "location_id")


@query(" UNION ALL ".join(
    f"SELECT response_id, '{f}' AS variable, strftime({_AT.format('i')} - INTERVAL {n} DAY, '%Y-%m-%d %H:%M:%S') AS init_time, strftime({_AT.format('i')}, '%Y-%m-%d %H:%M:%S') AS valid_time, CAST({24 * n} AS INTEGER) AS lead_hours, round({_si(f, f'hourly.{f}[i]')}, 6) AS value FROM {_HOURS}"
    for f, n in (("temperature_2m", 1), ("pressure_msl", 3))))
def melt_backfill_columns(spark, d):
    good, _ = parse.split_forecasts(backfill_messages(spark, d))
    return _shown(good.where("ingestion_mode = 'backfill'"), F.col("source_event_id").cast("bigint").alias("response_id"))


# ---- poll cycles ---------------------------------------------------------------------------------------------------------------
@query(f"""WITH r AS (SELECT model, location_id, {_AT.format(1)} AS run FROM open_meteo_forecast_response WHERE len(hourly.time) > 0),
 k AS (SELECT * FROM r WHERE run <= TIMESTAMP '2025-03-01' AND run >= TIMESTAMP '2025-03-01' - INTERVAL 2394 HOUR), t AS (SELECT model, max(run) AS run FROM k GROUP BY model)
 SELECT DISTINCT sha256(model || '|' || location_id || '|' || strftime(run, '%Y-%m-%dT%H:%M:%S+00:00')) AS event_id, model, location_id FROM k JOIN t USING (model, run) WHERE location_id IS NOT NULL""")
def forecast_poll_cycle(spark, d):
    """The messages of one cycle over staged responses: the latest run of every model."""
    r = table(spark, d, "open_meteo_forecast_response")
    models = [x[0] for x in r.select("model").distinct().collect()]  # a handful, from settings otherwise
    staged_rows = r.select("model", "location_id", F.get("hourly.time", F.lit(0)).alias("run"), F.struct("hourly").alias("api_response"))
    return staged.forecast_cycle(staged_rows, models, NOW, 6, 400).messages.select("event_id", "model", "location_id")


@query("""SELECT DISTINCT station FROM dim_location WHERE station IS NOT NULL AND NOT EXISTS
 (SELECT 1 FROM iem_asos_sample s WHERE 'Q' || s.station = dim_location.station AND trim(metar) <> '' AND try_strptime(valid, '%Y-%m-%d %H:%M') IS NOT NULL)""")
def stations_without_report(spark, d):
    raw = table(spark, d, "iem_asos_sample").withColumn("station", F.concat(F.lit("Q"), "station"))
    return staged.observation_cycle(parse.archive_reports(raw), table(spark, d, "dim_location"), NOW).missing


# ---- gate and tables -----------------------------------------------------------------------------------------------------------
_HARD = v._range("value", "hard")
_LOAD = f"""{_MELT}, blocked AS (SELECT DISTINCT response_id FROM melt WHERE NOT ({_HARD}) OR model IS NULL OR location_id IS NULL),
 clean AS (SELECT *, row_number() OVER (PARTITION BY model, location_id, init_time, valid_time, variable ORDER BY response_id DESC) AS rn FROM melt WHERE response_id NOT IN (SELECT response_id FROM blocked))"""


@query(f"WITH {_LOAD} SELECT response_id, {_TIMES}, variable, {_LEAD}, round(value, 6) AS value FROM clean WHERE rn = 1")
def loaded_forecasts(spark, d):
    """The forecast table after one batch of the topic: parsed, gated, the last row of each key upserted."""
    root = _folder(spark)
    tables = pipeline.Tables(spark, root)
    pipeline.load_forecasts(tables, forecast_messages(spark, d), S, NOW)
    return _kept(_shown(tables.forecast.read(), F.col("source_event_id").cast("bigint").alias("response_id")), root)


_CELLS = {"tmpc": "temp", "dwpc": "dewp", "sknt": "wspd", "mslp": "slp", "alti": "altim"}
_NUMERIC = " AND ".join(f"(trim({c}) = '' OR {c} IS NULL OR try_cast(trim({c}) AS DOUBLE) IS NOT NULL)" for c in _CELLS)
_NUMBER = "CASE WHEN isnan(try_cast(trim({0}) AS DOUBLE)) THEN NULL ELSE try_cast(trim({0}) AS DOUBLE) END"
_REPORTS = f"""raw AS (SELECT record_id, 'Q' || station AS station, try_strptime(valid, '%Y-%m-%d %H:%M') AS t, metar, {_NUMERIC} AS numeric, {", ".join(f"{_NUMBER.format(c)} AS {n}" for c, n in _CELLS.items())} FROM iem_asos_sample),
 good AS (SELECT raw.*, coalesce(slp, CASE WHEN l.elevation_m <= 300 THEN altim END) AS p FROM raw LEFT JOIN dim_location l USING (station) WHERE raw.station IS NOT NULL AND t IS NOT NULL AND numeric),
 tidy AS (SELECT record_id, station, t, coalesce(regexp_matches(metar, '\\bCOR\\b'), FALSE) AS cor, unnest(['temperature_2m', 'dew_point_2m', 'wind_speed_10m', 'pressure_msl']) AS variable,
   unnest([temp + 273.15, dewp + 273.15, wspd * 0.514444, p * 100.0]) AS value FROM good),
 blocked AS (SELECT DISTINCT record_id FROM tidy WHERE NOT ({_HARD})),
 clean AS (SELECT *, row_number() OVER (PARTITION BY station, t, variable ORDER BY cor DESC, record_id DESC) AS rn FROM tidy WHERE record_id NOT IN (SELECT record_id FROM blocked))"""


@query(f"WITH {_REPORTS} SELECT record_id, station, strftime(t, '%Y-%m-%d %H:%M:%S') AS observed_at, variable, round(value, 6) AS value, cor AS is_corrected FROM clean WHERE rn = 1")
def replayed_observations(spark, d):
    """The observation table after a load from the lake and a rebuild from it."""
    root = _folder(spark)
    tables, stations = pipeline.Tables(spark, root), table(spark, d, "dim_location")
    bronze.append_bronze(observation_messages(spark, d), f"{root}/lake")
    lake = bronze.read_bronze(spark, f"{root}/lake", "weather.observation.raw.v1").drop("seq")
    pipeline.load_observations(tables, lake, stations, S, NOW)
    pipeline.replay(tables, lake, "observation", stations, S, NOW)
    o = tables.observation.read().select(F.col("source_event_id").cast("bigint").alias("record_id"), "station", v.ts("observed_at").alias("observed_at"), "variable", F.round("value", 6).alias("value"), "is_corrected")
    return _kept(o, root)


@query(f"""WITH {_REPORTS} SELECT record_id, CASE WHEN station IS NULL OR t IS NULL THEN 'ValidationError' ELSE 'NotANumberError' END AS error_type FROM raw WHERE station IS NULL OR t IS NULL OR NOT numeric
 UNION ALL SELECT record_id, 'QualityError' FROM blocked""")
def dead_letters_of_a_load(spark, d):
    root = _folder(spark)
    tables = pipeline.Tables(spark, root)
    pipeline.load_observations(tables, observation_messages(spark, d), table(spark, d, "dim_location"), S, NOW)
    return _kept(tables.dead_letter.read().select(F.col("source_offset").alias("record_id"), "error_type"), root)


@query(f"""WITH w AS (SELECT *, coalesce(is_corrected, FALSE) AS cor, CASE WHEN isnan(value) THEN NULL ELSE value END AS x, inserted_at < TIMESTAMPTZ '{CUT}+00' AS old FROM observation),
 r AS (SELECT *, row_number() OVER (PARTITION BY old, station, observed_at, variable ORDER BY cor DESC, inserted_at DESC, observation_id DESC) AS rn FROM w),
 j AS (SELECT coalesce(o.station, n.station) AS station, coalesce(o.observed_at, n.observed_at) AS observed_at, coalesce(o.variable, n.variable) AS variable, o.station IS NULL OR (n.station IS NOT NULL AND (n.cor OR NOT o.cor)) AS take, o.x AS ox, n.x AS nx, o.cor AS oc, n.cor AS nc
   FROM (SELECT * FROM r WHERE old AND rn = 1) o FULL JOIN (SELECT * FROM r WHERE NOT old AND rn = 1) n ON o.station = n.station AND o.observed_at = n.observed_at AND o.variable = n.variable)
 SELECT station, {v.qt('observed_at')} AS observed_at, variable, CASE WHEN take THEN nx ELSE ox END AS value, CASE WHEN take THEN nc ELSE oc END AS is_corrected FROM j""")
def guarded_upserts(spark, d):
    """The observation table after two batches: a correction stays whatever comes after it."""
    root = _folder(spark)
    t = VersionedTable(spark, f"{root}/observation", F.to_date("observed_at"), schemas.OBSERVATION)
    o = table(spark, d, "observation")
    for side in (F.col("inserted_at") < F.lit(CUT).cast("timestamp"), F.col("inserted_at") >= F.lit(CUT).cast("timestamp")):
        batch = upsert.last_observations(o.where(side)).select(*[c for c in schemas.OBSERVATION.names if c not in ("inserted_at", "updated_at")])
        upsert.upsert(t, batch, schemas.OBSERVATION_KEY, ("value", "raw_text", "is_corrected", "ingestion_mode", "source_event_id"), NOW, guard=upsert.correction_guard(), created=("inserted_at",), touched=("updated_at",))
    return _kept(t.read().select("station", v.ts("observed_at").alias("observed_at"), "variable", "value", F.coalesce("is_corrected", F.lit(False)).alias("is_corrected")), root)


_GOOD_F, _GOOD_O = (" AND ".join(f"coalesce({g}, TRUE)" for _, s, g in c if s == "blocking") for c in (v._FC, v._OC))
_GATED = v._VER.replace("FROM forecast)", f"FROM forecast WHERE {_GOOD_F})").replace("FROM observation)", f"FROM observation WHERE {_GOOD_O})")


@query(f"WITH {_GATED} {v._DAY}")
def gold_after_two_builds(spark, d):
    """The daily accuracy after a build of what had arrived by an instant and an incremental one of the rest; rows that the gate blocks never arrive."""
    root = _folder(spark)
    g = gold.Gold(spark, root, S)
    cut = F.lit(CUT).cast("timestamp")
    f, o = (t.where(~quality.blocked_rows(t, c)) for t, c in ((table(spark, d, "forecast"), quality.forecast_contract(S)), (table(spark, d, "observation"), quality.observation_contract(S))))
    for before, at in ((True, datetime.fromisoformat(CUT)), (False, NOW)):
        side = F.col("inserted_at") < cut if before else F.lit(True)
        g.build(upsert.keep_last(f.where(side), schemas.FORECAST_KEY, ["inserted_at", "forecast_id"]), upsert.last_observations(o.where(side)), table(spark, d, "dim_location"), at)
    a = g.accuracy.read()
    return _kept(a.select(F.date_format("valid_date", "yyyy-MM-dd").alias("valid_date"), "location_id", "model", "variable", F.col("lead_day").cast("bigint").alias("lead_day"), "n", *[v.r6(c).alias(c) for c in ("bias", "mae", "rmse")]), root)


# ---- audit, lineage, reads -------------------------------------------------------------------------------------------------------
_ALL = f"({v._results(v._FC, 'forecast', 'forecast')} UNION ALL {v._results(v._OC, 'observation', 'observation')})"


@query(f"""SELECT table_name, count(*) AS checks, count(*) FILTER (WHERE NOT passed AND severity = 'blocking') AS blocking_failed, count(*) FILTER (WHERE NOT passed AND severity = 'warning') AS warnings_failed,
 CAST(coalesce(sum(rows_failed) FILTER (WHERE NOT passed), 0) AS BIGINT) AS rows_failed FROM {_ALL} WHERE check_name <> 'all_checks' GROUP BY table_name""")
def audited_suite(spark, d):
    """The quality suite as the audit table shows it."""
    root = _folder(spark)
    a = audit.Audit(spark, root)
    a.results(audit.run_suite({t: table(spark, d, t) for t in ("forecast", "observation")}, S), "suite", NOW)
    return _kept(audit.quality_summary(a.read("quality_results")), root)


_FK = "model, location_id, init_time, valid_time, variable"


@query(f"""WITH own AS (SELECT DISTINCT {_FK} FROM forecast WHERE source_event_id = (SELECT max(source_event_id) FROM forecast))
 SELECT f.source_event_id, count(*) AS rows FROM forecast f WHERE EXISTS (SELECT 1 FROM own o WHERE o.model = f.model AND o.location_id = f.location_id AND o.init_time = f.init_time AND o.valid_time = f.valid_time AND o.variable = f.variable) GROUP BY ALL""")
def trace_current_events(spark, d):
    """Which events the keys of one event stand under."""
    f = table(spark, d, "forecast")
    event = f.agg(F.max("source_event_id")).first()[0]
    return ops.trace_event(event, f, v.verification(spark, d), table(spark, d, "accuracy_daily"))["current"]


@query(f"""WITH e AS (SELECT source_topic, source_partition, min(source_offset) AS low, max(source_offset) + 1 AS high, max(source_offset) FILTER (WHERE failed_at < TIMESTAMPTZ '{AS_OF}+00') + 1 AS done FROM dlq_record GROUP BY ALL)
 SELECT 'reader' AS "group", source_topic AS topic, CAST(sum(greatest(high - coalesce(done, low), 0)) AS BIGINT) AS lag FROM e GROUP BY source_topic""")
def consumer_lag(spark, d):
    q = table(spark, d, "dlq_record").groupBy(F.col("source_topic").alias("topic"), F.col("source_partition").alias("partition"))
    e = q.agg(F.min("source_offset").alias("low"), (F.max("source_offset") + 1).alias("high"), (F.max(F.when(F.col("failed_at") < F.lit(AS_OF).cast("timestamp"), F.col("source_offset"))) + 1).alias("offset"))
    return bronze.consumer_lag(e.drop("offset"), e.select(F.lit("reader").alias("group"), "topic", "partition", "offset"))


@query(f"""WITH {v._CHANGE}, a AS (SELECT location_id, init_time, sha256('run_change|' || model || '|' || location_id || '|' || strftime(init_time AT TIME ZONE 'UTC', '%Y-%m-%dT%H:%M:%S+00:00') || '|' || variable) AS alert_id FROM found)
 SELECT location_id, alert_id, {v.qt('init_time')} AS event_time FROM (SELECT *, row_number() OVER (PARTITION BY location_id ORDER BY init_time DESC, alert_id DESC) AS rn FROM a) WHERE rn = 1""")
def latest_alert_per_location(spark, d):
    a = alerts.as_alerts(alerts.run_change(alerts.live_runs(table(spark, d, "forecast")), S), "run_change").withColumns({"detected_at": F.lit(NOW), "arrival": F.col("alert_id")})
    return alerts.latest_per_location(a, "arrival").select("location_id", "alert_id", v.ts("event_time").alias("event_time"))


@query(f"""WITH {v._ACC}, r AS (SELECT model, {v._FIG} FROM good, bounds WHERE variable = 'temperature_2m' AND location_id = (SELECT min(location_id) FROM good, bounds WHERE variable = 'temperature_2m' AND valid_date > hi - 30) AND valid_date > hi - 30 GROUP BY model)
 SELECT *, row_number() OVER (ORDER BY mae, model) AS position FROM r""")
def leaderboard_one_location(spark, d):
    a = v.latest_accuracy(spark, d)
    place = accuracy.ranking(a, "temperature_2m", 30, by=("location_id", "model")).agg(F.min("location_id")).first()[0]
    b = accuracy.ranking(a, "temperature_2m", 30, location_id=place)
    return v._figs(b, "model", "position")


@query("""SELECT count(*) AS places, CAST(coalesce(sum(CASE WHEN l.elevation_m > 300 THEN 1 ELSE 0 END), 0) AS BIGINT) AS high FROM dim_location l""")
def dimension_after_two_loads(spark, d):
    """The place dimension loaded twice: the second load changes nothing and writes nothing."""
    root = _folder(spark)
    loc = table(spark, d, "dim_location")
    t = VersionedTable(spark, f"{root}/location", F.lit("all"), loc.schema)
    values = [c for c in loc.columns if c != "location_id"]
    upsert.upsert(t, loc, ("location_id",), values, NOW)
    before = t.manifest()["version"]
    upsert.upsert(t, loc, ("location_id",), values, NOW)
    if t.manifest()["version"] != before:
        raise RuntimeError("an unchanged dimension was written")
    return _kept(t.read().agg(F.count(F.lit(1)).alias("places"), F.count_if(F.col("elevation_m") > 300).alias("high")), root)


@query(f"""SELECT 'forecast' AS subject, {v.qt('max(init_time)')} AS newest, coalesce((epoch(TIMESTAMPTZ '{v.NOW}+00') - floor(epoch(max(init_time)))) / 3600.0 <= 14, FALSE) AS passed FROM forecast WHERE ingestion_mode = 'live'""")
def freshness_of_sources(spark, d):
    f = table(spark, d, "forecast").where("ingestion_mode = 'live'").withColumn("source", F.lit("forecast"))
    subjects = spark.createDataFrame([("forecast",)], "source string")
    r = quality.freshness(f, subjects, "source", "init_time", v.NOW, S.forecast_stale_hours, "source")
    return r.select("subject", v.ts("newest").alias("newest"), "passed")
