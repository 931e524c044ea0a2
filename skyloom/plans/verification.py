"""Queries of the verification engine over the driver's tables, with the same results in plain SQL.

Doubles that come from sums are rounded as ``round(x + 1e-9, 6)`` on both sides: the order of addition moves them by less, and exact
halves fall the same way.
"""

from __future__ import annotations

import uuid
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from skyloom import schemas
from skyloom.config import Settings
from skyloom.functions.columns import event_key, half_even_hour, iso_text, number
from skyloom.operators import accuracy, alerts, asof, briefing, gold, ops, quality, upsert
from skyloom.plans.data_quality import SQL as _QUALITY_SQL
from skyloom.session import shared_dir, table
from skyloom.sources import bronze, parse

S = Settings()
#: Instants the queries refer to (the data end on 2025-02-28).
AS_OF, SINCE, CUT, NOW = "2025-02-27 12:00:00", "2025-02-27 00:00:00", "2025-02-26 00:00:00", "2025-03-01 00:00:00"
_HOURLY = _QUALITY_SQL["p2_hourly"]
QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            SQL[f.__name__] = sql
        return f

    return add


def r6(c: Column | str) -> Column:
    return F.round((F.col(c) if isinstance(c, str) else c) + 1e-9, 6)


def ts(c: Column | str) -> Column:
    return F.date_format(c, "yyyy-MM-dd HH:mm:ss")


def q6(x: str) -> str:
    return f"round({x} + 1e-9, 6)"


def qt(x: str) -> str:
    return f"strftime({x} AT TIME ZONE 'UTC', '%Y-%m-%d %H:%M:%S')"


FK, OK = "model, location_id, init_time, valid_time, variable", "station, observed_at, variable"
_V = "(value IS NOT NULL AND NOT isnan(value))"
_SF = f"sf AS (SELECT * EXCLUDE rn FROM (SELECT *, row_number() OVER (PARTITION BY {FK} ORDER BY inserted_at DESC NULLS LAST, forecast_id DESC) AS rn FROM forecast) WHERE rn = 1)"
_SO = f"so AS (SELECT * EXCLUDE rn FROM (SELECT *, row_number() OVER (PARTITION BY {OK} ORDER BY coalesce(is_corrected, FALSE) DESC, inserted_at DESC NULLS LAST, observation_id DESC) AS rn FROM observation) WHERE rn = 1)"
_VER = f"""{_SF}, {_SO},
 el AS (SELECT f.*, l.station FROM sf f JOIN dim_location l USING (location_id) WHERE {_V.replace('value', 'f.value')} AND f.lead_hours >= 1 AND l.station IS NOT NULL),
 best AS (SELECT t.station, t.variable, t.valid_time, o.observed_at, o.value AS observed_value,
    row_number() OVER (PARTITION BY t.station, t.variable, t.valid_time ORDER BY abs(epoch_us(o.observed_at) - epoch_us(t.valid_time)), o.observed_at) AS rn
   FROM (SELECT DISTINCT station, variable, valid_time FROM el) t JOIN (SELECT * FROM so WHERE {_V}) o ON o.station = t.station AND o.variable = t.variable
    AND o.observed_at BETWEEN t.valid_time - INTERVAL 30 MINUTE AND t.valid_time + INTERVAL 30 MINUTE),
 ver AS (SELECT e.forecast_id, e.source_event_id, e.model, e.location_id, e.init_time, e.valid_time, e.variable, e.lead_hours, CAST(floor((e.lead_hours + 23) / 24.0) AS SMALLINT) AS lead_day,
    e.value AS forecast_value, b.observed_value, b.observed_at, (epoch_us(b.observed_at) - epoch_us(e.valid_time)) // 1000000 AS obs_offset_seconds, e.value - b.observed_value AS error,
    e.ingestion_mode, CAST(e.valid_time AT TIME ZONE 'UTC' AS DATE) AS valid_date
   FROM el e JOIN best b USING (station, variable, valid_time) WHERE b.rn = 1)"""
_ACC = """acc AS (SELECT valid_date, location_id, model, variable, lead_day, n, bias, mae, rmse FROM (SELECT *, row_number() OVER (PARTITION BY valid_date, location_id, model, variable, lead_day ORDER BY computed_at DESC) AS rn FROM accuracy_daily) WHERE rn = 1),
 good AS (SELECT * FROM acc WHERE n > 0 AND mae IS NOT NULL AND bias IS NOT NULL AND rmse IS NOT NULL AND NOT isnan(mae)),
 bounds AS (SELECT max(valid_date) AS hi FROM acc)"""
_FIG = f"CAST(sum(n) AS BIGINT) AS n, {q6('sum(n * bias) / sum(n)')} AS bias, {q6('sum(n * mae) / sum(n)')} AS mae, {q6('sqrt(sum(n * rmse * rmse) / sum(n))')} AS rmse"


def silver_forecast(spark: SparkSession, d: str) -> DataFrame:
    return upsert.keep_last(table(spark, d, "forecast"), schemas.FORECAST_KEY, ["inserted_at", "forecast_id"])


def silver_observation(spark: SparkSession, d: str) -> DataFrame:
    return upsert.last_observations(table(spark, d, "observation"))


def verification(spark: SparkSession, d: str) -> DataFrame:
    return asof.verify(silver_forecast(spark, d), silver_observation(spark, d), table(spark, d, "dim_location"), S.tolerance_minutes, S.min_lead_hours)


def latest_accuracy(spark: SparkSession, d: str) -> DataFrame:
    return accuracy.latest(table(spark, d, "accuracy_daily"))


# ---- dedupe and upsert -----------------------------------------------------------------------------------------------------
@query(f"WITH {_SF} SELECT forecast_id FROM sf")
def dedupe_keep_last(spark, d):
    return silver_forecast(spark, d).select("forecast_id")


@query(f"WITH {_SO} SELECT observation_id, coalesce(is_corrected, FALSE) AS is_corrected FROM so")
def correction_precedence(spark, d):
    return silver_observation(spark, d).select("observation_id", F.coalesce("is_corrected", F.lit(False)).alias("is_corrected"))


def _halves(spark, d):
    f = table(spark, d, "forecast")
    side = F.col("inserted_at") < F.lit(CUT).cast("timestamp")
    order = ["inserted_at", "forecast_id"]
    return upsert.keep_last(f.where(side), schemas.FORECAST_KEY, order), upsert.keep_last(f.where(~side), schemas.FORECAST_KEY, order)


@query(f"""WITH h AS (SELECT *, inserted_at < TIMESTAMPTZ '{CUT}+00' AS old, CASE WHEN isnan(value) THEN NULL ELSE value END AS v FROM forecast),
 r AS (SELECT *, row_number() OVER (PARTITION BY old, {FK} ORDER BY inserted_at DESC, forecast_id DESC) AS rn FROM h),
 o AS (SELECT * FROM r WHERE old AND rn = 1), n AS (SELECT * FROM r WHERE NOT old AND rn = 1),
 j AS (SELECT o.forecast_id AS oid, n.forecast_id AS nid, o.v AS ov, n.v AS nv,
   CASE WHEN o.model IS NULL THEN 'insert' WHEN n.model IS NULL THEN 'keep' WHEN o.v IS DISTINCT FROM n.v OR o.lead_hours IS DISTINCT FROM n.lead_hours OR o.source_event_id IS DISTINCT FROM n.source_event_id THEN 'update' ELSE 'keep' END AS action
  FROM o FULL JOIN n ON o.model = n.model AND o.location_id = n.location_id AND o.init_time = n.init_time AND o.valid_time = n.valid_time AND o.variable = n.variable)
 SELECT CASE WHEN action = 'keep' THEN oid ELSE nid END AS forecast_id, CASE WHEN action = 'keep' THEN ov ELSE nv END AS value, action FROM j""")
def conditional_upsert_changed_only(spark, d):
    old, new = _halves(spark, d)
    values = ("forecast_id", "value", "lead_hours", "source_event_id")
    r = upsert.diff(old, new, schemas.FORECAST_KEY, values, NOW, changed_by=values[1:], created=("inserted_at",), touched=("updated_at",))
    return r.select("forecast_id", "value", "action")


@query("""WITH k AS (SELECT *, row_number() OVER (PARTITION BY valid_date, location_id, model, variable, lead_day ORDER BY computed_at) AS a, row_number() OVER (PARTITION BY valid_date, location_id, model, variable, lead_day ORDER BY computed_at DESC) AS z,
   CASE WHEN isnan(mae) THEN NULL ELSE mae END AS m FROM accuracy_daily),
 o AS (SELECT * FROM k WHERE a = 1 AND lead_day <> 7), n AS (SELECT * FROM k WHERE z = 1 AND lead_day <> 1),
 j AS (SELECT coalesce(o.lead_day, n.lead_day) AS lead_day, CASE WHEN o.model IS NULL THEN 'insert' WHEN n.model IS NULL THEN 'delete' WHEN o.n IS DISTINCT FROM n.n OR o.m IS DISTINCT FROM n.m THEN 'update' ELSE 'keep' END AS action
  FROM o FULL JOIN n USING (valid_date, location_id, model, variable, lead_day))
 SELECT CAST(lead_day AS BIGINT) AS lead_day, action, count(*) AS rows FROM j GROUP BY ALL""")
def scope_sync_diff(spark, d):
    a = table(spark, d, "accuracy_daily")
    by = Window.partitionBy(*schemas.ACCURACY_KEY)
    old = a.withColumn("_r", F.row_number().over(by.orderBy("computed_at"))).where("_r = 1 and lead_day <> 7").drop("_r")
    new = a.withColumn("_r", F.row_number().over(by.orderBy(F.col("computed_at").desc()))).where("_r = 1 and lead_day <> 1").drop("_r")
    r = upsert.diff(old, new, schemas.ACCURACY_KEY, ("n", "mae"), NOW, touched=("computed_at",), sync=True)
    return r.groupBy(F.col("lead_day").cast("bigint").alias("lead_day"), "action").agg(F.count(F.lit(1)).alias("rows"))


# ---- as-of join and accuracy -----------------------------------------------------------------------------------------------
_VCOLS = f"model, location_id, {qt('init_time')} AS init_time, {qt('valid_time')} AS valid_time, variable, lead_hours, CAST(lead_day AS INTEGER) AS lead_day, forecast_value, observed_value, {qt('observed_at')} AS observed_at, obs_offset_seconds, {q6('error')} AS error"


@query(f"WITH {_VER} SELECT {_VCOLS} FROM ver")
def asof_nearest_verification(spark, d):
    return verification(spark, d).select("model", "location_id", ts("init_time").alias("init_time"), ts("valid_time").alias("valid_time"), "variable", "lead_hours", F.col("lead_day").cast("int").alias("lead_day"), "forecast_value", "observed_value", ts("observed_at").alias("observed_at"), "obs_offset_seconds", r6("error").alias("error"))


@query(f"WITH {_VER} SELECT forecast_id FROM sf WHERE {_V} AND lead_hours >= 1 AND NOT EXISTS (SELECT 1 FROM ver WHERE ver.forecast_id = sf.forecast_id)")
def asof_unmatched_forecasts(spark, d):
    return asof.unmatched(silver_forecast(spark, d), verification(spark, d)).select("forecast_id")


_DAY = f"SELECT strftime(valid_date, '%Y-%m-%d') AS valid_date, location_id, model, variable, CAST(lead_day AS BIGINT) AS lead_day, count(*) AS n, {q6('avg(error)')} AS bias, {q6('avg(abs(error))')} AS mae, {q6('sqrt(avg(error * error))')} AS rmse FROM ver GROUP BY ALL"


@query(f"WITH {_VER} {_DAY}")
def accuracy_by_day(spark, d):
    return accuracy.daily(verification(spark, d)).select(F.date_format("valid_date", "yyyy-MM-dd").alias("valid_date"), "location_id", "model", "variable", F.col("lead_day").cast("bigint").alias("lead_day"), "n", r6("bias").alias("bias"), r6("mae").alias("mae"), r6("rmse").alias("rmse"))


@query(f"""WITH {_VER}, day AS (SELECT valid_date, location_id, model, variable, lead_day, count(*) AS n, avg(error) AS bias, avg(abs(error)) AS mae, sqrt(avg(error * error)) AS rmse FROM ver GROUP BY ALL)
 SELECT model, variable, CAST(lead_day AS BIGINT) AS lead_day, {_FIG}, 0.0 AS off FROM day GROUP BY model, variable, lead_day""")
def recombination_exactness(spark, d):
    v = verification(spark, d)
    keys = ["model", "variable", "lead_day"]
    raw = accuracy.daily(v, keys)
    parts = accuracy.recombine(accuracy.daily(v), keys)
    j = parts.join(raw.select(*keys, F.col("mae").alias("raw_mae"), F.col("rmse").alias("raw_rmse")), keys)
    off = F.round(F.greatest(F.abs(F.col("mae") - F.col("raw_mae")), F.abs(F.col("rmse") - F.col("raw_rmse"))), 6)
    return j.select("model", "variable", F.col("lead_day").cast("bigint").alias("lead_day"), "n", r6("bias").alias("bias"), r6("mae").alias("mae"), r6("rmse").alias("rmse"), off.alias("off"))


def _figs(df: DataFrame, *first) -> DataFrame:
    return df.select(*first, "n", r6("bias").alias("bias"), r6("mae").alias("mae"), r6("rmse").alias("rmse"))


@query(f"""WITH {_ACC}, w AS (SELECT unnest([7, 30]) AS window_days),
 r AS (SELECT window_days, location_id, variable, CAST(lead_day AS BIGINT) AS lead_day, model, {_FIG}, sum(n * mae) / sum(n) AS m FROM good, w, bounds WHERE valid_date > hi - CAST(window_days AS INTEGER) GROUP BY ALL)
 SELECT CAST(window_days AS BIGINT) AS window_days, location_id, variable, lead_day, model, n, bias, mae, rmse, rank() OVER (PARTITION BY window_days, location_id, variable, lead_day ORDER BY m) AS mae_rank FROM r""")
def model_leaderboard_7_30(spark, d):
    b = accuracy.leaderboard(latest_accuracy(spark, d), (7, 30))
    return b.select(F.col("window_days").cast("bigint").alias("window_days"), "location_id", "variable", F.col("lead_day").cast("bigint").alias("lead_day"), "model", "n", r6("bias").alias("bias"), r6("mae").alias("mae"), r6("rmse").alias("rmse"), "mae_rank")


@query(f"WITH {_ACC}, r AS (SELECT model, {_FIG} FROM good, bounds WHERE variable = 'temperature_2m' AND valid_date > hi - 30 GROUP BY model) SELECT *, row_number() OVER (ORDER BY mae, model) AS position FROM r")
def leaderboard_one_variable(spark, d):
    b = accuracy.ranking(latest_accuracy(spark, d), "temperature_2m", 30)
    return _figs(b, "model", "position")


@query(f"WITH {_ACC}, r AS (SELECT CAST(lead_day AS BIGINT) AS lead_day, model, {_FIG} FROM good, bounds WHERE variable = 'temperature_2m' AND valid_date > hi - 30 GROUP BY ALL) SELECT *, row_number() OVER (PARTITION BY lead_day ORDER BY mae, model) AS position FROM r")
def error_by_lead(spark, d):
    b = accuracy.ranking(latest_accuracy(spark, d), "temperature_2m", 30, by=("lead_day", "model"))
    return _figs(b, F.col("lead_day").cast("bigint").alias("lead_day"), "model", "position")


@query(f"""WITH {_ACC}, r AS (SELECT location_id, model, CAST(sum(n) AS BIGINT) AS n, sum(n * mae) / sum(n) AS mae FROM good, bounds WHERE variable = 'temperature_2m' AND lead_day = 1 AND valid_date > hi - 30 GROUP BY ALL),
 k AS (SELECT *, rank() OVER (PARTITION BY location_id ORDER BY mae) AS r, lead(mae) OVER (PARTITION BY location_id ORDER BY mae, model) - mae AS margin FROM r)
 SELECT location_id, name, model AS best_model, n, {q6('mae')} AS mae, {q6('margin')} AS margin FROM k JOIN dim_location USING (location_id) WHERE r = 1""")
def best_model_by_location(spark, d):
    b = accuracy.best_by_location(latest_accuracy(spark, d), table(spark, d, "dim_location"), "temperature_2m", 30, 1)
    return b.select("location_id", "name", "best_model", "n", r6("mae").alias("mae"), r6("margin").alias("margin"))


@query(SQL["best_model_by_location"].replace(SQL["best_model_by_location"].split(" SELECT location_id, name")[1], "").replace(" SELECT location_id, name", " SELECT model, count(*) AS wins FROM k WHERE r = 1 GROUP BY model"))
def wins_per_model(spark, d):
    b = accuracy.best_by_location(latest_accuracy(spark, d), table(spark, d, "dim_location"), "temperature_2m", 30, 1)
    return b.groupBy(F.col("best_model").alias("model")).agg(F.count(F.lit(1)).alias("wins"))


@query(f"WITH {_ACC} SELECT location_id, model, {_FIG} FROM good WHERE variable = 'temperature_2m' AND lead_day = 1 AND valid_date >= DATE '{AS_OF[:10]}' - 30 AND valid_date < DATE '{AS_OF[:10]}' GROUP BY ALL")
def accuracy_before(spark, d):
    return _figs(accuracy.over_days(latest_accuracy(spark, d), AS_OF, 30, "temperature_2m", 1), "location_id", "model")


@query(f"WITH {_VER} SELECT variable, model, count(*) AS points, {q6('avg(error)')} AS bias, {q6('avg(abs(error))')} AS mae FROM ver GROUP BY ALL")
def selection_summary(spark, d):
    return verification(spark, d).groupBy("variable", "model").agg(F.count(F.lit(1)).alias("points"), r6(F.avg("error")).alias("bias"), r6(F.avg(F.abs("error"))).alias("mae"))


@query(f"WITH {_ACC} SELECT location_id, CAST(sum(n) AS BIGINT) AS n FROM good GROUP BY location_id ORDER BY n DESC, location_id LIMIT 1")
def busiest_location(spark, d):
    return accuracy.recombine(latest_accuracy(spark, d), ["location_id"]).select("location_id", "n").orderBy(F.col("n").desc(), "location_id").limit(1)


@query(f"WITH {_VER} SELECT {qt('min(valid_time)')} AS first_time, {qt('max(valid_time)')} AS last_time, count(*) AS rows FROM ver")
def verified_range(spark, d):
    return verification(spark, d).agg(ts(F.min("valid_time")).alias("first_time"), ts(F.max("valid_time")).alias("last_time"), F.count(F.lit(1)).alias("rows"))


@query(f"""WITH {_VER} SELECT model, location_id, variable, {qt('valid_time')} AS valid_time, round(CASE variable WHEN 'pressure_msl' THEN forecast_value * 0.01 WHEN 'wind_speed_10m' THEN forecast_value ELSE forecast_value - 273.15 END, 3) AS forecast_shown,
  round(CASE variable WHEN 'pressure_msl' THEN error * 0.01 ELSE error END + 1e-9, 3) AS error_shown, CASE variable WHEN 'pressure_msl' THEN 'hPa' WHEN 'wind_speed_10m' THEN 'm/s' ELSE '°C' END AS unit FROM ver WHERE lead_day = 1""")
def forecast_vs_actual(spark, d):
    v = verification(spark, d).where("lead_day = 1")
    return v.select("model", "location_id", "variable", ts("valid_time").alias("valid_time"), F.round(parse.display("forecast_value", "variable"), 3).alias("forecast_shown"), F.round(parse.display_error("error", "variable") + 1e-9, 3).alias("error_shown"), parse.display_unit("variable").alias("unit"))


# ---- runs and rules --------------------------------------------------------------------------------------------------------
@query(f"SELECT model, location_id, {qt('max(init_time)')} AS init_time FROM forecast WHERE ingestion_mode = 'live' AND init_time <= TIMESTAMPTZ '{AS_OF}+00' GROUP BY ALL")
def latest_run_per_model(spark, d):
    f = table(spark, d, "forecast").where((F.col("ingestion_mode") == "live") & (F.col("init_time") <= F.lit(AS_OF).cast("timestamp")))
    return f.groupBy("model", "location_id").agg(ts(F.max("init_time")).alias("init_time"))


_RUNS = f"runs AS (SELECT model, location_id, variable, init_time, valid_time, v AS value FROM (SELECT *, value AS v, row_number() OVER (PARTITION BY model, location_id, variable, init_time, valid_time ORDER BY inserted_at DESC, forecast_id DESC) AS rn FROM forecast WHERE ingestion_mode = 'live' AND {_V}) WHERE rn = 1)"
_LEAD = "(epoch(valid_time) - epoch(init_time))"


@query(f"""WITH {_RUNS} SELECT location_id, variable, {qt('valid_time')} AS valid_time, model, {qt('init_time')} AS init_time, value FROM
 (SELECT *, row_number() OVER (PARTITION BY location_id, variable, valid_time, model ORDER BY init_time DESC) AS rn FROM runs WHERE {_LEAD} BETWEEN 3600 AND 86400) WHERE rn = 1""")
def forecasts_at_hour(spark, d):
    runs = alerts.live_runs(table(spark, d, "forecast"))
    lead = F.unix_seconds("valid_time") - F.unix_seconds("init_time")
    g = runs.where(lead.between(3600, 86400)).groupBy("location_id", "variable", "valid_time", "model").agg(F.max_by(F.struct("init_time", "value"), "init_time").alias("x"))
    return g.select("location_id", "variable", ts("valid_time").alias("valid_time"), "model", ts("x.init_time").alias("init_time"), F.col("x.value").alias("value"))


def _limits(t: dict[str, float]) -> str:
    return "CASE variable " + " ".join(f"WHEN '{k}' THEN {v}" for k, v in t.items()) + " END"


_CHANGE = f"""{_RUNS}, st AS (SELECT *, lag(init_time) OVER (PARTITION BY model, location_id ORDER BY init_time) AS prev_init FROM (SELECT DISTINCT model, location_id, init_time FROM runs)),
 g AS (SELECT n.model, n.location_id, n.variable, n.init_time, s.prev_init, count(*) AS hours, avg(abs(n.value - o.value)) AS metric, avg(n.value - o.value) AS mean_change, max(abs(n.value - o.value)) AS max_change
  FROM runs n JOIN st s ON n.model = s.model AND n.location_id = s.location_id AND n.init_time = s.init_time JOIN runs o ON o.model = n.model AND o.location_id = n.location_id AND o.variable = n.variable AND o.init_time = s.prev_init AND o.valid_time = n.valid_time
  WHERE epoch(n.valid_time) - epoch(n.init_time) > 0 AND epoch(n.valid_time) - epoch(n.init_time) <= 172800 GROUP BY ALL HAVING count(*) >= 24),
 found AS (SELECT *, {_limits(S.run_change)} AS threshold FROM g WHERE metric >= {_limits(S.run_change)})"""


@query(f"WITH {_CHANGE} SELECT model, location_id, variable, {qt('init_time')} AS init_time, {qt('prev_init')} AS prev_init, hours, {q6('metric')} AS metric, {q6('mean_change')} AS mean_change, {q6('max_change')} AS max_change, CASE WHEN metric >= 2 * threshold THEN 'critical' ELSE 'warning' END AS severity FROM found")
def run_change_findings(spark, d):
    r = alerts.run_change(alerts.live_runs(table(spark, d, "forecast")), S)
    return r.select("model", "location_id", "variable", ts("init_time").alias("init_time"), ts("prev_init").alias("prev_init"), "hours", r6("metric").alias("metric"), r6("mean_change").alias("mean_change"), r6("max_change").alias("max_change"), "severity")


@query(f"WITH {_CHANGE} SELECT sha256('run_change|' || model || '|' || location_id || '|' || strftime(init_time AT TIME ZONE 'UTC', '%Y-%m-%dT%H:%M:%S+00:00') || '|' || variable) AS alert_id, CASE WHEN metric >= 2 * threshold THEN 'critical' ELSE 'warning' END AS severity FROM found")
def alert_ids(spark, d):
    return alerts.as_alerts(alerts.run_change(alerts.live_runs(table(spark, d, "forecast")), S), "run_change").select("alert_id", "severity")


@query(f"WITH {_CHANGE} SELECT 'run_change' AS rule, CASE WHEN metric >= 2 * threshold THEN 'critical' ELSE 'warning' END AS severity, count(*) AS alerts FROM found GROUP BY ALL")
def alert_counts(spark, d):
    return alerts.run_change(alerts.live_runs(table(spark, d, "forecast")), S).groupBy("rule", "severity").agg(F.count(F.lit(1)).alias("alerts"))


@query(f"""WITH {_RUNS}, w AS (SELECT *, make_timestamp(CAST(epoch(init_time) // 21600 * 21600000000 AS BIGINT)) AS cycle FROM runs WHERE {_LEAD} > 0 AND {_LEAD} <= 172800),
 newest AS (SELECT location_id, variable, cycle, model, valid_time, arg_max(value, init_time) AS value FROM w GROUP BY ALL),
 hour AS (SELECT location_id, variable, cycle, valid_time, max(value) - min(value) AS span, count(*) AS models FROM newest GROUP BY ALL HAVING count(*) >= 2),
 g AS (SELECT location_id, variable, cycle, count(*) AS hours, avg(span) AS metric, max(span) AS max_spread, max(models) AS models FROM hour GROUP BY ALL HAVING count(*) >= 24)
 SELECT location_id, variable, strftime(cycle, '%Y-%m-%d %H:%M:%S') AS cycle, hours, models, {q6('metric')} AS metric, {q6('max_spread')} AS max_spread, CASE WHEN metric >= 2 * {_limits(S.model_spread)} THEN 'critical' ELSE 'warning' END AS severity
 FROM g JOIN dim_location l USING (location_id) WHERE metric >= {_limits(S.model_spread)} AND NOT (variable = 'pressure_msl' AND l.elevation_m > 300)""")
def model_spread_findings(spark, d):
    loc = table(spark, d, "dim_location")
    r = alerts.model_spread(alerts.live_runs(table(spark, d, "forecast")), S, alerts.high_places(loc, S)).join(loc.select("location_id"), "location_id", "left_semi")
    return r.select("location_id", "variable", ts("cycle").alias("cycle"), "hours", "models", r6("metric").alias("metric"), r6("max_spread").alias("max_spread"), "severity")


_HALF = "make_timestamp(CASE WHEN epoch_us({0}) % 3600000000 > 1800000000 OR (epoch_us({0}) % 3600000000 = 1800000000 AND (epoch_us({0}) // 3600000000) % 2 = 1) THEN (epoch_us({0}) // 3600000000 + 1) ELSE epoch_us({0}) // 3600000000 END * 3600000000)"


@query(f"""WITH {_RUNS}, o AS (SELECT DISTINCT l.location_id, station, variable, observed_at, value, {_HALF.format('observed_at')} AS h FROM observation JOIN dim_location l USING (station) WHERE {_V} AND ingestion_mode = 'live'),
 latest AS (SELECT location_id, variable, valid_time, model, arg_max(value, init_time) AS f FROM runs WHERE {_LEAD} BETWEEN 3600 AND 86400 GROUP BY ALL),
 mean AS (SELECT location_id, variable, valid_time AT TIME ZONE 'UTC' AS h, avg(f) AS expected, count(*) AS models FROM latest GROUP BY ALL),
 g AS (SELECT o.*, expected, models, abs(value - expected) AS metric FROM o JOIN mean USING (location_id, variable, h))
 SELECT location_id, station, variable, {qt('observed_at')} AS observed_at, value, models, {q6('expected')} AS expected, {q6('metric')} AS metric, CASE WHEN metric >= 2 * {_limits(S.observation_miss)} THEN 'critical' ELSE 'warning' END AS severity
 FROM g JOIN dim_location l USING (location_id) WHERE metric >= {_limits(S.observation_miss)} AND NOT (variable = 'pressure_msl' AND l.elevation_m > 300)""".replace("SELECT location_id, station, variable, strftime", "SELECT g.location_id, g.station, variable, strftime"))
def observation_miss_findings(spark, d):
    loc = table(spark, d, "dim_location")
    r = alerts.observation_miss(table(spark, d, "observation"), alerts.live_runs(table(spark, d, "forecast")), loc, S, alerts.high_places(loc, S))
    return r.select("location_id", "station", "variable", ts("observed_at").alias("observed_at"), "value", "models", r6("expected").alias("expected"), r6("metric").alias("metric"), "severity")


# ---- incremental build -----------------------------------------------------------------------------------------------------
@query(f"""WITH lim AS (SELECT CAST((max(observed_at) + INTERVAL 30 MINUTE) AT TIME ZONE 'UTC' AS DATE) AS hi FROM observation),
 f AS (SELECT CAST(valid_time AT TIME ZONE 'UTC' AS DATE) AS d FROM forecast WHERE updated_at >= TIMESTAMPTZ '{SINCE}+00'),
 o AS (SELECT CAST(observed_at AT TIME ZONE 'UTC' AS DATE) + CAST(k AS INTEGER) AS d FROM observation, (SELECT unnest([-1, 0, 1]) AS k) WHERE updated_at >= TIMESTAMPTZ '{SINCE}+00')
 SELECT DISTINCT strftime(d, '%Y-%m-%d') AS valid_date FROM (SELECT d FROM f UNION ALL SELECT d FROM o), lim WHERE d <= hi""")
def dirty_days(spark, d):
    return gold.dirty_days(table(spark, d, "forecast"), table(spark, d, "observation"), SINCE).select(F.date_format("valid_date", "yyyy-MM-dd").alias("valid_date"))


# ---- quality ---------------------------------------------------------------------------------------------------------------
def _range(c: str, which: str) -> str:
    return "CASE " + " ".join(f"WHEN variable = '{v.name}' THEN {c} IS NULL OR isnan({c}) OR {c} BETWEEN {getattr(v, which)[0]} AND {getattr(v, which)[1]}" for v in S.variables) + " ELSE TRUE END"


def _known() -> str:
    return "coalesce(variable IN (" + ", ".join(f"'{v.name}'" for v in S.variables) + "), FALSE)"


_FIN = "({0} IS NULL OR isnan({0}) OR abs({0}) <> 'infinity'::DOUBLE)"
_STRICT = "({0} IS NOT NULL AND NOT isnan({0}) AND abs({0}) <> 'infinity'::DOUBLE)"
_FC = [*[(f"not_null:{c}", "blocking", f"{c} IS NOT NULL") for c in (*schemas.FORECAST_KEY, "lead_hours")], ("finite:value", "blocking", _FIN.format("value")), ("known_variable", "blocking", _known()),
       ("hard_range:value", "blocking", _range("value", "hard")), ("plausible_range:value", "warning", _range("value", "plausible")), ("lead_not_negative", "warning", "lead_hours >= 0")]
_OC = [*[(f"not_null:{c}", "blocking", f"{c} IS NOT NULL") for c in (*schemas.OBSERVATION_KEY, "is_corrected")], ("finite:value", "blocking", _FIN.format("value")), ("known_variable", "blocking", _known()),
       ("hard_range:value", "blocking", _range("value", "hard")), ("plausible_range:value", "warning", _range("value", "plausible"))]
_AC = [*[(f"not_null:{c}", "blocking", f"{c} IS NOT NULL") for c in (*schemas.ACCURACY_KEY, "n")], *[(f"finite:{c}", "blocking", _STRICT.format(c)) for c in ("bias", "mae", "rmse")], ("n_from_1", "blocking", "n >= 1"), ("lead_day_from_1", "blocking", "lead_day >= 1"),
       ("mae_not_negative", "blocking", "(mae >= 0 OR isnan(mae))"), ("rmse_not_negative", "blocking", "(rmse >= 0 OR isnan(rmse))"), ("rmse_from_mae", "blocking", "rmse + 1e-6 * greatest(1.0, mae) >= mae"), ("mae_from_bias", "blocking", "mae + 1e-6 * greatest(1.0, abs(bias)) >= abs(bias)")]
_XC = [*[(f"not_null:{c}", "blocking", f"{c} IS NOT NULL") for c in (*schemas.FORECAST_KEY, "forecast_value", "observed_value", "error")], *[(f"finite:{c}", "blocking", _STRICT.format(c)) for c in ("forecast_value", "observed_value", "error")], ("known_variable", "blocking", _known()),
       ("offset_in_tolerance", "blocking", "abs(obs_offset_seconds) <= 1800"), ("error_is_difference", "blocking", "abs(error - (forecast_value - observed_value)) <= 1e-6 * greatest(1.0, abs(forecast_value - observed_value))"),
       ("lead_day_of_hours", "blocking", "lead_day = floor((lead_hours + 23) / 24.0)"), ("lead_day_from_1", "blocking", "lead_day >= 1"),
       *[(f"hard_range:{c}", "blocking", _range(c, "hard")) for c in ("forecast_value", "observed_value")], *[(f"plausible_range:{c}", "warning", _range(c, "plausible")) for c in ("forecast_value", "observed_value")]]


def _results(checks: list[tuple[str, str, str]], source: str, name: str) -> str:
    fails = [(n, s, f"CASE WHEN coalesce({g}, TRUE) THEN 0 ELSE 1 END") for n, s, g in checks]
    for sev in ("blocking", "warning"):
        own = [g for _, s, g in checks if s == sev]
        if own:
            fails.append(("all_checks", sev, "CASE WHEN " + " AND ".join(f"coalesce({g}, TRUE)" for g in own) + " THEN 0 ELSE 1 END"))
    parts = [f"SELECT '{name}' AS table_name, '{n}' AS check_name, '{s}' AS severity, count(*) AS rows_checked, CAST(coalesce(sum({f}), 0) AS BIGINT) AS rows_failed, coalesce(sum({f}), 0) = 0 AS passed FROM {source}" for n, s, f in fails]
    return " UNION ALL ".join(parts)


def _shown(r: DataFrame) -> DataFrame:
    return r.drop("detail")


@query(_results(_FC, "forecast", "forecast"))
def quality_forecast(spark, d):
    return _shown(quality.validate(table(spark, d, "forecast"), quality.forecast_contract(S)))


@query(_results(_OC, "observation", "observation"))
def quality_observation(spark, d):
    return _shown(quality.validate(table(spark, d, "observation"), quality.observation_contract(S)))


@query(_results(_AC, "accuracy_daily", "accuracy_daily"))
def quality_accuracy(spark, d):
    return _shown(quality.validate(table(spark, d, "accuracy_daily"), quality.accuracy_contract()))


@query(f"WITH {_VER} " + _results(_XC, "ver", "forecast_verification"))
def quality_verification(spark, d):
    return _shown(quality.validate(verification(spark, d), quality.verification_contract(S)))


_BLOCK = " AND ".join(f"coalesce({g}, TRUE)" for _, s, g in _FC if s == "blocking")


@query(f"WITH b AS (SELECT DISTINCT source_event_id FROM forecast WHERE NOT ({_BLOCK}) AND source_event_id IS NOT NULL) SELECT forecast_id FROM forecast f WHERE ({_BLOCK}) AND NOT EXISTS (SELECT 1 FROM b WHERE b.source_event_id = f.source_event_id)")
def quality_gate_clean_rows(spark, d):
    return quality.gate(table(spark, d, "forecast"), quality.forecast_contract(S))[0].select("forecast_id")


@query(f"SELECT model, location_id, {qt('init_time')} AS init_time, {qt('valid_time')} AS valid_time, variable, count(*) AS copies FROM forecast GROUP BY {FK} HAVING count(*) > 1")
def duplicate_keys(spark, d):
    r = quality.duplicate_keys(table(spark, d, "forecast"), schemas.FORECAST_KEY)
    return r.select("model", "location_id", ts("init_time").alias("init_time"), ts("valid_time").alias("valid_time"), "variable", "copies")


@query(_results(_FC, "forecast", "forecast"))
def merged_quality_results(spark, d):
    f = table(spark, d, "forecast")
    c = quality.forecast_contract(S)
    parts = [quality.validate(f.where(F.col("ingestion_mode") == m), c) for m in ("live", "backfill")]
    return _shown(quality.merge_results(parts[0].unionByName(parts[1]))).select("table_name", "check_name", "severity", "rows_checked", "rows_failed", "passed")


@query(f"""SELECT 'station' AS check_name, l.station AS subject, {qt('max(o.observed_at)')} AS newest, {q6("(epoch(TIMESTAMPTZ '" + NOW + "+00') - floor(epoch(max(o.observed_at)))) / 3600.0")} AS age_hours,
 coalesce((epoch(TIMESTAMPTZ '{NOW}+00') - floor(epoch(max(o.observed_at)))) / 3600.0 <= 3, FALSE) AS passed, CASE WHEN max(o.observed_at) IS NULL THEN 'no data yet' END AS detail
 FROM (SELECT DISTINCT station FROM dim_location WHERE station IS NOT NULL) l LEFT JOIN observation o USING (station) GROUP BY l.station""")
def freshness_by_station(spark, d):
    subjects = table(spark, d, "dim_location").where("station is not null")
    r = quality.freshness(table(spark, d, "observation"), subjects, "station", "observed_at", NOW, S.observation_stale_hours, "station")
    return r.withColumns({"newest": ts("newest"), "age_hours": r6("age_hours")})


# ---- operations ------------------------------------------------------------------------------------------------------------
@query("""SELECT strftime(date_trunc('hour', inserted_at AT TIME ZONE 'UTC'), '%Y-%m-%d %H') AS hour, source, count(*) AS rows FROM
 (SELECT inserted_at, 'forecast' AS source FROM forecast UNION ALL SELECT inserted_at, 'observation' FROM observation) GROUP BY ALL""")
def hourly_throughput(spark, d):
    parts = [table(spark, d, t).select("inserted_at", F.lit(t).alias("source")) for t in ("forecast", "observation")]
    return parts[0].unionByName(parts[1]).groupBy(F.date_format("inserted_at", "yyyy-MM-dd HH").alias("hour"), "source").agg(F.count(F.lit(1)).alias("rows"))


@query(f"""SELECT model, count(*) AS rows, count(*) FILTER (WHERE ingestion_mode = 'live') AS live_rows, CAST(coalesce(sum(lead_hours) FILTER (WHERE ingestion_mode = 'backfill'), 0) AS BIGINT) AS backfill_lead_hours,
 {q6("avg(value) FILTER (WHERE variable = 'temperature_2m' AND value IS NOT NULL AND NOT isnan(value) AND value BETWEEN 150 AND 360)")} AS mean_temperature, count(*) FILTER (WHERE value IS NULL OR isnan(value)) AS missing FROM forecast GROUP BY model""")
def filtered_counts(spark, d):
    f = table(spark, d, "forecast")
    v = number("value")
    return f.groupBy("model").agg(
        F.count(F.lit(1)).alias("rows"), F.count_if(F.col("ingestion_mode") == "live").alias("live_rows"), F.coalesce(F.sum(F.when(F.col("ingestion_mode") == "backfill", F.col("lead_hours"))), F.lit(0)).alias("backfill_lead_hours"),
        r6(F.avg(F.when((F.col("variable") == "temperature_2m") & v.between(150, 360), v))).alias("mean_temperature"), F.count_if(v.isNull()).alias("missing"),
    )


@query(f"SELECT dlq_id, error_type, left(error_message, 40) AS message, {qt('failed_at')} AS failed_at FROM dlq_record ORDER BY dlq_record.failed_at DESC, dlq_id DESC LIMIT 20")
def recent_failures(spark, d):
    q = table(spark, d, "dlq_record").orderBy(F.col("failed_at").desc(), F.col("dlq_id").desc()).limit(20)
    return q.select("dlq_id", "error_type", F.left("error_message", F.lit(40)).alias("message"), ts("failed_at").alias("failed_at"))


_REC = f"""e AS (SELECT DISTINCT {OK} FROM observation WHERE ingestion_mode = 'live'), s AS (SELECT DISTINCT {OK} FROM observation WHERE {_V})"""


@query(f"""WITH {_REC}, j AS (SELECT e.station AS es, s.station AS ss FROM e FULL JOIN s USING ({OK}))
 SELECT count(es) AS expected, count(ss) AS silver, count(*) FILTER (WHERE ss IS NULL) AS missing, count(*) FILTER (WHERE es IS NULL) AS extra, count(*) FILTER (WHERE ss IS NULL OR es IS NULL) = 0 AS matched FROM j""")
def reconcile_keys(spark, d):
    o = table(spark, d, "observation")
    return ops.reconcile(o.where("ingestion_mode = 'live'"), o.where(number("value").isNotNull()), schemas.OBSERVATION_KEY)


@query(f"WITH {_REC} SELECT station, {qt('observed_at')} AS observed_at, variable FROM (SELECT * FROM s EXCEPT SELECT * FROM e)")
def unexplained_rows(spark, d):
    o = table(spark, d, "observation")
    r = ops.unexplained(o.where(number("value").isNotNull()).select(*schemas.OBSERVATION_KEY).distinct(), o.where("ingestion_mode = 'live'"), schemas.OBSERVATION_KEY)
    return r.select("station", ts("observed_at").alias("observed_at"), "variable")


@query(f"""WITH {_VER} SELECT strftime(a.valid_date, '%Y-%m-%d') AS valid_date, location_id, model, variable, CAST(lead_day AS BIGINT) AS lead_day, n FROM accuracy_daily a
 WHERE EXISTS (SELECT 1 FROM ver v WHERE v.ingestion_mode = 'backfill' AND v.valid_date = a.valid_date AND v.location_id = a.location_id AND v.model = a.model AND v.variable = a.variable AND v.lead_day = a.lead_day)""")
def trace_semi_join(spark, d):
    r = ops.trace_accuracy(verification(spark, d).where("ingestion_mode = 'backfill'"), table(spark, d, "accuracy_daily"))
    return r.select(F.date_format("valid_date", "yyyy-MM-dd").alias("valid_date"), "location_id", "model", "variable", F.col("lead_day").cast("bigint").alias("lead_day"), "n")


@query(f"""WITH runs AS (SELECT model, min(inserted_at) AS s, max(inserted_at) AS f FROM forecast WHERE ingestion_mode = 'backfill' GROUP BY model, CAST(inserted_at AT TIME ZONE 'UTC' AS DATE)),
 p AS (SELECT model, source_event_id, min(inserted_at) AS t FROM forecast WHERE source_event_id IS NOT NULL GROUP BY ALL)
 SELECT source_event_id, model, {qt('s')} AS started_at, {qt('f')} AS finished_at FROM (SELECT p.*, r.s, r.f, row_number() OVER (PARTITION BY p.model, p.source_event_id ORDER BY r.s DESC NULLS LAST) AS rn FROM p LEFT JOIN runs r ON r.model = p.model AND r.s <= p.t AND r.f >= p.t) WHERE rn = 1""")
def interval_containment(spark, d):
    f = table(spark, d, "forecast")
    runs = f.where("ingestion_mode = 'backfill'").groupBy("model", F.to_date("inserted_at").alias("day")).agg(F.min("inserted_at").alias("started_at"), F.max("inserted_at").alias("finished_at"))
    points = f.where("source_event_id is not null").groupBy("model", "source_event_id").agg(F.min("inserted_at").alias("t"))
    r = ops.containing_run(points, runs, "source_event_id", "t", ["model"])
    return r.select("source_event_id", "model", ts("started_at").alias("started_at"), ts("finished_at").alias("finished_at"))


@query("SELECT source_topic, CAST(sum(high - low + 1) AS BIGINT) AS offsets, CAST(sum(n) AS BIGINT) AS rows FROM (SELECT source_topic, source_partition, min(source_offset) AS low, max(source_offset) AS high, count(*) AS n FROM dlq_record GROUP BY ALL) GROUP BY ALL")
def dead_letter_volume(spark, d):
    g = table(spark, d, "dlq_record").groupBy("source_topic", "source_partition").agg(F.min("source_offset").alias("low"), F.max("source_offset").alias("high"), F.count(F.lit(1)).alias("n"))
    return g.groupBy("source_topic").agg(F.sum(F.col("high") - F.col("low") + 1).alias("offsets"), F.sum("n").alias("rows"))


@query(f"SELECT source_topic AS topic, source_partition AS kafka_partition, coalesce(min(source_offset) FILTER (WHERE failed_at >= TIMESTAMPTZ '{AS_OF}+00'), max(source_offset) + 1) AS target FROM dlq_record GROUP BY ALL")
def offset_targets(spark, d):
    q = table(spark, d, "dlq_record").select(F.col("source_topic").alias("topic"), F.col("source_partition").alias("kafka_partition"), F.col("source_offset").alias("kafka_offset"), F.unix_millis("failed_at").alias("kafka_timestamp_ms"))
    return bronze.offset_targets(q, int(datetime.fromisoformat(AS_OF).replace(tzinfo=timezone.utc).timestamp() * 1000))


# ---- parsing ---------------------------------------------------------------------------------------------------------------
@query("""WITH j AS (SELECT dlq_id, CASE WHEN json_valid(original_payload) THEN original_payload::JSON END AS p FROM dlq_record)
 SELECT dlq_id, p->>'$.event_id' AS event_id, p->>'$.event_type' AS event_type, p->>'$.payload.station' AS station, p->>'$.payload.model' AS model FROM j WHERE p IS NOT NULL""")
def json_payloads(spark, d):
    q = table(spark, d, "dlq_record")
    t = F.from_json("original_payload", "event_id string, event_type string, payload struct<station: string, model: string>, _corrupt string", {"columnNameOfCorruptRecord": "_corrupt"})
    return q.withColumn("p", t).where(F.col("p._corrupt").isNull() & F.col("original_payload").isNotNull() & (F.trim("original_payload") != "")).select("dlq_id", "p.event_id", "p.event_type", "p.payload.station", "p.payload.model")


_NUM = "CASE WHEN isnan(try_cast(trim({0}) AS DOUBLE)) THEN NULL ELSE try_cast(trim({0}) AS DOUBLE) END"


@query(f"""WITH r AS (SELECT 'Q' || station AS station, try_strptime(valid, '%Y-%m-%d %H:%M') AS t, {_NUM.format('tmpc')} AS a, {_NUM.format('dwpc')} AS b, {_NUM.format('sknt')} AS c, {_NUM.format('mslp')} AS p, {_NUM.format('alti')} * 33.8639 AS q, trim(metar) AS m, record_id FROM iem_asos_sample WHERE trim(metar) <> ''),
 j AS (SELECT r.*, coalesce(p, CASE WHEN l.elevation_m <= 300 THEN q END) AS pr FROM r LEFT JOIN dim_location l USING (station) WHERE t IS NOT NULL),
 u AS (SELECT record_id, station, t, m, 'temperature_2m' AS variable, a + 273.15 AS value FROM j UNION ALL SELECT record_id, station, t, m, 'dew_point_2m', b + 273.15 FROM j UNION ALL SELECT record_id, station, t, m, 'wind_speed_10m', c * 0.514444 FROM j UNION ALL SELECT record_id, station, t, m, 'pressure_msl', pr * 100.0 FROM j)
 SELECT record_id, station, strftime(t, '%Y-%m-%d %H:%M:%S') AS observed_at, variable, round(value, 4) AS value, regexp_matches(m, '\\bCOR\\b') AS is_corrected FROM u""")
def metar_archive_rows(spark, d):
    raw = table(spark, d, "iem_asos_sample").withColumn("station", F.concat(F.lit("Q"), "station"))
    reports = parse.archive_reports(raw).withColumn("record_id", F.get_json_object("_source", "$.record_id").cast("bigint")).drop("_source")
    rows = parse.metar_rows(reports, table(spark, d, "dim_location"), S.max_elevation_m)
    return rows.select("record_id", "station", ts("observed_at").alias("observed_at"), "variable", F.round("value", 4).alias("value"), "is_corrected")


@query("SELECT coalesce(regexp_matches(raw_text, '\\bCOR\\b'), FALSE) AS cor, coalesce(is_corrected, FALSE) AS flag, count(*) AS rows FROM observation GROUP BY ALL")
def correction_flags(spark, d):
    return table(spark, d, "observation").groupBy(parse.is_corrected("raw_text").alias("cor"), F.coalesce("is_corrected", F.lit(False)).alias("flag")).agg(F.count(F.lit(1)).alias("rows"))


@query("SELECT observation_id, sha256(station || '|' || strftime(observed_at AT TIME ZONE 'UTC', '%Y-%m-%dT%H:%M:%S+00:00') || '|' || coalesce(raw_text, '')) AS event_id FROM observation WHERE station IS NOT NULL AND observed_at IS NOT NULL")
def observation_event_ids(spark, d):
    o = table(spark, d, "observation").where("station is not null and observed_at is not null")
    return o.select("observation_id", event_key("station", iso_text("observed_at"), "raw_text").alias("event_id"))


@query(f"SELECT strftime({_HALF.format('observed_at')}, '%Y-%m-%d %H') AS hour, count(*) AS rows FROM observation WHERE observed_at IS NOT NULL GROUP BY 1")
def half_even_hours(spark, d):
    return table(spark, d, "observation").where("observed_at is not null").groupBy(F.date_format(half_even_hour("observed_at"), "yyyy-MM-dd HH").alias("hour")).agg(F.count(F.lit(1)).alias("rows"))


@query("SELECT variable, round(min(x), 3) AS least, round(max(x), 3) AS most, count(*) AS rows FROM (SELECT variable, CASE variable WHEN 'pressure_msl' THEN value * 0.01 WHEN 'wind_speed_10m' THEN value ELSE value - 273.15 END AS x FROM observation WHERE value IS NOT NULL AND NOT isnan(value)) GROUP BY variable")
def display_units(spark, d):
    o = table(spark, d, "observation").where(number("value").isNotNull()).withColumn("x", parse.display("value", "variable"))
    return o.groupBy("variable").agg(F.round(F.min("x"), 3).alias("least"), F.round(F.max("x"), 3).alias("most"), F.count(F.lit(1)).alias("rows"))


@query("SELECT strftime(s, '%Y-%m-%d') AS chunk_start, strftime(least(CAST(s AS DATE) + 13, DATE '2025-02-28'), '%Y-%m-%d') AS chunk_end FROM (SELECT unnest(generate_series(DATE '2024-12-01', DATE '2025-02-28', INTERVAL 14 DAY)) AS s)")
def date_chunks(spark, d):
    return parse.date_chunks(spark, "2024-12-01", "2025-02-28", 14).select(*[F.date_format(c, "yyyy-MM-dd").alias(c) for c in ("chunk_start", "chunk_end")])


@query("SELECT location_id, CAST((row_number() OVER (ORDER BY location_id) - 1) // 10 AS BIGINT) AS batch FROM dim_location")
def location_batches(spark, d):
    n = F.row_number().over(Window.orderBy("location_id")) - 1  # 66 rows, a fixed dimension
    return table(spark, d, "dim_location").select("location_id", F.floor(n / 10).cast("bigint").alias("batch"))


# ---- facts -----------------------------------------------------------------------------------------------------------------
_FACT = f"""latest AS (SELECT location_id, model, variable, valid_time, value FROM (SELECT *, row_number() OVER (PARTITION BY location_id, model, variable, valid_time ORDER BY init_time DESC, inserted_at DESC, forecast_id DESC) AS rn FROM forecast
 WHERE {_V} AND init_time <= TIMESTAMPTZ '{AS_OF}+00' AND valid_time > TIMESTAMPTZ '{AS_OF}+00' AND valid_time <= TIMESTAMPTZ '{AS_OF}+00' + INTERVAL 48 HOUR) WHERE rn = 1)"""
_SHOW = "CASE variable WHEN 'pressure_msl' THEN {0} * 0.01 WHEN 'wind_speed_10m' THEN {0} ELSE {0} - 273.15 END"


def _latest(spark, d):
    return briefing.latest_forecasts(table(spark, d, "forecast"), AS_OF, S.horizon_hours)


@query(f"WITH {_FACT} SELECT location_id, model, variable, {qt('valid_time')} AS valid_time, value FROM latest")
def fact_sheet_inputs(spark, d):
    return _latest(spark, d).withColumn("valid_time", ts("valid_time"))


@query(f"WITH {_FACT} SELECT location_id, model, variable, {q6('min(' + _SHOW.format('value') + ')')} AS least, {q6('avg(' + _SHOW.format('value') + ')')} AS mean, {q6('max(' + _SHOW.format('value') + ')')} AS most, count(*) AS hours FROM latest GROUP BY ALL")
def model_summaries(spark, d):
    return briefing.model_summaries(_latest(spark, d)).select("location_id", "model", "variable", r6("min").alias("least"), r6("mean").alias("mean"), r6("max").alias("most"), "hours")


@query(f"""WITH {_FACT}, h AS (SELECT location_id, variable, valid_time, max(value) - min(value) AS s, count(DISTINCT model) AS models FROM latest GROUP BY ALL HAVING count(DISTINCT model) >= 2), k AS (SELECT *, CASE variable WHEN 'pressure_msl' THEN s * 0.01 ELSE s END AS x FROM h)
 SELECT location_id, variable, {q6('avg(x)')} AS mean_spread, {q6('max(x)')} AS max_spread, max(models) AS models FROM k GROUP BY ALL""")
def spread_summary(spark, d):
    return briefing.spread(_latest(spark, d)).select("location_id", "variable", r6("mean_spread").alias("mean_spread"), r6("max_spread").alias("max_spread"), "models")


@query()
def fact_sheets(spark, d):
    found = alerts.as_alerts(alerts.run_change(alerts.live_runs(table(spark, d, "forecast")), S), "run_change")
    return briefing.fact_sheets(_latest(spark, d), accuracy.over_days(latest_accuracy(spark, d), AS_OF, 30, "temperature_2m", 1), found, AS_OF, S)


@query()
def numbers_in_documents(spark, d):
    return briefing.document_numbers(table(spark, d, "documents"))


# ---- streams ---------------------------------------------------------------------------------------------------------------
#: Files into which the log is cut for the stream: each is a micro-batch.
STREAM_FILES = 3


def _streamed(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """The observation log as a stream of several micro-batches in order of arrival, drained: the hourly figures and the late rows."""
    from skyloom.sources.files import Files
    from skyloom.sources.versioned import VersionedTable
    from skyloom.streaming import late_stream

    t, root = table(spark, d, "observation"), f"{shared_dir(spark)}/late-{uuid.uuid4().hex[:10]}"
    # the file source reads the oldest file first, so the parts are written one after the other
    us = F.unix_micros("inserted_at")
    cuts = t.select(us.alias("us")).approxQuantile("us", [i / STREAM_FILES for i in range(1, STREAM_FILES)], 0.01)
    bounds = [None, *map(int, cuts), None]
    for lo, hi in zip(bounds, bounds[1:]):
        side = F.lit(True) if lo is None else us >= lo
        side = side if hi is None else side & (us < hi) if lo is not None else us < hi
        t.where(side).coalesce(1).write.mode("append").parquet(f"{root}/log")
    source = spark.readStream.schema(t.schema).option("maxFilesPerTrigger", 1).parquet(f"{root}/log")
    accepted = VersionedTable(spark, f"{root}/accepted", F.to_date(F.date_trunc("month", "observed_at")))
    dropped = VersionedTable(spark, f"{root}/dropped", F.to_date(F.date_trunc("month", "observed_at")))
    hours = VersionedTable(spark, f"{root}/hours", F.to_date(F.date_trunc("month", "hour")), late_stream.HOURS)
    late_stream.start(source, accepted, dropped, f"{root}/checkpoint", hours=hours).awaitTermination()
    late = dropped.read()
    out = hours.read().checkpoint(), (spark.createDataFrame([], "observation_id bigint") if late is None else late.select("observation_id")).checkpoint()
    Files(spark).delete(root)
    return out


@query(f"SELECT * EXCLUDE n_revisions FROM ({_HOURLY})")
def stream_late_events(spark, d):
    """The figures that the stream of late events upserts hour by hour; they equal those of the batch form."""
    h = _streamed(spark, d)[0]
    return h.select("station", "variable", F.date_format("hour", "yyyy-MM-dd HH").alias("hour"), "n_reports", "n_values", "min_value", "max_value", F.round("mean_value", 6).alias("mean_value"))


@query(_QUALITY_SQL["p2_found"])
def stream_too_late(spark, d):
    """The rows that the stream of late events sets aside."""
    return _streamed(spark, d)[1]
