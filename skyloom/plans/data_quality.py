"""Queries of the general data-quality operators over the driver's tables, with the same results in plain SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyloom.operators import late_events, once, regular_grid, rolling, spikes, units
from skyloom.session import table

SERIES = ("location_id", "model", "variable", "lead_day")


def _totals(spark: SparkSession, d: str) -> DataFrame:
    return rolling.trailing_totals(table(spark, d, "accuracy_daily"), SERIES, "valid_date", "n", "mae", "computed_at", (7, 30))


def p1_totals(spark: SparkSession, d: str) -> DataFrame:
    t = _totals(spark, d)
    return t.select(
        "location_id", "model", "variable", F.col("lead_day").cast("long").alias("lead_day"), F.date_format("valid_date", "yyyy-MM-dd").alias("valid_date"),
        "n_7", "n_30", F.col("mean_7").alias("mae_7"), F.col("mean_30").alias("mae_30"),
    )


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    t = _totals(spark, d).where("n_7 = 0")
    return t.select("location_id", "model", "variable", F.col("lead_day").cast("long").alias("lead_day"), F.date_format("valid_date", "yyyy-MM-dd").alias("valid_date"))


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    return late_events.with_lateness(table(spark, d, "observation")).where("too_late").select("observation_id")


def p2_hourly(spark: SparkSession, d: str) -> DataFrame:
    h = late_events.hourly_revised(table(spark, d, "observation"))
    return h.select("station", "variable", F.date_format("hour", "yyyy-MM-dd HH").alias("hour"), "n_reports", "n_values", "n_revisions", "min_value", "max_value", F.round("mean_value", 6).alias("mean_value"))


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    g = regular_grid.hourly_grid(table(spark, d, "observation"))
    return g.where("missing").select("station", "variable", F.date_format("slot", "yyyy-MM-dd HH").alias("slot"))


def p4_grid(spark: SparkSession, d: str) -> DataFrame:
    g = regular_grid.hourly_grid(table(spark, d, "observation"))
    return g.select("station", "variable", F.date_format("slot", "yyyy-MM-dd HH").alias("slot"), F.round("value", 3).alias("value"), F.round("support", 4).alias("support"), "n_in_slot", "missing", "insufficient")


def _latest_day(df: DataFrame, arrival: str):
    """The start of the last day of arrivals: what came on it is the incoming batch, all before is history."""
    top = df.agg(F.date_trunc("day", F.max(arrival)).alias("t")).first()["t"]
    return F.lit(top).cast("timestamp")


def _surplus(spark: SparkSession, d: str) -> tuple[DataFrame, list[str], list[str]]:
    tables = {}
    for name, copies in (("forecast", once.forecast_copies("week")), ("observation", once.observation_copies("week")), ("dlq_record", once.dead_letter_copies())):
        df = table(spark, d, name)
        tables[name] = (df, copies, _latest_day(df, copies.arrival))
    return *once.surplus_of_tables(tables), list(tables)


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    return _surplus(spark, d)[0].select("table_name", F.col("id").cast("bigint").alias("row_id"))


def p5_rewritten(spark: SparkSession, d: str) -> DataFrame:
    """The partitions that the last day's messages rewrote, with their surplus rows; all others kept their files."""
    found, rewritten, names = _surplus(spark, d)
    r = spark.createDataFrame([(names[int(x.split("_", 1)[0])], x) for x in rewritten], "table_name string, part string")
    n = found.groupBy("table_name", "part").agg(F.count(F.lit(1)).alias("surplus"))
    return r.join(n, ["table_name", "part"], "left").select("table_name", F.expr("substring(part, 3)").alias("part"), F.coalesce("surplus", F.lit(0)).cast("bigint").alias("surplus"))


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    u = units.decoded(table(spark, d, "iem_asos_sample"), table(spark, d, "open_meteo_forecast_response"))
    return u.where("unit <> usual").select("table_name", "record_id", "field_name")


def p3_values(spark: SparkSession, d: str) -> DataFrame:
    c = units.converted(table(spark, d, "iem_asos_sample"), table(spark, d, "open_meteo_forecast_response"))
    return c.withColumn("si_value", F.round("si_value", 6))


def p7_found(spark: SparkSession, d: str) -> DataFrame:
    v = table(spark, d, "dim_variable")
    o = spikes.implausible_observations(table(spark, d, "observation"), v)
    f = spikes.implausible_forecasts(table(spark, d, "forecast"), v)
    return o.select(F.lit("observation").alias("table_name"), F.col("id").alias("row_id")).unionByName(f.select(F.lit("forecast").alias("table_name"), F.col("id").alias("row_id")))


QUERIES = {f.__name__: f for f in (p1_found, p1_totals, p2_found, p2_hourly, p3_found, p3_values, p4_found, p4_grid, p5_found, p5_rewritten, p7_found)}

_DAILY = """
WITH ranked AS (
  SELECT location_id, model, variable, lead_day, CAST(valid_date AS DATE) AS d, coalesce(n, 0) AS n,
         CASE WHEN isnan(mae) THEN NULL ELSE mae END AS v,
         row_number() OVER (PARTITION BY location_id, model, variable, lead_day, valid_date ORDER BY computed_at DESC NULLS LAST,
                            coalesce(n, 0) DESC, (CASE WHEN isnan(mae) THEN NULL ELSE mae END) DESC NULLS LAST) AS rn
  FROM accuracy_daily WHERE valid_date IS NOT NULL),
daily AS (SELECT * FROM ranked WHERE rn = 1),
days AS (
  SELECT location_id, model, variable, lead_day, CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS d
  FROM (SELECT location_id, model, variable, lead_day, min(d) AS lo, max(d) AS hi FROM daily GROUP BY ALL)),
filled AS (
  SELECT y.location_id, y.model, y.variable, y.lead_day, y.d, coalesce(x.n, 0) AS n,
         CASE WHEN x.v IS NOT NULL THEN x.n ELSE 0 END AS w, CASE WHEN x.v IS NOT NULL THEN x.n * x.v ELSE 0 END AS s
  FROM days y LEFT JOIN daily x ON y.location_id IS NOT DISTINCT FROM x.location_id AND y.model IS NOT DISTINCT FROM x.model
   AND y.variable IS NOT DISTINCT FROM x.variable AND y.lead_day IS NOT DISTINCT FROM x.lead_day AND y.d = x.d),
rolled AS (
  SELECT *, sum(n) OVER a AS n7, sum(w) OVER a AS w7, sum(s) OVER a AS s7, sum(n) OVER b AS n30, sum(w) OVER b AS w30, sum(s) OVER b AS s30
  FROM filled
  WINDOW a AS (PARTITION BY location_id, model, variable, lead_day ORDER BY d ROWS BETWEEN 6 PRECEDING AND CURRENT ROW),
         b AS (PARTITION BY location_id, model, variable, lead_day ORDER BY d ROWS BETWEEN 29 PRECEDING AND CURRENT ROW))
"""

_LATE = """
WITH live AS (SELECT * FROM observation WHERE ingestion_mode = 'live' AND station IS NOT NULL AND observed_at IS NOT NULL AND inserted_at IS NOT NULL),
marked AS (
  SELECT *, max(CASE WHEN observed_at <= inserted_at THEN observed_at END) OVER (PARTITION BY station ORDER BY inserted_at
            RANGE BETWEEN UNBOUNDED PRECEDING AND INTERVAL 1 MICROSECOND PRECEDING) AS mark
  FROM live),
flagged AS (SELECT *, coalesce(observed_at < mark - INTERVAL 3 HOUR, FALSE) AS too_late FROM marked)
"""

_GRID = """
WITH o AS (
  SELECT station, variable, CASE WHEN isnan(value) THEN NULL ELSE value END AS v, epoch_us(observed_at) AS us,
         (epoch_us(observed_at) + 1800000000) // 3600000000 AS own
  FROM observation WHERE station IS NOT NULL AND observed_at IS NOT NULL),
vars AS (SELECT unnest(['temperature_2m', 'dew_point_2m', 'wind_speed_10m', 'pressure_msl']) AS variable),
grid AS (
  SELECT station, variable, unnest(range(lo, hi + 1)) AS h
  FROM (SELECT station, min(own) AS lo, max(own) AS hi FROM o GROUP BY station), vars),
near AS (
  SELECT station, variable, own + k AS h, k, v, (us - (own + k) * 3600000000) / 3600000000.0 AS x
  FROM o, (SELECT unnest([-2, -1, 0, 1, 2]) AS k) WHERE v IS NOT NULL),
weighed AS (SELECT *, pow(1 - pow(abs(x) / 1.5, 3), 3) AS w FROM near WHERE abs(x) < 1.5),
sums AS (
  SELECT station, variable, h, sum(CASE WHEN k = 0 THEN 1 ELSE 0 END) AS n, sum(w) AS w, sum(w * w) AS ww, sum(w * x) AS wx, sum(w * x * x) AS wxx,
         sum(w * v) AS wv, sum(w * x * v) AS wxv
  FROM weighed GROUP BY ALL)
"""

_WIDER = "sqrt(1 + 0.4 * (least(greatest(coalesce({0}, 1), 1), 8) - 1))"  # hours without a reading widen the usual change
_SPIKES = f"""SELECT '{{table}}' AS table_name, id AS row_id FROM (
  WITH RECURSIVE r AS (SELECT {{id}} AS id, hash({{series}}) AS k, epoch_us({{time}}) AS t, value AS v, value < hard_min OR value > hard_max AS bad,
      CASE variable WHEN 'pressure_msl' THEN 30.0 ELSE 0.5 END AS least FROM {{table}} JOIN dim_variable USING (variable) WHERE value IS NOT NULL AND NOT isnan(value)),
  runs AS (SELECT *, sum(new) OVER (PARTITION BY k ORDER BY t, id) AS run FROM (SELECT *, CASE WHEN v = lag(v) OVER (PARTITION BY k ORDER BY t, id) THEN 0 ELSE 1 END AS new FROM r)),
  stuck AS (SELECT k, run, v, count(DISTINCT t) AS times FROM runs GROUP BY ALL),
  one AS (SELECT k, t, v, min(id) AS id, min(least) AS least FROM r WHERE NOT bad GROUP BY ALL),
  n AS (SELECT *, lag(v) OVER w AS p, lead(v) OVER w AS a, lead(v, 2) OVER w AS b, (t - lag(t) OVER w) / 3.6e9 AS hp, (lead(t) OVER w - t) / 3.6e9 AS ha, (lead(t, 2) OVER w - lead(t) OVER w) / 3.6e9 AS hb
    FROM one WINDOW w AS (PARTITION BY k ORDER BY t, id)),
  s AS (SELECT *, greatest(least, median(round(abs(v - p) * 100 / least)) OVER (PARTITION BY k) * least / 100) * 8 AS lim FROM n),
  d AS (SELECT *, least(abs(v - p), abs(v - a)) AS d1, least(abs(v - p), abs(a - b), abs(a - p), abs(v - b)) AS d2, lim * {_WIDER.format("greatest(hp, ha)")} AS lim1, lim * {_WIDER.format("greatest(hp, ha, hb)")} AS lim2 FROM s),
  c AS (SELECT *, CASE WHEN (v - p) * (v - a) > 0 AND d1 >= lim1 AND abs(a - p) <= 0.5 * d1 THEN 1
      WHEN (v - p) * (a - b) > 0 AND (v - p) * (v - b) > 0 AND (v - p) * (a - p) > 0 AND d2 >= lim2 AND abs(b - p) <= 0.5 * d2 THEN 2 ELSE 0 END AS len,
      row_number() OVER (PARTITION BY k ORDER BY t, id) AS n FROM d),
  -- of overlapping candidates the earlier one holds: after a spike the level is where it was, and the next reading belongs to it
  e AS (SELECT *, max(CASE WHEN len > 0 THEN n + len ELSE 0 END) OVER (PARTITION BY k ORDER BY n ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM c),
  g AS (SELECT *, sum(CASE WHEN len > 0 AND n > coalesce(reach, 0) THEN 1 ELSE 0 END) OVER (PARTITION BY k ORDER BY n) AS cluster FROM e),
  q AS (SELECT k, cluster, n, len, row_number() OVER (PARTITION BY k, cluster ORDER BY n) AS j FROM g WHERE len > 0),
  walk AS (SELECT k, cluster, j, n, len, TRUE AS hit, n + len AS upto FROM q WHERE j = 1
    UNION ALL SELECT q.k, q.cluster, q.j, q.n, q.len, q.n > w.upto, CASE WHEN q.n > w.upto THEN q.n + q.len ELSE w.upto END FROM walk w JOIN q ON q.k = w.k AND q.cluster = w.cluster AND q.j = w.j + 1),
  spike AS (SELECT c.k, c.t, c.v FROM c JOIN walk w ON c.k = w.k AND w.hit AND (c.n = w.n OR (w.len = 2 AND c.n = w.n + 1)))
  SELECT id FROM r WHERE bad OR EXISTS (SELECT 1 FROM spike x WHERE x.k = r.k AND x.t = r.t AND x.v = r.v)
  UNION SELECT id FROM runs JOIN stuck USING (k, run, v) WHERE {{stuck}})"""
_WIND = "(?:^| )(?:[0-9]{3}|VRB)([0-9]{2,3})(?:G[0-9]{2,3})?(KT|MPS|KMH)\\b"
_LEADING = "^[ ]*([-+]?(?:[0-9]+[.]?[0-9]*|[.][0-9]+))"
_LISTED = "list_filter(hourly.{0}, lambda x: x IS NOT NULL AND NOT isnan(x))"
_PRESSURE = "CASE WHEN {0} BETWEEN 25 AND 35 THEN 'inHg' WHEN {0} BETWEEN 2500 AND 3500 THEN 'inHg/100' WHEN {0} BETWEEN 850 AND 1100 THEN 'hPa' WHEN {0} BETWEEN 85 AND 110 THEN 'kPa' WHEN {0} BETWEEN 85000 AND 110000 THEN 'Pa' WHEN {0} BETWEEN 640 AND 830 THEN 'mmHg' ELSE '{1}' END"
_NUMBERS = "len(list_filter(hourly.{0}, lambda x: x IS NOT NULL AND NOT isnan(x)))"

SQL = {
    # what the decoded units come to on these data: a unit written in the cell, the report's own number in another unit, the magnitude
    "p3_found": f"""
    WITH w AS (SELECT record_id, sknt, try_cast(sknt AS DOUBLE) AS x, try_cast(regexp_extract(metar, '{_WIND}', 1) AS DOUBLE) AS m, regexp_extract(metar, '{_WIND}', 2) AS u FROM iem_asos_sample)
    SELECT 'iem_asos_sample' AS table_name, record_id, 'sknt' AS field_name FROM w WHERE regexp_matches(sknt, '[0-9] ?(m/s|MPS|km/h|mph)') OR (x = m AND x > 0 AND u IN ('MPS', 'KMH'))
    UNION ALL SELECT 'iem_asos_sample', record_id, 'alti' FROM iem_asos_sample WHERE regexp_matches(alti, '[0-9]') AND NOT try_cast(regexp_extract(alti, '^[0-9.]+') AS DOUBLE) BETWEEN 25 AND 35
    UNION ALL SELECT 'open_meteo_forecast_response', response_id, 'wind_speed_10m' FROM open_meteo_forecast_response
      WHERE {_NUMBERS.format('wind_speed_10m')} > 0 AND lower(hourly_units['wind_speed_10m']) NOT IN ('km/h', 'kmh', 'km h-1')
    UNION ALL SELECT 'open_meteo_forecast_response', response_id, 'pressure_msl' FROM open_meteo_forecast_response
      WHERE {_NUMBERS.format('pressure_msl')} > 0 AND NOT list_avg(list_filter(hourly.pressure_msl, lambda x: x IS NOT NULL AND NOT isnan(x))) BETWEEN 900 AND 1100""",
    "p3_values": f"""
    WITH w AS (SELECT record_id, sknt AS cell, try_cast(regexp_extract(sknt, '{_LEADING}', 1) AS DOUBLE) AS x, try_cast(regexp_extract(metar, '{_WIND}', 1) AS DOUBLE) AS m, regexp_extract(metar, '{_WIND}', 2) AS u FROM iem_asos_sample),
    a AS (SELECT record_id, try_cast(regexp_extract(alti, '{_LEADING}', 1) AS DOUBLE) AS x FROM iem_asos_sample),
    o AS (SELECT response_id, hourly, regexp_replace(lower(hourly_units['wind_speed_10m']), '[ ._()]', '', 'g') AS label, list_avg({_LISTED.format('pressure_msl')}) AS p,
      {_NUMBERS.format('wind_speed_10m')} AS nw, {_NUMBERS.format('pressure_msl')} AS np FROM open_meteo_forecast_response),
    v AS (
      SELECT 'iem_asos_sample' AS table_name, record_id, 'sknt' AS field_name, 0 AS pos, x, CASE WHEN regexp_matches(cell, '[0-9] ?(m/s|MPS)') THEN 'm/s' WHEN regexp_matches(cell, '[0-9] ?km/h') THEN 'km/h' WHEN regexp_matches(cell, '[0-9] ?mph') THEN 'mph'
        WHEN x = m AND x > 0 AND u = 'MPS' THEN 'm/s' WHEN x = m AND x > 0 AND u = 'KMH' THEN 'km/h' ELSE 'kt' END AS unit FROM w WHERE x IS NOT NULL
      UNION ALL SELECT 'iem_asos_sample', record_id, 'alti', 0, x, {_PRESSURE.format('x', 'inHg')} FROM a WHERE x IS NOT NULL
      UNION ALL SELECT 'open_meteo_forecast_response', response_id, 'wind_speed_10m', i - 1, hourly.wind_speed_10m[i], CASE WHEN label IN ('m/s', 'ms-1', 'mps') THEN 'm/s' WHEN label IN ('kt', 'kn', 'kts', 'knots') THEN 'kt' WHEN label IN ('mph', 'mp/h') THEN 'mph' ELSE 'km/h' END
        FROM (SELECT *, unnest(range(1, len(hourly.wind_speed_10m) + 1)) AS i FROM o WHERE nw > 0)
      UNION ALL SELECT 'open_meteo_forecast_response', response_id, 'pressure_msl', i - 1, hourly.pressure_msl[i], {_PRESSURE.format('p', 'hPa')} FROM (SELECT *, unnest(range(1, len(hourly.pressure_msl) + 1)) AS i FROM o WHERE np > 0))
    SELECT table_name, record_id, field_name, CAST(pos AS BIGINT) AS pos, unit, round(x * CASE unit {" ".join(f"WHEN '{k}' THEN {f!r}" for k, f in (units.WIND | units.PRESSURE).items())} END, 6) AS si_value FROM v WHERE x IS NOT NULL AND NOT isnan(x)""",
    "p7_found": " UNION ALL ".join(_SPIKES.format(table=t, id=i, series=k, time=c, stuck=s) for t, i, k, c, s in (
        ("observation", "observation_id", "station, variable", "observed_at", "times >= 6 AND v <> 0"),
        ("forecast", "forecast_id", "lower(trim(source_event_id)), variable, CASE WHEN ingestion_mode = 'backfill' THEN lead_hours END", "valid_time", "FALSE"))),
    "p1_found": _DAILY + "SELECT location_id, model, variable, CAST(lead_day AS BIGINT) AS lead_day, strftime(d, '%Y-%m-%d') AS valid_date FROM rolled WHERE n7 = 0",
    "p1_totals": _DAILY
    + """SELECT location_id, model, variable, CAST(lead_day AS BIGINT) AS lead_day, strftime(d, '%Y-%m-%d') AS valid_date,
      CAST(n7 AS BIGINT) AS n_7, CAST(n30 AS BIGINT) AS n_30, CASE WHEN w7 > 0 THEN round(s7, 6) / w7 END AS mae_7, CASE WHEN w30 > 0 THEN round(s30, 6) / w30 END AS mae_30 FROM rolled""",
    "p2_found": _LATE + "SELECT observation_id FROM flagged WHERE too_late",
    "p2_hourly": _LATE
    + """, ranked AS (
      SELECT station, variable, observed_at, CASE WHEN isnan(value) THEN NULL ELSE value END AS value,
             row_number() OVER (PARTITION BY station, variable, observed_at ORDER BY coalesce(is_corrected, FALSE) DESC, inserted_at DESC, observation_id DESC) AS rn,
             count(*) OVER (PARTITION BY station, variable, observed_at) AS copies
      FROM flagged WHERE NOT too_late)
    SELECT station, variable, strftime(observed_at AT TIME ZONE 'UTC', '%Y-%m-%d %H') AS hour, count(*) AS n_reports, count(value) AS n_values,
           CAST(sum(copies - 1) AS BIGINT) AS n_revisions, min(value) AS min_value, max(value) AS max_value, round(avg(value), 6) AS mean_value
    FROM ranked WHERE rn = 1 GROUP BY ALL""",
    "p4_found": _GRID
    + """SELECT g.station, g.variable, strftime(make_timestamp(g.h * 3600000000), '%Y-%m-%d %H') AS slot
    FROM grid g LEFT JOIN sums s USING (station, variable, h) WHERE coalesce(s.n, 0) = 0""",
    "p4_grid": _GRID
    + """SELECT g.station, g.variable, strftime(make_timestamp(g.h * 3600000000), '%Y-%m-%d %H') AS slot,
      round(CASE WHEN w * wxx - wx * wx > 1e-6 * w * w THEN (wxx * wv - wx * wxv) / (w * wxx - wx * wx) WHEN w > 0 THEN wv / w END, 3) AS value,
      round(CASE WHEN ww > 0 THEN w * w / ww ELSE 0.0 END, 4) AS support, CAST(coalesce(n, 0) AS BIGINT) AS n_in_slot, coalesce(n, 0) = 0 AS missing,
      round(CASE WHEN ww > 0 THEN w * w / ww ELSE 0.0 END, 6) < 1.5 AS insufficient
    FROM grid g LEFT JOIN sums s USING (station, variable, h)""",
    "p5_rewritten": """
    WITH u AS (
      SELECT 'forecast' AS table_name, right(regexp_replace(lower(source_event_id), '[^0-9a-f]', '', 'g'), 64) AS i, strftime(date_trunc('week', init_time AT TIME ZONE 'UTC'), '%Y-%m-%d') AS part,
             inserted_at >= (SELECT date_trunc('day', max(inserted_at)) FROM forecast) AS new,
             row_number() OVER (PARTITION BY i, model, location_id, init_time, valid_time, variable ORDER BY inserted_at NULLS FIRST, forecast_id) AS rn FROM forecast WHERE source_event_id IS NOT NULL
      UNION ALL SELECT 'observation', right(regexp_replace(lower(source_event_id), '[^0-9a-f]', '', 'g'), 64) AS i, strftime(date_trunc('week', observed_at AT TIME ZONE 'UTC'), '%Y-%m-%d'), inserted_at >= (SELECT date_trunc('day', max(inserted_at)) FROM observation),
             row_number() OVER (PARTITION BY i, station, observed_at, variable ORDER BY inserted_at NULLS FIRST, observation_id) FROM observation WHERE source_event_id IS NOT NULL
      UNION ALL SELECT 'dlq_record', source_topic || '|' || source_partition || '|' || source_offset AS i, source_topic || '_' || source_partition || '_' || (source_offset // 500), failed_at >= (SELECT date_trunc('day', max(failed_at)) FROM dlq_record),
             row_number() OVER (PARTITION BY i ORDER BY failed_at NULLS FIRST, dlq_id) FROM dlq_record WHERE source_topic IS NOT NULL),
    n AS (SELECT DISTINCT table_name, i FROM u WHERE new),
    a AS (SELECT table_name, part FROM u WHERE new UNION SELECT u.table_name, u.part FROM u JOIN n USING (table_name, i) WHERE NOT u.new)
    SELECT table_name, part, count(*) FILTER (WHERE rn > 1) AS surplus FROM a JOIN u USING (table_name, part) GROUP BY ALL""",
    "p5_found": """
    WITH f AS (SELECT forecast_id AS id, row_number() OVER (PARTITION BY right(regexp_replace(lower(source_event_id), '[^0-9a-f]', '', 'g'), 64), model, location_id, init_time, valid_time, variable
                 ORDER BY inserted_at NULLS FIRST, forecast_id) AS rn FROM forecast WHERE source_event_id IS NOT NULL),
    o AS (SELECT observation_id AS id, row_number() OVER (PARTITION BY right(regexp_replace(lower(source_event_id), '[^0-9a-f]', '', 'g'), 64), station, observed_at, variable
                 ORDER BY inserted_at NULLS FIRST, observation_id) AS rn FROM observation WHERE source_event_id IS NOT NULL),
    q AS (SELECT dlq_id AS id, row_number() OVER (PARTITION BY source_topic, source_partition, source_offset ORDER BY failed_at NULLS FIRST, dlq_id) AS rn
          FROM dlq_record WHERE source_topic IS NOT NULL)
    SELECT 'forecast' AS table_name, id AS row_id FROM f WHERE rn > 1 UNION ALL SELECT 'observation', id FROM o WHERE rn > 1
    UNION ALL SELECT 'dlq_record', id FROM q WHERE rn > 1""",
}
