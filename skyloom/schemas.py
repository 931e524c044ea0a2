"""Schemas of messages and tables."""

from __future__ import annotations

from pyspark.sql import types as T


_TYPES = {
    "string": T.StringType(), "int": T.IntegerType(), "bigint": T.LongType(), "smallint": T.ShortType(), "double": T.DoubleType(), "boolean": T.BooleanType(),
    "date": T.DateType(), "timestamp": T.TimestampType(), "binary": T.BinaryType(),
}


def flat(ddl: str) -> T.StructType:
    """A schema of plain columns from ``name type, ...``; unlike ``fromDDL`` it needs no running session."""
    return T.StructType([T.StructField(n, _TYPES[t]) for n, t in (c.split() for c in ddl.split(","))])




BRONZE = flat("topic string, dt date, kafka_partition int, kafka_offset bigint, kafka_timestamp_ms bigint, key binary, value binary")
FORECAST_PAYLOAD = "model string, location_id string, run string, start_date string, end_date string, api_response struct<hourly: map<string, array<string>>, hourly_units: map<string, string>>"
OBSERVATION_PAYLOAD = "station string, observed_at string, api_response struct<icaoId: string, obsTime: string, temp: string, dewp: string, wspd: string, slp: string, altim: string, rawOb: string>"
ENVELOPE = "event_id string, schema_version int, source string, event_type string, produced_at string, ingestion_mode string"
FORECAST_MESSAGE = f"{ENVELOPE}, payload struct<{FORECAST_PAYLOAD}>"
OBSERVATION_MESSAGE = f"{ENVELOPE}, payload struct<{OBSERVATION_PAYLOAD}>"
FORECAST = flat("model string, location_id string, init_time timestamp, valid_time timestamp, variable string, value double, lead_hours int, ingestion_mode string, source_event_id string, inserted_at timestamp, updated_at timestamp")
OBSERVATION = flat("station string, observed_at timestamp, variable string, value double, raw_text string, is_corrected boolean, ingestion_mode string, source_event_id string, inserted_at timestamp, updated_at timestamp")
VERIFICATION = flat(
    "model string, location_id string, init_time timestamp, valid_time timestamp, variable string, lead_hours int, lead_day smallint, forecast_value double, observed_value double, observed_at timestamp, obs_offset_seconds bigint, error double, ingestion_mode string, valid_date date, computed_at timestamp"
)
ACCURACY = flat("valid_date date, location_id string, model string, variable string, lead_day smallint, n bigint, bias double, mae double, rmse double, computed_at timestamp")
ALERT = flat(
    "alert_id string, rule string, severity string, location_id string, variable string, model string, station string, event_time timestamp, metric double, threshold double, details string, triggered_by_event_id string, detected_at timestamp, published_at timestamp"
)
DEAD_LETTER = flat("original_payload string, error_type string, error_message string, source_topic string, source_partition int, source_offset bigint, failed_at timestamp")
QUALITY_RESULT = flat("context string, table_name string, check_name string, severity string, subject string, rows_checked bigint, rows_failed bigint, passed boolean, detail string, checked_at timestamp")
INGESTION_RUN = flat("source string, mode string, status string, started_at timestamp, finished_at timestamp, produced bigint, failed bigint, error_message string")
BUILD_LOG = flat("built_at timestamp, run_kind string, valid_date date, eligible_forecasts bigint, matched bigint")
RECONCILIATION = flat("topic string, produced bigint, bronze bigint, distinct_events bigint, unparseable bigint, expected bigint, silver bigint, missing bigint, extra bigint, matched boolean")
FORECAST_KEY = ("model", "location_id", "init_time", "valid_time", "variable")
OBSERVATION_KEY = ("station", "observed_at", "variable")
ACCURACY_KEY = ("valid_date", "location_id", "model", "variable", "lead_day")
