"""Small tables for tests: rows as dicts, times as text in UTC."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import functions as F

T0 = datetime(2025, 2, 1)


def at(hours: float) -> datetime:
    return T0 + timedelta(hours=hours)


OBS = "observation_id bigint, station string, observed_at timestamp, variable string, value double, raw_text string, is_corrected boolean, ingestion_mode string, source_event_id string, inserted_at timestamp, updated_at timestamp"
FC = "forecast_id bigint, model string, location_id string, init_time timestamp, valid_time timestamp, variable string, value double, lead_hours int, ingestion_mode string, source_event_id string, inserted_at timestamp, updated_at timestamp"
ACC = "valid_date date, location_id string, model string, variable string, lead_day smallint, n int, bias double, mae double, rmse double, computed_at timestamp"
VAR = "variable string, unit string, description string, plausible_min double, plausible_max double, hard_min double, hard_max double"
LOC = "location_id string, name string, climate string, latitude double, longitude double, elevation_m double, timezone string, station string"


def rows(spark, schema: str, data: list[dict]):
    names = [c.split()[0] for c in schema.split(", ")]
    return spark.createDataFrame([tuple(d.get(n) for n in names) for d in data], schema)


def obs(i, hours, value, station="AAAA", variable="temperature_2m", seen=None, corrected=False, mode="live", event=None):
    t = at(hours)
    s = at(hours if seen is None else seen)
    return dict(observation_id=i, station=station, observed_at=t, variable=variable, value=value, raw_text="", is_corrected=corrected, ingestion_mode=mode, source_event_id=event, inserted_at=s, updated_at=s)


def fc(i, init, lead, value, model="m1", place="p1", variable="temperature_2m", mode="live", event="e", seen=None):
    return dict(forecast_id=i, model=model, location_id=place, init_time=at(init), valid_time=at(init + lead), variable=variable, value=value, lead_hours=lead, ingestion_mode=mode, source_event_id=event, inserted_at=at(init if seen is None else seen), updated_at=at(init if seen is None else seen))


def dims(spark):
    return rows(spark, VAR, [dict(variable="temperature_2m", hard_min=145.0, hard_max=365.0), dict(variable="wind_speed_10m", hard_min=0.0, hard_max=125.0), dict(variable="pressure_msl", hard_min=48000.0, hard_max=122000.0)])


def with_clashes(df):
    """The table with extra columns under names the operators use inside."""
    for c in ("id", "t", "d", "b", "k", "n_7", "e0", "us", "v", "own", "sk", "part", "k1", "_block", "_ev", "x", "h", "entity", "rank", "ident", "_r", "tokens", "p", "g"):
        if c not in df.columns:
            df = df.withColumn(c, F.lit("clash"))
    return df


def tuples(df, *cols):
    return sorted(tuple(r) for r in df.select(*cols).collect())


def acc_row(n):
    return dict(valid_date=datetime(2025, 1, 1 + n).date(), location_id="p1", model="m", variable="temperature_2m", lead_day=1, n=n, bias=0.0, mae=1.0, rmse=1.0, computed_at=T0)
