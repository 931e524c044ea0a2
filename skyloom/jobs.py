"""Command-line jobs: ``python -m skyloom.jobs JOB --data DIR --out DIR``. Exit 1 where something failed."""

from __future__ import annotations

import argparse
import sys
from datetime import datetime, timedelta, timezone

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from skyloom import schemas
from skyloom.config import Settings, load_settings
from skyloom.operators import audit, gold, ops, quality, upsert
from skyloom.session import build_session, shared_dir, table
from skyloom.sources import bronze, parse
from skyloom.streaming import pipeline


#: Lines of a listing; what is beyond them is counted.
SHOWN = 12


def _now() -> datetime:
    return datetime.now(timezone.utc).replace(tzinfo=None, microsecond=0)


def build_gold(spark: SparkSession, a: argparse.Namespace, s: Settings) -> int:
    f = upsert.keep_last(table(spark, a.data, "forecast"), schemas.FORECAST_KEY, ["inserted_at", "forecast_id"])
    o = upsert.last_observations(table(spark, a.data, "observation"))
    r = gold.Gold(spark, a.out, s).build(f, o, table(spark, a.data, "dim_location"), _now(), a.full)
    print(f"{r.kind}: {len(r.days)} days, verification {r.verification}, accuracy {r.accuracy}")
    return 0


def run_quality(spark: SparkSession, a: argparse.Namespace, s: Settings) -> int:
    since = None if a.all else str(_now() - timedelta(hours=a.hours))
    r = audit.run_suite({t: table(spark, a.data, t) for t in ("forecast", "observation", "accuracy_daily")}, s, since).checkpoint()
    audit.Audit(spark, a.out).results(r, "suite", _now())
    for x in r.orderBy("passed", "table_name", "check_name").collect():  # one row per check
        print(f"{'ok  ' if x['passed'] else 'FAIL'} {x['severity']:8} {x['table_name']}.{x['check_name']}: {x['rows_failed']} of {x['rows_checked']}")
    return int(not r.where("not passed and severity = 'blocking'").isEmpty())


def _messages(spark: SparkSession, a: argparse.Namespace, topic: str):
    return bronze.read_bronze(spark, a.lake, topic).drop("seq")


def reconcile(spark: SparkSession, a: argparse.Namespace, s: Settings) -> int:
    bad, tables = 0, pipeline.Tables(spark, a.out)
    for topic, t, key in (("weather.forecast.raw.v1", tables.forecast, schemas.FORECAST_KEY), ("weather.observation.raw.v1", tables.observation, schemas.OBSERVATION_KEY)):
        if a.topic not in (None, topic):
            continue
        m = _messages(spark, a, topic)
        good, broken = parse.split_forecasts(m) if "forecast" in topic else parse.split_observations(m, table(spark, a.data, "dim_location"), s.max_elevation_m)
        contract = quality.forecast_contract(s) if "forecast" in topic else quality.observation_contract(s)
        clean, _ = quality.gate(good, contract)
        n = m.agg(F.count(F.lit(1)).alias("bronze"), F.countDistinct(F.get_json_object(F.col("value").cast("string"), "$.event_id")).alias("events")).first()
        r = ops.reconcile(clean, t.read(), key).withColumns({"bronze": F.lit(n["bronze"]), "distinct_events": F.lit(n["events"]), "unparseable": F.lit(broken.count())}).checkpoint()
        audit.Audit(spark, a.out).reconciliation(topic, r)
        x = r.first()
        print(topic, x.asDict())
        bad += not x["matched"]
    return int(bad > 0)


def replay(spark: SparkSession, a: argparse.Namespace, s: Settings) -> int:
    tables = pipeline.Tables(spark, a.out)
    kind = "forecast" if "forecast" in (a.topic or "") else "observation"
    try:
        print(pipeline.replay(tables, _messages(spark, a, a.topic), kind, table(spark, a.data, "dim_location"), s, _now(), a.force))
    except RuntimeError as e:
        print(e)
        return 1
    return 0


def trace(spark: SparkSession, a: argparse.Namespace, s: Settings) -> int:
    lake = bronze.read_bronze(spark, a.lake)
    event = a.event_id or bronze.sample_event_id(lake)
    hits = bronze.find_event(lake, event) if event else None
    if hits is None or hits.isEmpty():
        print("event not found")
        return 1
    tables, g = pipeline.Tables(spark, a.out), gold.Gold(spark, a.out, s)
    t = ops.trace_event(event, tables.forecast.read(), g.verification.read(), g.accuracy.read())
    print(f"event {event}: {hits.count()} messages, {t['keys'].count()} rows written, {t['verification'].count()} verifications, {t['accuracy'].count()} accuracy rows")
    current = t["current"].checkpoint()
    for r in current.orderBy(F.col("rows").desc(), "source_event_id").limit(SHOWN).collect():
        print(f"  {r['rows']} rows now from {r['source_event_id']}")
    if (more := current.count() - SHOWN) > 0:
        print(f"  ... and {more} more")
    points = hits.select(F.get_json_object(F.col("value").cast("string"), "$.source").alias("source"), F.timestamp_millis("kafka_timestamp_ms").alias("t"), F.col("kafka_offset").alias("offset"))
    runs = audit.Audit(spark, a.out).read("ingestion_runs").select("source", "started_at", "finished_at")
    for r in ops.containing_run(points, runs, "offset", "t", ["source"]).where("started_at is not null").orderBy("offset").limit(SHOWN).collect():
        print(f"  message {r['offset']} came in the run of {r['source']} from {r['started_at']} to {r['finished_at']}")
    return 0


def retention(spark: SparkSession, a: argparse.Namespace, s: Settings) -> int:
    t = pipeline.Tables(spark, a.out)
    for name in ("forecast", "observation"):
        print(name, upsert.apply_retention(getattr(t, name), str(_now().date()), s.retention_months, a.dry_run))
    return 0


JOBS = {f.__name__: f for f in (build_gold, run_quality, reconcile, replay, trace, retention)}


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> int:
    p = argparse.ArgumentParser(prog="skyloom.jobs")
    p.add_argument("job", choices=JOBS)
    for name in ("--data", "--out", "--lake", "--topic", "--event-id", "--settings"):
        p.add_argument(name)
    for name in ("--full", "--all", "--force", "--dry-run"):
        p.add_argument(name, action="store_true")
    p.add_argument("--hours", type=int, default=24)
    a = p.parse_args(argv)
    spark = spark or build_session(f"skyloom-{a.job}")
    shared_dir(spark)
    return JOBS[a.job](spark, a, load_settings(a.settings) if a.settings else Settings())


if __name__ == "__main__":
    sys.exit(main())
