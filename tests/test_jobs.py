from datetime import datetime

import pytest
from helpers import ACC, FC, LOC, OBS, acc_row, fc, obs, rows
from test_engine import LIVE, metar, places
from test_streams import send

from skyloom import jobs
from pyspark.sql import functions as F

from skyloom.operators import audit
from skyloom.sources import parse, staged

AT = datetime(2025, 3, 1)


@pytest.fixture()
def data(spark, tmp_path):
    rows(spark, FC, [fc(i, 0, i + 1, 280.0) for i in range(30)]).write.parquet(f"{tmp_path}/data/forecast.parquet")
    rows(spark, OBS, [obs(i, i, 279.0) for i in range(40)]).write.parquet(f"{tmp_path}/data/observation.parquet")
    rows(spark, ACC, [acc_row(1), acc_row(0)]).write.parquet(f"{tmp_path}/data/accuracy_daily.parquet")
    rows(spark, LOC, [r.asDict() for r in places(spark).collect()]).write.parquet(f"{tmp_path}/data/dim_location.parquet")
    return ["--data", f"{tmp_path}/data", "--out", f"{tmp_path}/out", "--lake", f"{tmp_path}/lake"]


def test_jobs(spark, tmp_path, data, capsys):
    run = lambda *a: jobs.main([a[0], *data, *a[1:]], spark)
    assert run("build_gold") == 0 and "30" in capsys.readouterr().out
    assert run("run_quality", "--all") == 1  # a row that counts nothing
    assert "FAIL blocking accuracy_daily.n_from_1: 1 of 2" in capsys.readouterr().out
    f, o = "weather.forecast.raw.v1", "weather.observation.raw.v1"
    send(spark, f"{tmp_path}/lake", [LIVE, "{broken"], 0, f)
    send(spark, f"{tmp_path}/lake", [metar()], 0, o)
    assert run("reconcile") == 1
    assert run("replay", "--topic", f) == 0 and run("replay", "--topic", o) == 0
    assert run("reconcile") == 0 and run("reconcile", "--topic", o) == 0
    assert run("trace", "--event-id", "e1") == 0 and "6 rows written" in capsys.readouterr().out
    assert run("trace", "--event-id", "nothing") == 1 and run("retention", "--dry-run") == 0
    a = audit.Audit(spark, f"{tmp_path}/out")
    assert a.read("reconciliation_results").count() == 5
    s = {r["table_name"]: r["blocking_failed"] for r in audit.quality_summary(a.read("quality_results")).collect()}
    assert s == {"forecast": 0, "observation": 0, "accuracy_daily": 1}
    assert audit.quality_failures(a.read("quality_results")).count() == 2


def test_audit(spark, tmp_path):
    a = audit.Audit(spark, str(tmp_path / "a"))
    assert a.read("ingestion_runs").count() == 0 and audit.produced(a.read("ingestion_runs"), ["x"]).first()[0] == 0
    a.ingestion_run("s", "live", AT, AT, 5, 0)
    a.ingestion_run("s", "live", datetime(2025, 3, 2), AT, 7, 1, "late")
    assert [r["status"] for r in audit.recent_runs(a.read("ingestion_runs")).collect()] == ["failed", "succeeded"]
    assert audit.produced(a.read("ingestion_runs"), ["s"]).first()[0] == 12
    assert audit.latest_per(a.read("ingestion_runs"), "source", "started_at").first()["produced"] == 7
    calls = spark.createDataFrame([("ok", 2, 50, 50, 10.0), ("ok", 1, 0, 0, 40.0), ("bad", 0, 0, 0, 0.0)], "outcome string, calls int, input_tokens int, cached_tokens int, latency_ms double")
    assert {r["outcome"]: (r["calls"], r["cache_hit_rate"], r["latency_ms"]) for r in audit.call_usage(calls).collect()} == {"ok": (3, 0.5, 20.0), "bad": (0, 0.0, None)}


def test_poll_cycles_over_staged_files(spark, tmp_path):
    hour = '{"hourly": {"time": ["2025-02-28T18:00"], "temperature_2m": [1.5]}}'
    rows_ = [("m1", "p1", "2025-02-28T18:00"), ("m1", "p1", "2025-02-28T18:00"), ("m1", "p2", "2025-02-28T18:00"), ("m1", "p1", "2025-02-28T12:00"), ("m2", "p1", "2025-02-01T00:00"), ("other", "p1", "2025-02-28T18:00")]
    (tmp_path / "staged.json").write_text("[" + ",".join(f'{{"model": "{m}", "location_id": "{p}", "run": "{r}", "api_response": {hour}}}' for m, p, r in rows_) + "]")
    schema = "model string, location_id string, run string, api_response struct<hourly: struct<time: array<string>, temperature_2m: array<double>>>"
    c = staged.forecast_cycle(staged.read_json(spark, f"{tmp_path}/staged.json", schema), ["m1", "m2"], AT)
    a = audit.Audit(spark, str(tmp_path / "a"))
    assert c.send(a, AT, AT, lake=f"{tmp_path}/lake") == (2, 1)  # two places of the latest run; m2 has none in reach
    run = a.read("ingestion_runs").first()
    assert (run["source"], run["produced"], run["failed"], run["status"]) == ("forecast_producer", 2, 1, "failed")
    good, bad = parse.split_forecasts(c.messages.select(F.col("value").cast("binary").alias("value")))
    assert sorted((r["location_id"], r["value"], r["lead_hours"]) for r in good.collect()) == [("p1", 274.65, 0), ("p2", 274.65, 0)] and bad.count() == 0
    reports = spark.createDataFrame([("AAAA", AT, "1", "r"), (None, AT, "1", "r"), ("AAAA", None, "1", "r")], "station string, observed_at timestamp, temp string, rawOb string")
    for x in ("dewp", "wspd", "slp", "altim"):
        reports = reports.withColumn(x, F.lit(None).cast("string"))
    o = staged.observation_cycle(reports, places(spark), AT)
    assert o.messages.count() == 1 and [r[0] for r in o.missing.collect()] == ["BBBB"]


def test_load_accounting():
    def work(u):
        if u in (2, 4):
            raise ValueError("429" if u == 4 else "broken")
        return 10

    r = audit.Load().run([1, 2, 3, 4, 5], work, lambda e: "429" in str(e))
    assert (r.produced, r.failed, r.resume_from) == (20, 2, 4)
    assert audit.backfill_window("2025-03-10", days=3) == ("2025-03-08", "2025-03-10")
    with pytest.raises(ValueError):
        audit.backfill_window("2025-03-10", start="2025-03-11")
    assert audit.weighted_calls(10, 2, 20, 28) == 80 and audit.weighted_calls(2, 1, 5, 7) == 0.5
