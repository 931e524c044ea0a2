"""Parsing, as-of join, accuracy, upserts, gate, incremental build, rules and facts on small tables with known results."""

import random
from datetime import datetime, timedelta
from decimal import Decimal

import pytest
from helpers import ACC, FC, LOC, OBS, at, fc, obs, rows, tuples, with_clashes
from pyspark.sql import functions as F

from skyloom import schemas
from skyloom.config import Settings, load_settings
from skyloom.functions.columns import event_key, half_even_hour, int_floor_div, iso_text, lead_day
from skyloom.operators import accuracy, alerts, asof, briefing, gold, ops, quality, upsert
from skyloom.sources import parse
from skyloom.sources.versioned import VersionedTable

NOW, LATER = datetime(2025, 3, 1), datetime(2025, 3, 2)


def places(spark):
    return rows(spark, LOC, [dict(location_id="p1", name="Low", station="AAAA", elevation_m=4.0), dict(location_id="p2", name="High", station="BBBB", elevation_m=1655.0), dict(location_id="p3", name="None")])


# ---- columns ---------------------------------------------------------------------------------------------------------------
def test_columns(spark):
    df = spark.createDataFrame([(h,) for h in (-1, 0, 1, 24, 25, 168)], "h int")
    assert [r[0] for r in df.select(lead_day("h")).collect()] == [0, 0, 1, 1, 2, 7]
    df = spark.createDataFrame([(-5,), (5,), (-6,)], "a bigint")
    assert [r[0] for r in df.select(int_floor_div(F.col("a"), 3)).collect()] == [-2, 1, -2]
    df = spark.createDataFrame([(datetime(2025, 1, 1, 0, 30),), (datetime(2025, 1, 1, 1, 30),), (datetime(2025, 1, 1, 1, 29, 59),), (datetime(2025, 1, 1, 1, 30, 0, 1),)], "t timestamp")
    assert [r[0].hour for r in df.select(half_even_hour("t")).collect()] == [0, 2, 1, 2]
    assert [r[0] for r in df.select(iso_text("t")).collect()][0] == "2025-01-01T00:30:00+00:00"
    assert [r[0] for r in df.select(iso_text("t")).collect()][3] == "2025-01-01T01:30:00.000001+00:00"
    one = spark.createDataFrame([("a", None, "b"), ("a", "b", None)], "x string, y string, z string").select(event_key("x", "y", "z").alias("k")).distinct()
    assert one.count() == 2


# ---- parsing ---------------------------------------------------------------------------------------------------------------
def messages(spark, texts):
    return spark.createDataFrame([("t", 0, i, 1000 + i, t.encode() if t is not None else None) for i, t in enumerate(texts)], "topic string, kafka_partition int, kafka_offset bigint, kafka_timestamp_ms bigint, value binary")


LIVE = '{"event_id":"e1","event_type":"forecast.raw","ingestion_mode":"live","payload":{"model":"m","location_id":"p1","run":"2025-02-01T00:00:00+00:00","api_response":{"hourly":{"time":["2025-02-01T01:00","2025-02-01T02:00"],"temperature_2m":[1.5,null],"wind_speed_10m":[36],"pressure_msl":[1000,1001,1002],"cloud":[1,2]}}}}'
BACK = '{"event_id":"e2","event_type":"forecast.backfill.raw","payload":{"model":"m","location_id":"p1","start_date":"2025-02-01","end_date":"2025-02-01","api_response":{"hourly":{"time":["2025-02-01T00:00"],"temperature_2m_previous_day1":["0"],"temperature_2m_previous_day3":[2],"other":[1]}}}}'


def test_melt_live_and_backfill(spark):
    good, bad = parse.split_forecasts(messages(spark, [LIVE, BACK]))
    got = {(r["source_event_id"], r["variable"], r["lead_hours"]): r["value"] for r in good.collect()}
    assert got[("e1", "temperature_2m", 1)] == pytest.approx(274.65) and got[("e1", "temperature_2m", 2)] is None
    assert got[("e1", "wind_speed_10m", 1)] == pytest.approx(10.0) and got[("e1", "wind_speed_10m", 2)] is None
    assert got[("e1", "pressure_msl", 2)] == 100100.0 and len([k for k in got if k[0] == "e1"]) == 6
    assert {k[2] for k in got if k[0] == "e2"} == {24, 72}
    r = good.where("source_event_id = 'e2' and lead_hours = 72").first()
    assert str(r["init_time"]) == "2025-01-29 00:00:00" and r["ingestion_mode"] == "backfill"
    assert bad.count() == 0


def test_poison_goes_and_the_rest_loads(spark):
    texts = [
        LIVE, "{broken", None, LIVE.replace("forecast.raw", "other"), LIVE.replace('"hourly"', '"daily"'), LIVE.replace('"run":"2025-02-01T00:00:00+00:00"', '"run":"soon"'),
        LIVE.replace("[36]", '["abc"]'), BACK.replace("_previous_day", "_day"), BACK.replace('["0"]', '["0", 1]'), LIVE.replace('["2025-02-01T01:00","2025-02-01T02:00"]', "[]"),
    ]
    good, bad = parse.split_forecasts(messages(spark, texts))
    assert tuples(bad, "kafka_offset", "error_type") == [(1, "JSONDecodeError"), (2, "JSONDecodeError"), (3, "EventTypeError"), (4, "MissingHourlyError"), (5, "ValidationError"), (6, "NotANumberError"), (7, "NoLeadColumnsError"), (8, "UnequalArraysError")]
    assert tuples(good.select("kafka_offset").distinct(), "kafka_offset") == [(0,)]  # an empty block loads nothing and is no poison


def metar(event="o1", station="AAAA", slp="null", altim="1010", raw="AAAA 010000Z", temp="10"):
    return f'{{"event_id":"{event}","event_type":"observation.raw","payload":{{"station":"{station}","observed_at":"2025-02-01T00:05:00+00:00","api_response":{{"temp":{temp},"dewp":null,"wspd":10,"slp":{slp},"altim":{altim},"rawOb":"{raw}"}}}}}}'


def test_reports(spark):
    texts = [metar(), metar("o2", "BBBB"), metar("o3", "ZZZZ"), metar("o4", "BBBB", slp="1005", raw="METAR COR BBBB"), metar("o5", raw="RECORD"), metar("o6", temp='"//"'), "{}"]
    good, bad = parse.split_observations(messages(spark, texts), places(spark))
    p = {r["source_event_id"]: r["value"] for r in good.where("variable = 'pressure_msl'").collect()}
    assert p == {"o1": 101000.0, "o2": None, "o3": None, "o4": 100500.0, "o5": 101000.0}
    assert {r["source_event_id"] for r in good.where("is_corrected").collect()} == {"o4"}
    assert good.where("variable = 'wind_speed_10m'").first()["value"] == pytest.approx(5.14444)
    assert tuples(bad, "kafka_offset", "error_type") == [(5, "NotANumberError"), (6, "JSONDecodeError")]


def test_archive_csv(spark, tmp_path):
    (tmp_path / "a.csv").write_text("station,valid,tmpc,dwpc,sknt,mslp,alti,metar\nABC,2025-02-01 00:05,10.0,5.0,,,29.92,ABC 010005Z\nABC,bad,1,1,1,1,1,x\nABC,2025-02-01 01:05,M,5.0,4,1000, ,ABC COR\nABC,2025-02-01 02:05,1,1,1,1,1,\n")
    r = parse.archive_csv(spark, str(tmp_path / "a.csv"), "QABC").orderBy("observed_at").collect()
    assert [(x["station"], x["temp"], x["wspd"], x["slp"]) for x in r] == [("QABC", 10.0, None, None), ("QABC", None, 4.0, 1000.0)]
    assert r[0]["altim"] == pytest.approx(29.92 * 33.8639) and '"sknt"' not in r[0]["_source"]


def test_chunks_and_candidates(spark):
    c = parse.date_chunks(spark, "2025-01-01", "2025-01-10", 4).collect()
    assert [(str(a), str(b)) for a, b in c] == [("2025-01-01", "2025-01-04"), ("2025-01-05", "2025-01-08"), ("2025-01-09", "2025-01-10")]
    assert parse.date_chunks(spark, "2025-01-02", "2025-01-01", 4).count() == 0
    with pytest.raises(ValueError):
        parse.date_chunks(spark, "2025-01-01", "2025-01-02", 0)
    assert [str(r[0]) for r in parse.run_candidates(spark, "2025-01-01 13:10:00", 6, 3).collect()] == ["2025-01-01 12:00:00", "2025-01-01 06:00:00", "2025-01-01 00:00:00"]


# ---- as-of and accuracy ----------------------------------------------------------------------------------------------------
def test_as_of(spark):
    f = rows(spark, FC, [fc(1, 0, 1, 281.0), fc(2, 0, 2, 281.0), fc(3, 0, 3, 281.0), fc(4, 0, 0, 281.0), fc(5, 0, 5, None), fc(6, 0, 1, 1.0, place="p3"), fc(7, 0, 6, 281.0), fc(8, 0, 7, 281.0, variable="x")])
    o = rows(spark, OBS, [obs(1, 0.75, 280.0), obs(2, 1.25, 279.0), obs(3, 2.1, None), obs(4, 2.5, 282.0), obs(5, 3.51, 1.0), obs(6, 6.2, 9.0), obs(7, 6.2, 8.0, corrected=True)])
    v = {r["forecast_id"]: r for r in asof.verify(f, o, places(spark)).collect()}
    assert {k: r["observed_value"] for k, r in v.items()} == {1: 280.0, 2: 282.0, 7: 8.0, 3: 282.0}
    assert v[1]["obs_offset_seconds"] == -900 and v[2]["obs_offset_seconds"] == 1800 and v[1]["error"] == 1.0 and v[1]["lead_day"] == 1
    assert tuples(asof.unmatched(f, asof.verify(f, o, places(spark))), "forecast_id") == [(6,), (8,)]
    assert asof.verify(f, o, places(spark), tolerance_minutes=0).count() == 0
    assert asof.verify(rows(spark, FC, []), rows(spark, OBS, []), places(spark)).count() == 0
    assert asof.verify(with_clashes(f), with_clashes(o), places(spark)).count() == 4


def test_recombination_is_exact(spark):
    e = spark.createDataFrame([("2025-01-01", 1.0), ("2025-01-01", -3.0), ("2025-01-01", 2.0), ("2025-01-02", 4.0), ("2025-01-02", -1.0)], "d string, error double")
    v = e.select(F.to_date("d").alias("valid_date"), F.lit("p").alias("location_id"), F.lit("m").alias("model"), F.lit("t").alias("variable"), F.lit(1).alias("lead_day"), "error")
    raw = v.groupBy("model").agg(*accuracy.figures()).first()
    got = accuracy.recombine(accuracy.daily(v), ["model"]).first()
    assert got["n"] == 5 and all(got[c] == pytest.approx(raw[c]) for c in ("bias", "mae", "rmse"))


def acc(day, model, n, mae, place="p1", lead=1, computed=0):
    return dict(valid_date=datetime(2025, 1, day).date(), location_id=place, model=model, variable="temperature_2m", lead_day=lead, n=n, bias=0.0, mae=mae, rmse=mae, computed_at=at(computed))


def test_leaderboard(spark):
    a = rows(spark, ACC, [*[acc(d, m, 4, x) for d in (18, 19, 20) for m, x in (("a", 1.0), ("b", 3.0))], acc(4, "a", 4, 5.0), acc(4, "b", 4, 0.5), acc(20, "c", 0, None)])
    b = {(r["window_days"], r["model"]): (r["n"], round(r["mae"], 3), r["mae_rank"]) for r in accuracy.leaderboard(a).collect()}
    assert b == {(7, "a"): (12, 1.0, 1), (7, "b"): (12, 3.0, 2), (30, "a"): (16, 2.0, 1), (30, "b"): (16, 2.375, 2)}
    best = accuracy.best_by_location(a, places(spark), "temperature_2m", 30, 1).collect()
    assert [(r["best_model"], round(r["margin"], 3)) for r in best] == [("a", 0.375)]
    again = rows(spark, ACC, [acc(1, "a", 4, 1.0), acc(1, "a", 4, 2.0, computed=1)])
    assert accuracy.latest(again).first()["mae"] == 2.0


# ---- upserts ---------------------------------------------------------------------------------------------------------------
def store(spark, tmp_path, name="o"):
    return VersionedTable(spark, str(tmp_path / name), F.to_date("observed_at"), schemas.OBSERVATION)


def put(table, spark, data, now=NOW):
    values = ("value", "raw_text", "is_corrected", "ingestion_mode", "source_event_id")
    new = upsert.last_observations(rows(spark, OBS, data)).select(*schemas.OBSERVATION_KEY, *values)
    return upsert.upsert(table, new, schemas.OBSERVATION_KEY, values, now, guard=upsert.correction_guard(), created=("inserted_at",), touched=("updated_at",))


def test_redelivery_changes_nothing(spark, tmp_path):
    t = store(spark, tmp_path)
    assert put(t, spark, [obs(1, 0, 1.0), obs(2, 30, float("nan"))]) == {"insert": 2}
    before = t.manifest()
    assert put(t, spark, [obs(1, 0, 1.0), obs(2, 30, None)], LATER) == {} and t.manifest() == before
    assert put(t, spark, [obs(1, 0, 1.5)], LATER) == {"update": 1}
    r = {x["value"]: (x["inserted_at"], x["updated_at"]) for x in t.read().collect()}
    assert r[1.5] == (NOW, LATER) and r[None] == (NOW, NOW)
    assert t.manifest()["parts"]["2025-02-02"] == before["parts"]["2025-02-02"]


@pytest.mark.parametrize("batches", [[[0, 1]], [[1, 0]], [[0], [1]], [[1], [0]]])
def test_a_correction_wins_in_every_order(spark, tmp_path, batches):
    both = [obs(1, 0, 1.0, seen=2), obs(2, 0, 2.0, seen=1, corrected=True)]
    t = store(spark, tmp_path)
    for b in batches:
        put(t, spark, [both[i] for i in b])
    assert tuples(t.read(), "value", "is_corrected") == [(2.0, True)]


def test_sync_deletes_and_keeps_stamps(spark, tmp_path):
    t = VersionedTable(spark, str(tmp_path / "s"), F.col("valid_date"), schemas.ACCURACY)
    new = rows(spark, ACC, [acc(1, "a", 1, 1.0), acc(2, "a", 1, 1.0), acc(3, "a", 1, 1.0)]).drop("computed_at")
    values = ("n", "bias", "mae", "rmse")

    def sync(df, now):
        d = upsert.diff(t.read(), df, schemas.ACCURACY_KEY, values, now, touched=("computed_at",), sync=True).select(*schemas.ACCURACY.names, "action").checkpoint()
        return upsert.apply(t, d, d)

    assert sync(new, NOW) == {"insert": 3}
    assert sync(new.where("valid_date <> '2025-01-03'").withColumn("mae", F.when(F.col("valid_date") == "2025-01-02", 7.0).otherwise(F.col("mae"))), LATER) == {"update": 1, "delete": 1}
    assert [(str(r["valid_date"]), r["mae"], r["computed_at"]) for r in t.read().orderBy("valid_date").collect()] == [("2025-01-01", 1.0, NOW), ("2025-01-02", 7.0, LATER)]
    assert t.partitions() == ["2025-01-01", "2025-01-02"] and len(t.vacuum()) == 0


def test_retention(spark, tmp_path):
    assert upsert.retention_cutoff("2025-03-15", 2) == "2025-01-01" and upsert.retention_cutoff("2025-01-15", 2) == "2024-11-01" and upsert.retention_cutoff("2025-01-15", None) is None
    t = store(spark, tmp_path)
    put(t, spark, [obs(1, 0, 1.0), obs(2, 24 * 40, 1.0)])
    assert upsert.apply_retention(t, "2025-04-02", 1, dry_run=True) == ["2025-02-01"] and t.read().count() == 2
    assert upsert.apply_retention(t, "2025-04-02", 1) == ["2025-02-01"] and t.read().count() == 1


# ---- quality ---------------------------------------------------------------------------------------------------------------
def test_contract_and_gate(spark):
    data = [fc(1, 0, 1, 280.0), fc(2, 0, 2, 1013.0, event="bad"), fc(3, 0, 3, 280.0, event="bad"), fc(4, 0, 4, 149.9, event="x"), fc(5, 0, 5, 150.0), fc(6, 0, 6, float("inf"), event="y"), fc(7, 0, 7, None), fc(8, 0, 8, float("nan")), fc(9, 0, 9, 1.0, variable="other", event="z"), fc(10, 0, -1, 340.0), fc(11, 0, 11, 1.0, event=None)]
    f = rows(spark, FC, data)
    c = quality.forecast_contract()
    r = {(x["check_name"], x["severity"]): x["rows_failed"] for x in quality.validate(f, c).collect()}
    assert r[("hard_range:value", "blocking")] == 4 and r[("finite:value", "blocking")] == 1 and r[("known_variable", "blocking")] == 1 and r[("lead_not_negative", "warning")] == 1
    assert r[("plausible_range:value", "warning")] == 6 and r[("all_checks", "blocking")] == 5
    clean, blocked = quality.gate(f, c)
    assert tuples(clean, "forecast_id") == [(1,), (5,), (7,), (8,), (10,)] and tuples(blocked, "source_event_id") == [("bad",), ("x",), ("y",), ("z",)]
    assert quality.validate(f.limit(0), c).count() == 0
    ntz = f.withColumn("valid_time", F.col("valid_time").cast("timestamp_ntz"))
    assert quality.gate(ntz, c)[0].count() == 0
    v = {x["check_name"]: x["rows_failed"] for x in quality.validate(ntz, c).collect()}
    assert v["timezone_aware:valid_time"] == 11 and "lead_not_negative" not in v
    twice = quality.validate(f.union(f.limit(1)), c, unique=True).where("check_name = 'unique_key'").first()
    assert twice["rows_failed"] == 2


def test_freshness(spark):
    o = rows(spark, OBS, [obs(1, 0, 1.0), obs(2, 2, 1.0, station="BBBB")])
    r = {x["subject"]: (x["passed"], x["detail"]) for x in quality.freshness(o, spark.createDataFrame([("AAAA",), ("BBBB",), ("CCCC",)], "station string"), "station", "observed_at", "2025-02-01 05:00:00", 3, "station").collect()}
    assert r == {"AAAA": (False, None), "BBBB": (True, None), "CCCC": (False, "no data yet")}


# ---- incremental build -----------------------------------------------------------------------------------------------------
def silver(spark, days=4, changed=None, late=None):
    f = [fc(100 * d + 10 * h + lead, 24 * d + h - 24 * lead, 24 * lead, 280.0 + lead, event=f"f{d}") for d in range(days) for h in (0, 6, 12, 18) for lead in (1, 3)]
    o = [obs(100 * d + h, 24 * d + h, 280.0) for d in range(days) for h in (0, 6, 12, 18)]
    for r in f + o:
        r["updated_at"] = NOW
    if changed:
        for r in o:
            if r["observation_id"] == changed[0]:
                r["value"], r["updated_at"] = changed[1], late
    return rows(spark, FC, f), rows(spark, OBS, o)


def test_build_is_incremental(spark, tmp_path):
    g = gold.Gold(spark, str(tmp_path / "gold"))
    f, o = silver(spark)
    r = g.build(f, o, places(spark), datetime(2025, 3, 1, 1))
    assert r.kind == "full" and len(r.days) == 4 and r.verification == {"insert": 32} and r.accuracy == {"insert": 8}
    a = {(str(x["valid_date"]), x["lead_day"]): (x["n"], x["mae"], x["computed_at"]) for x in g.accuracy.read().collect()}
    assert a[("2025-02-01", 1)][:2] == (4, 1.0) and a[("2025-02-01", 3)][:2] == (4, 3.0)
    r = g.build(f, o, places(spark), datetime(2025, 3, 1, 5))
    assert r.kind == "incremental" and r.verification == {} and r.accuracy == {}
    f, o = silver(spark, changed=(206, 281.0), late=datetime(2025, 3, 1, 6))
    r = g.build(f, o, places(spark), datetime(2025, 3, 1, 7))
    assert r.days == ["2025-02-02", "2025-02-03", "2025-02-04"] and r.verification == {"update": 2} and r.accuracy == {"update": 2}
    stamps = {str(x["valid_date"]): x["computed_at"] for x in g.accuracy.read().where("lead_day = 1").collect()}
    assert stamps["2025-02-03"] == datetime(2025, 3, 1, 7) and stamps["2025-02-02"] == datetime(2025, 3, 1, 1)
    f, o = silver(spark, changed=(206, None), late=datetime(2025, 3, 1, 8))
    assert g.build(f, o, places(spark), datetime(2025, 3, 1, 9)).verification == {"delete": 2}
    kept = g.verification.read().count()
    assert g.build(f.where("valid_time >= '2025-02-02'"), o, places(spark), datetime(2025, 3, 1, 10), full=True).verification == {}
    assert g.verification.read().count() == kept  # a day that left the inputs is left alone
    other = gold.Gold(spark, str(tmp_path / "gold"), Settings(tolerance_minutes=10))
    assert other.build(f, o, places(spark), datetime(2025, 3, 1, 11)).kind == "full"


def test_a_blocking_failure_stops_the_build(spark, tmp_path):
    g = gold.Gold(spark, str(tmp_path / "gold"))
    f, o = silver(spark)
    with pytest.raises(quality.QualityError):
        g.build(f.withColumn("value", F.lit(1e6)), o, places(spark), NOW)
    assert g.accuracy.partitions() == [] and g.build(f, o, places(spark), NOW).kind == "full"


# ---- rules -----------------------------------------------------------------------------------------------------------------
def run_rows(i0, init, values, model="m1", place="p1", variable="temperature_2m"):
    return [fc(i0 + i, init, i + 1, v, model=model, place=place, variable=variable, event=f"{model}{init}") for i, v in enumerate(values)]


def test_run_change(spark):
    s = Settings()
    swing = [285.0 if i % 2 else 275.0 for i in range(72)]
    f = rows(spark, FC, run_rows(0, 0, [280.0] * 72) + run_rows(100, 6, swing[:60]) + run_rows(200, 0, [280.0] * 20, "m2") + run_rows(300, 6, [300.0] * 20, "m2"))
    r = alerts.run_change(alerts.live_runs(f), s).collect()
    assert [(x["model"], x["hours"], x["metric"], x["mean_change"], x["severity"]) for x in r] == [("m1", 48, 5.0, 0.0, "warning")]
    assert alerts.run_change(alerts.live_runs(f.withColumn("ingestion_mode", F.lit("backfill"))), s).count() == 0


def test_severity_bounds(spark):
    df = spark.createDataFrame([(2.999,), (3.0,), (5.999,), (6.0,)], "m double")
    assert [r[0] for r in df.select(alerts.classify(F.col("m"), F.lit(3.0), 2.0)).collect()] == [None, "warning", "warning", "critical"]


def test_model_spread_and_miss(spark):
    s = Settings()
    f = rows(spark, FC, [r for p, v in (("p1", "temperature_2m"), ("p2", "pressure_msl")) for r in run_rows(0, 0, [280.0] * 30, "a", p, v) + run_rows(100, 1, [290.0] * 30, "b", p, v)])
    high = alerts.high_places(places(spark), s)
    r = alerts.model_spread(alerts.live_runs(f), s, high).collect()
    assert [(x["location_id"], x["hours"], x["metric"], x["severity"]) for x in r] == [("p1", 29, 10.0, "critical")]
    o = rows(spark, OBS, [obs(1, 5.4, 292.0), obs(2, 8.0, 286.0), obs(3, 9.0, 200.0, mode="backfill"), obs(4, 10.0, None)])
    m = alerts.observation_miss(o, alerts.live_runs(f), places(spark), s, high).collect()
    assert [(x["station"], x["metric"], x["models"], x["severity"]) for x in m] == [("AAAA", 7.0, 2, "warning")]
    ids = alerts.as_alerts(alerts.observation_miss(o, alerts.live_runs(f), places(spark), s), "observation_miss").select("alert_id").collect()
    assert len(ids[0][0]) == 64


# ---- operations and facts --------------------------------------------------------------------------------------------------
def test_reconcile_and_containment(spark):
    a, b = rows(spark, OBS, [obs(1, 0, 1.0), obs(2, 1, 1.0), obs(3, 1, 2.0)]), rows(spark, OBS, [obs(2, 1, 1.0), obs(4, 5, 1.0)])
    assert tuple(ops.reconcile(a, b, schemas.OBSERVATION_KEY).first()) == (2, 2, 1, 1, False)
    assert tuple(ops.reconcile(a, a, schemas.OBSERVATION_KEY).first()) == (2, 2, 0, 0, True)
    assert ops.unexplained(b, a, schemas.OBSERVATION_KEY).count() == 1
    runs = spark.createDataFrame([("s", at(0), at(2)), ("s", at(4), at(5))], "source string, started_at timestamp, finished_at timestamp")
    pts = spark.createDataFrame([(1, "s", at(0)), (2, "s", at(2)), (3, "s", at(3)), (4, "s", at(5)), (5, "x", at(1)), (6, "s", at(-1))], "id int, source string, t timestamp")
    got = {r["id"]: r["started_at"] for r in ops.containing_run(pts, runs, "id", "t", ["source"]).collect()}
    assert got == {1: at(0), 2: at(0), 3: None, 4: at(4), 5: None, 6: None}


def test_containment_in_nested_and_overlapping_runs(spark):
    at_us = lambda us: at(0) + timedelta(microseconds=us)
    rnd = random.Random(4)
    data = [("n", 0, 10), ("n", 2, 5), ("n", 3, 4), ("n", 6, 6), ("o", 0, 5), ("o", 3, 8), ("o", 3, 6), ("o", 9, None), ("o", 12, 11), (None, 1, 4)]
    data += [(f"r{k}", s, s + rnd.choice([0, 1, 3, 8, 30])) for k in range(4) for s in rnd.choices(range(60), k=25)]
    keys = sorted({k for k, _, _ in data if k}) + [None]
    pts = [(i, k, t) for i, (k, t) in enumerate((k, t) for k in keys for t in range(-1, 95))]
    runs = spark.createDataFrame([(k, at_us(s), None if f is None else at_us(f)) for k, s, f in data], "source string, started_at timestamp, finished_at timestamp")
    points = spark.createDataFrame([(i, k, at_us(t)) for i, k, t in pts], "id int, source string, t timestamp")
    got = {r["id"]: (r["started_at"], r["finished_at"]) for r in ops.containing_run(points, runs, "id", "t", ["source"]).collect()}
    want = {}
    for i, k, t in pts:
        best = max(((s, f) for q, s, f in data if q == k and f is not None and s <= t <= f), default=None)
        want[i] = tuple(map(at_us, best)) if best else (None, None)
    assert got == want
    assert ops.containing_run(points, runs.limit(0), "id", "t", ["source"]).where("started_at is not null").count() == 0


def test_numbers_in_text():
    n = lambda t: [str(x) for x in briefing.numbers_in(t)]
    assert n("between -3.5 and 1,234.5, .5 or a-1, 20-24") == ["-3.5", "1234.5", "0.5", "1", "20", "24"]
    assert n("version 1.2.3 and −4") == ["1", "2", "3", "-4"] and n("") == [] and n(None) == []
    assert n("12345,678 and (3)-5, x_-4") == ["12345678", "3", "-5", "4"]
    assert n("ecmwf_ifs025 and temperature_2m over 48 hours; day-1 error (-2.0)") == ["25", "2", "48", "1", "-2.0"]
    assert n("version 3.14.15, near 1,013 hPa") == ["3", "14", "15", "1013"]


def test_grounding():
    facts = {"models": ["aurel_x1"], "confidence": "high", "spread": {"mean": 1.4}, "min": -2.35, "text": "12 h"}
    ok = dict(summary="aurel_x1 sees -2.4 to 1.4 within 12 hours", confidence="high", best_model="aurel_x1")
    assert briefing.check_grounding(ok, facts) == []
    assert len(briefing.check_grounding(dict(ok, summary="2.4 or 99"), facts)) == 2
    assert len(briefing.check_grounding(dict(ok, confidence="low", best_model="m9"), facts)) == 2
    known = dict(facts, models=["aurel_x1", "m9"], most_accurate_model="m9")
    assert briefing.check_grounding(ok, known) == ["not the most accurate model: aurel_x1"] and briefing.check_grounding(dict(ok, best_model="m9"), known) == []
    row = {"location_id": "p", "models": [{"model": m, "variable": "temperature_2m", "min": 1.0, "mean": 2.0, "max": 3.0} for m in ("a", "b")], "accuracy": [{"mae": 1.0, "model": "b", "n": 5}, {"mae": 2.0, "model": "a", "n": 5}]}
    assert briefing.sheet(row, "2025-02-01", Settings())["most_accurate_model"] == "b"
    assert briefing.sheet_hash({"a": 1, "b": 2}) == briefing.sheet_hash({"b": 2, "a": 1})
    assert briefing.values_in({"x": [Decimal(1), True, None, "2"]}) is not None


def test_confidence_bounds():
    s = Settings()
    assert [briefing.confidence(x, 2, s) for x in (1.5, 1.6, 3.0, 3.1, None)] == ["high", "medium", "medium", "low", "low"] and briefing.confidence(0.1, 1, s) == "low"


def test_facts_look_only_at_runs_before(spark):
    f = rows(spark, FC, run_rows(0, 0, [290.0] * 60) + run_rows(100, 12, [350.0] * 60) + run_rows(200, 0, [292.0] * 60, "m2"))
    latest = briefing.latest_forecasts(f, str(at(6)), 48)
    assert latest.agg(F.max("value")).first()[0] == 292.0 and latest.count() == 96
    sp = briefing.spread(latest).first()
    assert (sp["mean_spread"], sp["models"]) == (2.0, 2)


def test_settings_from_yaml(tmp_path):
    (tmp_path / "s.yaml").write_text("tolerance_minutes: 10\nvariables:\n- {name: a, unit: K, plausible: [1, 2], hard: [0, 3]}\n")
    s = load_settings(str(tmp_path / "s.yaml"))
    assert s.tolerance_minutes == 10 and s.variables[0].hard == (0.0, 3.0) and s.fingerprint() != Settings().fingerprint()
    (tmp_path / "t.yaml").write_text("nonsense: 1\n")
    with pytest.raises(ValueError):
        load_settings(str(tmp_path / "t.yaml"))
