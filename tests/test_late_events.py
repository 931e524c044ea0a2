import random

from helpers import OBS, obs, rows, tuples, with_clashes
from skyloom.operators import late_events as le

H3 = 3 * 3600


def brute_late(data):
    live = [r for r in data if r["ingestion_mode"] == "live" and r["station"] and r["observed_at"] and r["inserted_at"]]
    out = []
    for r in live:
        seen = [q["observed_at"] for q in live if q["station"] == r["station"] and q["inserted_at"] < r["inserted_at"] and q["observed_at"] <= q["inserted_at"]]
        if seen and (max(seen) - r["observed_at"]).total_seconds() > H3:
            out.append(r["observation_id"])
    return sorted(out)


def sample(seed, n=160):
    rnd = random.Random(seed)
    out = []
    for i in range(n):
        t = rnd.randrange(0, 60 * 24) / 12
        seen = t + rnd.choice([0, 0.1, 0.1, 5, 30, -2])
        r = obs(i, t, rnd.choice([1.0, 2.0, None, float("nan")]), rnd.choice(["A", "A", "A", "B", None]), rnd.choice(["t", "w"]), seen, rnd.random() < 0.1, rnd.choice(["live", "live", "backfill"]))
        if rnd.random() < 0.05:
            r["observed_at"] = None
        if rnd.random() < 0.05:
            r["inserted_at"] = None
        out.append(r)
    return out


def late(df):
    return [r[0] for r in tuples(le.with_lateness(df).where("too_late"), "observation_id")]


def test_against_brute_force(spark):
    for seed in (1, 2):
        data = sample(seed)
        assert late(rows(spark, OBS, data)) == brute_late(data)


def test_exactly_three_hours_is_in_time_and_ties_do_not_count(spark):
    data = [obs(1, 10, 1.0), obs(2, 7, 1.0, seen=11), obs(3, 6.99, 1.0, seen=11), obs(4, 6, 1.0, seen=10), obs(5, 30, 1.0, seen=12), obs(6, 9, 1.0, seen=13)]
    assert late(rows(spark, OBS, data)) == [3]  # 4 arrives with 1, and 5's clock runs ahead


def test_revised_hourly(spark):
    data = [obs(1, 10, 1.0), obs(2, 10, 5.0, seen=10.5, corrected=True), obs(3, 10, 9.0, seen=11), obs(4, 10.5, None, seen=10.6), obs(5, 4, 7.0, seen=20)]
    h = [tuple(r) for r in le.hourly_revised(rows(spark, OBS, data)).select("n_reports", "n_values", "n_revisions", "mean_value").collect()]
    assert h == [(2, 1, 2, 5.0)]


def test_empty_and_clashing(spark):
    assert late(rows(spark, OBS, [])) == []
    data = sample(4, 60)
    assert late(with_clashes(rows(spark, OBS, data))) == brute_late(data)


def test_stream_equals_batch(spark, tmp_path):
    from pyspark.sql import functions as F

    from skyloom.sources.versioned import VersionedTable
    from skyloom.streaming import late_stream

    data = sorted([r for r in sample(5, 200) if r["inserted_at"]], key=lambda r: r["inserted_at"])
    cut = [r["inserted_at"] for r in data][len(data) // 2]
    for i, part in enumerate(([r for r in data if r["inserted_at"] < cut], [r for r in data if r["inserted_at"] >= cut])):
        rows(spark, OBS, part).coalesce(1).write.parquet(f"{tmp_path}/in/{i}")
        src = spark.readStream.schema(rows(spark, OBS, []).schema).option("recursiveFileLookup", "true").parquet(f"{tmp_path}/in")
        ok = VersionedTable(spark, f"{tmp_path}/ok", F.to_date("observed_at"))
        no = VersionedTable(spark, f"{tmp_path}/no", F.to_date("observed_at"))
        late_stream.start(src, ok, no, f"{tmp_path}/cp").awaitTermination()  # the second start goes on from the first's checkpoint
    assert [r[0] for r in tuples(no.read(), "observation_id")] == brute_late(data)
    cols = ["station", "variable", "hour", "n_reports", "n_values", "mean_value"]
    assert tuples(late_stream.hourly(ok.read()), *cols) == tuples(le.hourly_revised(rows(spark, OBS, data)), *cols)


def test_stream_upserts_the_hours_it_touches(spark, tmp_path):
    from pyspark.sql import functions as F

    from skyloom.sources.versioned import VersionedTable
    from skyloom.streaming import late_stream

    data = sorted([r for r in sample(6, 120) if r["inserted_at"]], key=lambda r: r["inserted_at"]) + [obs(900, 119.5, 1.0, station="C", variable=None, seen=400)]
    data += [obs(901, 119.5, 4.0, station="C", variable=None, seen=401, corrected=True), obs(902, 119.6, 2.0, station="C", variable=None, seen=402), obs(903, 117.5, 2.0, station="C", seen=403)]
    cut = len(data) - 3
    ok = VersionedTable(spark, f"{tmp_path}/ok", F.to_date("observed_at"))
    no = VersionedTable(spark, f"{tmp_path}/no", F.to_date("observed_at"))
    hours = VersionedTable(spark, f"{tmp_path}/hours", F.to_date("hour"), late_stream.HOURS)
    assert hours.read().count() == 0
    before = {}
    cols = ["station", "variable", "hour", "n_reports", "n_values", "min_value", "max_value", "mean_value"]
    key = lambda r: str(r)
    for i, (part, so_far) in enumerate(((data[:cut], data[:cut]), (data[cut:], data))):
        rows(spark, OBS, part).coalesce(1).write.parquet(f"{tmp_path}/in/{i}")
        src = spark.readStream.schema(rows(spark, OBS, []).schema).option("recursiveFileLookup", "true").parquet(f"{tmp_path}/in")
        late_stream.start(src, ok, no, f"{tmp_path}/cp", hours=hours).awaitTermination()
        got, want = (sorted(map(tuple, x.select(*cols).collect()), key=key) for x in (hours.read(), le.hourly_revised(rows(spark, OBS, so_far))))
        assert got == want
        before, last = hours.manifest()["parts"], before
    assert {p for p in before if before[p] != last.get(p)} == {"2025-02-05"}  # the other days were not written again
