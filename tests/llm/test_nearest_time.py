import random

from helpers import FC, LOC, OBS, at, fc, obs, rows, tuples, with_clashes
from pyspark.sql import functions as F

from skyloom.llm.nearest_time import forecast_observation_pairs, nearest_pairs


def brute(f, o, station):
    out = []
    for r in f:
        s = station.get(r["location_id"])
        if r["value"] is None or r["value"] != r["value"] or r["lead_hours"] is None or r["lead_hours"] < 1:
            continue
        near = []
        for q in o:
            if s and q["station"] == s and r["variable"] and q["variable"] == r["variable"] and q["value"] is not None and q["value"] == q["value"] and q["observed_at"] and r["valid_time"]:
                d = abs((q["observed_at"] - r["valid_time"]).total_seconds())
                if d <= 1800:
                    near.append((d, q["observed_at"], not q["is_corrected"], q["observation_id"]))
        out.append((r["forecast_id"], min(near)[3] if near else -1))
    return sorted(out)


def sample(seed):
    rnd = random.Random(seed)
    f = [fc(i, 0, 1, rnd.choice([1.0, None, float("nan"), 2.0, 3.0]), place=rnd.choice(["p1", "p2", "p3", None]), variable=rnd.choice(["t", "w", None])) for i in range(200)]
    for r in f:
        r["valid_time"] = rnd.choice([at(rnd.randrange(0, 200) / 4), at(24), at(23.75), None])
        r["lead_hours"] = rnd.choice([0, 1, 5, None, 3])
    o = [obs(i, rnd.randrange(0, 400) / 8, rnd.choice([1.0, None, float("nan"), 2.0]), rnd.choice(["A", "B", None]), rnd.choice(["t", "w", None]), corrected=rnd.random() < 0.3) for i in range(250)]
    return f, o + [dict(obs(900 + i, 24, 1.0, "A", "t")) for i in range(3)]


def test_against_brute_force(spark):
    loc = rows(spark, LOC, [dict(location_id="p1", station="A"), dict(location_id="p2", station="B"), dict(location_id="p3")])
    for seed in (1, 2, 3):
        f, o = sample(seed)
        for wrap in (lambda d: d, with_clashes):
            p = forecast_observation_pairs(wrap(rows(spark, FC, f)), wrap(rows(spark, OBS, o)), wrap(loc))
            got = tuples(p.select("forecast_id", F.coalesce("observation_id", F.lit(-1)).alias("o")), "forecast_id", "o")
            assert got == brute(f, o, {"p1": "A", "p2": "B"})


def test_ties(spark):
    loc = rows(spark, LOC, [dict(location_id="p1", station="AAAA")])
    f = [fc(1, 0, 10, 1.0), fc(1, 0, 10, 1.0), fc(2, 0, 20, 1.0), fc(3, 0, 30, 1.0)]
    o = [obs(5, 10.25, 1.0), obs(6, 9.75, 1.0), obs(7, 9.75, 1.0), obs(8, 19.9, 1.0), obs(9, 19.9, 1.0, corrected=True), obs(10, 30.5, 1.0), obs(11, 29.4999, 1.0)]
    p = forecast_observation_pairs(rows(spark, FC, f), rows(spark, OBS, o), loc)
    assert tuples(p, "forecast_id", "observation_id") == [(1, 6), (1, 6), (2, 9), (3, 10)]


def test_empty_sides(spark):
    loc = rows(spark, LOC, [])
    f, o = sample(4)
    assert forecast_observation_pairs(rows(spark, FC, []), rows(spark, OBS, o), loc).count() == 0
    p = forecast_observation_pairs(rows(spark, FC, f), rows(spark, OBS, []), loc)
    assert p.where("observation_id is not null").count() == 0 and p.count() == len(brute(f, [], {}))


def test_small_blocks_give_the_same(spark):
    rnd = random.Random(3)
    left = spark.createDataFrame([(i, rnd.randrange(3), rnd.randrange(-500, 500)) for i in range(300)], "id bigint, entity bigint, t bigint")
    right = spark.createDataFrame([(i, rnd.randrange(3), rnd.randrange(-500, 500), 0) for i in range(80)], "id bigint, entity bigint, t bigint, rank int")
    a = tuples(nearest_pairs(left, right, 7, 7).na.fill(-1), "id", "right_id")
    b = tuples(nearest_pairs(left, right, 7, 100_000).na.fill(-1), "id", "right_id")
    c = tuples(nearest_pairs(left, right, 7, 100_000, hot_rows=10).na.fill(-1), "id", "right_id")
    assert a == b == c and len(a) == 300
