import random

from helpers import FC, OBS, at, fc, obs, rows, tuples, with_clashes
from pyspark.sql import functions as F

from skyloom.functions.columns import hex_id
from skyloom.operators import once

A, B = "ab" * 32, "0f" * 32


def sample(seed, n=150):
    rnd = random.Random(seed)
    out = []
    for i in range(n):
        e = rnd.choice([A, A.upper(), f" {A} ", B, f"0x{B}", "-".join([B[:8], B[8:]]), None])
        r = obs(i, rnd.randrange(0, 4) * 12, rnd.choice([1.0, None]), rnd.choice(["A", "B", None]), rnd.choice(["t", None]), rnd.randrange(0, 60), event=e)
        if rnd.random() < 0.1:
            r["inserted_at"] = None
        out.append(r)
    return out


def norm(e):
    h = "".join(c for c in e.lower() if c in "0123456789abcdef")
    return h[-64:]


def brute(data):
    groups = {}
    for r in data:
        if r["source_event_id"] is not None:
            groups.setdefault((norm(r["source_event_id"]), r["station"], r["observed_at"], r["variable"]), []).append((r["inserted_at"] or at(-1e5), r["observation_id"]))
    return sorted(i for g in groups.values() for _, i in sorted(g)[1:])


def test_identifier_however_written(spark):
    df = spark.createDataFrame([(x,) for x in (A, A.upper(), f"  {A}", f"0x{A}", f"{A[:8]}-{A[8:]}", f"{{{A}}}")], "e string")
    assert {r[0] for r in df.select(hex_id("e")).collect()} == {A}


def test_surplus_against_brute_force(spark):
    for seed in (1, 2):
        data = sample(seed)
        df = rows(spark, OBS, data)
        for cut, hot in ((-1, once.HOT_ROWS), (30, once.HOT_ROWS), (30, 5)):  # 5: every identifier is hot and goes through the salts
            s = once.surplus_by_arrival(df, once.observation_copies(), F.lit(at(cut)), hot)
            assert [r[0] for r in tuples(s, "id")] == brute(data)
    s = once.surplus_by_arrival(with_clashes(df), once.observation_copies(), F.lit(at(30)))
    assert [r[0] for r in tuples(s, "id")] == brute(data)


def test_a_batch_rewrites_only_the_partitions_it_affects(spark, tmp_path):
    c = once.observation_copies()
    log = once.SurplusLedger(spark, str(tmp_path / "l"))
    side = lambda data: c.rows(rows(spark, OBS, data)).withColumn("tab", F.lit(0))
    old = side([obs(1, 0, 1.0, event=A), obs(2, 0, 1.0, event=A, seen=3), obs(3, 30, 1.0, event=B), obs(4, 60, 1.0, event=B)])
    index = log.index(old)
    log.load(old, index)
    assert tuples(log.read(), "id", "part") == [(2, "2025-02-01")]
    before = log.table.manifest()["parts"]
    # a copy of 3; its identifier is also in another day's partition
    new = side([obs(5, 30, 1.0, event=f"0x{B}", seen=90)])
    assert log.merge(old, index, new) == ["2025-02-02", "2025-02-03"]
    assert tuples(log.read(), "id", "part") == [(2, "2025-02-01"), (5, "2025-02-02")]
    assert log.table.manifest()["parts"]["2025-02-01"] == before["2025-02-01"]
    assert log.merge(old, index, new.limit(0)) == []
    # without its entries in the index a late copy is not seen: the index decides what is combined
    none = once.SurplusLedger(spark, str(tmp_path / "n"))
    none.load(old, index)
    assert none.merge(old, index.limit(0), side([obs(6, 99, 1.0, event=A)])) == ["2025-02-05"]


def test_empty_tables(spark):
    assert once.surplus_by_arrival(rows(spark, OBS, []), once.observation_copies(), F.lit(at(0))).count() == 0
    assert once.surplus_by_arrival(rows(spark, FC, []), once.forecast_copies(), F.lit(None).cast("timestamp")).count() == 0


def test_same_identifier_other_natural_key_is_no_copy(spark):
    data = [fc(1, 0, 1, 1.0, event=A), fc(2, 0, 2, 1.0, event=A), fc(3, 0, 2, 9.0, event=A, seen=5), fc(4, 0, 2, 1.0, event=B)]
    assert tuples(once.surplus_by_arrival(rows(spark, FC, data), once.forecast_copies(), F.lit(at(3))), "id") == [(3,)]


def test_store_keeps_one_copy_over_batches(spark, tmp_path):
    data = sample(9, 120)
    df = rows(spark, OBS, data)
    store = once.OnceStore(spark, str(tmp_path / "s"), once.observation_copies(), df.schema)
    for i in range(3):
        store.merge(df.where(F.col("observation_id") % 3 == i))
    lost = set(brute(data))
    kept = [(r["observation_id"],) for r in data if r["observation_id"] not in lost]
    assert tuples(store.read(), "observation_id") == kept
    store.merge(df)  # everything once more
    assert tuples(store.read(), "observation_id") == kept
    assert store.merge(df.limit(0)) == []


def test_store_rewrites_only_affected_partitions(spark, tmp_path):
    store = once.OnceStore(spark, str(tmp_path / "s"), once.observation_copies(), rows(spark, OBS, []).schema)
    store.merge(rows(spark, OBS, [obs(1, 0, 1.0, event=A), obs(2, 30, 1.0, event=B)]))
    before = store.rows.manifest()["parts"]
    assert store.merge(rows(spark, OBS, [obs(3, 30, 1.0, event=B, seen=40)])) == ["2025-02-02"]
    after = store.rows.manifest()["parts"]
    assert before["2025-02-01"] == after["2025-02-01"] and before["2025-02-02"] != after["2025-02-02"]
    store.rows.vacuum()
    assert tuples(store.read(), "observation_id") == [(1,), (2,)]
    store.index.drop(store.index.partitions())
    store.reindex()
    assert store.index.read().count() == 2
