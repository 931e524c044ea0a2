import random

import numpy as np
from helpers import FC, OBS, dims, fc, obs, rows, tuples, with_clashes
from skyloom.functions.columns import DAY_US
from skyloom.operators.spikes import MEMORY, STUCK_TIMES, Runs, implausible_forecasts, implausible_observations, kalman_spikes, usual_changes


def series(values, start=0, step=1.0, i0=0, **k):
    return [obs(i0 + i, start + i * step, v, **k) for i, v in enumerate(values)]


def found(spark, data):
    return [r[0] for r in tuples(implausible_observations(rows(spark, OBS, data), dims(spark)), "id")]


def found_in(spark, data, days):
    return [r[0] for r in tuples(implausible_observations(rows(spark, OBS, data), dims(spark), block_us=int(days * DAY_US)), "id")]


def brute(data):
    """Stuck rows of one-valued variables, row by row."""
    out, series = [], {}
    for r in data:
        series.setdefault((r["station"], r["variable"]), []).append(r)
    for s in series.values():
        s.sort(key=lambda r: (r["observed_at"], r["observation_id"], r["value"]))
        i = 0
        while i < len(s):
            j = i
            while j < len(s) and s[j]["value"] == s[i]["value"]:
                j += 1
            if s[i]["value"] != 0 and len({r["observed_at"] for r in s[i:j]}) >= STUCK_TIMES:
                out += [r["observation_id"] for r in s[i:j]]
            i = j
    return sorted(out)


def calm(n, seed=1, base=280.0):
    rnd = random.Random(seed)
    out, x = [], base
    for _ in range(n):
        x += rnd.choice([-0.6, -0.3, 0.3, 0.6])
        out.append(round(x, 1))
    return out


def changed_calm(n=60, **changes):
    """A calm series with additions at some readings (``at20=15``)."""
    v = calm(n)
    for k, x in changes.items():
        v[int(k[2:])] += x
    return v


def cases():
    """Name -> rows (ids from 0, station A) and the ids that must be flagged; each becomes a station of its own."""
    flat = calm(30)
    flat[10:16] = [281.3] * 6
    five = [*flat[:10], 281.8, *flat[11:]]
    before = calm(30)
    before[10:16] = [281.3] * 6
    copies = series(before) + [obs(100, 10, 281.8, corrected=True), obs(101, 10, 281.3, seen=40)]
    wild = calm(20)
    wild[5], wild[6], wild[7], wild[8] = -9999.0, None, float("nan"), float("inf")
    step = [x + (15 if i >= 30 else 0) for i, x in enumerate(calm(60))]
    late = [x + (20 if i >= 30 else 0) + (18 if i == 32 else 0) for i, x in enumerate(calm(60))]
    spike = changed_calm(40, at20=15)
    sparse = calm(40)
    sparse[11:17] = [281.3] * 6
    sparse[30] += 40
    return {
        "one and two readings": (series(changed_calm(at20=15, at40=12, at41=12.5)), [20, 40, 41]),
        "a change that lasts": (series(step), []),
        "three readings and the ends": (series(changed_calm(at0=15, at30=15, at31=15, at32=15, at59=15)), []),
        "between two spikes": (series(changed_calm(at20=15, at22=15, at40=15, at41=15, at43=15)), [20, 22, 40, 41, 43]),
        "after a change": (series(late), [32]),
        "over a gap": ([obs(i, i + (10 if i > 30 else 0) + (10 if i > 31 else 0), x + (6 if i == 31 else 0)) for i, x in enumerate(calm(60))], []),
        "range and missing": (series(wild), [5, 8]),
        "copies and a correction of a spike": (series(spike) + [obs(100, 20, spike[20], seen=30), obs(101, 20, spike[20] - 15, corrected=True)], [20, 100]),
        "six times": (series(flat), list(range(10, 16))),
        "five times": (series(five), []),
        "five times and copies": (series(five) + [obs(200 + i, 12, 281.3) for i in range(5)], []),
        "calm wind": ([obs(i, i, 0.0, variable="wind_speed_10m") for i in range(12)], []),
        "a correction at the start": (copies, [11, 12, 13, 14, 15, 101]),  # 10 stands before the correction
        "two corrections at the start": ([*copies, obs(102, 10, 281.9, corrected=True)], []),
        "sparse": (series(sparse, step=48.0), [*range(11, 17), 30]),
        "always the same": (series([280.5] * 100), list(range(100))),
    }


def test_cases_in_blocks_of_any_length(spark):
    data, want = [], []
    for k, (r, ids) in enumerate(cases().values()):
        data += [dict(x, observation_id=x["observation_id"] + 1000 * k, station=f"S{k}") for x in r]
        want += [i + 1000 * k for i in ids]
    for days in (10, 1, 0.1):
        assert found_in(spark, data, days) == want


def test_blocks_of_any_length_flag_the_same_rows(spark):
    rnd = random.Random(11)
    data = []
    for station in range(60):
        ids = rnd.sample(range(1000), 130)
        x = 281.3
        for i, k in enumerate(ids):
            x = rnd.choice([x, x, x, x, x, 281.3, 281.8]) + 30 * (rnd.random() < 0.02)
            data.append(obs(station * 1000 + k, rnd.choice([i // 3, i // 3, i // 3 + 1]), x if x < 290 else x - 30 * (rnd.random() < 0.9), station=f"S{station}"))
    data += [dict(r, value=r["value"] + 0.5) for r in rnd.sample(data, 100)]  # one id, two values
    plain = found(spark, data)
    assert len(plain) > 1000 and set(brute(data)) <= set(plain)
    for days in (0.1, 0.3):
        assert found_in(spark, data, days) == plain


def test_runs_and_spikes_across_blocks(spark):
    v = calm(24 * 75, 3)
    v[24 * 25 - 3 : 24 * 25 + 3] = [280.1] * 6
    v[24 * 40 : 24 * 53] = [279.9] * 24 * 13
    want = set(range(24 * 25 - 3, 24 * 25 + 3)) | set(range(24 * 40, 24 * 53))
    for t in (24 * 10, 24 * 54, 24 * 55 - 1, 24 * 60, 24 * 60 - 1):
        v[t] += 20
        want.add(t)
    for days in (1, 5):
        assert set(found_in(spark, series(v) + series(v, i0=100_000), days)) == want | {100_000 + i for i in want}


def test_forecast_series_are_messages(spark):
    v = calm(24, 5)
    v[7] += 14
    live = [fc(i, 0, i + 1, x) for i, x in enumerate(v)]
    other = [fc(100 + i, 0, i + 1, x + 20, event="f") for i, x in enumerate(calm(24, 6))]
    back = [fc(200 + i, i - 24 * d, 24 * d, x + 5 * d, mode="backfill", event="g") for d in (1, 2, 3) for i, x in enumerate(calm(24, 8))]
    ids = [fc(400 + i, 0, i + 1, x, event=None) for i, x in enumerate(v)]
    f = rows(spark, FC, live + other + back + ids)
    assert tuples(implausible_forecasts(f, dims(spark)), "id") == [(7,), (407,)]
    assert tuples(implausible_forecasts(with_clashes(f), dims(spark)), "id") == [(7,), (407,)]
    assert tuples(implausible_forecasts(f, dims(spark), hot_rows=3), "id") == [(7,), (407,)]


def test_empty_unknown_and_untimed(spark):
    assert found(spark, []) == []
    v = calm(30)
    v[12] += 15
    a = series(v, variable="unknown")
    b = [dict(obs(90, 0, -5.0, variable="wind_speed_10m"), observed_at=None), dict(obs(91, 0, 5.0), observed_at=None, variable=None)]
    assert found(spark, a + b + series(v, i0=200, station=None)) == [12, 90, 212]


def test_kernels_on_many_series():
    rnd = np.random.default_rng(3)
    key = np.repeat(np.arange(50), 40)
    us = np.tile(np.arange(40), 50) * 3_600_000_000
    v = 280 + rnd.choice([-0.5, 0.5], len(key)).reshape(50, 40).cumsum(1).ravel()
    want = np.zeros(len(v), bool)
    want[np.arange(50) * 40 + rnd.integers(5, 35, 50)] = True
    v[want] += 20
    scale = usual_changes(key, v, np.full(len(v), 0.5))
    assert (kalman_spikes(key, us, v, scale) == want).all() and (scale == 0.5).all()
    ids = np.arange(len(v))
    assert not len(Runs(key, us, v, ids, ids).stuck()[0])
    assert kalman_spikes(key[:0], us[:0], v[:0], v[:0]).size == 0 and not len(Runs(key[:0], us[:0], v[:0], ids[:0], ids[:0]).stuck()[0])


def test_a_cut_with_enough_memory_changes_nothing():
    rnd = np.random.default_rng(5)
    for _ in range(200):
        n = 120
        v = rnd.choice([0.0, 0.3, 10.0, -10.0, 20.0], n, p=[0.4, 0.3, 0.1, 0.1, 0.1])
        us = np.cumsum(rnd.integers(1, 4, n)) * 3_600_000_000
        scale = np.full(n, 0.5)
        whole = kalman_spikes(np.zeros(n, int), us, v, scale)
        at = int(rnd.integers(30, 90))
        left = slice(0, at + 3)
        right = slice(at - MEMORY - 3, n)
        a = kalman_spikes(np.zeros(at + 3, int), us[left], v[left], scale[left])[:at]
        b = kalman_spikes(np.zeros(n - at + MEMORY + 3, int), us[right], v[right], scale[right])[MEMORY + 3 :]
        assert (np.r_[a, b] == whole).all()
