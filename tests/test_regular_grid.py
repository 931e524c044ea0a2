import random
from datetime import timedelta

import numpy as np
from helpers import OBS, T0, obs, rows, with_clashes
from skyloom.operators.regular_grid import VARIABLES, hourly_grid


def brute(data):
    ok = [r for r in data if r["station"] and r["observed_at"]]
    out = {}
    hours = lambda r: (r["observed_at"] - T0).total_seconds() / 3600
    for s in {r["station"] for r in ok}:
        slots = [int(np.floor(hours(r) + 0.5)) for r in ok if r["station"] == s]
        for v in VARIABLES:
            xs = [(hours(r), r["value"]) for r in ok if r["station"] == s and r["variable"] == v and r["value"] is not None and r["value"] == r["value"]]
            for h in range(min(slots), max(slots) + 1):
                near = [(x - h, y) for x, y in xs if abs(x - h) < 1.5]
                n = sum(-0.5 <= d < 0.5 for d, _ in near)
                w = np.array([(1 - (abs(d) / 1.5) ** 3) ** 3 for d, _ in near])
                fit = None
                if len(near):
                    d, y = np.array([a for a, _ in near]), np.array([b for _, b in near])
                    det = w.sum() * (w * d * d).sum() - (w * d).sum() ** 2
                    fit = ((w * d * d).sum() * (w * y).sum() - (w * d).sum() * (w * d * y).sum()) / det if det > 1e-6 * w.sum() ** 2 else (w * y).sum() / w.sum()
                out[(s, v, T0 + timedelta(hours=h))] = (n, fit, w.sum() ** 2 / (w * w).sum() if len(w) else 0.0)
    return out


def check(spark, data, df=None):
    got = {(r["station"], r["variable"], r["slot"]): r for r in hourly_grid(df if df is not None else rows(spark, OBS, data)).collect()}
    want = brute(data)
    assert got.keys() == want.keys()
    for k, (n, fit, support) in want.items():
        r = got[k]
        assert r["n_in_slot"] == n and r["missing"] == (n == 0) and abs(r["support"] - support) < 1e-6
        assert (r["value"] is None) == (fit is None) and (fit is None or abs(r["value"] - fit) < 1e-6)


def test_against_brute_force(spark):
    rnd = random.Random(7)
    data = [obs(i, rnd.choice([rnd.randrange(0, 200) / 4, 10.5, 11.4999]), rnd.choice([280.0, 281.5, 279.0, None, float("nan")]), rnd.choice(["A", "B", None]), rnd.choice([*VARIABLES, "other", None])) for i in range(220)]
    check(spark, data)
    check(spark, data, with_clashes(rows(spark, OBS, data)))


def test_slot_edges(spark):
    data = [obs(1, 5.5, 1.0), obs(2, 6.4997, 2.0), obs(3, 8, None)]
    got = {r["slot"]: r["n_in_slot"] for r in hourly_grid(rows(spark, OBS, data)).where("variable = 'temperature_2m'").collect()}
    assert [got[T0 + timedelta(hours=h)] for h in (6, 7, 8)] == [2, 0, 0]


def test_line_is_exact_and_empty(spark):
    data = [obs(i, x, 3.0 + 2.0 * x) for i, x in enumerate((9.2, 9.8, 10.3, 11.0))]
    g = {r["slot"]: r["value"] for r in hourly_grid(rows(spark, OBS, data)).where("variable = 'temperature_2m'").collect()}
    assert abs(g[T0 + timedelta(hours=10)] - 23.0) < 1e-9
    assert hourly_grid(rows(spark, OBS, [])).count() == 0
