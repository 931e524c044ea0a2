import random
from datetime import date, datetime, timedelta

from helpers import ACC, rows, with_clashes
from skyloom.operators.rolling import trailing_totals

KEYS = ("location_id", "model", "variable", "lead_day")


def run(df, periods=(7, 30)):
    return {(*(r[k] for k in KEYS), r["valid_date"]): r for r in trailing_totals(df, KEYS, "valid_date", "n", "mae", "computed_at", periods).collect()}


def brute(data, periods):
    last = {}
    for r in data:
        k = (*(r[c] for c in KEYS), r["valid_date"])
        mae = None if r["mae"] is None or r["mae"] != r["mae"] else r["mae"]
        x = (r["computed_at"] or datetime.min, r["n"] or 0, -1e9 if mae is None else mae)
        if k not in last or x > last[k][0]:
            last[k] = (x, r["n"] or 0, mae)
    out = {}
    for s in {k[:4] for k in last}:
        days = [k[4] for k in last if k[:4] == s]
        d = min(days)
        while d <= max(days):
            row = []
            for p in periods:
                xs = [last.get((*s, d - timedelta(days=i)), (0, 0, None)) for i in range(p)]
                w = sum(n for _, n, m in xs if m is not None)
                row += [sum(n for _, n, _ in xs), sum(n * m for _, n, m in xs if m is not None) / w if w else None]
            out[(*s, d)] = row
            d += timedelta(days=1)
    return out


def sample(seed, n=150):
    rnd = random.Random(seed)
    out = []
    for i in range(n):
        out.append(dict(
            valid_date=date(2025, 1, 1) + timedelta(days=rnd.choice([rnd.randrange(12), rnd.randrange(150)])), location_id=rnd.choice(["p", "q", None]), model=rnd.choice(["m", None]), variable="t", lead_day=rnd.choice([1, 2]),
            n=rnd.choice([None, 0, 3, 24]), mae=rnd.choice([None, float("nan"), 1.25, 2.5]), computed_at=rnd.choice([None, datetime(2025, 6, 1), datetime(2025, 6, 2) + timedelta(seconds=i)]),
        ))
    return out


def test_against_brute_force(spark):
    for seed in (1, 2):
        data = sample(seed)
        got, want = run(rows(spark, ACC, data)), brute(data, (7, 30))
        assert got.keys() == want.keys()
        for k, (n7, m7, n30, m30) in want.items():
            r = got[k]
            assert (r["n_7"], r["n_30"]) == (n7, n30)
            for a, b in ((r["mean_7"], m7), (r["mean_30"], m30)):
                assert (a is None) == (b is None) and (a is None or abs(a - b) < 1e-9)


def test_days_without_rows_and_zero(spark):
    data = [dict(valid_date=date(2025, 1, d), location_id="p", model="m", variable="t", lead_day=1, n=n, mae=1.0, computed_at=datetime(2025, 2, 1)) for d, n in ((1, 5), (20, 0))]
    got = run(rows(spark, ACC, data))
    assert len(got) == 20
    assert [k[4].day for k, r in sorted(got.items()) if r["n_7"] == 0] == list(range(8, 21))


def test_empty_repeated_and_clashing(spark):
    assert not run(rows(spark, ACC, []))
    data = sample(3, 40)
    once = run(rows(spark, ACC, data))
    assert run(with_clashes(rows(spark, ACC, data * 2))).keys() == once.keys()
    assert {k: r["n_7"] for k, r in run(rows(spark, ACC, data * 2)).items()} == {k: r["n_7"] for k, r in once.items()}
    assert not run(rows(spark, ACC, [dict(location_id="p", model="m", variable="t", lead_day=1, n=4)]))  # no day
