import numpy as np
import pytest

pytest.importorskip("tiktoken")
pytest.importorskip("public_tokenizers")

from helpers import with_clashes

from skyloom.llm.mix import flight, land, mix, plan_mix, shares

DOCS, TARGET = "doc_id bigint, source string, text string", "source string, target_share double, max_repeats int"


def src(name, share, repeats, tokens):
    return dict(source=name, target_share=share, max_repeats=repeats, tokens=tokens)


def test_plan_reaches_the_shares_or_the_caps():
    s = [src("a", 0.5, 1, 1000), src("b", 0.3, 4, 200), src("c", 0.2, 1, 0)]
    r = plan_mix(s)
    got = {k: r[k] * t for k, t in (("a", 1000), ("b", 200))}
    assert "c" not in r and got["a"] / sum(got.values()) == pytest.approx(0.625) and max(r["a"] / 1, r["b"] / 4) == pytest.approx(1.0)
    r = plan_mix(s, total=5000)
    assert r == {"a": 1.0, "b": 4.0}
    r = plan_mix(s, total=1300)
    assert r["a"] * 1000 + r["b"] * 200 == pytest.approx(1300) and r["a"] * 1000 / 1300 == pytest.approx(0.625)
    assert plan_mix([]) == {} and plan_mix([src("a", 1.0, 0, 5)]) == {}


def test_flight_keeps_both_sums_and_expectations():
    rng = np.random.default_rng(1)
    x = rng.integers(1, 900, 400).astype(float)
    p = np.full(400, 0.3)
    hits = np.zeros(400)
    for seed in range(300):
        q = flight(p, x, np.random.default_rng(seed))
        assert q.sum() == pytest.approx(p.sum()) and (q * x).sum() == pytest.approx((p * x).sum()) and ((q > 0) & (q < 1)).sum() <= 2
        z = land(q, x)
        assert set(np.unique(z)) <= {0.0, 1.0} and abs((z * x).sum() - (p * x).sum()) <= 1800
        hits += q
    assert abs(hits.mean() / 300 - 0.3) < 1e-9 and np.abs(hits / 300 - 0.3).max() < 0.15
    assert flight(np.full(5, 0.5), np.ones(5), rng).sum() == pytest.approx(2.5)
    assert flight(np.array([]), np.array([]), rng).size == 0


def corpus(spark):
    rows, i = [], 0
    for name, n in (("big", 600), ("small", 60), ("unlisted", 30), (None, 10)):
        for k in range(n):
            rows.append((i, name, "word " * (5 + (k * 37) % 90)))
            i += 1
    return spark.createDataFrame([*rows, (9000, "big", ""), (9001, "big", None), (None, "big", "x y z")], DOCS)


@pytest.mark.parametrize("group", [50_000, 50])
def test_mixture(spark, group):
    target = spark.createDataFrame([("big", 0.6, 1), ("small", 0.3, 5), ("absent", 0.1, 2)], TARGET)
    chosen, sources = mix(with_clashes(corpus(spark)), target, group=group)
    got = {r["source"]: r for r in shares(chosen, sources).collect()}
    assert got["big"]["most_uses"] <= 1 and got["small"]["most_uses"] <= 5 and got["absent"]["actual_share"] == 0.0
    assert abs(got["big"]["actual_share"] - 2 / 3) < 0.01 and abs(got["small"]["actual_share"] - 1 / 3) < 0.01
    assert chosen.where("source not in ('big', 'small') or uses < 1").count() == 0
    again = mix(corpus(spark), target, group=group)[0]
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, chosen.collect()))


def test_a_stated_total_and_repeated_rows(spark):
    target = spark.createDataFrame([("big", 0.5, 1), ("small", 0.5, 2)], TARGET)
    d = corpus(spark)
    chosen, sources = mix(d.union(d), target, total_tokens=4000.0)
    got = {r["source"]: r["tokens_used"] for r in shares(chosen, sources).collect()}
    assert abs(got["big"] - 2000) < 150 and abs(got["small"] - 2000) < 150
    assert chosen.groupBy("doc_id").count().where("count > 1").count() == 0


def test_empty(spark):
    target = spark.createDataFrame([("big", 1.0, 1)], TARGET)
    chosen, sources = mix(corpus(spark).limit(0), target)
    assert chosen.count() == 0 and shares(chosen, sources).first()["actual_share"] == 0.0
    assert mix(corpus(spark), target.limit(0))[0].count() == 0
