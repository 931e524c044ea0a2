"""Mixing sources to target shares of the total tokens by balanced sampling (cube method)."""

from __future__ import annotations

import zlib
from itertools import product

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyloom.llm.encode import TOKENIZER, token_counts
from skyloom.session import shared_dir

#: Pages of one source that fly together; each such group leaves at most two pages undecided.
GROUP = 50_000
SEED = 20250223


def plan_mix(sources: list[dict], total: float | None = None) -> dict[str, float]:
    """How often a page of each source is used on average: ``sources`` have source, target_share, max_repeats, tokens.

    Without ``total`` the mixture is the largest that reaches the target shares of the sources that have tokens (their shares
    scaled to sum to 1). With a ``total`` each such source gets its scaled share of it; sources that their cap stops give what
    they can and the rest is shared out again among the others.
    """
    live = {s["source"]: s for s in sources if s["tokens"] and s["target_share"] and s["target_share"] > 0 and s["max_repeats"] and s["max_repeats"] > 0}
    scale = sum(s["target_share"] for s in live.values())
    if not live:
        return {}
    cap = {k: s["max_repeats"] * s["tokens"] for k, s in live.items()}
    share = {k: s["target_share"] / scale for k, s in live.items()}
    if total is None:
        total = min(cap[k] / share[k] for k in live)
        return {k: min(share[k] * total / s["tokens"], s["max_repeats"]) for k, s in live.items()}
    want, left, open_ = {}, float(total), set(live)
    while open_:
        part = sum(share[k] for k in open_)
        full = {k for k in open_ if cap[k] <= share[k] / part * left}
        if not full:
            return want | {k: share[k] / part * left / live[k]["tokens"] for k in open_}
        for k in full:
            want[k] = float(live[k]["max_repeats"])
            left -= cap[k]
        open_ -= full
    return want


def flight(pi: np.ndarray, x: np.ndarray, rng: np.random.Generator) -> np.ndarray:
    """Move inclusion probabilities to 0 or 1 so that the sums of ``p`` and of ``p * x`` do not change, until at most two are left.

    Three undecided pages have one direction that changes neither sum; the step along it, in either sense with the odds that
    keep each probability's expectation, decides at least one page.
    """
    p = pi.astype(float).copy()
    held: list[int] = []
    eps = 1e-9
    coin = iter(rng.random(len(p) + 8).tolist())
    todo = iter(np.flatnonzero((p > eps) & (p < 1 - eps)).tolist())
    while True:
        while len(held) < 3:
            i = next(todo, None)
            if i is None:
                return p
            held.append(i)
        a, b, c = held
        u = (x[b] - x[c], x[c] - x[a], x[a] - x[b])
        if not any(u):
            u = (1.0, -1.0, 0.0)
        up = min((1 - p[i]) / v if v > 0 else p[i] / -v for i, v in zip(held, u) if v)
        down = min(p[i] / v if v > 0 else (1 - p[i]) / -v for i, v in zip(held, u) if v)
        step = up if next(coin, 0.5) * (up + down) < down else -down
        for i, v in zip(held, u):
            p[i] += step * v
        held = [i for i in held if eps < p[i] < 1 - eps]
        p[[a, b, c]] = np.where(p[[a, b, c]] <= eps, 0.0, np.where(p[[a, b, c]] >= 1 - eps, 1.0, p[[a, b, c]]))


def land(p: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Decide the few pages that are left: the choice nearest to their expected tokens, then to their expected number."""
    left = np.flatnonzero((p > 0) & (p < 1))
    if not len(left):
        return p
    want, number = float((p[left] * x[left]).sum()), float(p[left].sum())
    best = min(product((0.0, 1.0), repeat=len(left)), key=lambda c: (abs(np.dot(c, x[left]) - want), abs(sum(c) - number)))
    out = p.copy()
    out[left] = best
    return out


def _fly(pdf: pd.DataFrame, final: bool) -> pd.DataFrame:
    d = pdf.sort_values(["h", "doc_id"], kind="stable", ignore_index=True)
    first = d.iloc[0]
    rng = np.random.default_rng([SEED, zlib.crc32(str(first["source"]).encode()), int(first["g"]) + 1 if not final else 0])
    x = d["tokens"].to_numpy(float)
    p = flight(d["p"].to_numpy(), x, rng)
    d["p"] = land(p, x) if final else p
    return d


def _pages(documents: DataFrame, target: DataFrame, name: str) -> DataFrame:
    """One row per page of a listed source with at least one token. Repeated rows of a page are one page."""
    t = target.where(F.col("source").isNotNull()).select("source").distinct()
    listed = documents.where(F.col("doc_id").isNotNull()).select("doc_id", "source", "text").join(F.broadcast(t), "source", "left_semi")
    sizes = token_counts(listed, "doc_id", "source", name=name).where("tokens > 0")
    return sizes.groupBy("doc_id").agg(F.min(F.struct("source", "tokens")).alias("s")).select("doc_id", "s.source", "s.tokens")


def mix(documents: DataFrame, target: DataFrame, total_tokens: float | None = None, name: str = TOKENIZER, group: int = GROUP) -> tuple[DataFrame, list[dict]]:
    """The pages used, with how often (``doc_id``, ``source``, ``tokens``, ``uses``), and per listed source the plan and its sizes.

    Cube method: every page of a source has the same expected number of uses, its whole part is certain and its fraction an inclusion
    probability. The fractions are moved through the null-space of two constraints, the source's tokens and its
    number of pages, in groups of ``GROUP`` pages (a large source is many groups), which leaves two pages a group; those fly once
    more per source, and the last two land by the nearest choice. So each source ends within two pages of its share.
    ``target`` is a short list with one row per source (its size does not grow with the corpus); it is broadcast, and its sums are
    the only thing the driver sees. Token sizes are computed once and checkpointed in the shared folder. Pages of unlisted or NULL
    sources and pages without tokens are never used.
    """
    shared_dir(documents.sparkSession)
    pages = _pages(documents, target, name).checkpoint()
    sums = pages.groupBy("source").agg(F.count(F.lit(1)).alias("docs"), F.sum("tokens").alias("tokens"))
    listed = target.where(F.col("source").isNotNull()).groupBy("source").agg(F.max("target_share").alias("target_share"), F.max("max_repeats").alias("max_repeats"))
    sources = [r.asDict() for r in listed.join(sums, "source", "left").collect()]
    rate = plan_mix([s | {"tokens": s["tokens"] or 0} for s in sources], total_tokens)
    for s in sources:
        s |= {"docs": s["docs"] or 0, "tokens": s["tokens"] or 0, "rate": rate.get(s["source"], 0.0)}
    spark = documents.sparkSession
    rows = [(k, int(r), float(r - int(r)), max(1, -(-next(s["docs"] for s in sources if s["source"] == k) // group))) for k, r in rate.items()]
    plan = spark.createDataFrame(rows, "source string, base int, p double, groups bigint")
    h = F.xxhash64(F.lit(SEED), "doc_id")
    drawn = pages.join(F.broadcast(plan), "source").withColumn("h", h).withColumn("g", F.pmod(F.col("h"), F.col("groups"))).drop("groups")
    schema = "doc_id bigint, source string, tokens bigint, base int, p double, h bigint, g bigint"
    drawn = drawn.select("doc_id", "source", "tokens", "base", "p", "h", "g")
    # kept, because the decided and the undecided pages go different ways
    flown = drawn.groupBy("source", "g").applyInPandas(lambda d: _fly(d, False), schema).checkpoint()
    undecided = (F.col("p") > 0) & (F.col("p") < 1)
    landed = flown.where(undecided).groupBy("source").applyInPandas(lambda d: _fly(d, True), schema)
    uses = (F.col("base") + F.round("p").cast("int")).alias("uses")
    chosen = flown.where(~undecided).unionByName(landed).select("doc_id", "source", "tokens", uses).where("uses > 0")
    return chosen, sources


def shares(chosen: DataFrame, sources: list[dict]) -> DataFrame:
    """The report: per listed source its target, what it has, what is used, and the share of the mixture's tokens it reaches."""
    spark = chosen.sparkSession
    s = spark.createDataFrame([(x["source"], x["target_share"], x["max_repeats"], x["docs"], x["tokens"]) for x in sources], "source string, target_share double, max_repeats int, docs bigint, tokens bigint")
    used = chosen.groupBy("source").agg(F.count(F.lit(1)).alias("docs_used"), F.sum("uses").cast("bigint").alias("uses"), F.sum(F.col("tokens") * F.col("uses")).alias("tokens_used"), F.max("uses").cast("bigint").alias("most_uses"))
    r = s.join(used, "source", "left").na.fill(0, ["docs_used", "uses", "tokens_used", "most_uses"]).withColumn("all_tokens", used.agg(F.sum("tokens_used")).scalar())
    return r.select("source", "target_share", "max_repeats", "docs", "tokens", "docs_used", "uses", "most_uses", "tokens_used", F.when(F.col("all_tokens") > 0, F.col("tokens_used") / F.col("all_tokens")).otherwise(F.lit(0.0)).alias("actual_share"))
