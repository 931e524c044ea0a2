"""Totals and weighted means over trailing periods, days without activity included."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyloom.functions.columns import number

#: Days that share a shuffle partition while the exploded contributions are combined.
BLOCK_DAYS = 64


def latest_per_day(df: DataFrame, entity: Sequence[str], day: str, n: str, value: str, computed: str) -> DataFrame:
    """One row per entity and day: the row computed last (ties: the larger count, then the larger value).

    NULL stamps are oldest, NULL counts are 0, NaN values are missing, rows without a day belong to no day and are left out.
    """
    best = F.max(F.struct(F.col(computed).alias("c"), F.coalesce(F.col(n).cast("long"), F.lit(0)).alias("n"), number(value).alias("v")))
    return (
        df.where(F.col(day).isNotNull())
        .groupBy(*[F.col(e).alias(f"e{i}") for i, e in enumerate(entity)], F.col(day).cast("date").alias("d"))
        .agg(best.alias("x"))
        .select(*[f"e{i}" for i in range(len(entity))], "d", F.col("x.n").alias("n"), F.col("x.v").alias("v"))
    )


def trailing_totals(df: DataFrame, entity: Sequence[str], day: str, n: str, value: str, computed: str, periods: Sequence[int] = (7, 30)) -> DataFrame:
    """For each entity and each day from its first to its last row: ``n_P`` and the ``n``-weighted mean ``mean_P`` of every period P.

    Method: each daily total is exploded onto the output days it influences, grouped by entity and day, and joined with
    calendar rows for zeros. Days are first laid out by entity and block of days, so that the explosion is combined
    map-side (about 1.5 rows per input row reach the shuffle instead of the longest period); a hot entity spreads over its
    blocks. The calendar meets the totals in that same grouping, which is also null-safe on the entity columns.

    Result: the entity columns, ``day`` as ``valid_date``, and per period ``n_P`` BIGINT and ``mean_P`` DOUBLE (NULL where no row
    of the period has both a count and a value); the weighted sum is rounded to 6 places first, so that the mean does not
    depend on the order of addition. An empty input gives no rows. Rows without a value count in ``n_P`` only.
    """
    keys = [f"e{i}" for i in range(len(entity))]
    longest = max(periods)
    daily = latest_per_day(df, entity, day, n, value, computed)
    block = F.floor(F.datediff("d", F.lit("1970-01-01").cast("date")) / BLOCK_DAYS)
    spread = daily.withColumn("b", block).repartition(*keys, "b").withColumn("k", F.explode(F.sequence(F.lit(0), F.lit(longest - 1))))
    weight = F.when(F.col("v").isNotNull(), F.col("n")).otherwise(F.lit(0))
    parts = []
    for p in periods:
        inside = F.col("k") < p
        parts += [
            F.when(inside, F.col("n")).otherwise(F.lit(0)).alias(f"n{p}"),
            F.when(inside, weight).otherwise(F.lit(0)).alias(f"w{p}"),
            F.when(inside, weight * F.coalesce("v", F.lit(0.0))).otherwise(F.lit(0.0)).alias(f"s{p}"),
        ]
    totals = spread.select(*keys, F.date_add("d", F.col("k")).alias("d"), F.lit(False).alias("cal"), *parts)
    zeros = [x for p in periods for x in (F.lit(0).cast("long").alias(f"n{p}"), F.lit(0).cast("long").alias(f"w{p}"), F.lit(0.0).alias(f"s{p}"))]
    calendar = (
        daily.groupBy(*keys)
        .agg(F.min("d").alias("lo"), F.max("d").alias("hi"))
        .select(*keys, F.explode(F.sequence("lo", "hi")).alias("d"))
        .select(*keys, "d", F.lit(True).alias("cal"), *zeros)
    )
    names = [f"{a}{p}" for p in periods for a in "nws"]
    sums = totals.unionByName(calendar).groupBy(*keys, "d").agg(F.max("cal").alias("cal"), *[F.sum(x).alias(x) for x in names])
    out = [F.col(f"e{i}").alias(e) for i, e in enumerate(entity)] + [F.col("d").alias("valid_date")]
    for p in periods:
        out += [F.col(f"n{p}").alias(f"n_{p}"), F.when(F.col(f"w{p}") > 0, F.round(f"s{p}", 6) / F.col(f"w{p}")).alias(f"mean_{p}")]
    return sums.where("cal").select(*out)
