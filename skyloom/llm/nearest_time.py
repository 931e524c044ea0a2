"""Pairing records of two tables by nearest time for the same entity within a tolerance."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from skyloom.functions.columns import DAY_US, int_floor_div, micros, number

TOLERANCE_US = 30 * 60 * 1_000_000
#: Times of one entity are sorted together within one such period; must not be below the tolerance.
BLOCK_US = DAY_US
#: Left rows of one entity and block beyond which they are spread over SALTS parts, each with the block's right records. At most
#: left rows / HOT_ROWS blocks can be hot, which bounds what is broadcast.
HOT_ROWS, SALTS = 1_000_000, 32


def nearest_pairs(left: DataFrame, right: DataFrame, tolerance_us: int = TOLERANCE_US, block_us: int = BLOCK_US, hot_rows: int = HOT_ROWS) -> DataFrame:
    """``left`` (``id``, ``entity``, ``t`` in microseconds) with the nearest ``right`` (``id``, ``entity``, ``t``, ``rank``) of its entity.

    Both tables are united and sorted per entity and time; the last and, in the opposite order, the next right-side record
    are carried onto the left rows and the nearer one within the tolerance (inclusive) is kept. Ties of distance go to the earlier
    record; of right records at one time the one with the smallest ``rank`` (any orderable value), then ``id`` counts.

    An entity is laid out in blocks of time, so none is gathered whole; a right record near a block's edge is also carried
    into the neighbouring block, a left row lies in its own block only. Blocks with very many left rows (copies, or a very
    frequent entity) are spread by salt, and their right records are repeated in every part. Left rows keep their number: ``right_id`` is NULL without a
    partner. NULL entities or times have no partner. Right records at one time are reduced map-side before the shuffle.
    """
    if block_us < tolerance_us:
        raise ValueError("a block must be at least as long as the tolerance")
    lb = left.withColumn("block", int_floor_div(F.col("t"), block_us))
    hot = lb.where(F.col("entity").isNotNull() & F.col("t").isNotNull()).groupBy("entity", "block").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > hot_rows)
    hot = F.broadcast(hot.select("entity", "block", F.lit(SALTS).alias("salts")))
    best = (
        right.where(F.col("entity").isNotNull() & F.col("t").isNotNull())
        .groupBy("entity", "t")
        .agg(F.min(F.struct("rank", "id")).alias("best"))
        .select("entity", "t", F.col("best.id").alias("rid"))
        .withColumn("block", F.explode(F.array_distinct(F.array(*[int_floor_div(F.col("t") + d, block_us) for d in (-tolerance_us, 0, tolerance_us)]))))
    )
    r = best.join(hot, ["entity", "block"], "left").select(
        "entity", "block", F.explode(F.sequence(F.lit(0), F.coalesce("salts", F.lit(1)) - 1)).alias("salt"), "t",
        F.struct(F.col("t").alias("t"), F.col("rid").alias("id")).alias("rec"), F.lit(None).cast("bigint").alias("id"), F.lit(0).alias("side"),
    )
    # rows without an entity or time meet nothing; they are spread by their id
    alone = F.col("entity").isNull() | F.col("t").isNull()
    salt = F.when(alone | F.col("salts").isNotNull(), F.pmod(F.xxhash64("id"), F.lit(SALTS)).cast("int")).otherwise(F.lit(0))
    l = lb.join(hot, ["entity", "block"], "left").select("entity", "block", salt.alias("salt"), "t", F.lit(None).cast(r.schema["rec"].dataType).alias("rec"), "id", F.lit(1).alias("side"))
    back = Window.partitionBy("entity", "block", "salt").orderBy("t", "side").rowsBetween(Window.unboundedPreceding, 0)
    ahead = Window.partitionBy("entity", "block", "salt").orderBy(F.col("t").desc(), "side").rowsBetween(Window.unboundedPreceding, 0)
    both = l.unionByName(r).withColumn("a", F.last("rec", ignorenulls=True).over(back)).withColumn("b", F.last("rec", ignorenulls=True).over(ahead)).where("side = 1")
    da, db = F.col("t") - F.col("a.t"), F.col("b.t") - F.col("t")
    near_a, near_b = F.coalesce(da <= tolerance_us, F.lit(False)), F.coalesce(db <= tolerance_us, F.lit(False))
    pick = F.when(near_a & (~near_b | (da <= db)), F.col("a")).when(near_b, F.col("b"))
    return both.select("id", pick.alias("p")).select("id", F.col("p.id").alias("right_id"), F.col("p.t").alias("right_t"))


def forecast_observation_pairs(forecast: DataFrame, observation: DataFrame, location: DataFrame, tolerance_us: int = TOLERANCE_US) -> DataFrame:
    """Every forecast row with a value and a lead of an hour or more, with its nearest observation row or NULL.

    The locations are a fixed dimension (one row per place); Spark broadcasts it as long as it is under its size limit and
    shuffles it beyond. NaN is no value. Corrections win a tie of time.
    """
    place = location.where(F.col("station").isNotNull()).select("location_id", "station")
    f = forecast.where(number("value").isNotNull() & (F.col("lead_hours") >= 1)).select("forecast_id", "location_id", "variable", "valid_time")
    left = f.join(place, "location_id", "left").select(F.col("forecast_id").alias("id"), F.when(F.col("station").isNotNull(), F.xxhash64("station", "variable")).alias("entity"), micros("valid_time").alias("t"))
    o = observation.where(number("value").isNotNull())
    right = o.select(F.col("observation_id").alias("id"), F.when(F.col("station").isNotNull() & F.col("variable").isNotNull(), F.xxhash64("station", "variable")).alias("entity"), micros("observed_at").alias("t"), (~F.coalesce("is_corrected", F.lit(False))).alias("rank"))
    pairs = nearest_pairs(left, right, tolerance_us)
    return pairs.select(F.col("id").alias("forecast_id"), F.col("right_id").alias("observation_id"))
