"""Irregular readings onto a regular hourly grid by compact-kernel local linear regression."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyloom.functions.columns import HOUR_US, int_floor_div, micros, number

#: Half width of the kernel: a reading supports grid hours less than this far away.
BANDWIDTH_H = 1.5
#: Effective readings below which a fitted value is marked as insufficiently supported.
LEAST_SUPPORT = 1.5
VARIABLES = ("temperature_2m", "dew_point_2m", "wind_speed_10m", "pressure_msl")


def hourly_grid(df: DataFrame, variables: Sequence[str] = VARIABLES, bandwidth_h: float = BANDWIDTH_H, least_support: float = LEAST_SUPPORT) -> DataFrame:
    """One row per station, variable and full hour from the station's first to its last slot with any row.

    Each reading is indexed under the grid hours its kernel reaches (at most ``2 * bandwidth_h`` of them) and adds weighted
    moments there; the moments are combined map-side and the local line is solved in closed form per grid hour, so no
    group of readings is ever gathered. Columns: ``slot`` TIMESTAMP, ``value`` (fitted at the hour; the weighted mean where the
    readings do not fix a slope), ``support`` (effective number of readings, (sum w)^2 / sum w^2), ``n_in_slot`` (readings with a value
    from half an hour before, inclusive, to half an hour after, exclusive), ``missing`` (no such reading: ``value`` is then an
    interpolation, or NULL where nothing is near) and ``insufficient`` (less support than ``least_support``). Copies of a reading weigh as often as they occur. Rows without
    station or time are left out; a row with an unknown variable or without a value only extends its station's span.
    """
    rows = df.where(F.col("station").isNotNull() & F.col("observed_at").isNotNull()).select("station", "variable", number("value").alias("v"), micros("observed_at").alias("us"))
    half = HOUR_US // 2
    rows = rows.withColumn("own", int_floor_div(F.col("us") + half, HOUR_US))
    reach = int(bandwidth_h) + 1
    near = (
        rows.where(F.col("v").isNotNull() & F.col("variable").isin(*variables))
        .withColumn("k", F.explode(F.sequence(F.lit(-reach), F.lit(reach))))
        .withColumn("h", F.col("own") + F.col("k"))
        .withColumn("x", (F.col("us") - F.col("h") * HOUR_US) / float(HOUR_US))
        .where(F.abs("x") < bandwidth_h)
        .withColumn("w", F.pow(1 - F.pow(F.abs("x") / bandwidth_h, 3), 3))
    )
    moments = {"w": F.col("w"), "ww": F.col("w") * F.col("w"), "wx": F.col("w") * F.col("x"), "wxx": F.col("w") * F.col("x") * F.col("x"), "wv": F.col("w") * F.col("v"), "wxv": F.col("w") * F.col("x") * F.col("v")}
    part = near.select("station", "variable", "h", F.when(F.col("k") == 0, 1).otherwise(0).cast("long").alias("n"), F.lit(False).alias("grid"), *[e.alias(f"s_{k}") for k, e in moments.items()])
    grid = (
        rows.groupBy("station")
        .agg(F.min("own").alias("lo"), F.max("own").alias("hi"))
        .select("station", F.explode(F.array(*[F.lit(v) for v in variables])).alias("variable"), "lo", "hi")
        .select("station", "variable", F.explode(F.sequence("lo", "hi")).alias("h"))
        .select("station", "variable", "h", F.lit(0).cast("long").alias("n"), F.lit(True).alias("grid"), *[F.lit(0.0).alias(f"s_{k}") for k in moments])
    )
    s = part.unionByName(grid).groupBy("station", "variable", "h").agg(F.sum("n").alias("n"), F.max("grid").alias("grid"), *[F.sum(f"s_{k}").alias(k) for k in moments]).where("grid")
    det = F.col("w") * F.col("wxx") - F.col("wx") * F.col("wx")
    line = (F.col("wxx") * F.col("wv") - F.col("wx") * F.col("wxv")) / det
    fit = F.when(det > 1e-6 * F.col("w") * F.col("w"), line).when(F.col("w") > 0, F.col("wv") / F.col("w"))
    support = F.when(F.col("ww") > 0, F.col("w") * F.col("w") / F.col("ww")).otherwise(F.lit(0.0))
    return s.select(
        "station", "variable", F.timestamp_micros(F.col("h") * HOUR_US).alias("slot"), fit.alias("value"),
        support.alias("support"), F.col("n").alias("n_in_slot"), (F.col("n") == 0).alias("missing"), (F.round(support, 6) < least_support).alias("insufficient"),
    )
