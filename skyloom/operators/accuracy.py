"""Accuracy figures, their exact recombination over windows, and rankings of models."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

KEYS = ("valid_date", "location_id", "model", "variable", "lead_day")


def figures(error: str = "error") -> list[Column]:
    e = F.col(error)
    return [F.count(F.lit(1)).alias("n"), F.avg(e).alias("bias"), F.avg(F.abs(e)).alias("mae"), F.sqrt(F.avg(e * e)).alias("rmse")]


def daily(verification: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """Number, bias, MAE and RMSE per UTC day of validity, place, model, quantity and lead day."""
    return verification.groupBy(*keys).agg(*figures())


def latest(accuracy: DataFrame) -> DataFrame:
    """The row computed last of each day and series."""
    rest = [c for c in accuracy.columns if c not in (*KEYS, "computed_at")]
    return accuracy.groupBy(*KEYS).agg(F.max_by(F.struct(*rest), "computed_at").alias("x")).select(*KEYS, "x.*")


def recombine(accuracy: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Figures over any grouping from daily ones, exactly those of the errors behind them. Rows that count nothing count nothing."""
    a = accuracy.where((F.col("n") > 0) & F.col("mae").isNotNull() & F.col("bias").isNotNull() & F.col("rmse").isNotNull() & ~F.isnan("mae"))
    n = F.sum(F.col("n").cast("bigint"))
    return a.groupBy(*keys).agg(
        n.alias("n"), (F.sum(F.col("n") * F.col("bias")) / n).alias("bias"), (F.sum(F.col("n") * F.col("mae")) / n).alias("mae"), F.sqrt(F.sum(F.col("n") * F.col("rmse") * F.col("rmse")) / n).alias("rmse")
    )


def _last_day(accuracy: DataFrame) -> Column:
    """The last verified day, as a scalar subquery."""
    return accuracy.agg(F.max("valid_date")).scalar()


def leaderboard(accuracy: DataFrame, windows: Sequence[int] = (7, 30)) -> DataFrame:
    """Figures of every model per window that ends on the last verified day (``valid_date > end - days``), ranked by MAE.

    The windows are exploded onto the rows they hold (a row in both counts in both).
    """
    inside = accuracy.withColumn("window_end", _last_day(accuracy)).withColumn("window_days", F.explode(F.array(*[F.lit(w) for w in windows])))
    inside = inside.where(F.col("valid_date") > F.date_add("window_end", -F.col("window_days")))
    r = recombine(inside, ("window_days", "window_end", "location_id", "variable", "lead_day", "model"))
    by = Window.partitionBy("window_days", "location_id", "variable", "lead_day").orderBy("mae")
    return r.withColumn("mae_rank", F.rank().over(by).cast("bigint"))


def ranking(accuracy: DataFrame, variable: str, window_days: int, lead: int | None = None, location_id: str | None = None, by: Sequence[str] = ("model",)) -> DataFrame:
    """Models by MAE over one window, over all places or one; ``position`` counts 1, 2, 3 also among equals (then by model)."""
    a = accuracy.withColumn("window_end", _last_day(accuracy)).where((F.col("variable") == variable) & (F.col("valid_date") > F.date_add("window_end", -window_days)))
    if lead is not None:
        a = a.where(F.col("lead_day") == lead)
    if location_id is not None:
        a = a.where(F.col("location_id") == location_id)
    r = recombine(a, by)
    return r.withColumn("position", F.row_number().over(Window.partitionBy(*[c for c in by if c != "model"]).orderBy("mae", "model")).cast("bigint"))


def best_by_location(accuracy: DataFrame, location: DataFrame, variable: str, window_days: int, lead: int) -> DataFrame:
    """The best model of each place (all of them in a tie) with its margin to the next, NULL where there is no next."""
    a = accuracy.withColumn("window_end", _last_day(accuracy)).where((F.col("variable") == variable) & (F.col("lead_day") == lead) & (F.col("valid_date") > F.date_add("window_end", -window_days)))
    r = recombine(a, ("location_id", "model"))
    w = Window.partitionBy("location_id").orderBy("mae", "model")
    ranked = r.withColumns({"r": F.rank().over(Window.partitionBy("location_id").orderBy("mae")), "margin": F.lead("mae").over(w) - F.col("mae")})
    return ranked.where("r = 1").join(location.select("location_id", "name"), "location_id").select("location_id", "name", F.col("model").alias("best_model"), "n", "mae", "margin")


def over_days(accuracy: DataFrame, as_of: str, days: int, variable: str, lead: int) -> DataFrame:
    """Figures per model and place over the ``days`` whole UTC days before the day of ``as_of``."""
    end = F.to_date(F.lit(as_of).cast("timestamp"))
    a = accuracy.where((F.col("variable") == variable) & (F.col("lead_day") == lead) & (F.col("valid_date") >= F.date_add(end, -days)) & (F.col("valid_date") < end))
    return recombine(a, ("location_id", "model"))
