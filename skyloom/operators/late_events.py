"""Event-time aggregates that are revised as late records arrive, with a cut-off for lateness per source."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from skyloom.functions.columns import DAY_US, HOUR_US, int_floor_div, micros, number

#: A source's watermark trails the greatest event time it has shown by this much.
ALLOWED_LATENESS_US = 3 * HOUR_US
#: Arrivals of one source within one such period are sorted together; what came before is carried in as one number.
ARRIVAL_BLOCK_US = DAY_US


def with_lateness(
    df: DataFrame, *, row_id: str = "observation_id", source: str = "station", event_time: str = "observed_at", arrival: str = "inserted_at",
    mode: str = "ingestion_mode", keep: tuple[str, ...] = (), lateness_us: int = ALLOWED_LATENESS_US,
) -> DataFrame:
    """The live rows with ``watermark_us`` (greatest event time of the source among strictly earlier arrivals) and ``too_late``.

    This is the keyed state of an event-time stream, replayed over a log of any size: the state of a source after a block
    of arrivals is one number, so arrivals are reduced first to their instants (combined map-side: copies and bunches are one
    row), these to blocks; the running maximum is carried over the few block rows of each source, and only the instants of one
    source and block are sorted together. A source with a third of all rows spreads over its blocks, and the rows meet their
    instant's watermark in a join, which Spark splits where an instant holds very many.

    Rows that arrive before they happen (a clock that runs ahead) do not raise the watermark. Rows without source,
    event time or arrival have no place in the order: they are not returned. Copies and ties of arrival see the same watermark.
    """
    names = {row_id, source, event_time, arrival, *keep}
    rows = (
        df.where((F.col(mode) == "live") & F.col(source).isNotNull() & F.col(event_time).isNotNull() & F.col(arrival).isNotNull())
        .select(*[F.col(c) for c in df.columns if c in names])
        .withColumn("_ev", micros(event_time))
        .withColumn("_ar", micros(arrival))
    )
    instants = (
        rows.groupBy(source, int_floor_div(F.col("_ar"), ARRIVAL_BLOCK_US).alias("_block"), "_ar")
        .agg(F.max(F.when(F.col("_ev") <= F.col("_ar"), F.col("_ev"))).alias("_top"))
    )
    before = Window.partitionBy(source).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    carry = instants.groupBy(source, "_block").agg(F.max("_top").alias("_m")).select(source, "_block", F.max("_m").over(before).alias("_carry"))
    inside = Window.partitionBy(source, "_block").orderBy("_ar").rowsBetween(Window.unboundedPreceding, -1)
    marks = (
        instants.withColumn("_in", F.max("_top").over(inside)).join(carry, [source, "_block"])
        .select(source, "_ar", F.greatest("_in", "_carry").alias("watermark_us"))
    )
    return (
        rows.join(marks, [source, "_ar"])
        .withColumn("too_late", F.coalesce(F.col("_ev") < F.col("watermark_us") - F.lit(lateness_us), F.lit(False)))
        .drop("_ev", "_ar")
    )


def hourly_revised(df: DataFrame, *, lateness_us: int = ALLOWED_LATENESS_US) -> DataFrame:
    """Hourly figures per station and variable by event time, as they stand after every accepted row has been merged.

    A report (station, time, variable) counts once: a correction beats an original however they arrived, then the later
    arrival, then the greater id. ``n_revisions`` counts accepted rows beyond the first of each report. Rows without a value
    count in ``n_reports`` only; an hour all of whose values are missing has NULL figures.
    """
    flagged = with_lateness(df, keep=("variable", "value", "is_corrected"), lateness_us=lateness_us).where(~F.col("too_late"))
    order = F.struct(F.coalesce("is_corrected", F.lit(False)), "inserted_at", "observation_id")
    report = flagged.groupBy("station", "variable", "observed_at").agg(F.max_by(number("value"), order).alias("value"), F.count(F.lit(1)).alias("copies"))
    return report.groupBy("station", "variable", F.date_trunc("hour", "observed_at").alias("hour")).agg(
        F.count(F.lit(1)).alias("n_reports"),
        F.count("value").alias("n_values"),
        F.sum(F.col("copies") - 1).alias("n_revisions"),
        F.min("value").alias("min_value"),
        F.max("value").alias("max_value"),
        F.avg("value").alias("mean_value"),
    )
