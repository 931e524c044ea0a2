"""The late-event operator on a live stream: keyed state per source, upserted aggregates, late rows set aside."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from skyloom import schemas
from skyloom.functions.columns import micros
from skyloom.operators.late_events import ALLOWED_LATENESS_US
from skyloom.sources.versioned import VersionedTable

_OUT = "station string, observation_id bigint, variable string, ev bigint, ar bigint, value double, is_corrected boolean, too_late boolean"
HOURS = schemas.flat("station string, variable string, hour timestamp, n_reports bigint, n_values bigint, min_value double, max_value double, mean_value double")


def _judge(lateness_us: int):
    def run(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        mark = state.get[0] if state.exists else None
        d = pd.concat(list(frames)).sort_values(["ar", "observation_id"], kind="stable", ignore_index=True)
        counts = d["ev"].where(d["ev"] <= d["ar"]).astype("Float64")
        # the watermark a row meets comes from strictly earlier arrivals only
        best = counts.groupby(d["ar"]).max().cummax().ffill()
        seen = best.shift(1)
        if mark is not None:
            seen = seen.fillna(mark).clip(lower=mark)
        at = d["ar"].map(seen)
        d["too_late"] = (d["ev"] < at - lateness_us).fillna(False).astype(bool)
        top = best.max()
        if not pd.isna(top):
            state.update((int(max(top, mark)) if mark is not None else int(top),))
        yield d[["station", "observation_id", "variable", "ev", "ar", "value", "is_corrected", "too_late"]]

    return run


def judged(stream: DataFrame, lateness_us: int = ALLOWED_LATENESS_US) -> DataFrame:
    """The live rows of a stream that arrives in order of ``inserted_at``, each with ``too_late``.

    The state of a source is one number, its greatest event time so far, kept as long as the query runs; it is small whatever the
    stream's volume. Within a micro-batch the rows of one source are ordered here, so a micro-batch bounds what one task holds.
    """
    rows = stream.where((F.col("ingestion_mode") == "live") & F.col("station").isNotNull() & F.col("observed_at").isNotNull() & F.col("inserted_at").isNotNull())
    flat = rows.select("station", "observation_id", "variable", micros("observed_at").alias("ev"), micros("inserted_at").alias("ar"), "value", F.coalesce("is_corrected", F.lit(False)).alias("is_corrected"))
    return flat.groupBy("station").applyInPandasWithState(_judge(lateness_us), _OUT, "mark bigint", "append", GroupStateTimeout.NoTimeout)


def start(stream: DataFrame, accepted: VersionedTable, dropped: VersionedTable, checkpoint: str, drain: bool = True, hours: VersionedTable | None = None) -> StreamingQuery:
    """Keep the last accepted row of every report (a correction wins) in ``accepted`` and late rows in ``dropped``, upserted batch by batch.

    The figures of the hours that a batch touches are upserted in ``hours`` (see ``HOURS``), after the reports they come from, so a
    batch that is run again repairs them. A partition of ``accepted`` must hold whole hours.
    """
    from skyloom.operators.upsert import insert_absent, keep_last

    def handle(batch: DataFrame, _: int) -> None:
        b = batch.withColumn("observed_at", F.timestamp_micros("ev")).checkpoint()
        insert_absent(dropped, b.where("too_late").drop("too_late"), ("observation_id",))
        new = b.where("not too_late").drop("too_late")
        parts = [r[0] for r in new.select(accepted.part()).distinct().collect()]
        if not parts:
            return
        stored = accepted.read(parts)
        both = new if stored is None else stored.unionByName(new)
        best = keep_last(both.dropDuplicates(["observation_id"]), ("station", "variable", "ev"), ["is_corrected", "ar", "observation_id"]).checkpoint()
        accepted.replace(best, parts)
        if hours is not None:
            _upsert_hours(hours, best, new)

    w = judged(stream).writeStream.outputMode("append").foreachBatch(handle).option("checkpointLocation", checkpoint)
    return (w.trigger(availableNow=True) if drain else w.trigger(processingTime="5 seconds")).start()


def _upsert_hours(hours: VersionedTable, best: DataFrame, new: DataFrame) -> None:
    """Replace the figures of the hours that ``new`` touches by those of the reports in ``best``; the other hours stay as they are."""
    hour = F.date_trunc("hour", F.timestamp_micros("ev"))
    touched = new.select(F.col("station").alias("_s"), F.col("variable").alias("_v"), hour.alias("_h")).distinct().checkpoint()
    same = F.col("station").eqNullSafe(F.col("_s")) & F.col("variable").eqNullSafe(F.col("_v")) & F.col("hour").eqNullSafe(F.col("_h"))
    fresh = hourly(best.withColumn("hour", hour).join(touched, same, "left_semi").drop("hour")).checkpoint()
    parts = [r[0] for r in fresh.select(hours.part()).distinct().collect()]
    stored = hours.read(parts)
    kept = fresh if stored is None else stored.join(touched, same, "left_anti").unionByName(fresh)
    hours.replace(kept, parts)


def hourly(accepted: DataFrame) -> DataFrame:
    """The hourly figures as the accepted rows stand now."""
    v = F.when(~F.isnan("value"), F.col("value"))
    return accepted.groupBy("station", "variable", F.date_trunc("hour", F.timestamp_micros("ev")).alias("hour")).agg(F.count(F.lit(1)).alias("n_reports"), F.count(v).alias("n_values"), F.min(v).alias("min_value"), F.max(v).alias("max_value"), F.avg(v).alias("mean_value"))
