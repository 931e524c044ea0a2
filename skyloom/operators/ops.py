"""Reconciliation of the lake with the tables, lineage of an event, and containment in runs."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import partial

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from skyloom.functions.columns import micros


def reconcile(expected: DataFrame, stored: DataFrame, key: Sequence[str]) -> DataFrame:
    """Numbers of distinct keys expected, stored, missing and extra; one full outer join of the distinct keys."""
    e = expected.select(*key).distinct().withColumn("_e", F.lit(1))
    s = stored.select(*key).distinct().withColumn("_s", F.lit(1))
    on = [e[k].eqNullSafe(s[k]) for k in key]
    j = e.join(s, on, "full_outer").agg(F.count("_e").alias("expected"), F.count("_s").alias("silver"), F.count(F.when(F.col("_s").isNull(), 1)).alias("missing"), F.count(F.when(F.col("_e").isNull(), 1)).alias("extra"))
    return j.withColumn("matched", (F.col("missing") == 0) & (F.col("extra") == 0))


def unexplained(stored: DataFrame, expected: DataFrame, key: Sequence[str]) -> DataFrame:
    """Stored rows that a rebuild from the lake would not bring back; a rebuild refuses while there are any."""
    return stored.join(expected.select(*key).distinct(), list(key), "left_anti")


def _newest_open(batches: Iterator[pa.RecordBatch], by: Sequence[str]) -> Iterator[pa.RecordBatch]:
    """The instants from which on another run is the newest open one, with that run; the runs come by key in order of their starts.

    Runs are held while they can still become the newest open one again: what is held is as deep as runs are nested.
    """
    held: list[tuple[int, int, tuple]] = []  # starts ascend and ends descend
    out: list[tuple] = []

    def close(until: int | None) -> None:
        """End the held runs that end before ``until``, or all; where one ends, the one below is the newest open one again."""
        while held and (until is None or held[-1][1] < until):
            end = held.pop()[1]
            if held and (until is None or end + 1 < until):
                out.append((end + 1, *held[-1]))

    for b in batches:
        keys = zip(*(b.column(c).to_pylist() for c in by))
        for key, first, s, f in zip(keys, *(b.column(c).to_pylist() for c in ("_first", "_s", "_f"))):
            close(None if first else s)
            while held and held[-1][1] <= f:  # ends within the new run and is older
                held.pop()
            held.append((s, f, key))
            out.append((s, *held[-1]))
        yield _changes(out, b.schema, by)
        out.clear()
    close(None)
    if out:
        yield _changes(out, b.schema, by)


def _changes(out: list[tuple], schema: pa.Schema, by: Sequence[str]) -> pa.RecordBatch:
    keys = [pa.array([x[3][i] for x in out], schema.field(c).type) for i, c in enumerate(by)]
    return pa.record_batch([*keys, *(pa.array([x[i] for x in out], pa.int64()) for i in range(3))], [*by, "_t", "_s", "_f"])


def containing_run(points: DataFrame, runs: DataFrame, point_id: str, time: str, by: Sequence[str]) -> DataFrame:
    """The newest run (``started_at``, ``finished_at``) of the same ``by`` keys that contains each point's time, or NULL.

    Runs may overlap and lie within one another: they are first cut into intervals that carry the newest run open there. Points and
    intervals are united and sorted by time within a key and the last interval is carried forward. Of runs that start together
    the longest stands for all; a run without an end, or that ends before its start, contains nothing.
    """
    r = runs.groupBy(*by, micros("started_at").alias("_s")).agg(F.max(micros("finished_at")).alias("_f")).where("_f >= _s")
    r = r.withColumn("_first", F.row_number().over(Window.partitionBy(*by).orderBy("_s")) == 1).select(*by, "_first", "_s", "_f")
    names = ", ".join(f"`{c}` {t}" for c, t in r.select(*by).dtypes)
    cut = r.mapInArrow(partial(_newest_open, by=tuple(by)), f"{names}, _t bigint, _s bigint, _f bigint")
    p = points.select(*by, F.col(time).alias("_t"), F.col(point_id).alias("_id"))
    u = p.select(*by, "_t", "_id", F.lit(None).cast("struct<started_at: timestamp, finished_at: timestamp>").alias("_r"), F.lit(1).alias("_side"))
    rec = F.struct(F.timestamp_micros("_s").alias("started_at"), F.timestamp_micros("_f").alias("finished_at"))
    u = u.unionByName(cut.select(*by, F.timestamp_micros("_t").alias("_t"), F.lit(None).cast(dict(points.dtypes)[point_id]).alias("_id"), rec.alias("_r"), F.lit(0).alias("_side")))
    w = Window.partitionBy(*by).orderBy("_t", "_side").rowsBetween(Window.unboundedPreceding, 0)
    c = u.withColumn("_c", F.last("_r", ignorenulls=True).over(w)).where("_side = 1")
    inside = F.col("_c.finished_at") >= F.col("_t")
    return c.select(F.col("_id").alias(point_id), *by, F.when(inside, F.col("_c.started_at")).alias("started_at"), F.when(inside, F.col("_c.finished_at")).alias("finished_at"))


def trace_accuracy(verification: DataFrame, accuracy: DataFrame) -> DataFrame:
    """Accuracy rows that the given verification rows fed (left semi)."""
    keys = ["valid_date", "location_id", "model", "variable", "lead_day"]
    return accuracy.join(verification.select(*keys).distinct(), keys, "left_semi")


def trace_event(event_id: str, forecast: DataFrame, verification: DataFrame, accuracy: DataFrame) -> dict[str, DataFrame]:
    """What became of an event's rows: the rows it wrote, by which event each key stands now, and the rows they fed."""
    key = ["model", "location_id", "init_time", "valid_time", "variable"]
    own = forecast.where(F.col("source_event_id") == event_id).select(*key).distinct()
    now = forecast.join(own, key, "left_semi").groupBy("source_event_id").agg(F.count(F.lit(1)).alias("rows"))
    fed = verification.join(own, key, "left_semi")
    return {"keys": own, "current": now, "verification": fed, "accuracy": trace_accuracy(fed, accuracy)}
