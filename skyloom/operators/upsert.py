"""Keyed upserts, scope syncs and keep-last deduplication as set operations."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skyloom.sources.versioned import VersionedTable


def keep_last(df: DataFrame, key: Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    """One row per key, the last in ``order`` (a total order: arrival, then an id)."""
    by = Window.partitionBy(*key).orderBy(*[(F.col(c) if isinstance(c, str) else c).desc_nulls_last() for c in order])
    return df.withColumn("_rn", F.row_number().over(by)).where("_rn = 1").drop("_rn")


def last_observations(df: DataFrame, order: Sequence[Column | str] = ("inserted_at", "observation_id")) -> DataFrame:
    """One row per report and quantity: a correction wins over an original however they arrived, then the last arrival."""
    return keep_last(df, ("station", "observed_at", "variable"), [F.coalesce("is_corrected", F.lit(False)), *order])


def correction_guard() -> Column:
    """Whether an incoming observation may replace the stored one: it is a correction, or the stored one is none."""
    return F.coalesce(F.col("new.is_corrected"), F.lit(False)) | ~F.coalesce(F.col("old.is_corrected"), F.lit(False))


def changed(values: Sequence[str]) -> Column:
    """Whether any value differs between the sides, NULLs compared as values."""
    out = F.lit(False)
    for c in values:
        out = out | ~F.col(f"old.{c}").eqNullSafe(F.col(f"new.{c}"))
    return out


def diff(
    old: DataFrame, new: DataFrame, key: Sequence[str], values: Sequence[str], now: datetime | str, *, guard: Column | None = None, changed_by: Sequence[str] | None = None,
    created: Sequence[str] = (), touched: Sequence[str] = (), kept: Sequence[str] = (), sync: bool = False,
) -> DataFrame:
    """The rows after an upsert of ``new`` into ``old`` with ``action`` (insert, update, keep, delete).

    One full outer join on the key (keys are not NULL; give one row per key on each side, see ``keep_last``). A stored row takes
    the incoming values if the ``guard`` (over ``old.*`` and ``new.*``) allows and any of ``changed_by`` (default: ``values``) differs;
    otherwise it stays as it is, stamps included. ``created`` columns are set to ``now`` on insert, ``touched`` on insert and update,
    ``kept`` never change after insert. With ``sync`` stored rows that are not in ``new`` are deleted, else they are kept.
    NaN never reaches a table: doubles are NULLed first.
    """
    at = F.lit(now).cast("timestamp")
    clean = lambda d: d.withColumns({c: F.when(~F.isnan(c), F.col(c)) for c, t in d.dtypes if t in ("double", "float") and c in values}) if any(t in ("double", "float") for _, t in d.dtypes) else d
    o = clean(old).withColumn("_here", F.lit(True)).alias("old")
    n = clean(new).withColumn("_here", F.lit(True)).alias("new")
    on = [F.col(f"old.{k}") == F.col(f"new.{k}") for k in key]
    is_old, is_new = F.col("old._here").isNotNull(), F.col("new._here").isNotNull()
    update = is_old & is_new & changed(changed_by or values)
    if guard is not None:
        update = update & guard
    action = F.when(~is_old, "insert").when(~is_new, "delete" if sync else "keep").when(update, "update").otherwise("keep")
    j = o.join(n, on, "full_outer").withColumn("action", action)
    take = F.col("action").isin("insert", "update")
    out = [F.coalesce(F.col(f"old.{k}"), F.col(f"new.{k}")).alias(k) for k in key]
    out += [F.when(take, F.col(f"new.{c}")).otherwise(F.col(f"old.{c}")).alias(c) for c in values]
    out += [F.when(F.col("action") == "insert", F.col(f"new.{c}")).otherwise(F.col(f"old.{c}")).alias(c) for c in kept]
    out += [F.when(F.col("action") == "insert", at).otherwise(F.col(f"old.{c}")).alias(c) for c in created]
    out += [F.when(take, at).otherwise(F.col(f"old.{c}")).alias(c) for c in touched]
    return j.select(*out, "action")


def apply(table: VersionedTable, rows: DataFrame, changes: DataFrame) -> dict[str, int]:
    """Write a ``diff`` to its table: only partitions with an insert, update or delete are rewritten, and nothing if there is none.

    ``rows`` is the diff, given a second time as ``changes`` because its counts decide what is written; pass the same checkpointed frame.
    """
    part = table.part().alias("_p")
    counts = changes.groupBy(part, "action").count().where("action <> 'keep'").collect()  # partitions x actions, not rows
    total: dict[str, int] = {}
    for r in counts:
        total[r["action"]] = total.get(r["action"], 0) + r["count"]
    parts = sorted({r["_p"] for r in counts})
    if parts:
        table.replace(rows.where(table.part().isin(parts) & (F.col("action") != "delete")).drop("action"), parts)
    return total


def upsert(table: VersionedTable, new: DataFrame, key: Sequence[str], values: Sequence[str], now: datetime | str, **how) -> dict[str, int]:
    """``diff`` and ``apply`` against the partitions that ``new`` touches; returns the number of rows per action."""
    parts = [r[0] for r in new.select(table.part()).distinct().collect()]  # partitions, not rows
    old = table.read(parts)
    columns = [*key, *values, *how.get("kept", ()), *how.get("created", ()), *how.get("touched", ())]
    rows = diff(old, new, key, values, now, **how).select(*columns, "action").checkpoint()
    return apply(table, rows, rows)


def insert_absent(table: VersionedTable, new: DataFrame, key: Sequence[str]) -> int:
    """Append rows whose key is not stored; stored ones are left alone."""
    parts = [r[0] for r in new.select(table.part()).distinct().collect()]
    old = table.read(parts)
    fresh = (new if old is None else new.join(old.select(*key), list(key), "left_anti")).dropDuplicates(list(key)).checkpoint()
    n = fresh.count()
    if n:
        touched = [r[0] for r in fresh.select(table.part()).distinct().collect()]
        stored = table.read(touched)
        table.replace(fresh if stored is None else stored.unionByName(fresh), touched)
    return n


def retention_cutoff(today: str, months: int | None) -> str | None:
    """First day of the oldest month to keep; nothing is dropped without a number of months."""
    if months is None:
        return None
    y, m = int(today[:4]), int(today[5:7]) - 1 - months
    return f"{y + m // 12:04d}-{m % 12 + 1:02d}-01"


def apply_retention(table: VersionedTable, today: str, months: int | None, dry_run: bool = False) -> list[str]:
    """Drop the daily partitions of whole months before the cutoff; returns them."""
    cut = retention_cutoff(today, months)
    old = [p for p in table.partitions() if cut and p < cut and p[:4].isdigit()]
    return old if dry_run else table.drop(old)
