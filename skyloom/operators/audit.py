"""Append-only audit tables and the reads over them: runs, quality results, reconciliations."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skyloom import schemas
from skyloom.config import Settings
from skyloom.operators import quality


class Audit:
    """The audit tables under one folder. Appends never rewrite; a repeated append is harmless to every read here but counts."""

    TABLES = {"ingestion_runs": schemas.INGESTION_RUN, "quality_results": schemas.QUALITY_RESULT, "reconciliation_results": schemas.RECONCILIATION}

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root

    def append(self, name: str, df: DataFrame) -> None:
        schema: T.StructType = self.TABLES[name]
        cols = [F.col(f.name).cast(f.dataType).alias(f.name) if f.name in df.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in schema]
        df.select(*cols).coalesce(1).write.mode("append").parquet(f"{self.root}/{name}")

    def read(self, name: str) -> DataFrame:
        try:
            return self.spark.read.schema(self.TABLES[name]).parquet(f"{self.root}/{name}")
        except Exception as e:  # noqa: BLE001
            if "PATH_NOT_FOUND" in str(e):
                return self.spark.createDataFrame([], self.TABLES[name])
            raise

    def ingestion_run(self, source: str, mode: str, started: datetime, finished: datetime, produced: int, failed: int, error: str | None = None) -> None:
        """One run; it failed if any unit failed or an error is given."""
        status = "failed" if failed or error else "succeeded"
        self.append("ingestion_runs", self.spark.createDataFrame([(source, mode, status, started, finished, produced, failed, error)], schemas.INGESTION_RUN))

    def results(self, results: DataFrame, context: str, at: datetime, only_failures: bool = False) -> None:
        r = results.where("not passed") if only_failures else results
        self.append("quality_results", r.withColumns({"context": F.lit(context), "checked_at": F.lit(at)}))

    def reconciliation(self, topic: str, counts: DataFrame) -> None:
        self.append("reconciliation_results", counts.withColumn("topic", F.lit(topic)))


def recent_runs(runs: DataFrame, n: int = 20) -> DataFrame:
    return runs.orderBy(F.col("started_at").desc()).limit(n)


def latest_per(df: DataFrame, key: str, order: str) -> DataFrame:
    """The newest row of each key."""
    by = Window.partitionBy(key).orderBy(F.col(order).desc_nulls_last())
    return df.withColumn("_rn", F.row_number().over(by)).where("_rn = 1").drop("_rn")


def quality_failures(results: DataFrame, n: int = 50, width: int = 200) -> DataFrame:
    return results.where("not passed").withColumn("detail", F.left("detail", F.lit(width))).orderBy(F.col("checked_at").desc(), "table_name", "check_name").limit(n)


def quality_summary(results: DataFrame) -> DataFrame:
    """Checks, failed checks by severity and failed rows per table; the summaries of all checks are left out of the counts."""
    r = results.where("check_name <> 'all_checks'")
    failed = ~F.col("passed")
    return r.groupBy("table_name").agg(
        F.count(F.lit(1)).alias("checks"), F.count_if(failed & (F.col("severity") == "blocking")).alias("blocking_failed"), F.count_if(failed & (F.col("severity") == "warning")).alias("warnings_failed"), F.coalesce(F.sum(F.when(failed, F.col("rows_failed"))), F.lit(0)).alias("rows_failed")
    )


def produced(runs: DataFrame, sources: list[str]) -> DataFrame:
    """Messages produced by the given sources, 0 where there was no run."""
    return runs.where(F.col("source").isin(sources)).agg(F.coalesce(F.sum("produced"), F.lit(0)).alias("produced"))


def call_usage(calls: DataFrame) -> DataFrame:
    """Per outcome: calls, cache hits per input token read, and latency weighted by calls (``outcome, calls, input_tokens, cached_tokens, latency_ms``)."""
    n = F.sum("calls")
    read = F.sum(F.col("input_tokens") + F.col("cached_tokens"))
    return calls.groupBy("outcome").agg(n.alias("calls"), F.when(read > 0, F.sum("cached_tokens") / read).otherwise(F.lit(0.0)).alias("cache_hit_rate"), F.when(n > 0, F.sum(F.col("calls") * F.col("latency_ms")) / n).alias("latency_ms"))


def run_suite(tables: dict[str, DataFrame], settings: Settings, since: str | None = None) -> DataFrame:
    """The contracts of all tables given (forecast, observation, forecast_verification, accuracy_daily), over rows changed since, or all."""
    contracts = {"forecast": quality.forecast_contract(settings), "observation": quality.observation_contract(settings), "forecast_verification": quality.verification_contract(settings), "accuracy_daily": quality.accuracy_contract()}
    stamp = {"forecast": "updated_at", "observation": "updated_at", "forecast_verification": "computed_at", "accuracy_daily": "computed_at"}
    out = None
    for name, df in tables.items():
        d = df if since is None else df.where(F.col(stamp[name]) >= F.lit(since).cast("timestamp"))
        r = quality.validate(d, contracts[name])
        out = r if out is None else out.unionByName(r)
    return out


class Load:
    """Accounting of a load in units (a file, a date range, a place): one failing unit loses itself only; a rate limit ends the load."""

    def __init__(self) -> None:
        self.produced, self.failed, self.resume_from, self.errors = 0, 0, None, []

    def run(self, units: list, work: Callable, limited: Callable[[Exception], bool] = lambda e: False) -> Load:
        for u in units:
            try:
                self.produced += work(u)
            except Exception as e:  # noqa: BLE001
                self.failed += 1
                self.errors.append(f"{u}: {e}")
                if limited(e):
                    self.resume_from = u
                    break
        return self


def backfill_window(end: str, days: int | None = None, start: str | None = None) -> tuple[str, str]:
    """First and last day of a backfill: the given start, or ``days`` days up to the end."""
    if start is None:
        if not days or days < 1:
            raise ValueError("give a start or a number of days")
        start = str((datetime.fromisoformat(end) - timedelta(days=days - 1)).date())
    if start > end:
        raise ValueError("the start lies after the end")
    return start, end


def weighted_calls(locations: int, models: int, columns: int, days: int) -> float:
    """How many ordinary calls a backfill counts as: ten columns and fourteen days make one, in fractions too."""
    return locations * models * (columns / 10) * (days / 14)
