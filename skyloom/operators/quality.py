"""Quality contracts: predicates with severity, one pass per table, and a gate that quarantines whole messages."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skyloom.config import VARIABLES, Settings, Variable

EPS = 1e-6
BLOCKING, WARNING = "blocking", "warning"


@dataclass(frozen=True)
class Check:
    """A predicate a good row fulfils; NULL counts as fulfilled."""

    name: str
    severity: str
    good: Column


@dataclass(frozen=True)
class Contract:
    table: str
    checks: tuple[Check, ...]
    timestamps: tuple[str, ...] = ()
    integers: tuple[str, ...] = ()
    key: tuple[str, ...] = ()

    def frame_failures(self, df: DataFrame) -> list[str]:
        """What is wrong with the frame as a whole: times without a zone, whole numbers that are none."""
        types = {f.name: f.dataType for f in df.schema}
        bad = [f"timezone_aware:{c}" for c in self.timestamps if not isinstance(types.get(c), T.TimestampType)]
        return bad + [f"integer:{c}" for c in self.integers if not isinstance(types.get(c), T.IntegralType)]


class QualityError(ValueError):
    """A blocking failure; where messages are loaded it takes the way of a dead letter."""


def not_null(*cols: str) -> list[Check]:
    return [Check(f"not_null:{c}", BLOCKING, F.col(c).isNotNull()) for c in cols]


def finite(c: str, missing_ok: bool = True) -> Check:
    x = F.col(c).cast("double")
    ok = F.abs(x) != float("inf")
    return Check(f"finite:{c}", BLOCKING, x.isNull() | F.isnan(x) | ok if missing_ok else x.isNotNull() & ~F.isnan(x) & ok)


def known_variable(variables: Sequence[Variable] = VARIABLES) -> Check:
    return Check("known_variable", BLOCKING, F.coalesce(F.col("variable").isin(*[v.name for v in variables]), F.lit(False)))


def in_range(c: str, which: str, severity: str, variables: Sequence[Variable] = VARIABLES) -> Check:
    """Within the quantity's range, bounds included; a missing value or an unknown quantity passes."""
    x = F.col(c).cast("double")
    ok = F.lit(True)
    for v in variables:
        lo, hi = getattr(v, which)
        ok = F.when(F.col("variable") == v.name, x.isNull() | F.isnan(x) | x.between(lo, hi)).otherwise(ok)
    return Check(f"{which}_range:{c}", severity, ok)


def _close(a: Column, b: Column) -> Column:
    return F.abs(a - b) <= EPS * F.greatest(F.lit(1.0), F.abs(b))


def forecast_contract(s: Settings | None = None) -> Contract:
    s = s or Settings()
    key = ("model", "location_id", "init_time", "valid_time", "variable")
    checks = [*not_null(*key, "lead_hours"), finite("value"), known_variable(s.variables), in_range("value", "hard", BLOCKING, s.variables), in_range("value", "plausible", WARNING, s.variables), Check("lead_not_negative", WARNING, F.col("lead_hours") >= 0)]
    return Contract("forecast", tuple(checks), ("init_time", "valid_time"), ("lead_hours",), key)


def observation_contract(s: Settings | None = None) -> Contract:
    s = s or Settings()
    key = ("station", "observed_at", "variable")
    checks = [*not_null(*key, "is_corrected"), finite("value"), known_variable(s.variables), in_range("value", "hard", BLOCKING, s.variables), in_range("value", "plausible", WARNING, s.variables)]
    return Contract("observation", tuple(checks), ("observed_at",), (), key)


def verification_contract(s: Settings | None = None) -> Contract:
    s = s or Settings()
    key = ("model", "location_id", "init_time", "valid_time", "variable")
    values = ("forecast_value", "observed_value")
    checks = [
        *not_null(*key, *values, "error"), *[finite(c, False) for c in (*values, "error")], known_variable(s.variables),
        Check("offset_in_tolerance", BLOCKING, F.abs("obs_offset_seconds") <= s.tolerance_minutes * 60),
        Check("error_is_difference", BLOCKING, _close(F.col("error"), F.col("forecast_value") - F.col("observed_value"))),
        Check("lead_day_of_hours", BLOCKING, F.col("lead_day") == F.floor((F.col("lead_hours") + 23) / 24)), Check("lead_day_from_1", BLOCKING, F.col("lead_day") >= 1),
        *[in_range(c, "hard", BLOCKING, s.variables) for c in values], *[in_range(c, "plausible", WARNING, s.variables) for c in values],
    ]
    return Contract("forecast_verification", tuple(checks), ("init_time", "valid_time", "observed_at"), ("lead_hours", "lead_day"), key)


def accuracy_contract() -> Contract:
    key = ("valid_date", "location_id", "model", "variable", "lead_day")
    checks = [
        *not_null(*key, "n"), *[finite(c, False) for c in ("bias", "mae", "rmse")], Check("n_from_1", BLOCKING, F.col("n") >= 1), Check("lead_day_from_1", BLOCKING, F.col("lead_day") >= 1),
        Check("mae_not_negative", BLOCKING, F.col("mae") >= 0), Check("rmse_not_negative", BLOCKING, F.col("rmse") >= 0),
        Check("rmse_from_mae", BLOCKING, F.col("rmse") + EPS * F.greatest(F.lit(1.0), F.col("mae")) >= F.col("mae")), Check("mae_from_bias", BLOCKING, F.col("mae") + EPS * F.greatest(F.lit(1.0), F.abs("bias")) >= F.abs("bias")),
    ]
    return Contract("accuracy_daily", tuple(checks), (), ("lead_day",), key)


def _fails(c: Check) -> Column:
    return ~F.coalesce(c.good, F.lit(True))


def duplicate_keys(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their number; counted map-side."""
    return df.groupBy(*key).agg(F.count(F.lit(1)).alias("copies")).where("copies > 1")


def validate(df: DataFrame, contract: Contract, *, unique: bool = False) -> DataFrame:
    """One row per check and a summary ``all_checks`` per severity: rows checked and failed, passed, and a failing row as text.

    All checks are evaluated in one pass over the rows. A failure of the frame counts as all rows failed and leaves out the
    warnings; the summary then still reports what the row checks alone found. An empty frame gives no rows. ``unique`` adds the key's
    uniqueness, every copy of a repeated key counting as failed.
    """
    frame = contract.frame_failures(df)
    if unique and contract.key:
        df = df.withColumn("_copies", F.count(F.lit(1)).over(Window.partitionBy(*contract.key)))
    checks = list(contract.checks)
    if unique and contract.key:
        checks.append(Check("unique_key", BLOCKING, F.col("_copies") == 1))
    if frame:
        checks = [c for c in checks if c.severity == BLOCKING]
    show = F.left(F.to_json(F.struct(*[F.col(c) for c in df.columns if c != "_copies"])), F.lit(400))
    fails = {f"f{i}": _fails(c) for i, c in enumerate(checks)}
    marked = df.withColumns(fails) if checks else df
    cols = [F.count(F.lit(1)).alias("rows")]
    for i in range(len(checks)):
        cols.append(F.sum(F.col(f"f{i}").cast("bigint")).alias(f"n{i}"))
        cols.append(F.min(F.when(F.col(f"f{i}"), show)).alias(f"s{i}"))  # one example, made of failing rows only; a list would grow
    groups = {}
    for sev in (BLOCKING, WARNING):
        own = [i for i, c in enumerate(checks) if c.severity == sev]
        if own:
            any_ = F.col(f"f{own[0]}")
            for i in own[1:]:
                any_ = any_ | F.col(f"f{i}")
            cols.append(F.sum(any_.cast("bigint")).alias(f"all_{sev}"))
            groups[sev] = own
    t = marked.agg(*cols)
    out = [F.struct(F.lit(c.name).alias("check_name"), F.lit(c.severity).alias("severity"), F.col(f"n{i}").alias("rows_failed"), F.col(f"s{i}").alias("detail")) for i, c in enumerate(checks)]
    none = F.lit(None).cast("string")
    out += [F.struct(F.lit("all_checks").alias("check_name"), F.lit(sev).alias("severity"), F.col(f"all_{sev}").alias("rows_failed"), none.alias("detail")) for sev in groups]
    out += [F.struct(F.lit(x).alias("check_name"), F.lit(BLOCKING).alias("severity"), F.col("rows").alias("rows_failed"), none.alias("detail")) for x in frame]
    r = t.where("rows > 0").select("rows", F.explode(F.array(*out)).alias("c"))
    return r.select(F.lit(contract.table).alias("table_name"), "c.check_name", "c.severity", F.col("rows").alias("rows_checked"), "c.rows_failed", (F.col("c.rows_failed") == 0).alias("passed"), "c.detail")


def merge_results(results: DataFrame) -> DataFrame:
    """Results of parts of a table as one, by check and (where there is one) subject: rows add up, the first example in order of text stays."""
    key = [c for c in ("table_name", "check_name", "severity", "subject") if c in results.columns]
    return results.groupBy(*key).agg(F.sum("rows_checked").alias("rows_checked"), F.sum("rows_failed").alias("rows_failed"), F.min("detail").alias("detail")).withColumn("passed", F.col("rows_failed") == 0)


def blocked_rows(df: DataFrame, contract: Contract) -> Column:
    bad = F.lit(bool(contract.frame_failures(df)))
    for c in contract.checks:
        if c.severity == BLOCKING:
            bad = bad | _fails(c)
    return bad


def gate(df: DataFrame, contract: Contract, event: str = "source_event_id") -> tuple[DataFrame, DataFrame]:
    """Clean rows, and the ids of blocked events: one bad row quarantines its whole message.

    The blocked ids are few where data are sound; Spark picks the join by their size. A row without an event id is
    quarantined alone.
    """
    marked = df.withColumn("_bad", blocked_rows(df, contract))
    blocked = marked.where(F.col("_bad") & F.col(event).isNotNull()).select(event).distinct()
    clean = marked.where(~F.col("_bad")).drop("_bad").join(blocked, event, "left_anti").select(*df.columns)
    return clean, blocked


def freshness(newest: DataFrame, subjects: DataFrame, subject: str, time: str, now: str, limit_hours: float, context: str) -> DataFrame:
    """Whether each configured subject has data newer than the limit; a subject without any fails. Always a warning.

    One aggregate and a left join from the short list of subjects, instead of a lookup per subject.
    """
    top = newest.groupBy(subject).agg(F.max(time).alias("newest"))
    age = (F.unix_seconds(F.lit(now).cast("timestamp")) - F.unix_seconds("newest")) / 3600.0
    r = subjects.select(subject).distinct().join(top, subject, "left").withColumn("age_hours", age)
    return r.select(
        F.lit(context).alias("check_name"), F.col(subject).alias("subject"), "newest", "age_hours", (F.col("age_hours").isNotNull() & ~(F.col("age_hours") > limit_hours)).alias("passed"),
        F.when(F.col("newest").isNull(), F.lit("no data yet")).alias("detail"),
    )
