"""The same quantity recorded in different units and scales, brought to m/s and Pa."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyloom.functions.columns import number
from skyloom.functions.packing import Packed, whole_series

#: Unit -> factor to m/s or Pa, and the spellings of its name without blanks, dots and case.
WIND = {"kt": 1852 / 3600, "m/s": 1.0, "km/h": 1 / 3.6, "mph": 0.44704}
PRESSURE = {"inHg": 3386.389, "inHg/100": 33.86389, "hPa": 100.0, "kPa": 1000.0, "Pa": 1.0, "mmHg": 133.322387415}
SPELLINGS = {
    "kt": ("kt", "kts", "kn", "knot", "knots"),
    "m/s": ("m/s", "mps", "ms-1", "m/sec", "mpers", "meterspersecond", "metrespersecond"),
    "km/h": ("km/h", "kmh", "kmh-1", "kph", "kmph", "km/hr", "kmperh"),
    "mph": ("mph", "mp/h", "mi/h", "mih-1", "milesperhour"),
    "inHg": ("inhg", "in", "inchhg", "inches", "incheshg", "inch", '"hg', '"'),
    "hPa": ("hpa", "mb", "mbar", "mbars", "millibar", "millibars", "hectopascal", "hectopascals"),
    "kPa": ("kpa", "kilopascal", "kilopascals"),
    "Pa": ("pa", "pascal", "pascals"),
    "mmHg": ("mmhg", "torr"),
}
USUAL = {"sknt": "kt", "alti": "inHg", "wind_speed_10m": "km/h", "pressure_msl": "hPa"}
#: Log level around which a quantity lies in SI units, its spread, the spread of its change between readings, and the most that a
#: change can count: wind may fall calm, so no jump outweighs a stated unit; pressure cannot jump by a unit's factor.
LEVEL = {"wind": (np.log(4.0), 1.5, 1.0, 2.0), "pressure": (np.log(101_325.0), 0.05, 0.02, 10.0)}
#: Log odds: of a stated unit, of the usual unit where none is stated, of report text, of a switch from one reading to the next.
LABEL, USUALLY, REPORT, SWITCH = 12.0, 4.0, 10.0, 0.7
STATES = {"wind": list(WIND), "pressure": list(PRESSURE)}
KIND = {"sknt": "wind", "wind_speed_10m": "wind", "alti": "pressure", "pressure_msl": "pressure"}


def stated_unit(text: Column) -> Column:
    """The unit a label or the rest of a cell states, NULL where it states none that is known."""
    bare = F.regexp_replace(F.regexp_replace(F.lower(text), "⁻¹|\\^-1", "-1"), "[\\s._()]", "")
    table = F.create_map(*[F.lit(x) for unit, names in SPELLINGS.items() for n in names for x in (n, unit)])
    return F.element_at(table, bare)


def _archive_readings(asos: DataFrame) -> DataFrame:
    """Cells of the archive file: the number, the unit written in the cell, and what the report text says of the same reading."""
    wind = "(?:^|\\s)(?:\\d{3}|VRB)(\\d{2,3})(?:G\\d{2,3})?(KT|MPS|KMH)\\b"
    parts = []
    for field in ("sknt", "alti"):
        cell = F.col(field)
        value = F.regexp_extract(cell, "^\\s*([-+]?(?:\\d+\\.?\\d*|\\.\\d+))", 1)
        rest = F.regexp_extract(cell, "^\\s*[-+]?(?:\\d+\\.?\\d*|\\.\\d+)\\s*(.*?)\\s*$", 1)
        if field == "sknt":
            said = F.regexp_extract("metar", wind, 1).try_cast("double")
            unit = F.regexp_extract("metar", wind, 2)
            si = said * F.when(unit == "KT", WIND["kt"]).when(unit == "MPS", WIND["m/s"]).when(unit == "KMH", WIND["km/h"])
        else:
            inches = F.regexp_extract("metar", "(?:^|\\s)A(\\d{4})\\b", 1).try_cast("double") * PRESSURE["inHg/100"]
            si = F.coalesce(inches, F.regexp_extract("metar", "(?:^|\\s)Q(\\d{4})\\b", 1).try_cast("double") * PRESSURE["hPa"])
        parts.append(F.struct(F.lit(field).alias("field_name"), value.try_cast("double").alias("x"), stated_unit(rest).alias("label"), si.alias("said")))
    return asos.select(
        F.lit("iem_asos_sample").alias("table_name"), F.col("record_id"), F.xxhash64(F.lit("a"), F.col("station")).alias("device"),
        F.unix_seconds(F.try_to_timestamp("valid", F.lit("yyyy-MM-dd HH:mm"))).alias("at"), F.explode(F.array(*parts)).alias("r"),
    ).select("table_name", "record_id", "device", "at", "r.*")


def _response_readings(om: DataFrame) -> DataFrame:
    """One reading per response and field: the mean of the numbers of its array, with the label of the response."""
    parts = []
    for field in ("wind_speed_10m", "pressure_msl"):
        nums = F.filter(F.col(f"hourly.{field}"), lambda v: v.isNotNull() & ~F.isnan(v))
        mean = F.aggregate(nums, F.lit(0.0), lambda a, v: a + v) / F.size(nums)
        parts.append(F.struct(F.lit(field).alias("field_name"), F.when(F.size(nums) > 0, mean).alias("x"), stated_unit(F.element_at("hourly_units", field)).alias("label"), F.lit(None).cast("double").alias("said")))
    at = F.unix_seconds(F.try_to_timestamp(F.get("hourly.time", F.lit(0)), F.lit("yyyy-MM-dd'T'HH:mm")))
    return om.select(
        F.lit("open_meteo_forecast_response").alias("table_name"), F.col("response_id").alias("record_id"), F.xxhash64(F.lit("o"), F.col("model"), F.col("location_id")).alias("device"), at.alias("at"), F.explode(F.array(*parts)).alias("r"),
    ).select("table_name", "record_id", "device", "at", "r.*")


def viterbi_units(kind: str, key: np.ndarray, x: np.ndarray, label: np.ndarray, said: np.ndarray, usual: np.ndarray) -> np.ndarray:
    """The most likely unit (index into the kind's states) of each reading, rows sorted by device and time.

    Hidden state: the unit. A state's own score comes from the stated unit (-1: none), the report's value of the same reading (NaN: none) and
    the level the value would mean; the step between two readings is scored by the jump of the log level their units would
    mean, and by whether the unit switches. Values of 0 and below have no log level and are judged by statement alone.
    """
    names = STATES[kind]
    factor = np.array([(WIND if kind == "wind" else PRESSURE)[u] for u in names])
    mu, spread, jump_spread, jump_most = LEVEL[kind]
    n, k = len(x), len(names)
    with np.errstate(divide="ignore", invalid="ignore"):
        lv = np.where(x > 0, np.log(np.where(x > 0, x, 1.0)), np.nan)[:, None] + np.log(factor)[None, :]
    own = np.where(np.isnan(lv), 0.0, -0.5 * np.square((lv - mu) / spread))
    state = np.arange(k)[None, :]
    own -= np.where(label[:, None] >= 0, np.where(label[:, None] == state, 0.0, LABEL), np.where(usual[:, None] == state, 0.0, USUALLY))
    expect = said[:, None] / factor[None, :]
    tol = 0.1 if kind == "wind" else np.maximum(np.abs(expect) * 0.01, 1e-9)
    miss = np.minimum(0.5 * np.square((x[:, None] - expect) / tol), REPORT)
    own -= np.where(np.isnan(miss), 0.0, miss)
    p = Packed(key)
    best = np.zeros(n, np.int64)
    came = np.zeros((n, k), np.int64)
    score = np.zeros((len(p.start), k))
    change = SWITCH * (1 - np.eye(k))
    for t in range(len(p.alive)):
        a = p.alive[t]
        r = p.start[:a] + t
        if t == 0:
            score[:a] = own[r]
            continue
        jump = lv[r][:, None, :] - lv[r - 1][:, :, None]
        step = score[:a][:, :, None] - change[None] - np.where(np.isnan(jump), 0.0, np.minimum(0.5 * np.square(jump / jump_spread), jump_most))
        came[r] = step.argmax(axis=1)
        score[:a] = step.max(axis=1) + own[r]
    now = score.argmax(axis=1) if len(p.start) else np.zeros(0, int)
    for t in range(len(p.alive) - 1, -1, -1):
        a = p.alive[t]
        r = p.start[:a] + t
        best[r] = now[:a]
        now[:a] = came[r, now[:a]]
    return best


def _decode(t: pa.Table) -> pa.RecordBatch:
    field = t["field_name"].to_numpy(zero_copy_only=False)
    label = t["label"].to_numpy(zero_copy_only=False)
    out = np.empty(t.num_rows, object)
    for kind, states in STATES.items():
        code = {u: i for i, u in enumerate(states)}
        rows = np.flatnonzero(np.array([KIND[f] == kind for f in field], bool))
        if len(rows):
            got = viterbi_units(
                kind, t["sk"].to_numpy()[rows], t["x"].to_numpy()[rows], np.array([code.get(u, -1) for u in label[rows]]),
                t["said"].to_numpy(zero_copy_only=False)[rows].astype(float), np.array([code[USUAL[f]] for f in field[rows]]),
            )
            out[rows] = np.array(states, object)[got]
    return pa.record_batch([*(t[c].combine_chunks() for c in ("table_name", "record_id", "field_name", "x")), pa.array(out, pa.string())], ["table_name", "record_id", "field_name", "x", "unit"])


def decoded(asos: DataFrame, om: DataFrame) -> DataFrame:
    """Every reading of wind and pressure with its decoded ``unit`` and the field's ``usual`` one.

    Method: a hidden Markov model per device (station, or model and place) and field, decoded by Viterbi over the readings in order
    of time; see ``viterbi_units``. A device is decoded month by month, so one with a third of all rows is no single task. Cells and arrays
    without a number have no unit and are not returned; repeated records are decoded each; a label nobody knows counts as
    none; readings without a time come first.
    """
    r = _archive_readings(asos).unionByName(_response_readings(om)).where(F.col("x").isNotNull() & ~F.isnan("x"))
    month = F.floor(F.coalesce("at", F.lit(0)) / (30 * 86_400))
    laid = r.withColumn("sk", F.xxhash64("device", "field_name", month)).repartition("sk").sortWithinPartitions("sk", "at", "record_id")
    got = laid.mapInArrow(_decode_all, "table_name string, record_id bigint, field_name string, x double, unit string")
    usual = F.create_map(*[F.lit(v) for kv in USUAL.items() for v in kv])
    return got.withColumn("usual", F.element_at(usual, F.col("field_name")))


def _decode_all(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    return whole_series(batches, "sk", _decode)


def to_si(value: Column, unit: Column) -> Column:
    """The value in m/s or Pa."""
    factors = F.create_map(*[F.lit(v) for kv in (WIND | PRESSURE).items() for v in kv])
    return value * F.element_at(factors, unit)


def converted(asos: DataFrame, om: DataFrame) -> DataFrame:
    """Every single value in m/s or Pa: one row per archive cell, and per response and hour (``pos`` its place in the array, 0 for a cell)."""
    d = decoded(asos, om)
    cells = d.where("table_name = 'iem_asos_sample'").select("table_name", "record_id", "field_name", F.lit(0).cast("bigint").alias("pos"), "unit", to_si(F.col("x"), F.col("unit")).alias("si_value"))
    fields = F.array(*[F.struct(F.lit(f).alias("field_name"), F.col(f"hourly.{f}").alias("xs")) for f in ("wind_speed_10m", "pressure_msl")])
    arrays = om.select(F.col("response_id").alias("record_id"), F.explode(fields).alias("f")).select("record_id", "f.field_name", F.posexplode("f.xs").alias("pos", "v"))
    hours = arrays.join(d.where("table_name = 'open_meteo_forecast_response'").select("table_name", "record_id", "field_name", "unit"), ["record_id", "field_name"])
    values = hours.where(number("v").isNotNull()).select("table_name", "record_id", "field_name", F.col("pos").cast("bigint").alias("pos"), "unit", to_si(F.col("v"), F.col("unit")).alias("si_value"))
    return cells.unionByName(values)
