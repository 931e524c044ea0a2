"""Readings that cannot be true or do not fit what their own source usually shows."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from skyloom.functions.columns import DAY_US, HOUR_US, hex_id, int_floor_div, micros, number
from skyloom.functions.packing import series_median, whole_series

#: The usual change from one reading to the next is the series' own median change, but at least this (fixed values).
LEAST_CHANGE = {"temperature_2m": 0.5, "dew_point_2m": 0.5, "wind_speed_10m": 0.5, "pressure_msl": 30.0}
#: Changes are counted in bins of this part of the least change, so that their median needs a bounded number of counters a series.
BIN_PARTS = 100.0
#: Standardised innovation from which a reading is withheld from the filter, and which makes a spike of it if the level comes back.
WITHHOLD = 8.0
#: Part of a spike's innovation by which the reading after it may differ from the level before it.
BACK = 0.5
#: Growth of the innovation variance with each hour without a reading beyond the first, in squared usual changes, up to so many hours.
HOUR_VAR, MOST_HOURS = 0.4, 8.0
#: The filter's memory: readings further back than this cannot matter, however the readings between them lie.
MEMORY = 16
#: Different times over which the innovations must vanish for a value to count as stuck.
STUCK_TIMES = 6
#: A station's readings of one variable are cut into such blocks; what a block needs of its neighbours is carried over its edges.
BLOCK_US = 10 * DAY_US
#: Rows of one message beyond which its copies are reduced to distinct readings before they meet in one task. At most
#: rows / HOT_ROWS messages can be hot, which bounds what is broadcast.
HOT_ROWS = 1_000_000
_HEADER, _CONTEXT, _OWN = 0, 1, 2
_LOWEST = -(2**63)


def _back(x: np.ndarray, key: np.ndarray, by: int) -> np.ndarray:
    """The value ``by`` readings before in the same series, NaN before its start."""
    out = np.full(len(x), np.nan)
    ok = np.flatnonzero(key[by:] == key[:-by]) + by
    out[ok] = x[ok - by]
    return out


def kalman_spikes(key: np.ndarray, us: np.ndarray, v: np.ndarray, scale: np.ndarray) -> np.ndarray:
    """Mask of spikes among readings sorted by series and time; ``scale`` is each row's usual change.

    Local-level Kalman filter whose readings are sharp against the level's own steps: the gain is 1, the forecast is the last reading that
    was not withheld, and the innovation's deviation is the usual change, widened over hours without a reading. A reading whose
    standardised innovation reaches ``WITHHOLD`` does not update the level. Comes the next reading, or the one after it, back to the
    level (an innovation of at most ``BACK`` times the withheld one, which must reach ``WITHHOLD`` against that reading too and lie on the
    same side), the withheld readings are a spike. At a third reading off the level the change lasts: the level moves to the first
    withheld reading, from which the second may be a spike, alone or with the third.

    The state is how many readings are withheld, 0, 1 or 2; a reading near both readings before it leaves 0 whatever the
    state was. The state of each reading is found from the ``MEMORY`` readings before it, all series at once, so no result depends on
    where a series was cut, given that many readings.
    """
    n = len(v)
    out = np.zeros(n, bool)
    if n < 3:
        return out
    lim = WITHHOLD * np.where(scale > 0, scale, np.inf)
    hours = (us - _back(us.astype(float), key, 1)) / HOUR_US
    wide = np.sqrt(1.0 + HOUR_VAR * (np.clip(np.nan_to_num(hours, nan=1.0), 1.0, MOST_HOURS) - 1.0))
    wide2 = np.fmax(wide, _back(wide, key, 1))
    wide3 = np.fmax(wide2, _back(wide, key, 2))
    x1, x2, x3 = (_back(v, key, j) for j in (1, 2, 3))
    with np.errstate(invalid="ignore"):
        far1 = np.abs(v - x1) >= lim * wide
        far2 = (np.abs(v - x2) >= lim * wide2) & (np.abs(v - x2) > BACK * np.abs(x1 - x2))
        far3 = (np.abs(v - x3) >= lim * wide3) & (np.abs(v - x3) > BACK * np.fmin(np.abs(x1 - x3), np.abs(x2 - x3)))
    to = np.stack([far1, np.where(far2, 2, 0), np.where(far2 & far3, 2, 0)]).astype(np.int8)  # the state after a reading, by the state before it
    unsure = np.flatnonzero(far1 | far2)
    state = np.zeros(len(unsure), np.int8)
    for back in range(MEMORY - 1, -1, -1):
        at = unsure - back
        inside = (at >= 0) & (key[at] == key[unsure])
        state = np.where(inside, to[state, np.maximum(at, 0)], 0).astype(np.int8)
    now = unsure[state > 0] + 1  # the reading that may have come back
    withheld = state[state > 0]
    inside = (now < n) & (key[np.minimum(now, n - 1)] == key[now - 1])
    now, withheld = now[inside], withheld[inside]

    def back(i: np.ndarray, k: int, width: np.ndarray) -> np.ndarray:
        """Whether reading ``i`` is back at the level before the ``k`` readings before it, which are off both."""
        level, a, z, x = v[i - 1 - k], v[i - k], v[i - 1], v[i]
        off = np.minimum.reduce([np.abs(a - level), np.abs(a - x), np.abs(z - level), np.abs(z - x)])
        side = ((a - level) * (a - x) > 0) & ((z - level) * (z - x) > 0) & ((a - level) * (z - level) > 0)
        return side & (off >= lim[i] * width[i]) & (np.abs(x - level) <= BACK * off)

    two = np.zeros(len(now), bool)
    two[withheld == 2] = back(now[withheld == 2], 2, wide3)
    one = ~two & back(now, 1, wide2)
    out[now[one | two] - 1] = True
    out[now[two] - 2] = True
    return out


def usual_changes(key: np.ndarray, v: np.ndarray, least: np.ndarray) -> np.ndarray:
    """Each row's usual change: the median change of its series (in bins), at least ``least``."""
    scale = least.astype(float)
    if len(v) < 2:
        return scale
    same = key[1:] == key[:-1]
    if not same.any():
        return scale
    k, med = series_median(key[1:][same], change_bins(v, least)[same].astype(float))
    at = np.minimum(np.searchsorted(k, key), len(k) - 1)
    return np.maximum(scale, np.where(k[at] == key, med[at], 0.0) * _bin(least))


def _bin(least: np.ndarray) -> np.ndarray:
    return np.where(least > 0, least, 0.1).astype(float) / BIN_PARTS


def change_bins(v: np.ndarray, least: np.ndarray) -> np.ndarray:
    """The changes from one row to the next as numbers of bins."""
    return np.rint(np.abs(np.diff(v)) / _bin(least)[1:]).astype(np.int64)


class Runs:
    """Runs of one and the same value over readings sorted by series, time, ``low`` and value.

    Readings are distinct values of an instant, ``low`` and ``top`` the smallest and the greatest id of their rows. A run of several times
    enters and leaves an instant by the instant's first and last rows only: the first lie before the smallest id of the second value,
    the last after the greatest id of any other, and a value that was there before may come last again. In a run all
    innovations of the filter are 0: from ``STUCK_TIMES`` times on their variance has vanished.
    """

    def __init__(self, key: np.ndarray, us: np.ndarray, v: np.ndarray, low: np.ndarray, top: np.ndarray):
        n = len(v)
        self.v, self.low, self.top = v, low, top
        start = np.flatnonzero(np.r_[True, (key[1:] != key[:-1]) | (us[1:] != us[:-1])]) if n else np.zeros(0, int)
        self.end = np.r_[start[1:], n] - 1
        instant = np.repeat(np.arange(len(start)), self.end - start + 1)
        self.late = np.lexsort((v, top, instant))
        again = np.flatnonzero(self.late[self.end] != self.end) if n else np.zeros(0, int)
        last = self.late[self.end][again] if n else np.zeros(0, int)
        self.seq = np.r_[np.arange(n), last][np.argsort(np.r_[np.arange(n), self.end[again] + 0.5], kind="stable")].astype(int)
        self.instant = instant[self.seq]
        k, u, x = key[self.seq], us[self.seq], v[self.seq]
        new_key = np.r_[True, k[1:] != k[:-1]] if n else np.zeros(0, bool)
        new = new_key | np.r_[True, x[1:] != x[:-1]] if n else new_key
        self.run = np.cumsum(new) - 1
        self.times = np.bincount(self.run, weights=np.r_[1, (u[1:] != u[:-1]) | new[1:]]).astype(np.int64) if n else np.zeros(0, np.int64)
        first = np.flatnonzero(new_key)
        self.keys = k[first]
        self.first, self.last = self.run[first], (self.run[np.r_[first[1:], len(k)] - 1] if n else self.run[first])

    def carry(self, before: np.ndarray, after: np.ndarray) -> None:
        """Add the times that the first and last run of each series have beyond its edges."""
        self.times[self.first] += before
        np.add.at(self.times, self.last, after)

    def stuck(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The readings in runs that are stuck, and the smallest and the greatest id whose rows lie in the run."""
        hit = np.flatnonzero((self.times[self.run] >= STUCK_TIMES) & (self.v[self.seq] != 0)) if len(self.seq) else np.zeros(0, int)
        at, i = self.seq[hit], self.instant[hit]
        begin = np.r_[0, self.end[:-1] + 1].astype(int)
        first = np.r_[True, self.instant[1:] != self.instant[:-1]][hit] if len(self.seq) else np.zeros(0, bool)
        several = self.end[i] > begin[i]
        lo, hi = np.full(len(at), _LOWEST), np.full(len(at), 2**63 - 1)
        a, b = several & first, several & ~first
        other = begin[i[a]] + 1
        hi[a] = self.low[other] - (self.v[at[a]] > self.v[other])
        other = self.late[self.end[i[b]] - 1]
        lo[b] = self.top[other] + (self.v[at[b]] < self.v[other])
        return at, lo, hi


# ---- stations: blocks with what they need carried over their edges --------------------------------------------------------------
_EDGE = "struct<us: bigint, v: double, low: bigint>"
_SUMMARY = f"sk bigint, series bigint, b bigint, least float, head array<{_EDGE}>, tail array<{_EDGE}>, bins array<bigint>, counts array<bigint>, vf double, vl double, nf bigint, nl bigint, whole boolean"
_ROW = "sk bigint, kind int, us bigint, v double, low bigint, top bigint, bad boolean, least float"


def _summarise(t: pa.Table) -> pa.RecordBatch:
    """One row a block: its first and last readings within range, its changes, and the runs at its edges."""
    sk, series, b, us, v, low, top, bad, least = (t[c].to_numpy() for c in ("sk", "series", "b", "us", "v", "low", "top", "bad", "least"))
    r = Runs(sk, us, v, low, top)
    good = ~bad
    gk, gu, gv, gl, g_least = sk[good], us[good], v[good], low[good], least[good]
    step = change_bins(gv, g_least) if len(gv) else np.zeros(0, np.int64)
    out: dict[str, list] = {c: [] for c in ("head", "tail", "bins", "counts")}
    begin = np.flatnonzero(np.r_[True, sk[1:] != sk[:-1]])
    lo, hi = np.searchsorted(gk, sk[begin], "left"), np.searchsorted(gk, sk[begin], "right")
    edge = lambda i, j: [{"us": int(u), "v": float(x), "low": int(k)} for u, x, k in zip(gu[i:j], gv[i:j], gl[i:j])]
    for i, j in zip(lo.tolist(), hi.tolist()):
        out["head"].append(edge(i, min(j, i + 3)))
        out["tail"].append(edge(max(i, j - MEMORY - 3), j))
        bins, counts = np.unique(step[i : max(i, j - 1)], return_counts=True)
        out["bins"].append(bins.tolist())
        out["counts"].append(counts.tolist())
    vf, vl = (v[r.seq[np.searchsorted(r.run, x)]] for x in (r.first, r.last))
    columns = {"sk": sk[begin], "series": series[begin], "b": b[begin], "least": least[begin], **out, "vf": vf, "vl": vl, "nf": r.times[r.first], "nl": r.times[r.last], "whole": r.first == r.last}
    e = pa.list_(pa.struct([("us", pa.int64()), ("v", pa.float64()), ("low", pa.int64())]))
    types = {"head": e, "tail": e, "bins": pa.list_(pa.int64()), "counts": pa.list_(pa.int64())}
    return pa.record_batch({c: pa.array(x, types.get(c)) for c, x in columns.items()})


def _summaries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    return whole_series(batches, "sk", _summarise)


def _carried(summary: DataFrame) -> DataFrame:
    """The rows each block gets beside its own: a header (usual change of the series, times of its edge runs beyond its edges) and readings.

    Windows over a series see one row a block; blocks without a reading within range are passed over when readings are carried.
    """
    by = Window.partitionBy("series").orderBy("b")
    linked, next_ = F.coalesce(F.col("vf") == F.lag("vl").over(by), F.lit(False)), F.coalesce(F.col("vl") == F.lead("vf").over(by), F.lit(False))
    s = summary.withColumns({"linked": linked, "next": next_, "good": F.size("tail") > 0})
    s = s.withColumn("up", F.sum(F.when(F.col("whole") & F.col("linked"), 0).otherwise(1)).over(by))
    back = Window.partitionBy("series").orderBy(F.col("b").desc())
    s = s.withColumn("down", F.sum(F.when(F.col("whole") & F.col("next"), 0).otherwise(1)).over(back))
    s = s.withColumns({"t_up": F.sum("nl").over(Window.partitionBy("series", "up").orderBy("b")), "t_down": F.sum("nf").over(Window.partitionBy("series", "down").orderBy(F.col("b").desc()))})
    own = Window.partitionBy("series", "good").orderBy("b")
    before = F.flatten(F.collect_list("tail").over(own.rowsBetween(-MEMORY - 3, -1)))
    s = s.withColumns({
        "cin": F.when(F.col("linked"), F.lag("t_up").over(by)).otherwise(F.lit(0)), "cout": F.when(F.col("next"), F.lead("t_down").over(by)).otherwise(F.lit(0)),
        "before": F.slice(before, F.greatest(F.size(before) - (MEMORY + 2), F.lit(1)), MEMORY + 3), "after": F.slice(F.flatten(F.collect_list("head").over(own.rowsBetween(1, 3))), 1, 3),
    })
    width = F.when(F.col("least") > 0, F.col("least").cast("double")).otherwise(F.lit(0.1)) / BIN_PARTS
    last, first = F.element_at("before", -1), F.get("head", F.lit(0))
    over_edge = F.rint(F.abs(last["v"] - first["v"]) / width).cast("bigint")
    joined = F.size("before") > 0
    bins, counts = F.when(joined, F.array_append("bins", over_edge)).otherwise(F.col("bins")), F.when(joined, F.array_append("counts", F.lit(1).cast("bigint"))).otherwise(F.col("counts"))
    changes = s.where("good").select("series", "least", F.explode(F.arrays_zip(bins.alias("bin"), counts.alias("n"))).alias("c")).select("series", "least", "c.bin", "c.n")
    scale = changes.groupBy("series").agg((F.expr("percentile(bin, 0.5, n)") * F.max(width)).alias("median"))
    s = s.join(scale, "series", "left").withColumn("scale", F.greatest(F.col("least").cast("double"), F.coalesce("median", F.lit(0.0))))
    none = F.lit(None).cast("boolean")
    header = F.struct(F.lit(_HEADER).alias("kind"), F.lit(_LOWEST).alias("us"), F.col("scale").alias("v"), F.col("cin").cast("bigint").alias("low"), F.col("cout").cast("bigint").alias("top"))
    near = F.transform(F.concat("before", "after"), lambda e: F.struct(F.lit(_CONTEXT).alias("kind"), e["us"].alias("us"), e["v"].alias("v"), e["low"].alias("low"), e["low"].alias("top")))
    return s.select("sk", F.explode(F.concat(F.array(header), near)).alias("r"), "least").select("sk", "r.kind", "r.us", "r.v", "r.low", "r.top", F.coalesce(none, F.lit(False)).alias("bad"), "least")


def _flag_blocks(t: pa.Table) -> pa.RecordBatch:
    sk, kind, us, v, low, top, bad = (t[c].to_numpy() for c in ("sk", "kind", "us", "v", "low", "top", "bad"))
    head = np.flatnonzero(kind == _HEADER)
    block = np.searchsorted(head, np.arange(len(sk)), "right") - 1
    hit = bad & (kind == _OWN)
    good = np.flatnonzero(~bad & (kind != _HEADER))
    mask = kalman_spikes(sk[good], us[good], v[good], v[head][block[good]])
    hit[good] |= mask & (kind[good] == _OWN)
    own = np.flatnonzero(kind == _OWN)
    r = Runs(sk[own], us[own], v[own], low[own], top[own])
    mine = head[np.searchsorted(sk[head], r.keys)]
    r.carry(low[mine], top[mine])
    stuck, lo, hi = r.stuck()
    stuck = own[stuck]
    at = np.flatnonzero(hit)
    keep = ~hit[stuck]
    at, lo, hi = np.r_[at, stuck[keep]], np.r_[np.full(len(at), _LOWEST), lo[keep]], np.r_[np.full(len(at), 2**63 - 1), hi[keep]]
    return pa.record_batch({"sk": sk[at], "us": us[at], "v": v[at], "low": low[at], "top": top[at], "lo": lo, "hi": hi})


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    return whole_series(batches, "sk", _flag_blocks)


def _rows(df: DataFrame, variable: DataFrame, row_id: str, time: str, *more: str) -> DataFrame:
    least = F.lit(0.0)
    for name, x in LEAST_CHANGE.items():
        least = F.when(F.col("variable") == name, F.lit(x)).otherwise(least)
    rng = variable.select("variable", F.col("hard_min").alias("_lo"), F.col("hard_max").alias("_hi"))
    rows = df.where(number("value").isNotNull() & F.col(row_id).isNotNull()).select(F.col(row_id).alias("id"), "variable", micros(time).alias("us"), F.col("value").cast("double").alias("v"), *more)
    return rows.join(rng, "variable", "left").withColumn("bad", F.coalesce((F.col("v") < F.col("_lo")) | (F.col("v") > F.col("_hi")) | (F.abs("v") == float("inf")), F.lit(False))).withColumn("least", least.cast("float")).drop("_lo", "_hi")


def implausible_observations(observation: DataFrame, variable: DataFrame, block_us: int = BLOCK_US) -> DataFrame:
    """Ids of observation rows outside the hard range of their variable, in a spike, or in a stuck run.

    A series is a station and variable. Its rows are reduced map-side to distinct readings (time and value, the smallest and the greatest
    id of their rows), so copies never gather, and laid out in blocks of time, so a station with a third of all rows spreads over
    its blocks. A first pass tells of each block what its neighbours need: its last ``MEMORY`` + 3 and first 3 readings, its changes, and the
    runs at its edges; these go along the blocks of a series (one row each) and the second pass judges the readings. So neither a
    spike, nor a run of any length, nor the usual change depends on a block's edge. The rows behind flagged readings of several rows are
    found again by reading and range of ids; a reading of one row carries its id.

    A variable without a range has none; rows without a value, or without a time, pass (the latter are judged by range only); a
    NULL station is a station of its own.
    """
    r = _rows(observation, variable, "observation_id", "observed_at", "station")
    block = int_floor_div(F.col("us"), block_us)
    rows = r.where(F.col("us").isNotNull()).withColumns({"series": F.xxhash64("station", "variable"), "b": block}).withColumn("sk", F.xxhash64("series", "b"))
    readings = rows.groupBy("sk", "us", "v").agg(
        F.min("id").alias("low"), F.max("id").alias("top"), F.max("bad").alias("bad"), F.max("least").alias("least"), F.max("series").alias("series"), F.max("b").alias("b")
    )
    laid = readings.repartition("sk").sortWithinPartitions("sk", "us", "low", "v")
    carried = _carried(laid.mapInArrow(_summaries, _SUMMARY))
    own = readings.select("sk", F.lit(_OWN).alias("kind"), "us", "v", "low", "top", "bad", "least")
    found = own.unionByName(carried).drop("least").repartition("sk").sortWithinPartitions("sk", "us", "low", "v")
    found = found.mapInArrow(_blocks, "sk bigint, us bigint, v double, low bigint, top bigint, lo bigint, hi bigint")
    one = found.where("low = top").select(F.col("low").alias("id"))
    several = rows.select("sk", "us", "v", "id").join(found.where("low < top").select("sk", "us", "v", "lo", "hi"), ["sk", "us", "v"]).where("id between lo and hi").select("id")
    return one.unionByName(several).unionByName(r.where(F.col("us").isNull() & F.col("bad")).select("id"))


# ---- messages: short series, each in one task -----------------------------------------------------------------------------------
def _flag_messages(t: pa.Table) -> pa.RecordBatch:
    key, us, v, ident, bad, least = (t[c].to_numpy() for c in ("sk", "us", "v", "id", "bad", "least"))
    hit = bad.copy()
    good = np.flatnonzero(~bad)
    k, u, x = key[good], us[good], v[good]
    # one reading per series, time and value: copies neither lengthen a spike nor hide its neighbours
    tie = np.r_[False, (k[1:] == k[:-1]) & (u[1:] == u[:-1])] if len(k) else np.zeros(0, bool)
    reading = np.arange(len(k))
    if tie.any():
        among = np.flatnonzero(tie | np.r_[tie[1:], False])
        order = among[np.lexsort((among, x[among], u[among], k[among]))]
        first = np.r_[True, (k[order][1:] != k[order][:-1]) | (u[order][1:] != u[order][:-1]) | (x[order][1:] != x[order][:-1])]
        reading[order] = order[np.maximum.accumulate(np.where(first, np.arange(len(order)), 0))]
    single = np.flatnonzero(reading == np.arange(len(k)))
    mask = np.zeros(len(k), bool)
    mask[single] = kalman_spikes(k[single], u[single], x[single], usual_changes(k[single], x[single], least[good][single]))
    hit[good] |= mask[reading]
    return pa.record_batch({"sk": key[hit], "us": us[hit], "v": v[hit], "id": ident[hit]})


def _messages(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    return whole_series(batches, "sk", _flag_messages)


def implausible_forecasts(forecast: DataFrame, variable: DataFrame, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Ids of forecast rows outside the hard range of their variable or in a spike.

    A series is one message and variable and, for backfill, lead: one run of bounded length, which lies in one task. A row without a
    message id belongs to the run of its model, place and start. Where copies make a series longer than ``hot_rows``, its rows are
    first reduced map-side to distinct readings, these are judged, and the rows are found again by reading: both ways flag the same rows.
    """
    r = _rows(forecast, variable, "forecast_id", "valid_time", "source_event_id", "ingestion_mode", "lead_hours", "model", "location_id", "init_time")
    message = F.coalesce(hex_id("source_event_id"), F.concat_ws("|", "model", "location_id", F.col("init_time").cast("string")))
    lead = F.when(F.col("ingestion_mode") == "backfill", F.col("lead_hours"))
    rows = r.withColumn("sk", F.xxhash64(message, F.col("variable"), F.coalesce(lead, F.lit(-(2**31))))).select("sk", "us", "v", "id", "bad", "least")
    timed = rows.where(F.col("us").isNotNull())
    hot = timed.groupBy("sk").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > hot_rows).select("sk", F.lit(True).alias("hot"))
    marked = timed.join(F.broadcast(hot), "sk", "left")
    schema = "sk bigint, us bigint, v double, id bigint"
    few = marked.where(F.col("hot").isNull()).drop("hot").repartition("sk").sortWithinPartitions("sk", "us", "id", "v").mapInArrow(_messages, schema)
    many = marked.where("hot").drop("hot")
    readings = many.groupBy("sk", "us", "v").agg(F.min("id").alias("id"), F.max("bad").alias("bad"), F.max("least").alias("least"))
    found = readings.repartition("sk").sortWithinPartitions("sk", "us", "id", "v").mapInArrow(_messages, schema)
    # a semi join would be pushed below the filter on hot series and move every row
    again = many.select("sk", "us", "v", "id").join(found.select("sk", "us", "v"), ["sk", "us", "v"])
    return few.select("id").unionByName(again.select("id")).unionByName(rows.where(F.col("us").isNull() & F.col("bad")).select("id"))
