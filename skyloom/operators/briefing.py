"""Facts about the coming hours of a place, and the check that a text states only numbers that are among them."""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterable
from decimal import ROUND_HALF_UP, Decimal

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyloom.config import Settings
from skyloom.functions.columns import number
from skyloom.sources.parse import display, display_error


def latest_forecasts(forecast: DataFrame, as_of: str, hours: int) -> DataFrame:
    """Per place, model, quantity and hour in ``(as_of, as_of + hours]`` the value of the latest run started at or before ``as_of``."""
    t = F.unix_seconds(F.lit(as_of).cast("timestamp"))
    f = forecast.where(number("value").isNotNull() & (F.unix_seconds("init_time") <= t) & (F.unix_seconds("valid_time") > t) & (F.unix_seconds("valid_time") <= t + hours * 3600))
    tie = [F.col(c) for c in ("init_time", "inserted_at", "forecast_id") if c in forecast.columns]
    return f.groupBy("location_id", "model", "variable", "valid_time").agg(F.max_by("value", F.struct(*tie)).alias("value"))


def model_summaries(latest: DataFrame) -> DataFrame:
    """Least, mean and greatest value per place, model and quantity in display units."""
    v = display("value", "variable")
    return latest.groupBy("location_id", "model", "variable").agg(F.min(v).alias("min"), F.avg(v).alias("mean"), F.max(v).alias("max"), F.count(F.lit(1)).alias("hours"))


def spread(latest: DataFrame) -> DataFrame:
    """Mean and greatest span between models over the hours for which at least two speak, in display units."""
    hour = latest.groupBy("location_id", "variable", "valid_time").agg((F.max("value") - F.min("value")).alias("span"), F.countDistinct("model").alias("models")).where("models >= 2")
    d = display_error("span", "variable")
    return hour.groupBy("location_id", "variable").agg(F.avg(d).alias("mean_spread"), F.max(d).alias("max_spread"), F.max("models").alias("models"))


def confidence(mean_spread: float | None, models: int, s: Settings) -> str:
    """low without two models or a spread; else by the rounded mean spread of the temperature."""
    if models < 2 or mean_spread is None:
        return "low"
    return "high" if mean_spread <= s.high_confidence_spread else "medium" if mean_spread <= s.medium_confidence_spread else "low"


def fact_sheets(latest: DataFrame, accuracy_30d: DataFrame, alerts: DataFrame, as_of: str, s: Settings) -> DataFrame:
    """One nested JSON document per place with its canonical hash.

    The parts are aggregated where they lie; per place only a few dozen rows remain, which one Arrow pass turns into
    text: rounding to one place is Python's, on the binary value, and the hash is over sorted keys.
    """
    m = model_summaries(latest).groupBy("location_id").agg(F.sort_array(F.collect_list(F.struct("model", "variable", "min", "mean", "max"))).alias("models"))
    p = spread(latest).groupBy("location_id").agg(F.sort_array(F.collect_list(F.struct("variable", "mean_spread", "max_spread", "models"))).alias("spread"))
    a = accuracy_30d.groupBy("location_id").agg(F.sort_array(F.collect_list(F.struct("mae", "model", "n"))).alias("accuracy"))
    subject = F.coalesce("model", "station", F.lit(""))
    t = F.lit(as_of).cast("timestamp")
    active = alerts.where((F.col("event_time") <= t) & (F.unix_seconds("event_time") > F.unix_seconds(t) - s.alert_active_hours * 3600))
    w = active.groupBy("location_id").agg(F.sort_array(F.collect_list(F.struct(F.date_format("event_time", "yyyy-MM-dd'T'HH:mm:ss").alias("event_time"), "rule", "variable", subject.alias("subject"), "severity", "metric"))).alias("alerts"))
    j = m.join(p, "location_id", "left").join(a, "location_id", "left").join(w, "location_id", "left")

    def run(batches):
        import pandas as pd

        for b in batches:
            sheets = [sheet({k: _plain(v) for k, v in r.items()}, as_of, s) for r in b.to_dict("records")]
            yield pd.DataFrame({"location_id": b["location_id"], "fact_sheet": [canonical(x) for x in sheets], "sheet_hash": [sheet_hash(x) for x in sheets]})

    return j.mapInPandas(run, "location_id string, fact_sheet string, sheet_hash string")


def _plain(v):
    if hasattr(v, "tolist") and not isinstance(v, (str, bytes)):
        v = v.tolist()
    if hasattr(v, "asDict"):
        v = v.asDict()
    if isinstance(v, (list, tuple)):
        return [_plain(x) for x in v]
    return {k: _plain(x) for k, x in v.items()} if isinstance(v, dict) else v


def sheet(row: dict, as_of: str, s: Settings) -> dict:
    one = lambda x: None if x is None else round(float(x), 1)
    spreads = {x["variable"]: {"mean": one(x["mean_spread"]), "max": one(x["max_spread"]), "models": x["models"]} for x in row.get("spread") or []}
    t = spreads.get("temperature_2m", {})
    models = sorted({x["model"] for x in row["models"]})
    return {
        "location_id": row["location_id"], "as_of": as_of, "models": models,
        "summaries": [{"model": x["model"], "variable": x["variable"], "min": one(x["min"]), "mean": one(x["mean"]), "max": one(x["max"])} for x in row["models"]],
        "spread": spreads, "accuracy": [{"model": x["model"], "mae": one(x["mae"]), "n": x["n"]} for x in row.get("accuracy") or []],
        "most_accurate_model": next((x["model"] for x in row.get("accuracy") or [] if x["mae"] is not None), None),
        "alerts": row.get("alerts") or [], "confidence": confidence(t.get("mean"), len(models), s),
    }


def canonical(x: dict) -> str:
    return json.dumps(x, sort_keys=True, separators=(",", ":"), ensure_ascii=False)


def sheet_hash(x: dict) -> str:
    return hashlib.sha256(canonical(x).encode()).hexdigest()


def cache_key(sheet_hash_: str, prompt_version: str, model: str) -> str:
    return hashlib.sha256("|".join((sheet_hash_, prompt_version, model)).encode()).hexdigest()


# ---- numbers in texts ------------------------------------------------------------------------------------------------------
_TOKEN = re.compile(r"\.?\d+(?:(?:,(?=\d{3}(?!\d))|\.)\d+)*")  # a comma before exactly three digits groups thousands


def numbers_in(text: str | None) -> list[Decimal]:
    """The numbers of a text. A minus counts unless it joins the number to a word, a number, a dot or an underscore (``a-1``,
    ``20-24``); commas group thousands; a leading dot is a fraction; of a run with several dots each part is a number."""
    out = []
    for m in _TOKEN.finditer(text or ""):
        at = m.start()
        joiner = text[at - 2] if at > 1 else " "
        signed = at > 0 and text[at - 1] in "-−" and not (joiner.isalnum() or joiner in "._")
        raw = m.group().replace(",", "")
        parts = [raw] if raw.count(".") <= 1 else [p for p in raw.split(".") if p]
        out += [Decimal(("-" if signed and not i else "") + ("0" if p[0] == "." else "") + p) for i, p in enumerate(parts)]
    return out


def values_in(x, path: tuple = ()) -> Iterable[Decimal]:
    """Every number of a nested document, those inside its texts included."""
    if isinstance(x, bool) or x is None:
        return
    if isinstance(x, (int, float, Decimal)):
        yield Decimal(str(x))
    elif isinstance(x, str):
        yield from numbers_in(x)
    elif isinstance(x, dict):
        for v in x.values():
            yield from values_in(v)
    else:
        for v in x:
            yield from values_in(v)


def identifiers_in(x) -> list[str]:
    """Texts with digits that are names (models, places, stations), longest first, to be taken out before numbers are read."""
    found: set[str] = set()

    def walk(v):
        if isinstance(v, str) and any(c.isdigit() for c in v) and any(c.isalpha() for c in v):
            found.add(v)
        elif isinstance(v, dict):
            for y in v.values():
                walk(y)
        elif isinstance(v, (list, tuple)):
            for y in v:
                walk(y)

    walk(x)
    return sorted(found, key=lambda w: (-len(w), w))


def strip_identifiers(text: str, names: list[str]) -> str:
    for w in names:
        text = re.sub(rf"(?<!\w){re.escape(w)}(?!\w)", " ", text)
    return text


def ungrounded(text: str, facts: dict) -> list[str]:
    """The numbers of a text that no fact gives, at the number of places the text uses (halves up); the sign must agree."""
    allowed = list(values_in(facts))
    bad = []
    for n in numbers_in(strip_identifiers(text, identifiers_in(facts))):
        q = Decimal(1).scaleb(n.as_tuple().exponent)
        if not any(a.quantize(q, ROUND_HALF_UP) == n for a in allowed if a.is_finite()):
            bad.append(f"number not among the facts: {n}")
    return bad


def check_grounding(briefing: dict, facts: dict) -> list[str]:
    """Failures of a written briefing: numbers, stated confidence, named model (the most accurate one where the facts know it)."""
    text = " ".join(str(v) for k, v in briefing.items() if k not in ("confidence", "best_model"))
    out = ungrounded(text, facts)
    if briefing.get("confidence") != facts.get("confidence"):
        out.append("confidence differs from the facts")
    m, best = briefing.get("best_model"), facts.get("most_accurate_model")
    if best is not None and m != best:
        out.append(f"not the most accurate model: {m}")
    elif best is None and m is not None and m not in facts.get("models", ()):
        out.append(f"model not among the facts: {m}")
    return out


def document_numbers(documents: DataFrame) -> DataFrame:
    """``doc_id`` and the numbers of its text as plain decimals, Arrow batch by batch."""

    def run(batches):
        import pandas as pd

        for b in batches:
            yield pd.DataFrame({"doc_id": b["doc_id"], "numbers": [[format(n, "f") for n in numbers_in(t)] for t in b["text"]]})

    return documents.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string")).mapInPandas(run, "doc_id bigint, numbers array<string>")
