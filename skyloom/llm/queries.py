"""Queries of the llm operators and, where SQL can say them, their results in plain SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from skyloom.llm import encode, mix, nearest_time, pii
from skyloom.session import table


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    pairs = nearest_time.forecast_observation_pairs(table(spark, d, "forecast"), table(spark, d, "observation"), table(spark, d, "dim_location"))
    return pairs.where("observation_id is not null")


def p8_ids(spark: SparkSession, d: str) -> DataFrame:
    return encode.encode_corpus(table(spark, d, "documents"))


def p8_pieces(spark: SparkSession, d: str) -> DataFrame:
    """How many chunks each text has, and to how many pieces they were stitched."""
    return encode.corpus_pieces(table(spark, d, "documents"))


def p9_mix(spark: SparkSession, d: str) -> DataFrame:
    return mix.mix(table(spark, d, "documents"), table(spark, d, "mix_target"))[0]


def p9_shares(spark: SparkSession, d: str) -> DataFrame:
    return mix.shares(*mix.mix(table(spark, d, "documents"), table(spark, d, "mix_target")))


def p10_found(spark: SparkSession, d: str) -> DataFrame:
    return pii.found(table(spark, d, "documents"))


def p10_redacted(spark: SparkSession, d: str) -> DataFrame:
    return pii.redacted(table(spark, d, "documents"))


QUERIES = {f.__name__: f for f in (p6_found, p8_ids, p8_pieces, p9_mix, p9_shares, p10_found, p10_redacted)}

SQL = {
    "p6_found": """
    WITH f AS (SELECT f.forecast_id, l.station, f.variable, f.valid_time FROM forecast f JOIN dim_location l USING (location_id)
               WHERE f.value IS NOT NULL AND NOT isnan(f.value) AND f.lead_hours >= 1),
    times AS (SELECT DISTINCT station, variable, valid_time FROM f),
    o AS (SELECT * FROM observation WHERE value IS NOT NULL AND NOT isnan(value)),
    best AS (
      SELECT t.station, t.variable, t.valid_time, o.observation_id,
             row_number() OVER (PARTITION BY t.station, t.variable, t.valid_time
               ORDER BY abs(epoch_us(o.observed_at) - epoch_us(t.valid_time)), o.observed_at, coalesce(o.is_corrected, FALSE) DESC, o.observation_id) AS rn
      FROM times t JOIN o ON o.station = t.station AND o.variable = t.variable
       AND o.observed_at >= t.valid_time - INTERVAL 30 MINUTE AND o.observed_at <= t.valid_time + INTERVAL 30 MINUTE)
    SELECT f.forecast_id, b.observation_id FROM f JOIN best b USING (station, variable, valid_time) WHERE b.rn = 1""",
}
