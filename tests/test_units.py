from helpers import with_clashes
from pyspark.sql import functions as F

from skyloom.operators import units

ASOS = "record_id bigint, station string, valid string, tmpc string, dwpc string, sknt string, mslp string, alti string, metar string"
OM = "response_id bigint, model string, location_id string, hourly_units map<string,string>, hourly struct<time: array<string>, wind_speed_10m: array<double>, pressure_msl: array<double>>"


def asos(spark, cells):
    return spark.createDataFrame([(i, "ABC", f"2025-02-01 {i:02d}:00", None, None, s, None, a, m) for i, (s, a, m) in enumerate(cells)], ASOS)


def om(spark, rows):
    return spark.createDataFrame([(i, "m", "p", u, (["2025-02-01T00:00", "2025-02-01T01:00"], w, p)) for i, (u, w, p) in enumerate(rows)], OM)


def test_units_of_archive_cells(spark):
    cells = [
        ("8.00", "29.92", "QABC 010000Z 12008KT 9999 A2992"), ("4.1 m/s", "1013.2 hPa", ""), ("9kt", "29.92inHg", None), ("12.0km/h", "101.30 kPa", ""), ("6 mph", "759.8", "QABC 010000Z 12005KT A2992"),
        ("5.00", "2992", "QABC 010000Z 12005MPS Q1013"), ("9.72", "101320", "QABC 010000Z 12005MPS Q1013"), ("M", "", ""), (None, None, None), ("0.00", "29.92 in", "QABC 010000Z 00000KT A2992"), ("15.00", "1013mb", "QABC 010000Z VRB15KMH Q1013"),
    ]
    d = units.decoded(asos(spark, cells), om(spark, []))
    got = {(r["record_id"], r["field_name"]): r["unit"] for r in d.collect()}
    assert [got.get((i, "sknt")) for i in range(11)] == ["kt", "m/s", "kt", "km/h", "mph", "m/s", "kt", None, None, "kt", "km/h"]
    assert [got.get((i, "alti")) for i in range(11)] == ["inHg", "hPa", "inHg", "kPa", "mmHg", "inHg/100", "Pa", None, None, "inHg", "hPa"]
    si = {(r["record_id"], r["field_name"]): r["si_value"] for r in units.converted(asos(spark, cells), om(spark, [])).collect()}
    assert abs(si[(0, "sknt")] - 4.1156) < 1e-3 and abs(si[(10, "sknt")] - 15 / 3.6) < 1e-9
    assert all(99_000 < x < 103_000 for (i, f), x in si.items() if f == "alti")


def test_labels_of_responses_missing_and_wrong(spark):
    rows = [
        ({"wind_speed_10m": "km/h", "pressure_msl": "hPa"}, [10.0, 12.0], [1013.0, 1014.0]), ({"wind_speed_10m": "KM/H", "pressure_msl": "hPa"}, [0.1, 0.0], [101300.0, 101400.0]), ({"wind_speed_10m": "m s-1", "pressure_msl": "mbar"}, [3.0, None], [1013.0, 1014.0]),
        ({"pressure_msl": ""}, [9.0, 9.0], [101300.0, None]), ({}, [2.0, 2.5], [1013.0, 1012.0]), ({"wind_speed_10m": "kn", "pressure_msl": "inch Hg"}, [5.0, 6.0], [29.9, 29.8]), (None, None, [None, None]), ({"wind_speed_10m": "mp/h", "pressure_msl": "Pa"}, [0.0, 0.0], [1013.0, 1013.1]),
    ]
    d = units.decoded(asos(spark, []), om(spark, rows))
    got = {(r["record_id"], r["field_name"]): r["unit"] for r in d.collect()}
    assert [got.get((i, "wind_speed_10m")) for i in range(8)] == ["km/h", "km/h", "m/s", "km/h", "km/h", "kt", None, "mph"]
    assert [got.get((i, "pressure_msl")) for i in range(8)] == ["hPa", "Pa", "hPa", "Pa", "hPa", "inHg", None, "hPa"]
    hours = units.converted(asos(spark, []), om(spark, rows)).where("field_name = 'pressure_msl'")
    assert hours.where(~F.col("si_value").between(99_000, 103_000)).count() == 0 and hours.count() == 13


def test_empty_and_clashing(spark):
    assert units.decoded(asos(spark, []), om(spark, [])).count() == 0
    a = with_clashes(asos(spark, [("5.0 m/s", "29.9", "")]))
    assert {r["unit"] for r in units.decoded(a, with_clashes(om(spark, []))).collect()} == {"m/s", "inHg"}
