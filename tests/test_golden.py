"""Golden tests from the literal fixtures (FIXTURES.md §A)."""

import datetime as dt
import math

import numpy as np
from pyspark.sql import Window
from pyspark.sql import functions as F

from tickframe.operators import clean, stats, timeseries as ts, windows
from tickframe.sources import files

D = dt.date
TS = dt.datetime


def test_a1_lag_finishers(spark):
    rows = [("Carly Forte", "03:08:58", "F25-29"), ("Sophia Liu", "02:51:45", "F30-34"),
            ("Nikki Leith", "02:59:01", "F30-34"), ("Jen Edwards", "03:06:36", "F30-34"),
            ("Meghan Lederer", "03:07:41", "F30-34"), ("Lauren Reasoner", "03:10:14", "F30-34"),
            ("Lisa Stelzner", "02:54:11", "F35-39"), ("Lauren Matthews", "03:01:17", "F35-39"),
            ("Desiree Berry", "03:05:42", "F35-39"), ("Suzy Slane", "03:06:24", "F35-39")]
    df = spark.createDataFrame([(n, TS.fromisoformat(f"2016-10-18 {t}"), d) for n, t, d in rows],
                               "name string, finish_time timestamp_ntz, division string")
    expected = {"Carly Forte": None, "Sophia Liu": None, "Nikki Leith": "Sophia Liu", "Jen Edwards": "Nikki Leith",
                "Meghan Lederer": "Jen Edwards", "Lauren Reasoner": "Meghan Lederer", "Lisa Stelzner": None,
                "Lauren Matthews": "Lisa Stelzner", "Desiree Berry": "Lauren Matthews", "Suzy Slane": "Desiree Berry"}
    # the skew-safe form, with buckets small enough that every division spans several
    out = windows.lag_split(df, ["division"], ["finish_time"], ["name"],
                            F.date_trunc("minute", "finish_time"), prefix="preceding_")
    got = {r["name"]: r["preceding_name"] for r in out.collect()}
    assert got == expected
    plain = df.withColumn("p", F.lag("name").over(Window.partitionBy("division").orderBy("finish_time")))
    assert {r["name"]: r["p"] for r in plain.collect()} == expected


RAW_SCHEMA = ("Name string, Date string, Open double, High double, Low double, Close double, "
              "`Adj Close` double, Volume double")


def _raw(spark, rows):
    fl = [tuple(v if i < 2 or v is None else float(v) for i, v in enumerate(r)) for r in rows]
    return spark.createDataFrame(fl, RAW_SCHEMA)


def test_a2_change_and_percent(spark):
    closes = [("APPL", "2021-06-11", 83.0), ("APPL", "2021-06-14", 90.0), ("APPN", "2021-06-09", 107.37),
              ("APPN", "2021-06-10", 111.04), ("APPN", "2021-06-11", 113.0), ("APPN", "2021-06-14", 117.65)]
    raw = _raw(spark, [(n, d, c, c, c, c, c, 100.0) for n, d, c in closes])
    out = {(r["Name"], str(r["Date"])): r for r in ts.build_prices(raw, "2021-06-15").collect()}
    exp = {("APPL", "2021-06-11"): (None, 0.0, None), ("APPL", "2021-06-14"): (83.0, 7.0, 8.43),
           ("APPN", "2021-06-09"): (None, 0.0, None), ("APPN", "2021-06-10"): (107.37, 3.67, 3.42),
           ("APPN", "2021-06-11"): (111.04, 1.96, 1.77), ("APPN", "2021-06-14"): (113.0, 4.65, 4.12)}
    for k, (prev, ch, pct) in exp.items():
        r = out[k]
        assert (r["prev_close"], r["change"], r["change_in_percent"]) == (prev, ch, pct), k
        assert r["record_ingestion_date"] == D(2021, 6, 15)


def test_a2_prices_round_half_even(spark):
    raw = _raw(spark, [("X", "2021-01-01", 2.125, 2.135, 2.5, 2.125, 2.125, 7.0)])
    r = ts.build_prices(raw, "2021-01-02").first()
    assert (r["Open"], r["High"], r["Close"]) == (2.12, 2.14, 2.12)


def test_a3_json(spark, tmp_path):
    p = tmp_path / "j.json"
    p.write_text('{"action":"create","timestamp":"2016-01-07T00:01:17Z"}\n')
    inferred = files.read_json_infer(spark, str(p))
    assert dict(inferred.dtypes) == {"action": "string", "timestamp": "string"}
    raw = spark.createDataFrame([('{"action":"create","timestamp":"2016-01-07T00:01:17Z"}',)], "json string")
    parsed = files.parse_json(raw, "json", "action string, timestamp timestamp")  # session zone is UTC
    row = parsed.select("j.*").first()
    assert row["action"] == "create" and row["timestamp"] == TS(2016, 1, 7, 0, 1, 17)


def test_a4_pivot(spark):
    df = spark.createDataFrame([("2015-01-31", "ARG", 0.0), ("2015-01-31", "AUS", -0.001119),
                                ("2015-01-31", "BRA", 0.005085)], "Date string, Company string, Close_change double")
    w = df.groupBy("Date").pivot("Company", ["ARG", "AUS", "BRA"]).agg(F.first("Close_change")).collect()
    assert len(w) == 1 and (w[0]["ARG"], w[0]["AUS"], w[0]["BRA"]) == (0.0, -0.001119, 0.005085)


def test_a5_regression(spark):
    x, y = [1.0, 2.0, 4.0], [2.1, 3.9, 8.2]
    df = spark.createDataFrame(list(zip(x, y)), "Value double, dollar_price double")
    r = df.agg(F.regr_slope("dollar_price", "Value").alias("s"), F.regr_intercept("dollar_price", "Value").alias("i")).first()
    s, i = np.polyfit(x, y, 1)
    assert math.isclose(r["s"], s, rel_tol=1e-12) and math.isclose(r["i"], i, rel_tol=1e-12)


def test_a6_lag_features(spark):
    df = spark.createDataFrame([("G", i, float(v)) for i, v in enumerate([10, 12, 11, 15, 14])], "k string, t int, c double")
    out = sorted(windows.lag_features(df, "k", "t", "c", 3).collect(), key=lambda r: r["t"])
    assert out[0]["state"] == [0.0, 0.0, 0.0]
    assert out[1]["state"] == [0.0, 0.0, 2.0]
    assert out[2]["state"] == [0.0, 2.0, -1.0]
    assert out[4]["state"] == [-1.0, 4.0, -1.0]


def test_a7_sentinels(spark):
    df = spark.createDataFrame([(9999.9, "999.9", 999.9, 99.99), (50.0, "12.5", 3.0, 0.2)],
                               "temp double, wdsp string, visib double, prcp double")
    q1 = clean.sentinel_to(df, {"temp": (9999.9, None), "wdsp": ("999.9", None, "double"),
                                "visib": (999.9, None), "prcp": (99.99, 0.0)}).collect()
    assert (q1[0]["temp"], q1[0]["wdsp"], q1[0]["visib"], q1[0]["prcp"]) == (None, None, None, 0.0)
    assert q1[1]["wdsp"] == 12.5
    q3 = clean.sentinel_to(df, {"prcp": (99.99, None)}).collect()
    assert q3[0]["prcp"] is None and q3[1]["prcp"] == 0.2


def test_a8_symbol_list(spark):
    text = "AAPL, MSFT,AAPL , ,GOOG,MSFT"
    got = sorted(r["Name"] for r in files.symbol_list(spark, text).collect())
    assert got == ["AAPL", "GOOG", "MSFT"]


def test_a9_edge_cases(spark):
    nan = float("nan")
    raw = _raw(spark, [
        ("A", "2021-01-01", 10.0, 10, 10, 10.0, 10, 1), ("A", "2021-01-01", 10.0, 10, 10, 10.0, 10, 1),  # duplicate
        ("A", "2021-01-02", nan, 11, 11, 11.0, 11, 1),   # NaN open: dropped
        ("A", "2021-01-03", None, 12, 12, 12.0, 12, 1),  # NULL open: kept
        ("B", "2021-01-01", 5.0, 5, 5, 5.0, 5, 1),       # one-row symbol
        ("Z", "2021-01-01", 0.0, 0, 0, 0.0, 0, 1), ("Z", "2021-01-02", 1.0, 1, 1, 1.0, 1, 1),  # zero price
    ])
    out = {(r["Name"], str(r["Date"])): r for r in ts.build_prices(raw, "2021-01-04").collect()}
    assert set(out) == {("A", "2021-01-01"), ("A", "2021-01-03"), ("B", "2021-01-01"), ("Z", "2021-01-01"),
                        ("Z", "2021-01-02")}
    assert out[("A", "2021-01-03")]["prev_close"] == 10.0 and out[("A", "2021-01-03")]["change"] == 2.0
    b = out[("B", "2021-01-01")]
    assert (b["prev_close"], b["change"], b["change_in_percent"]) == (None, 0.0, None)
    z = out[("Z", "2021-01-02")]
    assert z["change"] == 1.0 and z["change_in_percent"] is None  # ÷0 → NULL, not an error
    assert ts.build_prices(raw.limit(0), "2021-01-04").count() == 0


def test_daily_increment_missing_symbol_and_rerun(spark):
    stored = ts.build_prices(_raw(spark, [("A", "2021-01-01", 1.0, 1, 1, 10.0, 1, 1),
                                          ("B", "2021-01-01", 1.0, 1, 1, 20.0, 1, 1)]), "2021-01-01")
    day = _raw(spark, [("A", "2021-01-02", 1.0, 1, 1, 11.0, 1, 1), ("C", "2021-01-02", 1.0, 1, 1, 5.0, 1, 1)])
    inc = {r["Name"]: r for r in ts.increment_prices(day, stored, "2021-01-02").collect()}
    assert set(inc) == {"A", "C"}
    assert inc["A"]["prev_close"] == 10.0 and inc["A"]["change"] == 1.0
    assert inc["C"]["change"] == 0.0 and inc["C"]["prev_close"] is None  # not in the snapshot: restarts
    # a same-day rerun keeps its rows (the reference's date comparison would drop them all)
    again = ts.increment_prices(day, stored.unionByName(ts.increment_prices(day, stored, "2021-01-02")), "2021-01-02")
    assert {r["Name"]: (r["prev_close"], r["change"]) for r in again.collect()} == {"A": (10.0, 1.0), "C": (None, 0.0)}
    # a symbol that is absent from the last stored day goes on from its own last row
    b = ts.increment_prices(_raw(spark, [("B", "2021-01-03", 1.0, 1, 1, 25.0, 1, 1)]),
                            stored.unionByName(ts.increment_prices(day, stored, "2021-01-02")), "2021-01-03").collect()
    assert [(r["prev_close"], r["change"]) for r in b] == [(20.0, 5.0)]


def test_histogram_and_describe(spark):
    vals = [float(v) for v in [1, 2, 2, 3, 3, 3, 4, 10]]
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    h = {r["bin"]: r["count"] for r in stats.histogram(df, "x", 3).collect()}
    counts, _ = np.histogram(vals, bins=3)
    assert [h.get(i, 0) for i in range(3)] == list(counts)
    dsc = stats.describe(df, ["x"]).first()
    assert dsc["q25"] == np.percentile(vals, 25) and dsc["q75"] == np.percentile(vals, 75)
    assert math.isclose(dsc["std"], float(np.std(vals, ddof=1)))
