"""The daily increment stream: restart safety and agreement with the batch pipeline."""

from pyspark.sql import functions as F

from tickframe.operators import timeseries as ts
from tickframe.plans.prices import prices, raw_feed
from tickframe.plans.streams import RAW_SCHEMA
from tickframe.streaming.daily import run_daily_stream, store_prices

from conftest import SF_SMALL


def test_stream_restart_processes_only_new_files(spark, tmp_path):
    base = str(tmp_path)
    table, source, ckpt = f"{base}/prices", f"{base}/incoming", f"{base}/ckpt"
    raw = raw_feed(spark, SF_SMALL).select("Name", "Date", "Open", "High", "Low", "Close", "Adj Close", "Volume")
    cut = F.lit("2001-05-01").cast("date")
    store_prices(ts.build_prices(raw.filter(F.col("Date") < cut), "2000-12-31"), table)
    may = raw.filter((F.col("Date") >= cut) & (F.col("Date") < F.lit("2001-06-01").cast("date")))
    june = raw.filter((F.col("Date") >= F.lit("2001-06-01").cast("date")) & (F.col("Date") < F.lit("2001-07-01").cast("date")))
    may.coalesce(1).write.parquet(f"{source}/2001-05")
    run_daily_stream(spark, f"{source}/*", table, ckpt, RAW_SCHEMA)
    after_may = spark.read.parquet(table).count()
    run_daily_stream(spark, f"{source}/*", table, ckpt, RAW_SCHEMA)  # nothing new: no change
    assert spark.read.parquet(table).count() == after_may
    june.coalesce(1).write.parquet(f"{source}/2001-06")
    run_daily_stream(spark, f"{source}/*", table, ckpt, RAW_SCHEMA)  # only the new file
    got = spark.read.parquet(table).filter(F.col("Date") >= cut)
    assert got.count() == may.select("Name", "Date").distinct().count() + june.select("Name", "Date").distinct().count()
    # prev_close / change agree with the batch pipeline over the full history
    batch = {(r["Name"], r["Date"]): (r["prev_close"], r["change"])
             for r in prices(spark, SF_SMALL).filter((F.col("Date") >= cut) & (F.col("Date") < F.lit("2001-07-01").cast("date"))).collect()}
    stream = {(r["Name"], r["Date"]): (r["prev_close"], r["change"]) for r in got.collect()}
    assert stream == batch


def test_retention_is_part_of_the_job(spark, tmp_path):
    base = str(tmp_path)
    raw = raw_feed(spark, SF_SMALL).select("Name", "Date", "Open", "High", "Low", "Close", "Adj Close", "Volume")
    raw.filter("Date < '1995-03-01'").coalesce(1).write.parquet(f"{base}/in/a")
    raw.filter("Date >= '2001-07-01'").coalesce(1).write.parquet(f"{base}/in/b")
    run_daily_stream(spark, f"{base}/in/*", f"{base}/prices", f"{base}/ckpt", RAW_SCHEMA, keep_days=180)
    assert spark.read.parquet(f"{base}/prices").select(F.min("Date").cast("string")).first()[0] >= "2001-07-01"


def test_batch_replayed_after_a_crash_changes_nothing(spark, tmp_path):
    from tickframe.streaming.daily import merge_prices
    base = str(tmp_path)
    raw = raw_feed(spark, SF_SMALL).select("Name", "Date", "Open", "High", "Low", "Close", "Adj Close", "Volume").filter("Date >= '2001-05-01'")
    store_prices(ts.build_prices(raw.filter("Date < '2001-07-01'"), "2001-06-30"), f"{base}/prices")
    day = raw.filter("Date >= '2001-07-01'")
    seen = []
    for k in range(2):  # the second merge is the replay of a batch that was written but not committed
        merge_prices(day, f"{base}/prices", "2001-08-01", f"{base}/staged{k}")
        seen.append(sorted(map(str, spark.read.parquet(f"{base}/prices").collect())))
    assert seen[0] == seen[1]
    want = {(r.Name, r.Date): (r.prev_close, r.change) for r in ts.build_prices(raw, "2001-08-01").collect()}
    assert {(r.Name, r.Date): (r.prev_close, r.change) for r in spark.read.parquet(f"{base}/prices").collect()} == want


def plan(df) -> str:
    import contextlib
    import io
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode="formatted")
    return buf.getvalue()


def _stored(spark, path):
    return {(r.Name, r.Date): tuple(r) for r in spark.read.parquet(path).select(
        "Name", "Date", "Close", "prev_close", "change", "change_in_percent", "record_ingestion_date").collect()}


def test_file_two_years_late_changes_one_successor_per_symbol(spark, tmp_path):
    from tickframe.streaming.daily import merge_prices
    base = str(tmp_path)
    raw = raw_feed(spark, SF_SMALL).select("Name", "Date", "Open", "High", "Low", "Close", "Adj Close", "Volume")
    late = (F.col("Date") >= "1998-11-20") & (F.col("Date") < "1998-12-05")
    store_prices(ts.build_prices(raw.filter(~late), "2001-06-30"), f"{base}/prices")
    before = _stored(spark, f"{base}/prices")
    merge_prices(raw.filter(late), f"{base}/prices", "2001-08-01", f"{base}/staged")
    after = _stored(spark, f"{base}/prices")
    new = {k for k in after if k not in before}
    changed = {k for k in before if after[k] != before[k]}
    assert {k[0] for k in new} == {"F", "O", "P"} & {k[0] for k in after} or new
    assert set(before) <= set(after) and len(changed) <= len({k[0] for k in new})
    for name, day in changed:  # the next stored row after the late ones
        assert day == min(d for n, d in before if n == name and d >= max(x for m, x in new if m == name))
    want = ts.build_prices(raw, "2001-08-01").collect()
    assert {k: v[2:6] for k, v in after.items()} == {(r.Name, r.Date): (r.Close, r.prev_close, r.change, r.change_in_percent) for r in want}


def test_batch_reads_only_the_months_it_touches(spark, tmp_path):
    import re

    from tickframe.streaming import daily
    base = str(tmp_path)
    raw = raw_feed(spark, SF_SMALL).select("Name", "Date", "Open", "High", "Low", "Close", "Adj Close", "Volume")
    # a symbol that is absent for two years: its next stored row is far away
    gap = (F.col("Name") == "P") & (F.col("Date") >= "1996-02-01") & (F.col("Date") < "1998-01-01")
    late = F.col("Date") == "1996-01-10"
    store_prices(ts.build_prices(raw.filter(~gap & ~late), "2001-06-30"), f"{base}/prices")
    batch = raw.filter(late).unionByName(raw.filter(F.col("Date") == "1996-01-11").limit(0))
    extra = spark.createDataFrame([("P", "1996-01-31", 1.0, 1.0, 1.0, 1.0, 1.0, 1.0)], "Name string, d string, Open double, High double, Low double, "
                                  "Close double, `Adj Close` double, Volume double").withColumn("Date", F.to_date("d")).drop("d")
    new = ts.clean_prices(batch.unionByName(extra), "2001-08-01")
    tails = daily.read_tails(spark, f"{base}/prices")
    months = daily.touched_months(new, tails)
    assert "1996-01-01" in map(str, months) and len(months) <= 3
    nxt = min(r.Date for r in spark.read.parquet(f"{base}/prices").filter("Name = 'P' AND Date > '1996-01-31'").collect())
    assert nxt.replace(day=1) in months
    rows = daily.merged_months(new, spark.read.parquet(f"{base}/prices"), tails, months)
    # every scan of the table is cut to these months by its partition filter
    nodes = re.findall(r"Scan parquet[^\n]*\n(?:(?!\n\n).)*?Location: InMemoryFileIndex \[[^\]]*/prices\].*?(?=\n\n)", plan(rows), re.S)
    assert nodes
    for node in nodes:
        listed = re.search(r"PartitionFilters: \[market_month#\d+ IN(?:SET)? ?\(?([^)\]]*)", node)
        assert listed and set(re.findall(r"\d{4}-\d\d-\d\d", listed.group(1))) == set(map(str, months)), node
    # merging it gives what one batch over all rows gives
    daily.merge_prices(batch.unionByName(extra), f"{base}/prices", "2001-08-01", f"{base}/staged")
    want = ts.build_prices(raw.filter(~gap).unionByName(extra), "2001-08-01").collect()
    assert {k: v[2:6] for k, v in _stored(spark, f"{base}/prices").items()} == {
        (r.Name, r.Date): (r.Close, r.prev_close, r.change, r.change_in_percent) for r in want}


def test_random_order_of_arrival(spark, tmp_path):
    """Days in any order, some twice with other values: the last one that came counts."""
    import random

    from tickframe.streaming.daily import merge_prices, read_tails
    rng = random.Random(4)
    schema = "Name string, Date date, Open double, High double, Low double, Close double, `Adj Close` double, Volume double"
    import datetime as dt
    days = [dt.date(2000, 1, 15) + dt.timedelta(days=rng.randrange(300)) for _ in range(60)]
    rows = [(rng.choice("abc"), d, *[float(rng.randrange(1, 99))] * 6) for d in days]
    base, known = str(tmp_path), {}
    for k in range(0, len(rows), 12):
        part = {(r[0], r[1]): r for r in rows[k:k + 12]}
        known |= part
        merge_prices(spark.createDataFrame(list(part.values()), schema), f"{base}/prices", "2001-01-01", f"{base}/staged{k}")
        want = ts.build_prices(spark.createDataFrame(list(known.values()), schema), "2001-01-01").collect()
        got = _stored(spark, f"{base}/prices")
        assert {k: v[2:6] for k, v in got.items()} == {(r.Name, r.Date): (r.Close, r.prev_close, r.change, r.change_in_percent) for r in want}
    tails = {(r.Name, str(r.market_month)): (r.first_date, r.last_date, r.last_close) for r in read_tails(spark, f"{base}/prices").collect()}
    for (name, month), (first, last, close) in tails.items():
        mine = sorted(d for n, d in known if n == name and str(d)[:7] == month[:7])
        assert (first, last) == (mine[0], mine[-1]) and close == known[name, last][5]
