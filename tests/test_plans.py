"""Physical-plan checks: the shapes the operators promise at scale."""

import contextlib
import io
import re

import pytest

import __spark_entry__ as entry
from conftest import SF_SMALL

Q = entry.queries()


def plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode="formatted")
    return buf.getvalue()


def test_anti_join_is_left_anti(spark):
    assert "LeftAnti" in plan(Q["join.anti_null"](spark, SF_SMALL))


def test_not_exists_is_left_anti_and_exists_is_semi(spark):
    p = plan(Q["join.not_exists"](spark, SF_SMALL))
    assert "LeftAnti" in p and "LeftSemi" in p


def test_band_scalars_scan_once(spark):
    tree = plan(Q["join.cross_scalar"](spark, SF_SMALL)).split("\n\n")[0]  # the operator tree only
    assert len(re.findall(r"Scan parquet", tree)) == 1


NO_PRODUCT = [n for n in Q if n.split(".")[0] in ("proj", "filt", "join", "sub", "agg", "win", "set", "sort", "limit")
              and n not in ("join.cross_rows",)]


@pytest.mark.parametrize("name", NO_PRODUCT)
def test_no_cartesian_product(spark, name):
    p = plan(Q[name](spark, SF_SMALL))
    assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p, name


def test_filter_pushed_to_scan(spark):
    p = plan(Q["filt.cmp"](spark, SF_SMALL))
    pushed = re.search(r"PushedFilters: \[(.*)\]", p).group(1)
    assert "l_quantity" in pushed and "l_linestatus" in pushed


def test_column_pruning(spark):
    p = plan(Q["proj.select"](spark, SF_SMALL))
    schema = re.search(r"ReadSchema: struct<(.*)>", p).group(1)
    assert "l_shipdate" not in schema and "l_comment" not in schema and "l_extendedprice" in schema


def test_rank_filter_becomes_group_limit(spark):
    assert "WindowGroupLimit" in plan(Q["win.top_n"](spark, SF_SMALL))


def test_dedup_is_an_aggregate_not_a_window(spark):
    from tickframe.operators import clean
    from tickframe.plans.prices import raw_feed
    p = plan(clean.dedup(raw_feed(spark, SF_SMALL), ["Date", "Name"]))
    assert "HashAggregate" in p or "ObjectHashAggregate" in p or "SortAggregate" in p
    assert "Window" not in p


def test_lag_split_windows_per_key_and_range(spark):
    from tickframe.operators import windows
    e = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    # partition spec of the lag window: the key and its range, or the caller's bucket
    p = plan(windows.idle_gap(e, "event_type", "ts", "ts", "event_id", rows=50))
    assert re.search(r"\], \[__key#\d+, __piece#\d+L?\], \[ts#", p) and "BroadcastHashJoin" in p
    p = plan(windows.lag_split(e, ["user_id"], ["ts"], ["event_id"], e.ts.cast("date")))
    assert re.search(r"\], \[user_id#\d+L?, __bucket#\d+\], \[ts#", p)


def test_topk_is_take_ordered(spark):
    assert "TakeOrderedAndProject" in plan(Q["limit.topk"](spark, SF_SMALL))


def test_partition_pruning_on_latest_snapshot(spark, tmp_path):
    from pyspark.sql import functions as F
    from tickframe.operators import timeseries as ts
    from tickframe.plans.prices import prices
    path = str(tmp_path / "p")
    prices(spark, SF_SMALL).withColumn("record_ingestion_date", F.to_date(F.concat(F.year("Date").cast("string"),
                                                                                   F.lit("-01-01")))) \
        .write.partitionBy("record_ingestion_date").parquet(path)
    snap = ts.latest_snapshot(spark.read.parquet(path))
    p = plan(snap)
    part = re.search(r"PartitionFilters: \[(.*)\]", p).group(1)
    assert "record_ingestion_date" in part and "Subquery" in part  # the max is a partition filter
    assert snap.select("record_ingestion_date").distinct().count() == 1


def test_bucketed_join_has_no_shuffle_on_the_join_keys(spark):
    p = plan(Q["join.inner_equi.bucketed"](spark, SF_SMALL))
    assert "hashpartitioning(l_orderkey" not in p and "hashpartitioning(o_orderkey" not in p
