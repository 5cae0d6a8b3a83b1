"""Table replacement and profiles."""

import duckdb
import pytest
from pyspark.sql import functions as F

from tickframe.sources import profile, sinks
from tickframe.sources.tables import table

from conftest import SF_ORACLE


def test_profile_counts_and_sketch_error(spark):
    names = ["orders", "events", "customer", "embeddings"]
    got = profile.profile_tables({t: table(spark, SF_ORACLE, t) for t in names}).collect()
    con = duckdb.connect()
    for r in got:
        n, nulls, distinct = con.execute(f"SELECT count(*), count(*) - count({r.column_name}), count(DISTINCT {r.column_name}) "
                                         f"FROM '{SF_ORACLE}/{r.table_name}.parquet'").fetchall()[0]
        assert (r.n_rows, r.n_nulls) == (n, nulls)
        assert abs(r.approx_distinct - distinct) <= 0.06 * distinct + 1, (r, distinct)
        assert r.size_gb is not None and r.last_modified is not None


def test_ctas_replaces_and_keeps_the_old_table_when_the_query_fails(spark, tmp_path):
    name, path = "replaced_t", str(tmp_path)
    sinks.ctas(spark, name, "SELECT 1 AS a", path)
    assert sinks.ctas(spark, name, "SELECT 2 AS a", path).first().a == 2
    with pytest.raises(Exception):
        sinks.ctas(spark, name, "SELECT raise_error('no') AS a", path)
    assert spark.table(name).first().a == 2
    left = [t.name for t in spark.catalog.listTables() if t.name.startswith(name) and t.name.endswith("_old")]
    assert left == []
    spark.sql(f"DROP TABLE {name}")


def test_replacement_that_fails_halfway_brings_the_old_table_back(spark, tmp_path):
    spark.range(1).write.option("path", f"{tmp_path}/a").saveAsTable("halfway_t")
    with pytest.raises(Exception):
        sinks._replace(spark, "halfway_t", "there_is_no_such_table")
    assert spark.table("halfway_t").count() == 1
    spark.sql("DROP TABLE halfway_t")


def test_bucketed_table_is_replaced(spark, tmp_path):
    for n in (10, 20):
        t = sinks.write_bucketed(spark.range(n), "bucketed_t", "id", 4, str(tmp_path))
        assert t.agg(F.count("*")).first()[0] == n
    spark.sql("DROP TABLE bucketed_t")
