"""Versions, their audit and their publishing."""

from pathlib import Path

import pytest
from pyspark.sql import functions as F

from closebook.sinks import daily, versions
from closebook.sinks.publish import publish_partitions, publish_whole, vacuum
from closebook.sinks.tables import write_partitioned
from closebook.sinks.versions import AuditFailed, stored_versions, write_version


def months(spark, *rows):
    return spark.createDataFrame(rows, "partition_id string, n int")


def breaking(df):
    """Fails in the middle of the write: some tasks end, one does not."""
    return df.withColumn("n", F.when(F.col("n") == 7, F.raise_error(F.lit("lost")).cast("int")).otherwise(F.col("n")))


def rows_of(spark, table):
    spark.catalog.refreshTable(table)
    return sorted(tuple(r) for r in spark.table(table).collect())


def test_a_failing_write_leaves_the_old_rows(spark, tmp_path):
    root, table = str(tmp_path / "t"), "publish_db.whole"
    spark.sql("create database if not exists publish_db")
    publish_whole(spark, table, write_version(spark.range(5).selectExpr("cast(id as int) as n"), root))
    new = spark.range(100).repartition(8).selectExpr("cast(id as int) as n")
    with pytest.raises(Exception, match="lost"):
        publish_whole(spark, table, write_version(breaking(new), root))
    assert rows_of(spark, table) == [(i,) for i in range(5)]
    publish_whole(spark, table, write_version(new, root))
    assert len(rows_of(spark, table)) == 100


def test_a_breach_or_a_differing_total_is_not_published(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "t")
    df = months(spark, ("2024-01", 1), ("2024-02", -2))
    with pytest.raises(AuditFailed, match="negative"):
        write_version(df, root, breaches={"negative": F.col("n") < 0})
    with monkeypatch.context() as m:  # files that lost a row after they were written
        m.setattr(versions.Version, "read", lambda self, session: session.read.schema(self.schema).parquet(self.path).where("n > 0"))
        with pytest.raises(AuditFailed, match="differ"):
            write_version(df, root, totals={"n": F.sum("n")})
    good = write_version(df, root, ["partition_id"], totals={"n": F.sum("n")}, breaches={"none": F.col("n").isNull()})
    assert (good.rows, good.metrics["n"], good.metrics["breach_none"]) == (2, -1, 0)
    assert good.read(spark).columns == ["n", "partition_id"]


def test_partitions_are_replaced_one_by_one(spark, tmp_path):
    root, table = str(tmp_path / "t"), "publish_db.months"
    old = months(spark, ("2024-01", 1), ("2024-02", 2))
    write_partitioned(old, root)  # an older job's partitions lie in the root
    publish_partitions(spark, table, root, write_version(months(spark, ("2024-02", 5), ("2024-03", 3)), root, ["partition_id"]))
    assert rows_of(spark, table) == [(1, "2024-01"), (3, "2024-03"), (5, "2024-02")]
    with pytest.raises(Exception, match="lost"):
        publish_partitions(spark, table, root, write_version(breaking(months(spark, ("2024-01", 9), ("2024-03", 7))), root, ["partition_id"]))
    assert rows_of(spark, table) == [(1, "2024-01"), (3, "2024-03"), (5, "2024-02")]
    wider = months(spark, ("2024-03", 4)).withColumns({"n": F.col("n").cast("bigint"), "note": F.lit("x")})
    publish_partitions(spark, table, root, write_version(wider, root, ["partition_id"]))
    assert rows_of(spark, table) == [(1, None, "2024-01"), (4, "x", "2024-03"), (5, None, "2024-02")]
    assert spark.read.parquet(root).count() == 2  # readers of the folder see no version


def test_vacuum_keeps_what_is_read(spark, tmp_path):
    root, table = str(tmp_path / "t"), "publish_db.vacuumed"
    for n in (1, 2, 3, 4):
        publish_whole(spark, table, write_version(spark.range(n), root))
    assert stored_versions(spark, root).count() == 4
    assert len(vacuum(spark, table, root, keep=1)) == 2
    assert stored_versions(spark, root).count() == 2
    assert spark.table(table).count() == 4
    assert vacuum(spark, table, root, keep=1) == []


DAYS = [("2024-03-05", 1), ("2024-03-05", 2), ("2024-03-06", 3)]


def shown(spark, table, extract):
    there = spark.catalog.tableExists(table) and spark.table(table).count()
    return there or 0, Path(extract).exists()


def test_daily_table_and_extract_are_published_together(spark, tmp_path):
    root, table, extract = str(tmp_path / "t"), "publish_db.daily", str(tmp_path / "out" / "Activity_1.csv")
    result = months(spark, *DAYS)
    marker = daily.publish_daily(spark, result, table, root, extract)
    assert marker.rows == 3 and shown(spark, table, extract) == (3, True)
    assert sorted(r.n for r in spark.read.schema("partition_id string, n int").option("header", True).csv(extract).collect()) == [1, 2, 3]
    daily.publish_daily(spark, months(spark, ("2024-03-06", 9)), table, root, extract)
    assert rows_of(spark, table) == [(1, "2024-03-05"), (2, "2024-03-05"), (9, "2024-03-06")]
    assert [r.n for r in spark.read.schema("partition_id string, n int").option("header", True).csv(extract).collect()] == [9]
    assert [m.done for m in daily.published(spark, root)] == [True, True]


@pytest.mark.parametrize("place", ["write_daily_extract", "_write_marker"])
def test_an_interrupted_run_shows_neither(spark, tmp_path, monkeypatch, place):
    root, table, extract = str(tmp_path / "t"), f"publish_db.{place.strip('_')}", str(tmp_path / "out" / "Activity_1.csv")

    def stop(*_):
        raise RuntimeError("interrupted")

    with monkeypatch.context() as m:
        m.setattr(daily, place, stop)
        with pytest.raises(RuntimeError):
            daily.publish_daily(spark, months(spark, *DAYS), table, root, extract)
    assert shown(spark, table, extract) == (0, False)
    assert daily.finish_publish(spark, table, root, months(spark, *DAYS)) == 0
    daily.publish_daily(spark, months(spark, *DAYS), table, root, extract)
    assert shown(spark, table, extract) == (3, True)


@pytest.mark.parametrize("place", ["publish_partitions", "_place"])
def test_a_committed_run_is_finished_by_the_next(spark, tmp_path, monkeypatch, place):
    root, table, extract = str(tmp_path / "t"), f"publish_db.later_{place.strip('_')}", str(tmp_path / "out" / "Activity_1.csv")

    def stop(*_):
        raise RuntimeError("interrupted")

    with monkeypatch.context() as m:
        m.setattr(daily, place, stop)
        with pytest.raises(RuntimeError):
            daily.publish_daily(spark, months(spark, *DAYS), table, root, extract)
    assert not Path(extract).exists()
    assert daily.finish_publish(spark, table, root, months(spark, *DAYS)) == 1
    assert shown(spark, table, extract) == (3, True)
    assert daily.finish_publish(spark, table, root, months(spark, *DAYS)) == 0
