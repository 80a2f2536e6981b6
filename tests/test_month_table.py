"""A stored universe: updates by month, reruns, failed writes, archive."""

import pytest
from pyspark.sql import functions as F

from propal.operators.month_table import MonthTable
from propal.operators.panel import sample_exact
from propal.session import scratch_path

SCHEMA = "ANO_MES int, ID int, TARGET int"


def rows(df):
    return sorted(map(tuple, df.select("ANO_MES", "ID", "TARGET").collect()), key=str)


@pytest.fixture
def table(spark):
    t = MonthTable(spark, scratch_path(spark, "months"))
    t.create(spark.createDataFrame([
        (200001, 1, 0), (200001, 2, 1), (200002, 3, 0), (200002, 4, 0), (200003, 5, 0), (200003, 6, 1),
        (200003, None, 0), (200003, 7, None)], SCHEMA))
    return t


NEW = [(200004, 3, 1), (200004, 5, 0), (200004, 8, 0), (200004, 7, 0), (200004, None, 0), (200004, 6, 1)]


def test_one_month_in(spark, table):
    assert table.roll(spark.createDataFrame(NEW, SCHEMA), 200004, 3, cap=False) == 2
    assert rows(table.read()) == sorted([
        (200002, 4, 0), (200003, 5, 0), (200003, 6, 1), (200003, None, 0), (200003, 7, None),     # 3 bought: its 0 leaves
        (200004, 3, 1), (200004, 6, 1), (200004, 8, 0), (200004, None, 0)], key=str)             # 5 and 7 are held already
    assert rows(table.read(archived=True)) == [(200001, 1, 0), (200001, 2, 1)]
    assert table.rows_by_month() == {200002: 1, 200003: 4, 200004: 4}
    assert rows(table.read([200002, 199001])) == [(200002, 4, 0)]
    assert len(rows(table.read(at=1))) == 8            # as it was


def test_only_months_that_lose_rows_are_written(spark, table):
    before = table._state()["live"]
    table.roll(spark.createDataFrame(NEW, SCHEMA), 200004, 3, cap=False)
    after = table._state()
    assert after["live"]["200003"] == before["200003"] and after["archive"]["200001"] == before["200001"]
    assert after["live"]["200002"] != before["200002"]


def test_the_same_update_twice(spark, table):
    new = spark.createDataFrame(NEW, SCHEMA)
    table.roll(new, 200004, 3)
    once = rows(table.read())
    assert table.roll(new, 200004, 3) == 2 and rows(table.read()) == once and table.entry() == 2
    with pytest.raises(ValueError):
        table.roll(new, 200004, 3, update="under another name")
    with pytest.raises(FileExistsError):
        table.create(new, "second")


@pytest.mark.parametrize("step", ["second folder", "commit"])
def test_a_failed_update_leaves_the_table(spark, table, monkeypatch, step):
    new, before = spark.createDataFrame(NEW, SCHEMA), rows(table.read())
    with monkeypatch.context() as m:
        if step == "commit":
            m.setattr(MonthTable, "_commit", lambda *a, **k: (_ for _ in ()).throw(OSError("lost")))
        else:
            staged, calls = MonthTable._stage, []

            def stage(self, df):
                calls.append(1)
                if len(calls) == 2:
                    raise OSError("lost")
                return staged(self, df)
            m.setattr(MonthTable, "_stage", stage)
        with pytest.raises(OSError):
            table.roll(new, 200004, 3, cap=False)
    assert rows(table.read()) == before and table.rows_by_month(archived=True) == {}
    again = MonthTable(spark, table.root)
    assert again.roll(new, 200004, 3, cap=False) == 2 and again.updates() == ["create", "month 200004"]
    assert len(rows(again.read())) == 9


def test_two_writers(spark, table, monkeypatch):
    new = spark.createDataFrame(NEW, SCHEMA)
    stale = table._state()
    table.roll(new, 200004, 3)
    monkeypatch.setattr(MonthTable, "_state", lambda self, at=None: stale)
    with pytest.raises(RuntimeError):
        MonthTable(spark, table.root).roll(new, 200004, 3, update="other")


def test_cap_and_later_columns(spark, table):
    new = (spark.range(100, 140).select(F.lit(200004).alias("ANO_MES"), F.col("id").cast("int").alias("ID"),
                                         F.lit(0).alias("TARGET"), F.lit(1.5).alias("month")))
    table.roll(new, 200004, 4)
    assert table.rows_by_month()[200004] == 10         # max(8, 40) / 4
    got = table.read().groupBy("ANO_MES").agg(F.count("month").alias("n"))
    assert {r[0]: r[1] for r in got.collect()} == {200001: 0, 200002: 0, 200003: 0, 200004: 10}
    with pytest.raises(TypeError):
        table.roll(new.withColumn("ANO_MES", F.lit(200005)).withColumn("ID", F.col("ID").cast("string")), 200005, 4)


def test_rows_of_other_months_and_empty_months(spark, table):
    with pytest.raises(ValueError):
        table.roll(spark.createDataFrame([(200005, 1, 0)], SCHEMA), 200004, 3)
    with pytest.raises(ValueError):
        table.roll(spark.createDataFrame([(None, 1, 0)], SCHEMA), 200004, 3)
    table.roll(spark.createDataFrame([], SCHEMA), 200004, 3)
    assert table.rows_by_month() == {200002: 2, 200003: 4} and table.rows_by_month(True) == {200001: 2}
    with pytest.raises(KeyError):
        MonthTable(spark, table.root + "-none").read()
    empty = MonthTable(spark, scratch_path(spark, "months"))
    empty.create(spark.createDataFrame([], SCHEMA))
    assert empty.read().count() == 0


def test_rows_without_an_id_are_drawn_last(spark):
    df = spark.createDataFrame([(200001, None, 0), (200001, 4, 0), (200001, None, 1)], SCHEMA)
    assert rows(sample_exact(df, "ID", 1)) == [(200001, 4, 0)]
    assert sample_exact(df, "ID", 2).count() == 2 and sample_exact(df, "ID", 9).count() == 3
