from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from tickloom.operators.clean import fill_defaults
from tickloom.sources import schemas, sinks
from tickloom.sources.key_filter import MAY_HOLD, KeyFilter


def rows_of(spark, tickers, days, source="own"):
    start = date(2024, 1, 1)
    data = [(t, start + timedelta(days=d), 1.0, 2.0, 0.5, 1.5, 100 + d, source) for t in tickers for d in days]
    return fill_defaults(spark.createDataFrame(data, "ticker string, date date, open double, high double, low double, close double, volume long, source string"))


@pytest.fixture
def table(tmp_path):
    return f"{tmp_path}/bars", KeyFilter(f"{tmp_path}/keys", sinks.BAR_KEY, buckets=2)


def test_new_keys_read_no_stored_rows(spark, table, monkeypatch):
    path, known = table
    assert sinks.append_if_absent(spark, rows_of(spark, "AB", range(40)), path, known=known) == 80
    read = []
    whole = sinks.read_table
    monkeypatch.setattr(sinks, "read_table", lambda *a: read.append(a) or whole(*a))
    assert sinks.append_if_absent(spark, rows_of(spark, "C", range(40)), path, known=known) == 40
    assert not read
    again = rows_of(spark, "ABC", range(38, 45))
    assert sinks.append_if_absent(spark, again.unionByName(again), path, known=known) == 15
    assert read
    assert sinks.append_if_absent(spark, again, path, known=known) == 0
    assert whole(spark, path, schemas.RAW_BARS).count() == 135


def test_table_older_than_its_filter(spark, table):
    """Months that the filter does not know are read, and known as a whole afterwards."""
    path, known = table
    sinks.append_if_absent(spark, rows_of(spark, "AB", range(40)), path)
    assert sinks.append_if_absent(spark, rows_of(spark, "A", range(10)).unionByName(rows_of(spark, "C", range(10))), path, known=known) == 10
    assert known.months(spark) == ["2024-01"]
    assert sinks.append_if_absent(spark, rows_of(spark, "ABC", range(40)), path, known=known) == 30
    assert sorted(known.months(spark)) == ["2024-01", "2024-02"]


def test_answers_stay_after_compaction(spark, table):
    _, known = table
    held = rows_of(spark, "AB", range(60))
    known.add(held.where("ticker = 'A'"))
    known.add(held.where("ticker = 'B'"))
    known.add(held.where("ticker = 'B'"))
    before = known.mark(rows_of(spark, "ABCDE", range(60))).select("ticker", "date", MAY_HOLD)
    seen = sorted(map(tuple, before.collect()))
    known.compact(spark)
    after = known.mark(rows_of(spark, "ABCDE", range(60))).select("ticker", "date", MAY_HOLD)
    assert sorted(map(tuple, after.collect())) == seen
    told = {t: n for t, n in after.groupBy("ticker").agg(F.count_if(MAY_HOLD)).collect()}
    assert told["A"] == told["B"] == 60 and told["C"] + told["D"] + told["E"] < 10


def test_empty_and_null(spark, table):
    path, known = table
    none = rows_of(spark, "A", range(3)).where("1 = 0")
    assert sinks.append_if_absent(spark, none, path, known=known) == 0
    odd = rows_of(spark, "A", range(3)).withColumn("source", F.lit(None).cast("string"))
    assert sinks.append_if_absent(spark, odd, path, known=known) == 3
    assert known.mark(odd.withColumn("date", F.lit(None).cast("date"))).where(MAY_HOLD).count() == 3
