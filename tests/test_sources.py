import json
from datetime import date, datetime

import pandas as pd
import pytest
from pyspark.sql import functions as F

from tests.conftest import price_series
from tickloom.operators import modeling, splits, validate
from tickloom.plans import daily
from tickloom.plans.daily import DailyConfig, run_daily
from tickloom.plans.process import ProcessConfig, process_bars, process_file
from tickloom.session import work_folder
from tickloom.sources import readers, schemas, sinks


def as_file(pdf, path):
    pdf.rename(columns={"date": "Date", "open": "Open", "high": "High", "low": "Low", "close": "Close", "volume": "Volume"}).drop(columns="ticker").assign(
        **{"Adj Close": pdf["close"]}).to_csv(path, index=False)


def test_process_file(spark, tmp_path):
    as_file(price_series(300), tmp_path / "aapl_daily.csv")
    meta = process_file(spark, str(tmp_path / "aapl_daily.csv"), f"{tmp_path}/out")
    assert meta["rows_in"] == 300 and meta["rows_out"] == 280
    assert "target_close" not in meta["feature_columns"] and "rsi_14" in meta["feature_columns"]
    parts = {p: spark.read.option("header", True).csv(path).count() for p, path in meta["split_paths"].items()}
    assert parts == {"train": 196, "validation": 42, "test": 42}
    stored = json.loads(spark.read.text(f"{tmp_path}/out.metadata.json").first()[0])
    assert stored["rows_out"] == 280
    assert spark.read.option("header", True).csv(meta["split_paths"]["test"]).first()["ticker"] == "AAPL"


def test_wide_file_keeps_its_rows(spark, tmp_path):
    pdf = price_series(100)
    pd.DataFrame({"Unnamed: 0": pdf["date"], "Stock_1": pdf["close"], "Stock_2": pdf["close"] + 5}).to_csv(tmp_path / "wide.csv", index=False)
    meta = process_file(spark, str(tmp_path / "wide.csv"), f"{tmp_path}/out", fmt="parquet")
    out = spark.read.parquet(f"{tmp_path}/out")
    assert meta["rows_in"] == 200 and {r["ticker"]: r["count"] for r in out.groupBy("ticker").count().collect()} == {"Stock_1": 80, "Stock_2": 80}


def test_bad_values_and_copies(spark, tmp_path):
    (tmp_path / "x.csv").write_text("Date,Open,High,Low,Close,Volume\n2024-01-02,1,2,0.5,1,10\n2024-01-02,9,9,9,9,9\nnonsense,1,1,1,1,1\n2024-01-03,1,abc,1,1,1\n2024-01-04,1,1,1,1,\n")
    from tickloom.plans.process import clean_bars

    bars, close_only = clean_bars(readers.read_bar_csv(spark, str(tmp_path / "x.csv")))
    assert [(r["ticker"], r["date"], r["close"]) for r in bars.collect()] == [("X", date(2024, 1, 2), 1.0)] and not close_only


def test_missing_columns(spark):
    with pytest.raises(ValueError, match=r"\['high', 'low', 'close', 'volume'\]"):
        readers.require_columns(spark.createDataFrame([("2024-01-01", 1.0)], "date string, open double"))


def test_ticker_files(spark, tmp_path):
    for t in ("AAPL", "MSFT"):
        as_file(price_series(5, t), tmp_path / f"{t}.csv")
    with open(tmp_path / "MSFT.csv", "a") as f:
        f.write("2024-02-30,x,y,z,1,2,3\n")
    df = readers.read_ticker_files(spark, str(tmp_path), ["AAPL", "MSFT", "ABSENT"])
    got = {r["ticker"]: (r["n"], r["bad"], r["dated"]) for r in df.groupBy("ticker").agg(
        F.count("*").alias("n"), F.count("corrupt_record").alias("bad"), F.count("date").alias("dated")).collect()}
    assert got == {"AAPL": (5, 0, 5), "MSFT": (6, 1, 5)}
    row = df.where("ticker = 'AAPL'").first()
    assert row["source"] == "yfinance" and isinstance(row["date"], date) and row["adj_close"] == row["close"]


def test_headers_of_different_order(spark, tmp_path):
    (tmp_path / "a.csv").write_text("Date,Open,High,Low,Close,Volume\n2024-01-02,1,4,0.5,2,10\n")
    (tmp_path / "b.csv").write_text("Date,Close,Volume,Low,High,Open\n2024-01-02,2,10,0.5,4,1\n")
    (tmp_path / "c.csv").write_text(",X,Y\n2024-01-02,7,8\n")
    (tmp_path / "empty.csv").write_text("")
    rows = readers.read_bar_csv(spark, str(tmp_path)).orderBy("source_file", "ticker").collect()
    assert [(r["open"], r["high"], r["low"], r["close"], r["volume"]) for r in rows[:2]] == [("1", "4", "0.5", "2", "10")] * 2
    assert [(r["ticker"], r["close"], r["volume"]) for r in rows[2:]] == [("X", "7", "0"), ("Y", "8", "0")]
    files = readers.read_ticker_files(spark, str(tmp_path), ["a", "b", "zz"]).collect()
    assert {(r["ticker"], r["open"], r["close"]) for r in files} == {("A", 1.0, 2.0), ("B", 1.0, 2.0)}
    assert [r["ticker"] for r in readers.absent_tickers(spark, str(tmp_path), ["a", "b", "zz", "empty"]).orderBy("ticker").collect()] == ["EMPTY", "ZZ"]


def test_small_readers(spark, bars):
    listed = spark.createDataFrame([('["AAPL", "TSLA"]',)], "c string").select(F.explode(readers.ticker_list(F.col("c"))).alias("ticker"))
    assert {r[0] for r in readers.only_tickers(bars, listed).select("ticker").distinct().collect()} == {"AAPL"}
    assert readers.for_ticker_date(spark, bars, "GOOGL", date(2020, 1, 5)).count() == 1
    assert readers.recent(bars, date(2020, 9, 1), 10).agg(F.min("date")).first()[0] == date(2020, 8, 22)
    assert readers.assign_ticker(bars, "Z").select("ticker").distinct().first()[0] == "Z"
    with pytest.raises(ValueError):
        readers.feature_source(spark)


def test_append_twice(spark, bars, tmp_path):
    raw = bars.withColumn("source", F.lit("yfinance"))
    path = f"{tmp_path}/raw"
    assert sinks.append_if_absent(spark, raw.limit(100).unionByName(raw.limit(50)), path) == 100
    assert sinks.append_if_absent(spark, raw, path) == bars.count() - 100
    assert sinks.append_if_absent(spark, raw, path) == 0
    table = sinks.read_table(spark, path, schemas.RAW_BARS)
    assert table.count() == bars.count() and table.select("month").distinct().count() == 9


def test_upsert_rewrites_only_touched_months(spark, tmp_path):
    schema, path = schemas.TARGETS, f"{tmp_path}/t"

    def rows(day, value, at):
        return spark.createDataFrame([("A", day, value, at)], "ticker string, date date, target_return double, computed_at timestamp_ntz")

    sinks.upsert(spark, rows(date(2024, 1, 5), 0.1, datetime(2024, 1, 6)), path, schema)
    sinks.upsert(spark, rows(date(2024, 2, 5), 0.2, datetime(2024, 2, 6)), path, schema)
    def february():
        return {f for f in spark.read.parquet(path).inputFiles() if "month=2024-02" in f}

    before = february()
    sinks.upsert(spark, rows(date(2024, 1, 5), 0.3, datetime(2024, 1, 7)), path, schema)
    sinks.upsert(spark, rows(date(2024, 1, 5), 0.9, datetime(2024, 1, 1)), path, schema)  # older: no effect
    got = {r["date"]: float(r["target_return"]) for r in sinks.read_table(spark, path, schema).collect()}
    assert got == {date(2024, 1, 5): 0.3, date(2024, 2, 5): 0.2}
    assert before == february() and len(before) == 1


def test_values_beyond_the_stored_type(spark, tmp_path):
    """They go to quarantine with their row, and are counted; nothing becomes null unseen. NaN is missing."""
    path, at = f"{tmp_path}/features", datetime(2024, 1, 6)
    names = "ticker string, date date, macd_line double, price_range_pct double, computed_at timestamp_ntz"
    rows = [("A", date(2024, 1, 5), 1.5, 2.0, at), ("B", date(2024, 1, 5), 250.0, 1200.0, at), ("C", date(2024, 1, 5), float("nan"), None, at)]
    for _ in range(2):
        assert sinks.upsert(spark, spark.createDataFrame(rows, names), path, schemas.TECHNICAL) == 1
    table = {r["ticker"]: r["macd_line"] for r in sinks.read_table(spark, path, schemas.TECHNICAL).collect()}
    assert table == {"A": 1.5, "C": None}
    kept = spark.read.parquet(f"{path}_quarantine").collect()
    assert [(r["ticker"], r["macd_line"], r["price_range_pct"]) for r in kept] == [("B", 250.0, 1200.0)]
    assert kept[0]["validation_error"] == "Value outside the stored type: macd_line, price_range_pct"


def test_retention(spark, bars, tmp_path):
    months = sinks.archive_expired(bars, f"{tmp_path}/old", date(2020, 9, 1), 120)
    assert months == ["2020-01", "2020-02", "2020-03", "2020-04"]
    assert spark.read.parquet(f"{tmp_path}/old").agg(F.max("date")).first()[0] == date(2020, 4, 30)
    assert sinks.archive_expired(bars, f"{tmp_path}/none", date(2010, 1, 1), 1) == []


def test_snapshot_and_close_only(spark, bars):
    snap = modeling.dataset_snapshot(splits.positional_split(bars), ["close"], "x").first()
    assert snap["tickers"] == ["AAPL", "GOOGL"] and snap["train_records"] + snap["validation_records"] + snap["test_records"] == 440 and len(snap["dataset_id"]) == 16
    flat = bars.withColumn("volume", F.lit(0).cast("bigint"))
    assert process_bars(flat).isEmpty() and process_bars(flat, ProcessConfig(), close_only=True).count() == 400


def test_daily_run(spark, bars, tmp_path):
    config = DailyConfig(root=str(tmp_path))
    landed = bars.withColumn("source", F.lit("yfinance")).unionByName(
        bars.limit(1).withColumns({"source": F.lit("bad"), "volume": F.lit(1).cast("bigint")}))
    day = date(2020, 6, 1)
    stats = run_daily(spark, config, landed, day)
    assert stats["total_records"] == 441 and stats["inserted_records"] == 440 and stats["validation_errors"] == 1
    again = None
    with pytest.raises(validate.QualityGateError):
        again = run_daily(spark, config, landed, day)
    assert again is None
    log = {r["status"]: r for r in spark.read.parquet(config.table("pipeline_execution_log")).collect()}
    assert set(log) == {"success", "failed"} and "No records" in log["failed"]["error_message"]
    features = sinks.read_table(spark, config.table("feature_technical_indicators"), schemas.TECHNICAL)
    assert features.count() == features.select("ticker", "date").distinct().count() > 300
    assert spark.read.parquet(config.table("training_dataset_metadata")).first()["total_records"] == features.count()
    assert spark.read.parquet(config.table("data_lineage")).count() == 2
    assert spark.read.parquet(config.table("quarantine")).count() == 1
    before = {(r["ticker"], r["date"]): (r["sma_200"], r["ema_26"]) for r in features.collect()}
    later = date(2020, 8, 20)
    daily.indicators(spark, config, later)
    after = {(r["ticker"], r["date"]): (r["sma_200"], r["ema_26"]) for r in sinks.read_table(spark, config.table("feature_technical_indicators"), schemas.TECHNICAL).collect()}
    assert len(after) > len(before) and all(after[k] == v for k, v in before.items()) and after["AAPL", later][0] is not None
    raw = sinks.read_table(spark, config.table("raw_market_data"), schemas.RAW_BARS)
    plan = readers.recent(raw, later, 30)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(month" in plan


def test_shared_folder(spark):
    assert work_folder(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))


def test_concat(spark, bars):
    from tickloom.operators.clean import concat

    out = concat([bars.select("ticker", "close").limit(2), bars.select("ticker", "volume").limit(3)])
    assert out.columns == ["ticker", "close", "volume"] and out.where("close is null").count() == 3


def test_a_bad_file_does_not_stop_the_others(spark, tmp_path):
    import gzip

    from tickloom.sources import ticker_files

    good = "Date,Open,High,Low,Close,Adj Close,Volume\n2024-01-02,1,2,0.5,1.5,1.4,100\n\n2024-01-03,1,2,0.5,,1.4,100\n"
    (tmp_path / "aapl_daily.csv").write_text(good)
    (tmp_path / "msft.csv").write_text("volume,close,low,high,open,date\n7,1,1,1,1,2024-01-02\n7,x,1,1,1,2024-01-03\n7,1\n")
    (tmp_path / "ibm.csv.gz").write_bytes(gzip.compress(good.encode()))
    (tmp_path / "cut.csv.gz").write_bytes(gzip.compress(good.encode() * 50)[:-30])
    (tmp_path / "noise.csv").write_bytes(b"\xff\xfe\x00\x01" * 9)
    (tmp_path / "empty.csv").write_bytes(b"")
    (tmp_path / "header.csv").write_text("date,open,high,low,close,volume\n")
    (tmp_path / "short.csv").write_text("date,open\n2024-01-02,1\n")
    bars, report = ticker_files.split_readable(ticker_files.read_apart(spark, str(tmp_path)))
    got = sorted((r["ticker"], str(r["date"]), r["close"], r["adj_close"], r["volume"]) for r in bars.collect())
    assert got == [("AAPL", "2024-01-02", 1.5, 1.4, 100), ("AAPL", "2024-01-03", None, 1.4, 100), ("IBM", "2024-01-02", 1.5, 1.4, 100),
                   ("IBM", "2024-01-03", None, 1.4, 100), ("MSFT", "2024-01-02", 1.0, None, 7)]
    errors = {}
    for r in report.collect():
        errors.setdefault(r["ticker"], []).append(r["error"])
    assert errors.keys() == {"MSFT", "CUT", "NOISE", "HEADER", "SHORT"} and len(errors["MSFT"]) == 2
    assert errors["SHORT"] == ["Missing columns: high, low, close, volume"] and errors["HEADER"] == ["No lines"]
    assert errors["CUT"][0].startswith("EOFError") and errors["NOISE"][0].startswith("UnicodeDecodeError")
