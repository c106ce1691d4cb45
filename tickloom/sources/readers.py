"""Readers for bar files, bar tables and feature tables."""

from __future__ import annotations

import csv
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from datetime import date, timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickloom.sources.schemas import OHLCV, REQUIRED

# Header spellings accepted for each column.
HEADER_NAMES = {
    "Date": "date",
    "Open": "open",
    "High": "high",
    "Low": "low",
    "Close": "close",
    "Adj Close": "adj_close",
    "Adj_Close": "adj_close",
    "Volume": "volume",
    "Ticker": "ticker",
}


@dataclass(frozen=True)
class HeaderPlan:
    """What a header line says about its files: the name of each field in order, and whether they are closes by ticker."""

    names: tuple[str, ...]

    @classmethod
    def of_line(cls, line: str) -> HeaderPlan:
        fields = next(csv.reader([line]), [])
        named = [HEADER_NAMES.get(n, n) for n in fields]
        blank = [i for i, n in enumerate(named) if not n or n.startswith("Unnamed:")]
        dates = blank[:1] if "date" not in named else []  # an index column without a name holds the dates
        return cls(tuple("date" if i in dates else n or f"Unnamed: {i}" for i, n in enumerate(named)))

    @property
    def missing(self) -> list[str]:
        return [c for c in REQUIRED if c not in self.names]

    @property
    def is_wide(self) -> bool:
        return "date" in self.names and bool(self.missing) and len(self.names) > 1


def header_groups(spark: SparkSession, path: str | list[str], pattern: str | None = None) -> dict[HeaderPlan, list[str]]:
    """The files of a CSV source by their header.

    First lines are found by a distributed scan, as the least row number of the block at the start of each file. Only
    the list of files reaches the driver, which plans the scans from it. Empty files are in no group.
    """
    reader = spark.read if pattern is None else spark.read.option("pathGlobFilter", pattern)
    lines = reader.text(path).select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("at"))
    first = lines.where("at = 0").withColumn("row", F.monotonically_increasing_id()).groupBy("file").agg(F.min_by("value", "row").alias("line"))
    groups: dict[HeaderPlan, list[str]] = {}
    for row in first.orderBy("file").collect():
        groups.setdefault(HeaderPlan.of_line(row["line"]), []).append(row["file"])
    return groups


def read_bar_csv(spark: SparkSession, path: str) -> DataFrame:
    """CSV scan with every field as text and canonical names; bad fields are judged later.

    Each distinct header has its own scan, so the order of columns may differ between files. ``source_file`` names the
    file. If files of different shapes meet, those of closes by ticker are made long here.
    """
    groups = header_groups(spark, path)
    frames = []
    for plan, files in groups.items():
        schema = T.StructType([T.StructField(n, T.StringType()) for n in plan.names])
        raw = spark.read.schema(schema).option("header", True).option("enforceSchema", True).csv(files).withColumn("source_file", F.col("_metadata.file_name"))
        if len(groups) > 1 and plan.is_wide:
            raw = wide_closes_to_long(raw).withColumn("volume", F.col("volume").cast("string"))
        frames.append(raw)
    if not frames:
        return spark.createDataFrame([], T.StructType([T.StructField(n, T.StringType()) for n in (*REQUIRED, "source_file")]))
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def require_columns(df: DataFrame, required: Sequence[str] = REQUIRED) -> DataFrame:
    """``df``, if it has all columns; otherwise an error that lists what is not there."""
    absent = [c for c in required if c not in df.columns]
    if not absent:
        return df
    raise ValueError(f"Columns not in the input: {absent}; it has {df.columns}")


def wide_closes_to_long(df: DataFrame, id_columns: Sequence[str] = ("source_file",)) -> DataFrame:
    """``date, A, B, ...`` (one close per column) to one bar per (date, ticker); other shapes pass through."""
    ids = [c for c in ("date", *id_columns) if c in df.columns]
    tickers = [c for c in df.columns if c not in ids]
    if not HeaderPlan(tuple(df.columns)).is_wide or not tickers:
        return df
    closes = df.unpivot(ids, tickers, "ticker", "close")
    return closes.select("*", *[F.col("close").alias(c) for c in ("open", "high", "low")], F.lit(0).cast("bigint").alias("volume"))


def stem_ticker(file_name: Column) -> Column:
    """Ticker named by a file: the stem up to the first underscore, in upper case."""
    stem = F.regexp_replace(F.regexp_extract(file_name, r"([^/]+)$", 1), r"\.[^.]*$", "")
    return F.upper(F.split(stem, "_")[0])


def assign_ticker(df: DataFrame, ticker: str | None = None) -> DataFrame:
    """Keep a given ticker column, override it, or take it from the file name."""
    if ticker is not None:
        return df.withColumn("ticker", F.lit(ticker))
    if "ticker" in df.columns:
        return df
    return df.withColumn("ticker", stem_ticker(F.col("source_file")))


def normalize_provider(df: DataFrame, ticker: str | Column, source: str = "yfinance") -> DataFrame:
    """A provider download (``Date, Open, ..., Adj Close``) as bars with ticker and source."""
    named = df.withColumnsRenamed({c: HEADER_NAMES[c] for c in df.columns if c in HEADER_NAMES})
    return named.withColumns({"date": F.col("date").cast("date"), "ticker": F.lit(ticker) if isinstance(ticker, str) else ticker, "source": F.lit(source)})


def read_ticker_files(spark: SparkSession, folder: str, tickers: Sequence[str] | None = None, source: str = "yfinance") -> DataFrame:
    """One ``{ticker}.csv`` per ticker, each distinct header with its own scan.

    A line that does not fit the schema keeps its text in ``corrupt_record``. A file that cannot be read fails the job;
    ``absent_tickers`` lists those that have none.
    """
    kinds = {"date": T.DateType(), "volume": T.LongType()}
    frames = []
    for plan, files in _ticker_groups(spark, folder, tickers).items():
        fields = [T.StructField(n, kinds.get(n, T.DoubleType())) for n in plan.names]
        schema = T.StructType([*fields, T.StructField("corrupt_record", T.StringType())])
        raw = spark.read.schema(schema).option("header", True).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "corrupt_record").csv(files)
        frames.append(raw.withColumn("source_file", F.col("_metadata.file_name")))
    if not frames:
        names = [T.StructField(n, kinds.get(n, T.DoubleType())) for n in ("date", *OHLCV)]
        frames = [spark.createDataFrame([], T.StructType([*names, T.StructField("corrupt_record", T.StringType()), T.StructField("source_file", T.StringType())]))]
    return normalize_provider(reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames), stem_ticker(F.col("source_file")), source)


def _ticker_groups(spark: SparkSession, folder: str, tickers: Sequence[str] | None) -> dict[HeaderPlan, list[str]]:
    return header_groups(spark, folder, "*.csv" if tickers is None else "{" + ",".join(f"{t}.csv" for t in tickers) + "}")


def absent_tickers(spark: SparkSession, folder: str, tickers: Sequence[str]) -> DataFrame:
    """(ticker, reason) of the asked tickers of which no file with a header was found."""
    files = [(f,) for own in _ticker_groups(spark, folder, tickers).values() for f in own]
    there = spark.createDataFrame(files, "file string").select(stem_ticker(F.col("file")).alias("ticker"))
    asked = spark.createDataFrame([(t.upper(),) for t in tickers], "ticker string")
    return asked.join(there, "ticker", "left_anti").withColumn("reason", F.lit("no file, or an empty one"))


def recent(df: DataFrame, as_of: date, days: int = 200, until: date | None = None, date_column: str = "date", month_column: str = "month") -> DataFrame:
    """Rows from ``days`` days before ``as_of`` on, up to ``until`` if that is given. In a table stored by month, months outside are not read."""
    first = as_of - timedelta(days=days)
    by_month = month_column in df.columns
    rows = df.where(F.col(date_column) >= F.lit(first))
    rows = rows.where(F.col(month_column) >= f"{first:%Y-%m}") if by_month else rows
    if until is None:
        return rows
    rows = rows.where(F.col(date_column) <= F.lit(until))
    return rows.where(F.col(month_column) <= f"{until:%Y-%m}") if by_month else rows


def for_ticker_date(spark: SparkSession, table: DataFrame, ticker: str, day: date) -> DataFrame:
    """Rows of one ticker and date through a parameterised query."""
    return spark.sql(
        "SELECT * FROM {bars} WHERE ticker = :ticker AND date = :day", args={"ticker": ticker, "day": day}, bars=table
    )


def ticker_list(config: Column) -> Column:
    """Ticker list configured as JSON text."""
    return F.from_json(config, T.ArrayType(T.StringType()))


def only_tickers(df: DataFrame, tickers: DataFrame) -> DataFrame:
    return df.join(tickers.select("ticker").distinct(), "ticker", "left_semi")


def feature_source(spark: SparkSession, path: str | None = None, table: str | None = None,
                   jdbc: Mapping[str, str] | None = None) -> DataFrame:
    """A feature table from parquet files, the catalogue, or a database reached over JDBC."""
    if path:
        return spark.read.parquet(path)
    if table:
        return spark.table(table)
    if jdbc:
        return spark.read.format("jdbc").options(**jdbc).load()
    raise ValueError("give a path, a table or jdbc options")
