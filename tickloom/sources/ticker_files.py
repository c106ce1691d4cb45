"""Ticker files that fail by themselves: one unreadable file gives a report row, the others their bars.

Each file is one row of Spark's own binary reader, so the files are listed and opened wherever Spark can read, and a
task parses them by the header that each begins with. A ticker's daily file is bounded by the calendar.
"""

from __future__ import annotations

import csv
import gzip
import io
import math
from collections.abc import Iterator
from datetime import date

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.sources.readers import HEADER_NAMES, stem_ticker
from tickloom.sources.schemas import OHLCV, REQUIRED

NUMBERS = [*OHLCV, "adj_close"]
ROW = "path string, line int, date date, " + ", ".join(f"{c} double" for c in NUMBERS) + ", error string"


class UnreadableFile(ValueError):
    """A file that gives no bars at all."""


def bars_of_file(name: str, data: bytes) -> Iterator[tuple]:
    """(line, date, numbers, error) of each line of a file. A bad line has an error and nothing else; a bad file raises."""
    try:
        text = (gzip.decompress(data) if name.endswith(".gz") else data).decode("utf-8-sig")
    except (OSError, EOFError, UnicodeDecodeError) as e:
        raise UnreadableFile(f"{type(e).__name__}: {e}") from e
    lines = csv.reader(io.StringIO(text, newline=""))
    header = [HEADER_NAMES.get(c.strip(), c.strip()) for c in next(lines, [])]
    absent = [c for c in REQUIRED if c not in header]
    if absent:
        raise UnreadableFile(f"Missing columns: {', '.join(absent)}")
    at = {c: header.index(c) for c in header}
    for number, cells in enumerate(lines, 2):
        if not cells:
            continue
        try:
            if len(cells) != len(header):
                raise ValueError(f"{len(cells)} cells for {len(header)} columns")
            day = date.fromisoformat(cells[at["date"]].strip()[:10])
            values = [_number(cells[at[c]]) if c in at else None for c in NUMBERS]
        except ValueError as e:
            yield number, None, [None] * len(NUMBERS), f"line {number}: {e}"
        else:
            yield number, day, values, None


def _number(cell: str) -> float | None:
    """A number; an empty cell and NaN are missing."""
    value = float(cell) if cell.strip() else math.nan
    return None if math.isnan(value) else value


def read_apart(spark: SparkSession, path: str, ticker: Column | None = None, source: str = "yfinance") -> DataFrame:
    """Bars of all files that match ``path`` (folder or pattern): ticker, date, numbers, source, source_file, error.

    Rows without ``error`` are bars; a file that can't be read, or isn't a table of bars, is one row with its error, and so is
    a bad line. ``ticker`` comes from the file's name by default. A text file that breaks off gives its whole lines. Nothing is
    read twice. Files without a byte are passed over by Spark, and so have no row; a folder without files gives none.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).select("path", "content")
    schema = spark.createDataFrame([], ROW).schema

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        arrow = to_arrow_schema(schema)
        for batch in batches:
            for name, data in zip(batch.column(0).to_pylist(), batch.column(1)):
                try:
                    rows = [(name, line, day, *values, error) for line, day, values, error in bars_of_file(name, data.as_py())]
                    if not rows:
                        raise UnreadableFile("No lines")
                except (UnreadableFile, csv.Error) as e:
                    rows = [(name, None, None, *[None] * len(NUMBERS), str(e))]
                yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(arrow.types)], schema=arrow)

    found = files.mapInArrow(parse, schema)
    named = stem_ticker(F.regexp_replace("path", r"\.gz$", "")) if ticker is None else ticker
    return found.select(named.alias("ticker"), "date", *[F.col(c).cast("bigint").alias(c) if c == "volume" else F.col(c) for c in NUMBERS],
                        F.lit(source).alias("source"), F.col("path").alias("source_file"), "error")


def split_readable(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(bars, report): the report has one row per file or line that failed."""
    bad = F.col("error").isNotNull()
    return rows.where(~bad).drop("error"), rows.where(bad).select("ticker", "source_file", "error")
