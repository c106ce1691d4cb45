"""Registration of queries with the SQL that states the same result."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

BARS_SQL = """bars AS (
  SELECT n_name AS ticker, r_name AS sector, CAST(date_trunc('week', o_orderdate) AS DATE) AS date,
         arg_min(o_totalprice, o_orderkey) AS open, max(o_totalprice) AS high, min(o_totalprice) AS low,
         arg_max(o_totalprice, o_orderkey) AS close, count(*) AS volume
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
       JOIN region ON n_regionkey = r_regionkey
  GROUP BY 1, 2, 3)"""

WINDOW_SQL = "WINDOW w AS (PARTITION BY ticker ORDER BY date)"


def frame(n: int) -> str:
    return f"(PARTITION BY ticker ORDER BY date ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)"


def rolling_sql(fn: str, x: str, n: int) -> str:
    return f"(CASE WHEN count({x}) OVER {frame(n)} >= {n} THEN {fn}({x}) OVER {frame(n)} END)"


def rsql(x: str, n: int) -> str:
    """Rounded and free of negative zero."""
    return f"(round({x}, {n}) + 0.0)"


def portable(df: DataFrame) -> DataFrame:
    """Dates and times as text, so that every reader compares the same values."""
    out = []
    for f in df.schema:
        if isinstance(f.dataType, T.DateType):
            out.append(F.col(f.name).cast("string").alias(f.name))
        elif isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType)):
            out.append(F.date_format(f.name, "yyyy-MM-dd HH:mm:ss").alias(f.name))
        else:
            out.append(F.col(f.name))
    return df.select(*out)


def day_sql(x: str) -> str:
    return f"CAST({x} AS VARCHAR)"


def second_sql(x: str) -> str:
    return f"strftime({x}, '%Y-%m-%d %H:%M:%S')"


def rounded(df: DataFrame, digits: Mapping[str, int]) -> DataFrame:
    def value(c: str) -> Column:
        return (F.round(F.col(c).cast("double"), digits[c]) + F.lit(0.0)).alias(c) if c in digits else F.col(c)

    return df.select(*[value(c) for c in df.columns])


def query(name: str, oracle: str | None = None) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        QUERIES[name] = lambda spark, folder: portable(f(spark, folder))
        if oracle is not None:
            ORACLES[name] = oracle
        return f

    return add
