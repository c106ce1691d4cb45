"""Registered queries that call the package's SQL functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from tickloom.functions import sql
from tickloom.plans import datasets
from tickloom.plans.market_queries import BARS, REPORT_SQL, RSI_A, _quality
from tickloom.plans.registry import day_sql, query, rsql


def _session(spark, folder):
    bars = datasets.bars_table(spark, folder)
    bars.createOrReplaceTempView("tickloom_bars")
    _quality(bars).where(F.col("quality_score") < 1).createOrReplaceTempView("tickloom_quality")
    sql.register(spark, "tickloom_bars", "tickloom_quality")
    return spark


@query("sql_validate_market_data", f"{REPORT_SQL} WHERE bars.date = DATE '1998-06-01'")
def sql_validate_market_data(spark, folder):
    return _session(spark, folder).sql("SELECT * FROM validate_market_data(DATE '1998-06-01')")


@query("sql_compute_rsi", f"""{BARS}, {RSI_A} SELECT ticker, {day_sql('date')} AS date, {rsql('rsi_14', 6)} AS rsi FROM rsi""")
def sql_compute_rsi(spark, folder):
    """RSI of every bar through a lateral call of the scalar function."""
    return _session(spark, folder).sql(
        "SELECT b.ticker, b.date, round(r.rsi, 6) + 0D AS rsi FROM tickloom_bars b, LATERAL (SELECT compute_rsi(b.ticker, b.date, 14) AS rsi) r")
