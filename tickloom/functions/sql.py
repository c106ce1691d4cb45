"""Functions that SQL can call: a table function for data quality, and RSI by ticker and date."""

from __future__ import annotations

from pyspark.sql import SparkSession


def register(spark: SparkSession, bars: str = "raw_market_data", quality: str = "data_quality_metrics") -> None:
    """Temporary SQL functions over two tables or views of the session.

    * ``validate_market_data([day])``: bars of a day, yesterday by default, with their flags and quality score, 0.5 without one.
    * ``compute_rsi(ticker, day[, period])``: RSI on simple means at the last bar up to a day; null before ``period`` changes
      are known and without a loss. A query that calls it per row reads each ticker's closes once, as one list bounded by the
      calendar.
    """
    spark.sql(f"""
        CREATE OR REPLACE TEMPORARY FUNCTION validate_market_data(day DATE DEFAULT date_sub(current_date(), 1))
        RETURNS TABLE (ticker STRING, validation_date DATE, has_missing BOOLEAN, has_outliers BOOLEAN, quality_score DOUBLE)
        RETURN SELECT b.ticker, b.date, b.open IS NULL OR b.close IS NULL OR b.volume IS NULL, b.close > b.high OR b.close < b.low,
                      coalesce(CAST(q.quality_score AS DOUBLE), 0.5D)
               FROM {bars} b LEFT JOIN {quality} q ON b.ticker = q.ticker AND b.date = q.date
               WHERE b.date = validate_market_data.day""")
    spark.sql("""
        CREATE OR REPLACE TEMPORARY FUNCTION rsi_of_closes(closes ARRAY<DOUBLE>, period INT)
        RETURNS DOUBLE
        RETURN CASE WHEN size(closes) > period THEN 100 - 100 / (1 + try_divide(
            aggregate(sequence(1, period), 0D, (sum, i) -> sum + greatest(closes[i] - closes[i - 1], 0D)),
            aggregate(sequence(1, period), 0D, (sum, i) -> sum + greatest(closes[i - 1] - closes[i], 0D)))) END""")
    spark.sql(f"""
        CREATE OR REPLACE TEMPORARY FUNCTION closes_of(ticker STRING)
        RETURNS ARRAY<STRUCT<date: DATE, close: DOUBLE>>
        RETURN (SELECT array_sort(collect_list(named_struct('date', b.date, 'close', CAST(b.close AS DOUBLE)))) FROM {bars} b WHERE b.ticker = closes_of.ticker)""")
    spark.sql("""
        CREATE OR REPLACE TEMPORARY FUNCTION last_closes(bars ARRAY<STRUCT<date: DATE, close: DOUBLE>>, day DATE, n INT)
        RETURNS ARRAY<DOUBLE>
        RETURN slice(transform(filter(bars, b -> b.date <= day), b -> b.close), greatest(size(filter(bars, b -> b.date <= day)) - n, 0) + 1, n)""")
    spark.sql("""
        CREATE OR REPLACE TEMPORARY FUNCTION compute_rsi(ticker STRING, day DATE, period INT DEFAULT 14)
        RETURNS DOUBLE
        RETURN rsi_of_closes(last_closes(closes_of(ticker), day, period + 1), period)""")
