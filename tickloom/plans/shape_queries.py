"""Registered queries on the shape of tables: provider files, defaults, feature catalogue, projections, ticker lists, gates."""

from __future__ import annotations

from pyspark.sql import functions as F

from tickloom.operators import clean, feature_store, validate
from tickloom.plans import datasets
from tickloom.plans.market_queries import BARS
from tickloom.plans.registry import WINDOW_SQL, day_sql, query
from tickloom.session import work_folder
from tickloom.sources import readers, schemas, sinks
from tickloom.sources.key_filter import KeyFilter

SPELLED = {"date": "Date", "open": "Open", "high": "High", "low": "Low", "close": "Close", "volume": "Volume"}


@query("provider_bars", f"""{BARS} SELECT replace(ticker, '_', '-') AS ticker, {day_sql('date')} AS date, open, high, low, close, volume, close / 2 AS adj_close,
  'vendor' AS source FROM bars""")
def provider_bars(spark, folder):
    """Bars in the spelling of a provider, one file name per ticker, as bars with ticker and source."""
    bars = datasets.bars(spark, folder)
    download = bars.withColumnsRenamed(SPELLED).withColumn("Adj Close", F.col("Close") / 2)
    download = download.withColumn("source_file", F.concat(F.lit("landing/"), F.lower(F.replace("ticker", F.lit("_"), F.lit("-"))), F.lit("_daily.csv")))
    named = readers.assign_ticker(readers.normalize_provider(download.drop("sector"), readers.stem_ticker(F.col("source_file")), "vendor"))
    return readers.require_columns(named).drop("source_file")


@query("default_fields", f"""{BARS} SELECT ticker, {day_sql('date')} AS date, CAST(NULL AS DOUBLE) AS adj_close,
  CASE WHEN volume >= 2 THEN 'own' ELSE 'unknown' END AS source FROM bars""")
def default_fields(spark, folder):
    """Bars without an adjusted close, some without a source."""
    bars = datasets.bars(spark, folder).withColumn("source", F.when(F.col("volume") >= 2, "own"))
    return clean.fill_defaults(bars).select("ticker", "date", "adj_close", "source")


def _views(b):
    returns = datasets.known_next_day(b.withColumn("spread", F.col("high") - F.col("low")))
    return [
        feature_store.FeatureView("prices", returns, ["open", "close"], descriptions={"close": "last price"}),
        feature_store.FeatureView("shape", returns, ["spread", "volume"]),
    ]


@query("catalogue_counts", f"""{BARS} SELECT * FROM (VALUES ('prices', 'open', 'double', ''), ('prices', 'close', 'double', 'last price'),
  ('shape', 'spread', 'double', ''), ('shape', 'volume', 'bigint', '')) AS c(feature_view, feature, type, description),
  (SELECT count(*) AS stored FROM bars) AS n""")
def catalogue_counts(spark, folder):
    """The feature catalogue with the stored values of each feature."""
    views = _views(datasets.bars(spark, folder))
    catalogue = feature_store.feature_catalogue(spark, views)
    served = views[0].df.select(*[F.col(c).cast("double").alias(c) for v in views for c in v.features])
    counts = served.agg(*[F.count(c).alias(c) for c in served.columns]).unpivot([], served.columns, "feature", "stored")
    return catalogue.join(counts, "feature")


@query("service_columns", f"""{BARS}, led AS (SELECT ticker, date, open, close, high - low AS spread, volume, lead(close) OVER w AS target_close FROM bars {WINDOW_SQL})
  SELECT ticker, {day_sql('date')} AS date, open, close, spread, volume, target_close FROM led WHERE target_close IS NOT NULL""")
def service_columns(spark, folder):
    """Complete training rows cut to what a service serves; the targets are what is neither an id nor a feature."""
    from tickloom.operators.targets import with_targets

    b = datasets.bars(spark, folder)
    service = feature_store.FeatureService("serve", _views(b))
    rows = clean.drop_incomplete(with_targets(b.withColumn("spread", F.col("high") - F.col("low"))), ("target_return", "target_direction"))
    features = feature_store.feature_columns(rows, ("date", "ticker", "sector"))
    kept = feature_store.project_service(rows, service, ("ticker", "date", "target_close"))
    return kept.select("ticker", "date", *[c for c in features if c in kept.columns], "target_close")


@query("configured_tickers", f"""{BARS} SELECT ticker, {day_sql('date')} AS date, close FROM bars
  WHERE ticker IN (SELECT n_name FROM nation WHERE n_regionkey < 2)""")
def configured_tickers(spark, folder):
    """Bars of the tickers that regions list in their configuration text, one JSON list per region."""
    nations = datasets.table(spark, folder, "nation").where("n_regionkey < 2")
    config = nations.groupBy("n_regionkey").agg(F.to_json(F.collect_list("n_name")).alias("tickers"))
    wanted = config.select(F.explode(readers.ticker_list(F.col("tickers"))).alias("ticker"))
    return readers.only_tickers(datasets.bars(spark, folder), wanted).select("ticker", "date", "close")


@query("gated_bars", f"""{BARS} SELECT ticker, count(*) AS bars, count(*) FILTER (close > high OR close < low OR close IS NULL) AS flagged FROM bars
  GROUP BY ticker HAVING (SELECT avg(CASE WHEN close > high OR close < low THEN 0.75 ELSE 1 END) FROM bars) >= 0.85""")
def gated_bars(spark, folder):
    """Bars per ticker, once the average score of all bars has passed the gate."""
    flags = validate.quality_flags(datasets.bars_table(spark, folder))
    scores = flags.withColumn("quality_score", F.when(F.col("price_outlier") | F.col("missing_ohlcv"), 0.75).otherwise(1.0))
    validate.quality_gate(validate.quality_summary(scores))
    return scores.groupBy("ticker").agg(F.count("*").alias("bars"), F.count_if(F.col("quality_score") < 1).alias("flagged"))


@query("append_twice", f"""{BARS} SELECT (SELECT count(*) FROM bars WHERE volume >= 2) AS first, (SELECT count(*) FROM bars WHERE NOT volume >= 2) AS second,
  0::BIGINT AS third, count(*) AS stored, {day_sql('max(date)')} AS last FROM bars""")
def append_twice(spark, folder):
    """Rows counted by three appends to one table by month, some of them stored before, and a metadata file that tells of them."""
    root = work_folder(spark, "append")
    bars = clean.fill_defaults(datasets.bars_table(spark, folder).withColumns({c: F.col(c) / 100 for c in ("open", "high", "low", "close")}))
    counts = [sinks.append_if_absent(spark, b, f"{root}/bars") for b in (bars.where("volume >= 2"), bars, bars)]
    sinks.write_metadata(spark, f"{root}/metadata", **dict(zip(("first", "second", "third"), counts)))
    told = spark.read.text(f"{root}/metadata").select(F.from_json("value", "first bigint, second bigint, third bigint").alias("m")).select("m.*")
    table = sinks.read_table(spark, f"{root}/bars", schemas.RAW_BARS).agg(F.count("*").alias("stored"), F.max("date").alias("last"))
    return told.withColumns({"stored": table.select("stored").scalar(), "last": table.select("last").scalar()})


@query("refused_batches", f"""{BARS}, b AS (SELECT ticker, strftime(date, '%Y') AS year, count(*) OVER (PARTITION BY ticker, strftime(date, '%Y')) AS n FROM bars)
  SELECT ticker || '_' || year AS batch_id, n AS batch_size, CASE WHEN n > 40 THEN 'Batch size exceeds 40' END AS batch_error, count(*) AS items FROM b GROUP BY ALL""")
def refused_batches(spark, folder):
    """Years of bars as batches of requests; a batch above the limit is refused as a whole."""
    from tickloom.operators.scoring import within_batch_limit

    items = datasets.bars_table(spark, folder).select(F.concat_ws("_", "ticker", F.date_format("date", "yyyy")).alias("batch_id"))
    return within_batch_limit(items, limit=40).groupBy("batch_id", "batch_size", "batch_error").agg(F.count("*").alias("items"))


@query("append_filtered", f"""{BARS} SELECT ticker, {day_sql('date')} AS date, round(close, 2) + 0.0 AS close, (date < DATE '1998-01-01') AS batch_one FROM bars""")
def append_filtered(spark, folder):
    """Three appends under a filter of stored keys: the first batch, the rest of the bars, and all of them once more; the
    first version of a key stays."""
    root = work_folder(spark, "append-filtered")
    bars = datasets.bars_table(spark, folder).withColumns({c: F.col(c) / 100 for c in ("open", "high", "low", "close")}).withColumn("source", F.lit("own"))
    known = KeyFilter(f"{root}/bars_keys", sinks.BAR_KEY, buckets=4)
    for batch, own in ((bars.where("date < DATE'1998-01-01'"), 1), (bars, 0), (bars, -1)):
        sinks.append_if_absent(spark, clean.fill_defaults(batch).withColumn("adj_close", F.lit(own)), f"{root}/bars", known=known)
    table = sinks.read_table(spark, f"{root}/bars", schemas.RAW_BARS)
    return table.select("ticker", "date", F.round(F.col("close").cast("double") * 100, 2).alias("close"), (F.col("adj_close") == 1).alias("batch_one"))
