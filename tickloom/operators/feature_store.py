"""Feature views, services, point-in-time joins and latest values."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from datetime import date

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tickloom.functions.slices import SLICE, in_slice, slice_number, with_carry

MONTH_SECONDS = 30 * 86400


@dataclass(frozen=True)
class FeatureView:
    """A feature table: entity keys, event time, the columns served, and how long a row stays valid."""

    name: str
    df: DataFrame
    features: Sequence[str]
    ttl_days: int | None = None
    keys: Sequence[str] = ("ticker",)
    ts: str = "computed_at"
    descriptions: Mapping[str, str] = field(default_factory=dict)


@dataclass(frozen=True)
class OnDemandView:
    """Columns computed from joined features and request fields at read time."""

    name: str
    transform: Callable[[DataFrame], DataFrame]


@dataclass(frozen=True)
class FeatureService:
    name: str
    views: Sequence[FeatureView]
    on_demand: Sequence[OnDemandView] = ()


def price_momentum(df: DataFrame) -> DataFrame:
    """Moving averages relative to the requested price."""
    price = F.col("current_price").cast("double")
    return df.withColumns({
        "momentum_5d": F.try_divide(F.col("sma_20").cast("double"), price) - 1,
        "momentum_20d": F.try_divide(F.col("sma_50").cast("double"), price) - 1,
    })


def date_spine(tickers: DataFrame, start: date, end: date, name: str = "event_timestamp") -> DataFrame:
    """Every ticker on every day of a range."""
    days = F.sequence(F.lit(start), F.lit(end), F.make_dt_interval(F.lit(1)))
    return tickers.select("ticker").distinct().select("ticker", F.explode(days).alias(name))


def point_in_time(spine: DataFrame, views: Sequence[FeatureView], spine_ts: str = "event_timestamp",
                  slice_seconds: int = MONTH_SECONDS) -> DataFrame:
    """For each spine row the newest row of every view at or before its time, null when older than the view's TTL.

    All views are stacked with the spine and share one shuffle by (key, time slice). Inside a slice the newest row so far
    is a running ``last``; what earlier slices leave behind is carried in as one row per (key, slice). A key of
    any length is therefore spread over its slices. Of several feature rows with equal time the greatest is taken.
    """
    keys = list(views[0].keys)
    if any(list(v.keys) != keys for v in views):
        raise ValueError("views of one join must share their keys")
    slots = [f"__f{i}" for i in range(len(views))]
    stacked = spine.select(*keys, F.col(spine_ts).cast("timestamp").alias("__ts"), F.lit(1).alias("__side"),
                           F.struct(*spine.columns).alias("__row"))
    for slot, v in zip(slots, views):
        ts = F.col(v.ts).cast("timestamp")
        row = F.struct(ts.alias("__at"), *[F.col(c) for c in v.features])
        part = v.df.where(ts.isNotNull()).select(*keys, ts.alias("__ts"), F.lit(0).alias("__side"), row.alias(slot))
        stacked = stacked.unionByName(part, allowMissingColumns=True)
    stacked = stacked.withColumn(SLICE, slice_number(stacked, "__ts", slice_seconds))
    left_behind = {f"{s}_last": F.max(s) for s in slots}
    carry = {f"{s}_carry": (lambda w, s=s: F.last(f"{s}_last", ignorenulls=True).over(w)) for s in slots}
    w = in_slice(keys, F.col("__ts"), F.col("__side"), *[F.col(s) for s in slots])
    w = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ordered = stacked.withColumns({s: F.last(s, ignorenulls=True).over(w) for s in slots}).where(F.col("__side") == 1)
    out = with_carry(ordered, stacked, keys, left_behind, carry)
    out = out.withColumns({s: F.coalesce(F.col(s), F.col(f"{s}_carry")) for s in slots})
    columns = []
    for slot, v in zip(slots, views):
        age = F.unix_micros("__ts") - F.unix_micros(F.col(slot)["__at"])
        valid = F.lit(True) if v.ttl_days is None else age <= v.ttl_days * 86400 * 1000000
        columns += [F.when(valid, F.col(slot)[c]).alias(c) for c in v.features]
    return out.select("__row.*", *columns)


def historical_features(spine: DataFrame, service: FeatureService, spine_ts: str = "event_timestamp") -> DataFrame:
    """Training rows of a service: point-in-time values of all views, then its on-demand columns."""
    out = point_in_time(spine, service.views, spine_ts)
    for view in service.on_demand:
        out = view.transform(out)
    return out


def latest_values(view: FeatureView) -> DataFrame:
    """Newest row of each key, reduced on the map side."""
    newest = view.df.groupBy(*view.keys).agg(F.max(F.struct(view.ts, *view.features)).alias("__row"))
    return newest.select(*view.keys, *[F.col("__row")[c].alias(c) for c in view.features])


def online_features(request: DataFrame, service: FeatureService) -> DataFrame:
    """Newest values for the requested keys; a key without features keeps nulls."""
    out = request
    for view in service.views:
        wanted = view.df.join(request.select(*view.keys).distinct(), list(view.keys), "left_semi")
        out = out.join(latest_values(FeatureView(view.name, wanted, view.features, keys=view.keys, ts=view.ts)), list(view.keys), "left")
    for od in service.on_demand:
        out = od.transform(out)
    return out


def feature_catalogue(spark: SparkSession, views: Sequence[FeatureView]) -> DataFrame:
    """One row per feature: view, name, type, description."""
    rows = [
        (v.name, c, v.df.schema[c].dataType.simpleString(), v.descriptions.get(c, "")) for v in views for c in v.features
    ]
    return spark.createDataFrame(rows, "feature_view string, feature string, type string, description string")


def project_service(df: DataFrame, service: FeatureService, extra: Sequence[str] = ("ticker", "date")) -> DataFrame:
    """The columns a service serves from an already joined frame."""
    return df.select(*[c for c in extra if c in df.columns], *[c for v in service.views for c in v.features])


def feature_columns(df: DataFrame, ids: Sequence[str] = ("date", "ticker"),
                    targets: Sequence[str] = ("target_close", "target_return", "target_direction")) -> list[str]:
    """Every column that is neither an id nor a target."""
    return [c for c in df.columns if c not in {*ids, *targets}]
