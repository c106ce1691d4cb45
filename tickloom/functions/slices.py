"""Ordered computations over series of unbounded length.

A window partitioned by the key alone puts a whole key into one task. Here each key is cut into
slices of time (or of value). A slice is summarised by an ordinary aggregate, which combines on the map
side; the summaries, one short row per (key, slice), are scanned in order to learn what the earlier
slices leave behind; and the rows are then ordered only inside their own (key, slice). The result is
exact, and the largest task is one slice rather than one key.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F
from pyspark.sql import types as T

SLICE = "__slice"
DEFAULT_SLICE_SECONDS = 600


def slice_number(df: DataFrame, column: str, seconds: int = DEFAULT_SLICE_SECONDS) -> Column:
    """Number of the time slice that holds ``column`` (DATE or TIMESTAMP)."""
    if isinstance(df.schema[column].dataType, T.DateType):
        return F.floor(F.unix_date(column) / max(1, seconds // 86400))
    return F.floor(F.unix_seconds(F.col(column).cast("timestamp")) / seconds)


def suggest_slice_seconds(df: DataFrame, keys: Sequence[str], ts: str, rows_per_slice: int = 1_000_000) -> int:
    """Slice width that gives the busiest key about ``rows_per_slice`` rows per slice (one small job)."""
    seconds = F.unix_seconds(F.col(ts).cast("timestamp"))
    per_key = df.groupBy(*keys).agg(F.count("*").alias("n"), (F.max(seconds) - F.min(seconds)).alias("span"))
    busiest = per_key.agg(F.max(F.try_divide(F.col("n"), F.col("span") + 1)).alias("rate")).first()
    return max(1, int(rows_per_slice / busiest["rate"])) if busiest and busiest["rate"] else DEFAULT_SLICE_SECONDS


def with_carry(ordered: DataFrame, source: DataFrame, keys: Sequence[str], summary: Mapping[str, Column],
               carry: Mapping[str, Callable[[WindowSpec], Column]]) -> DataFrame:
    """Add to every row of ``ordered`` the state left behind by the earlier slices of its key in ``source``.

    ``summary`` holds the aggregates of a slice, ``carry`` builds each carried column from them over the window of all
    earlier slices. ``ordered`` should already hold its windows inside a slice: the join then finds the rows sorted by
    (key, slice) and adds no sort of its own.
    """
    per_slice = source.groupBy(SLICE, *keys).agg(*[c.alias(n) for n, c in summary.items()])
    earlier = Window.partitionBy(*keys).orderBy(SLICE).rowsBetween(Window.unboundedPreceding, -1)
    carried = per_slice.select(*keys, SLICE, *[f(earlier).alias(n) for n, f in carry.items()])
    return ordered.join(carried, [SLICE, *keys])


def in_slice(keys: Sequence[str], *order: Column) -> WindowSpec:
    """Rows of one slice in order. The slice number comes first, as a number sorts faster than a text key."""
    return Window.partitionBy(SLICE, *keys).orderBy(*order)


def order_value(df: DataFrame, ts: str, ties: Sequence[str]) -> Column:
    """One value that sorts like (ts, ties). Of fixed width where possible, so that an aggregate over it is hashed."""
    if not ties:
        return F.col(ts)
    if len(ties) == 1 and isinstance(df.schema[ties[0]].dataType, (T.LongType, T.IntegerType)):
        micros = F.unix_micros(F.col(ts).cast("timestamp")).cast("decimal(18,0)")
        apart = F.lit(str(2 * 10**19)).cast("decimal(20,0)")  # wider than the range of a bigint
        return (micros * apart).cast("decimal(38,0)") + F.col(ties[0]).cast("decimal(19,0)")
    return F.struct(ts, *ties)


def with_previous(df: DataFrame, keys: Sequence[str], ts: str, column: str, name: str, ties: Sequence[str] = (),
                  seconds: int = DEFAULT_SLICE_SECONDS) -> DataFrame:
    """``lag(column)`` along (ts, ties) for each key."""
    sliced = df.withColumn(SLICE, slice_number(df, ts, seconds))
    w = in_slice(keys, *[F.col(c) for c in (ts, *ties)])
    ordered = sliced.withColumns({"__here": F.lag(column).over(w), "__first": F.row_number().over(w) == 1})
    out = with_carry(
        ordered, sliced, keys, {"__last": F.max_by(column, order_value(df, ts, ties))},
        {"__prev": lambda earlier: F.last("__last").over(earlier)},
    )
    value = F.when(F.col("__first"), F.col("__prev")).otherwise(F.col("__here"))
    return out.withColumn(name, value).drop(SLICE, "__prev", "__here", "__first")


def with_running_sum(df: DataFrame, keys: Sequence[str], ts: str, column: str, name: str, ties: Sequence[str] = (),
                     seconds: int = DEFAULT_SLICE_SECONDS) -> DataFrame:
    """Sum of ``column`` over all rows up to this one along (ts, ties), for each key."""
    sliced = df.withColumn(SLICE, slice_number(df, ts, seconds))
    w = in_slice(keys, *[F.col(c) for c in (ts, *ties)]).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    out = with_carry(
        sliced.withColumn("__here", F.sum(column).over(w)), sliced, keys, {"__sum": F.sum(column)},
        {"__before": lambda earlier: F.sum("__sum").over(earlier)},
    )
    zero = F.lit(0)
    return out.withColumn(name, F.coalesce("__before", zero) + F.coalesce("__here", zero)).drop(SLICE, "__before", "__here")


def newest_rows(df: DataFrame, keys: Sequence[str], order: Sequence[str], k: int, salts: int = 64,
                seconds: int = DEFAULT_SLICE_SECONDS) -> DataFrame:
    """The ``k`` newest rows of each key along ``order`` (the reference keeps the last 1000 requests).

    Where the order starts with a time, counts per (key, slice) first tell which slices can hold them, and only those are
    ordered. Every key is then cut into salted parts, so that the last step sees at most ``k * salts`` rows of it.
    """
    if isinstance(df.schema[order[0]].dataType, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        df = df.withColumn(SLICE, slice_number(df, order[0], seconds))
        counts = df.groupBy(*keys, SLICE).agg(F.count("*").alias("__n"))
        newer = Window.partitionBy(*keys).orderBy(F.col(SLICE).desc()).rowsBetween(Window.unboundedPreceding, -1)
        near = counts.withColumn("__newer", F.coalesce(F.sum("__n").over(newer), F.lit(0))).where(F.col("__newer") < k)
        df = df.join(near.select(*keys, SLICE), [*keys, SLICE], "left_semi").drop(SLICE)
    newest = [F.col(c).desc() for c in order]
    salted = df.withColumn("__salt", F.pmod(F.xxhash64(*order), F.lit(salts)))
    part = Window.partitionBy(*keys, "__salt").orderBy(*newest)
    whole = Window.partitionBy(*keys).orderBy(*newest)
    return (
        salted.withColumn("__rn", F.row_number().over(part)).where(F.col("__rn") <= k)
        .withColumn("__rn", F.row_number().over(whole)).where(F.col("__rn") <= k)
        .drop("__salt", "__rn")
    )


#: Slices in each doubling of a value, and the parts that a slice with a wanted rank is cut into.
SLICES_PER_OCTAVE, PARTS = 64, 4096


def value_slice(v: Column) -> Column:
    """Number of the slice that holds a value: about one percent wide anywhere but at zero, ascending with the value."""
    octave = F.floor(F.log2(F.abs(v)) * SLICES_PER_OCTAVE) + 1100 * SLICES_PER_OCTAVE
    return F.when(v == 0, F.lit(0)).otherwise(F.signum(v).cast("bigint") * octave)


def order_statistics(df: DataFrame, keys: Sequence[str], value: str, fractions: Mapping[str, float]) -> DataFrame:
    """For each key the sorted value at index ``floor(n * q)``, without interpolation, for each named q.

    Equal values are counted together first. The distinct values are cut into slices of about one percent relative width; the
    slices that hold a wanted rank are cut again, evenly between their least and greatest value, and only the parts that hold
    one are ordered: values close together are spread over tasks as well as those over many scales.
    """
    v = F.col(value)
    counted = df.where(v.isNotNull()).groupBy(*keys, value).agg(F.count("*").alias("__n")).withColumn(SLICE, value_slice(v))
    per_slice = counted.groupBy(*keys, SLICE).agg(F.sum("__n").alias("__in"), F.min(v).alias("__lo"), F.max(v).alias("__hi"))
    ordered = Window.partitionBy(*keys).orderBy(SLICE)
    per_slice = per_slice.select(
        *keys, SLICE, "__in", "__lo", "__hi",
        (F.sum("__in").over(ordered) - F.col("__in")).alias("__before"),
        F.sum("__in").over(Window.partitionBy(*keys)).alias("__total"),
    )
    rank = {n: F.floor(F.col("__total") * F.lit(float(q))) for n, q in fractions.items()}

    def holds_a_rank(count: str) -> Column:
        wanted = F.lit(False)
        for r in rank.values():
            wanted = wanted | ((r >= F.col("__before")) & (r < F.col("__before") + F.col(count)))
        return wanted

    near = counted.join(per_slice.where(holds_a_rank("__in")).drop("__in"), [*keys, SLICE])
    share = F.coalesce(F.try_divide(v - F.col("__lo"), F.col("__hi") - F.col("__lo")), F.lit(0.0))
    near = near.withColumn("__part", F.floor(share * (PARTS - 1))).drop("__lo", "__hi")
    parts = near.groupBy(*keys, SLICE, "__part", "__before", "__total").agg(F.sum("__n").alias("__in"))
    earlier = F.sum("__in").over(Window.partitionBy(*keys, SLICE).orderBy("__part")) - F.col("__in")
    parts = parts.withColumn("__before", F.col("__before") + earlier).where(holds_a_rank("__in"))
    rows = near.drop("__before", "__total").join(parts.drop("__in"), [*keys, SLICE, "__part"])
    below = F.col("__before") + F.sum("__n").over(Window.partitionBy(*keys, SLICE, "__part").orderBy(v)) - F.col("__n")
    rows = rows.withColumn("__first", below)
    return rows.groupBy(*keys).agg(
        *[F.max(F.when((r >= F.col("__first")) & (r < F.col("__first") + F.col("__n")), v)).alias(n)
          for n, r in rank.items()]
    )
