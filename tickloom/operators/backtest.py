"""Signal backtest as windows over bars: runs of equal signal, trades, equity, metrics, bootstrap."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickloom.functions.rolling import bars_window, pct_change, running

DAYS = 252


@dataclass(frozen=True)
class BacktestConfig:
    capital: float = 10000.0
    cost: float = 0.001
    risk_free: float = 0.02
    price: str = "close"
    equity_mode: str = "reference"  # adds the whole open profit each bar; or "mark_to_market"


def missing_signals(bars: DataFrame, signals: DataFrame) -> DataFrame:
    """Tickers that have bars but no signal at all; they are skipped."""
    return bars.select("ticker").distinct().join(signals.select("ticker"), "ticker", "left_anti")


def signal_runs(bars: DataFrame, signals: DataFrame, cfg: BacktestConfig = BacktestConfig()) -> DataFrame:
    """Bars with their signal (flat where none is given), the number of their run, and the entry of the run.

    After each bar the position equals the signal, so a position is a run of equal signals. The entry price carries the
    cost for long and short alike.
    """
    prices = bars.select("ticker", "date", F.col(cfg.price).cast("double").alias("price"))
    with_any = signals.select("ticker").distinct()
    joined = prices.join(with_any, "ticker", "left_semi").join(
        signals.select("ticker", "date", F.col("signal").cast("int").alias("signal")), ["ticker", "date"], "left")
    joined = joined.withColumn("signal", F.coalesce("signal", F.lit(0)))
    w = bars_window()
    changed = (F.col("signal") != F.lag("signal", 1, 0).over(w)).cast("int")
    runs = joined.withColumn("__changed", changed).withColumn("run", F.sum("__changed").over(running(w)))
    first = Window.partitionBy("ticker", "run").orderBy("date").rowsBetween(Window.unboundedPreceding, 0)
    held = F.col("signal") != 0
    return runs.withColumns({
        "entry_price": F.when(held, F.first("price").over(first) * (1 + cfg.cost)),
        "entry_date": F.when(held, F.first("date").over(first)),
    }).drop("__changed")


def run_table(runs: DataFrame) -> DataFrame:
    """One row per run with the first price and date of the next run, where it ends."""
    per_run = runs.groupBy("ticker", "run").agg(
        F.first("signal").alias("signal"), F.first("entry_price").alias("entry_price"),
        F.min("date").alias("start_date"), F.min_by("price", "date").alias("first_price"),
    )
    w = Window.partitionBy("ticker").orderBy("run")
    return per_run.withColumns({
        "exit_date": F.lead("start_date").over(w), "exit_price": F.lead("first_price").over(w),
    })


def all_trades(runs: DataFrame) -> DataFrame:
    """Positions with their exit; an open one has no exit date."""
    long = F.col("signal") > 0
    gain = F.when(long, F.col("exit_price") - F.col("entry_price")).otherwise(F.col("entry_price") - F.col("exit_price"))
    return run_table(runs).where((F.col("signal") != 0) & (F.col("entry_price") > 0)).select(
        "ticker", F.when(long, "long").otherwise("short").alias("position"), F.col("start_date").alias("entry_date"),
        "entry_price", "exit_date", "exit_price", gain.alias("pnl"), F.try_divide(gain, F.col("entry_price")).alias("pnl_pct"),
    )


def closed_trades(runs: DataFrame) -> DataFrame:
    return all_trades(runs).where(F.col("exit_date").isNotNull())


def open_positions(runs: DataFrame) -> DataFrame:
    return all_trades(runs).where(F.col("exit_date").isNull()).drop("exit_date", "exit_price", "pnl", "pnl_pct")


def equity_curve(runs: DataFrame, cfg: BacktestConfig = BacktestConfig()) -> DataFrame:
    """Equity after each bar and its change.

    ``reference`` adds the open profit of the position at every bar; ``mark_to_market`` adds only the change of the bar.
    """
    w = bars_window()
    if cfg.equity_mode == "reference":
        step = F.coalesce((F.col("price") - F.col("entry_price")) * F.col("signal"), F.lit(0.0))
    elif cfg.equity_mode == "mark_to_market":
        carried = (F.col("price") - F.lag("price").over(w)) * F.lag("signal").over(w)
        opened = F.when(F.col("date") == F.col("entry_date"), (F.col("price") - F.col("entry_price")) * F.col("signal"))
        step = F.coalesce(carried, F.lit(0.0)) + F.coalesce(opened, F.lit(0.0))
    else:
        raise ValueError(f"unknown equity mode {cfg.equity_mode}")
    out = runs.withColumn("__step", step).withColumn("equity", F.lit(cfg.capital) + F.sum("__step").over(running(w)))
    return out.withColumn("equity_return", pct_change(F.col("equity"), w)).drop("__step")


def drawdown(curve: DataFrame) -> DataFrame:
    """Relative distance to the running peak of compounded returns, from the second bar on."""
    w = bars_window()
    first = F.first("equity").over(running(w))
    grown = curve.withColumn("cumulative", F.when(F.col("equity_return").isNotNull(), F.try_divide(F.col("equity"), first)))
    peaked = grown.withColumn("peak", F.max("cumulative").over(running(w)))
    return peaked.withColumn("drawdown", F.try_divide(F.col("cumulative") - F.col("peak"), F.col("peak")))


def risk_columns(r: Column, risk_free: float = 0.02) -> dict[str, Column]:
    """Aggregates of a return column: annualised volatility, Sharpe and Sortino ratios."""
    root = F.sqrt(F.lit(float(DAYS)))
    excess = F.avg(r - risk_free / DAYS)
    dev = F.stddev_samp(r)
    down = F.stddev_samp(F.when(r < 0, r)) * root
    return {
        "volatility": dev * root,
        "sharpe_ratio": F.when(dev > 0, F.try_divide(excess, dev) * root).otherwise(F.lit(0.0)),
        "sortino_ratio": F.when(down > 0, F.try_divide(excess, down) * root).otherwise(F.lit(0.0)),
    }


def risk_metrics(returns: DataFrame, column: str = "returns", keys: tuple[str, ...] = ("ticker",), order: str = "date",
                 risk_free: float = 0.02) -> DataFrame:
    """Volatility, Sharpe, Sortino and maximum drawdown of return series.

    Compounding runs on logarithms, so that it is a running sum of each key's calendar-bounded series.
    """
    r = F.col(column)
    w = running(bars_window(keys, order))
    out = returns.where(r.isNotNull()).withColumn("__grown", F.exp(F.sum(F.log1p(r)).over(w)))
    out = out.withColumn("__peak", F.max("__grown").over(w))
    low = F.min(F.try_divide(F.col("__grown") - F.col("__peak"), F.col("__peak")))
    return out.groupBy(*keys).agg(*[c.alias(n) for n, c in risk_columns(r, risk_free).items()], low.alias("max_drawdown"))


def backtest_metrics(runs: DataFrame, cfg: BacktestConfig = BacktestConfig()) -> DataFrame:
    """One result row per ticker."""
    falls = drawdown(equity_curve(runs, cfg))
    total = (F.max_by("equity", "date") - cfg.capital) / cfg.capital
    results = falls.groupBy("ticker").agg(
        F.min("date").alias("start_date"), F.max("date").alias("end_date"), total.alias("total_return"),
        *[c.alias(n) for n, c in risk_columns(F.col("equity_return"), cfg.risk_free).items()],
        F.min("drawdown").alias("max_drawdown"),
    )
    years = F.datediff("end_date", "start_date") / F.lit(365.25)
    grown = 1 + F.col("total_return")
    annual = F.when(years <= 0, F.lit(0.0)).when(grown >= 0, F.pow(grown, F.try_divide(F.lit(1.0), years)) - 1)
    trades = closed_trades(runs).groupBy("ticker").agg(
        F.count("*").alias("total_trades"), F.count_if(F.col("pnl") > 0).alias("winning_trades"),
        F.count_if(F.col("pnl") <= 0).alias("losing_trades"),
    )
    counts = {c: F.coalesce(F.col(c), F.lit(0)) for c in ("total_trades", "winning_trades", "losing_trades")}
    out = results.withColumn("annual_return", annual).join(trades, "ticker", "left").withColumns(counts)
    rate = F.coalesce(F.try_divide(F.col("winning_trades").cast("double"), F.col("total_trades").cast("double")), F.lit(0.0))
    return out.withColumn("win_rate", rate)


def compare(metrics: DataFrame, top: int | None = None) -> DataFrame:
    """Results side by side, best Sharpe ratio first."""
    ranked = metrics.select(
        "ticker", "total_return", "annual_return", "volatility", "sharpe_ratio", "sortino_ratio", "max_drawdown", "win_rate",
        "total_trades",
    ).orderBy(F.col("sharpe_ratio").desc(), "ticker")
    return ranked if top is None else ranked.limit(top)


def trade_stats(trades: DataFrame, keys: tuple[str, ...] = ("ticker",)) -> DataFrame:
    """Distribution of trade results per key; a key without trades has no row."""
    pnl = F.col("pnl")
    won, lost = F.when(pnl > 0, pnl), F.when(pnl <= 0, pnl)
    losses = F.coalesce(F.sum(lost), F.lit(0.0))
    return trades.groupBy(*keys).agg(
        F.count("*").alias("total_trades"), F.count(won).alias("profitable_trades"), F.count(lost).alias("losing_trades"),
        F.coalesce(F.avg(won), F.lit(0.0)).alias("avg_win"), F.coalesce(F.avg(lost), F.lit(0.0)).alias("avg_loss"),
        F.max(pnl).alias("max_win"), F.min(pnl).alias("max_loss"), F.avg("pnl_pct").alias("avg_return_per_trade"),
        F.stddev_pop("pnl_pct").alias("std_return_per_trade"),
        F.coalesce(F.try_divide(F.coalesce(F.sum(won), F.lit(0.0)), F.abs(losses)), F.lit(0.0)).alias("profit_factor"),
    )


# Modulus and multiplier of the draw generator, chosen so that every product fits a bigint.
DRAW_MODULUS = 2147483647
DRAW_MULTIPLIER = 48271


#: Simulations are dealt out in so many shares of each ticker.
SIM_BLOCKS = 32


def drawn(sim: Column, steps: Column, seed: int) -> Column:
    """A number for each step (array of bigint) of a simulation: a fixed function, so a lost task draws the same again."""
    sim, m = sim.cast("bigint"), F.lit(DRAW_MODULUS).cast("bigint")
    out = F.transform(steps, lambda i: (sim * DRAW_MULTIPLIER + i * 69621 + seed) % m)

    def mixed(k: int) -> Column:
        return F.zip_with(out, steps, lambda h, i: (h * h + h * k + i + sim) % m)

    for k in (40692, 16807, 39373):
        out = mixed(k)
    return out


def bootstrap_returns(curve: DataFrame, sims: int = 1000, seed: int = 42) -> DataFrame:
    """Compounded return of each (ticker, sim): as many draws with replacement as there are returns.

    A ticker's returns are one array, bounded by the calendar. It is dealt out with a share of the simulations, which
    draw from it in place: what is shuffled are arrays, not draws.
    """
    ordered = F.array_sort(F.collect_list(F.struct("date", F.col("equity_return").alias("r"))))
    series = curve.where(F.col("equity_return").isNotNull()).groupBy("ticker").agg(F.transform(ordered, lambda x: x["r"]).alias("r"))
    parts, blocks = int(curve.sparkSession.conf.get("spark.sql.shuffle.partitions")), min(SIM_BLOCKS, sims)
    shares = series.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))).repartition(parts, "ticker", "block")
    steps = F.sequence(F.lit(0).cast("bigint"), (F.size("r") - 1).cast("bigint"))
    runs = shares.withColumn("steps", steps).withColumn("sim", F.explode(F.sequence(F.col("block"), F.lit(sims - 1), F.lit(blocks))))
    factor = lambda h: 1 + F.get(F.col("r"), (h % F.size("r")).cast("int"))
    grown = F.aggregate(drawn(F.col("sim"), F.col("steps"), seed), F.lit(1.0), lambda x, h: x * factor(h))
    return runs.select("ticker", "sim", (grown - 1).alias("sim_return"))


def monte_carlo(curve: DataFrame, sims: int = 1000, confidence: float = 0.95, seed: int = 42) -> DataFrame:
    """Mean, deviation, extremes, value at risk and expected shortfall of the bootstrap, per ticker."""
    # One row per simulation: the window is as long as ``sims``.
    cut = F.percentile("sim_return", F.lit(1 - confidence)).over(Window.partitionBy("ticker"))
    s = bootstrap_returns(curve, sims, seed).withColumn("var", cut)
    x = F.col("sim_return")
    return s.groupBy("ticker").agg(
        F.avg(x).alias("mean_return"), F.stddev_pop(x).alias("std_return"), F.min(x).alias("min_return"),
        F.max(x).alias("max_return"), F.max("var").alias("var"), F.avg(F.when(x <= F.col("var"), x)).alias("cvar"),
    )


def crossover_signals(bars: DataFrame, fast: int = 5, slow: int = 20) -> DataFrame:
    """Sign of the difference of two moving averages, flat until both exist."""
    from tickloom.operators.indicators import with_sma

    out = with_sma(bars, (fast, slow))
    sign = F.signum(F.col(f"sma_{fast}") - F.col(f"sma_{slow}"))
    return out.select("ticker", "date", F.coalesce(sign, F.lit(0.0)).cast("int").alias("signal"))
