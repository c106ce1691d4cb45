from datetime import date

import numpy as np
import pandas as pd
import pytest

from tests.conftest import price_series
from tickloom.operators import backtest
from tickloom.operators.backtest import BacktestConfig

DAYS = [date(2024, 1, d) for d in (1, 2, 3, 4)]


def frame(spark, prices, signals, ticker="A"):
    n = len(prices)
    days = [date(2024, 1, 1) + pd.Timedelta(days=i) for i in range(n)]
    bars = spark.createDataFrame(pd.DataFrame({"ticker": ticker, "date": days, "close": np.asarray(prices, float)}))
    sig = spark.createDataFrame(pd.DataFrame({"ticker": ticker, "date": days, "signal": signals}))
    return bars, sig


def test_hand_case(spark):
    runs = backtest.signal_runs(*frame(spark, [100, 110, 105, 120], [1, 1, -1, 0]))
    trades = backtest.closed_trades(runs).orderBy("entry_date").collect()
    assert [(t["position"], round(t["entry_price"], 6), t["exit_price"]) for t in trades] == [("long", 100.1, 105.0), ("short", 105.105, 120.0)]
    assert [round(t["pnl"], 6) for t in trades] == [4.9, -14.895]
    assert backtest.open_positions(runs).isEmpty()
    curve = [r["equity"] for r in backtest.equity_curve(runs).orderBy("date").collect()]
    np.testing.assert_allclose(curve, [9999.9, 10009.8, 10009.905, 10009.905])


def step_through(prices, signals, capital=10000.0, cost=0.001):
    """Bar by bar, as a plain loop: the meaning of the window form."""
    equity, position, entry, trades, curve = capital, 0, 0.0, [], []
    for i, (p, s) in enumerate(zip(prices, signals)):
        if s != position:
            if position != 0:
                trades.append((p - entry) * (1 if position > 0 else -1))
            position, entry = s, p * (1 + cost) if s != 0 else 0.0
        equity += (p - entry) * position
        curve.append(equity)
    return np.array(curve), trades


@pytest.fixture(scope="module")
def random_case(spark):
    pdf = price_series(400, seed=11)
    signals = np.random.RandomState(5).choice([-1, 0, 1], 400, p=[0.3, 0.2, 0.5])
    return pdf["close"].to_numpy(), signals, backtest.signal_runs(*frame(spark, pdf["close"], signals))


def test_against_loop(random_case):
    prices, signals, runs = random_case
    curve, pnl = step_through(prices, signals)
    got = [r["equity"] for r in backtest.equity_curve(runs).orderBy("date").collect()]
    np.testing.assert_allclose(got, curve)
    np.testing.assert_allclose([r["pnl"] for r in backtest.closed_trades(runs).orderBy("entry_date").collect()], pnl)

    m = backtest.backtest_metrics(runs).first()
    r = pd.Series(curve).pct_change().dropna()
    grown = (1 + r).cumprod()
    down = r[r < 0].std() * np.sqrt(252)
    years = 399 / 365.25
    np.testing.assert_allclose(
        [m["total_return"], m["volatility"], m["sharpe_ratio"], m["sortino_ratio"], m["max_drawdown"], m["annual_return"]],
        [curve[-1] / 10000 - 1, r.std() * np.sqrt(252), (r - 0.02 / 252).mean() / r.std() * np.sqrt(252), (r - 0.02 / 252).mean() / down * np.sqrt(252),
         (grown / grown.cummax() - 1).min(), (curve[-1] / 10000) ** (1 / years) - 1], rtol=1e-7)
    assert (m["total_trades"], m["winning_trades"]) == (len(pnl), sum(p > 0 for p in pnl))

    s = backtest.trade_stats(backtest.closed_trades(runs)).first()
    won, lost = [p for p in pnl if p > 0], [p for p in pnl if p <= 0]
    np.testing.assert_allclose([s["avg_win"], s["avg_loss"], s["profit_factor"]], [np.mean(won), np.mean(lost), sum(won) / -sum(lost)])


def test_marked_equity_ends_at_the_sum_of_trades(spark):
    runs = backtest.signal_runs(*frame(spark, [100, 110, 105, 120, 90, 95], [1, 1, -1, -1, 0, 0]))
    last = backtest.equity_curve(runs, BacktestConfig(equity_mode="mark_to_market")).orderBy("date").collect()[-1]["equity"]
    assert abs(last - 10000 - sum(r["pnl"] for r in backtest.closed_trades(runs).collect())) < 1e-9


def test_missing_and_partial_signals(spark):
    bars, sig = frame(spark, [1, 2, 3, 4], [1, 1, 1, 1])
    other, _ = frame(spark, [1, 2, 3, 4], [0, 0, 0, 0], "B")
    both = bars.unionByName(other)
    runs = backtest.signal_runs(both, sig.where("date < '2024-01-03'"))
    assert [r["signal"] for r in runs.orderBy("date").collect()] == [1, 1, 0, 0]
    assert [r[0] for r in backtest.missing_signals(both, sig).collect()] == ["B"]


def test_flat_signals_give_zero_ratios(spark):
    m = backtest.backtest_metrics(backtest.signal_runs(*frame(spark, [1, 2, 3], [0, 0, 0]))).first()
    assert (m["sharpe_ratio"], m["sortino_ratio"], m["win_rate"], m["total_return"]) == (0, 0, 0, 0)


def draws(sims, n, seed):
    m = backtest.DRAW_MODULUS
    sim, i = np.meshgrid(np.arange(sims, dtype=object), np.arange(n, dtype=object), indexing="ij")
    h = (sim * backtest.DRAW_MULTIPLIER + i * 69621 + seed) % m
    for k in (40692, 16807, 39373):
        h = (h * h + h * k + i + sim) % m
    return (h % n).astype(int)


def test_monte_carlo(random_case):
    curve = backtest.equity_curve(random_case[2])
    r = np.array([x["equity_return"] for x in curve.orderBy("date").collect()][1:], float)
    s = np.prod(1 + r[draws(200, len(r), 7)], axis=1) - 1
    got = backtest.monte_carlo(curve, 200, 0.95, 7).first()
    var = np.percentile(s, 5)
    np.testing.assert_allclose([got["mean_return"], got["std_return"], got["var"], got["cvar"]], [s.mean(), s.std(), var, s[s <= var].mean()], rtol=1e-8)
    counts = np.bincount(draws(200, len(r), 7).ravel(), minlength=len(r))
    assert abs(counts.mean() - 200) < 1e-9 and counts.std() < 2 * np.sqrt(200)  # draws are spread evenly
