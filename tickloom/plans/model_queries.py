"""Registered queries on splits, leakage, backtests, features, vectors and modelling."""

from __future__ import annotations

from datetime import date

import numpy as np
from pyspark.sql import functions as F

from tickloom.operators import backtest, clean, feature_store, indicators, leakage, modeling, scoring, splits, targets, validate
from tickloom.plans import datasets
from tickloom.plans.market_queries import ATR_SQL, BARS, CALENDAR_SQL, EMA_SQL, INNER, RETURNS_SQL, RSI_A, RSI_B, TARGET_SQL, keyed
from tickloom.plans.registry import WINDOW_SQL, day_sql, query, rolling_sql, rounded, rsql
from tickloom.session import stored
from tickloom.sources import sinks

# ---- splits and folds

SPLIT_SQL = """sp AS (SELECT *, row_number() OVER (PARTITION BY ticker ORDER BY date) - 1 AS rn, count(*) OVER (PARTITION BY ticker) AS n FROM bars),
  split AS (SELECT *, CASE WHEN rn < floor(n * 0.7::DOUBLE) THEN 'train' WHEN rn < floor(n * (0.7::DOUBLE + 0.15::DOUBLE)) THEN 'validation' ELSE 'test' END AS split FROM sp)"""


@query("positional_split", f"{BARS}, {SPLIT_SQL} SELECT ticker, {day_sql('date')} AS date, split FROM split")
def positional_split(spark, folder):
    return splits.positional_split(datasets.bars(spark, folder)).select("ticker", "date", "split")


@query("date_split", f"""{BARS} SELECT 'train' AS part, ticker, {day_sql('date')} AS date FROM bars WHERE bars.date BETWEEN DATE '1996-01-01' AND DATE '1997-12-31'
  UNION ALL SELECT 'val', ticker, {day_sql('date')} FROM bars WHERE bars.date BETWEEN DATE '1998-01-05' AND DATE '1998-12-28'""")
def date_split(spark, folder):
    train, val = splits.date_split(datasets.bars(spark, folder), date(1996, 1, 1), date(1997, 12, 31), date(1998, 1, 5), date(1998, 12, 28))
    return train.select(F.lit("train").alias("part"), "ticker", "date").unionByName(val.select(F.lit("val").alias("part"), "ticker", "date"))


PLAN = splits.FoldPlan(n_splits=4, train_days=700, val_days=200, test_days=60, gap_days=7, min_train_size=100)
GROWING = splits.FoldPlan(n_splits=5, train_days=700, val_days=200, gap_days=0, min_train_size=100, strategy="anchored")


def _folds_sql(p: splits.FoldPlan) -> str:
    need = p.train_days + p.val_days + p.test_days
    start = "lo" if p.strategy == "anchored" else f"te - {p.train_days}"
    return f"""span AS (SELECT min(date) AS lo, max(date) AS hi FROM bars),
  cnt AS (SELECT *, CASE WHEN hi - lo < {need} THEN 1 ELSE {p.n_splits} END AS n FROM span),
  i AS (SELECT *, CAST(unnest(range(n)) AS INTEGER) AS i FROM cnt),
  te AS (SELECT *, hi - (n - i) * {p.val_days} AS te FROM i),
  f0 AS (SELECT i AS fold, hi, {start} AS train_start, te AS train_end, te + {p.gap_days} AS val_start, te + {p.gap_days + p.val_days} AS val_end FROM te),
  folds AS (SELECT *, val_end + {p.gap_days} AS test_start, val_end + {p.gap_days + p.test_days} AS test_end,
    {p.test_days} > 0 AND val_end + {p.gap_days + p.test_days} <= hi AS has_test FROM f0 WHERE val_end <= hi),
  stats AS (SELECT fold, train_start, train_end, val_start, val_end,
    count(*) FILTER (date BETWEEN train_start AND train_end) AS train_size,
    count(*) FILTER (date BETWEEN val_start + {p.gap_days} AND val_end) AS val_size,
    count(*) FILTER (has_test AND date BETWEEN test_start AND test_end) AS test_size
    FROM folds, bars GROUP BY ALL HAVING train_size >= {p.min_train_size})"""


STATS_OUT = f"""fold, {day_sql('train_start')} AS train_start, {day_sql('train_end')} AS train_end, {day_sql('val_start')} AS val_start,
  {day_sql('val_end')} AS val_end, train_size, val_size, test_size FROM stats"""


@query("cv_fold_stats", f"{BARS}, {_folds_sql(PLAN)} SELECT {STATS_OUT}")
def cv_fold_stats(spark, folder):
    return splits.fold_statistics(datasets.bars_table(spark, folder), PLAN)


@query("cv_anchored", f"{BARS}, {_folds_sql(GROWING)} SELECT {STATS_OUT}")
def cv_anchored(spark, folder):
    return splits.fold_statistics(datasets.bars_table(spark, folder), GROWING)


@query("cv_row_roles", f"""{BARS}, {_folds_sql(PLAN)}, r AS (
  SELECT fold, 'train' AS role, ticker, date FROM folds, bars WHERE date BETWEEN train_start AND train_end
  UNION ALL SELECT fold, 'val', ticker, date FROM folds, bars WHERE date BETWEEN val_start + 7 AND val_end
  UNION ALL SELECT fold, 'test', ticker, date FROM folds, bars WHERE has_test AND date BETWEEN test_start AND test_end)
  SELECT fold, role, ticker, {day_sql('date')} AS date FROM r""")
def cv_row_roles(spark, folder):
    return splits.walk_forward(datasets.bars_table(spark, folder).select("ticker", "date"), PLAN)


@query("cv_overlap", f"""{BARS}, {_folds_sql(PLAN)} SELECT a.fold AS fold1, b.fold AS fold2, 'train-train' AS type,
  CAST(a.train_end - b.train_start AS INTEGER) AS overlap_days FROM folds a JOIN folds b ON a.fold < b.fold AND a.train_end >= b.train_start""")
def cv_overlap(spark, folder):
    return splits.fold_overlaps(splits.fold_table(datasets.bars_table(spark, folder), PLAN))


@query("cv_leakage", f"""{BARS}, {_folds_sql(GROWING)}
  SELECT fold, 'Validation starts before training ends' AS issue, 'CRITICAL' AS severity FROM folds WHERE val_start <= train_end
  UNION ALL SELECT fold, 'No gap between train/val (gap=' || CAST(val_start - train_end AS VARCHAR) || ')', 'HIGH' FROM folds WHERE val_start - train_end < 1""")
def cv_leakage(spark, folder):
    return splits.fold_leakage(splits.fold_table(datasets.bars_table(spark, folder), GROWING))


@query("cv_leakage_summary", f"""{BARS}, {_folds_sql(GROWING)} SELECT count(*) AS total_folds,
  count(*) FILTER (val_start <= train_end) + count(*) FILTER (val_start - train_end < 1) AS issues,
  count(*) FILTER (val_start > train_end) AS valid_folds, count(*) FILTER (val_start - train_end < 1) > 0 AS has_leakage FROM folds""")
def cv_leakage_summary(spark, folder):
    return splits.fold_leakage_summary(splits.fold_table(datasets.bars_table(spark, folder), GROWING))


@query("cv_distribution", f"""{BARS}, {_folds_sql(PLAN)} SELECT count(*) AS total_folds, CAST(sum(train_size) AS BIGINT) AS total_train_samples,
  CAST(sum(val_size) AS BIGINT) AS total_val_samples, {rsql('avg(train_size)', 6)} AS avg_train_per_fold, {rsql('avg(val_size)', 6)} AS avg_val_per_fold,
  {rsql('CAST(sum(train_size) AS DOUBLE) / sum(val_size)', 6)} AS train_val_ratio FROM stats""")
def cv_distribution(spark, folder):
    out = splits.sample_distribution(splits.fold_statistics(datasets.bars_table(spark, folder), PLAN))
    return rounded(out, {"avg_train_per_fold": 6, "avg_val_per_fold": 6, "train_val_ratio": 6})


@query("month_blocks", f"""{BARS}, m AS (SELECT month, row_number() OVER (ORDER BY month) - 1 AS i, count(*) OVER () // 5 AS size
    FROM (SELECT DISTINCT date_trunc('month', date) AS month FROM bars)),
  b AS (SELECT month, CASE WHEN size = 0 THEN 4 ELSE least(i // size, 4) END AS f FROM m)
  SELECT ticker, {day_sql('bars.date')} AS date, CAST(f AS INTEGER) AS val_fold FROM bars JOIN b ON date_trunc('month', bars.date) = b.month""")
def month_blocks(spark, folder):
    return splits.month_blocks(datasets.bars_table(spark, folder)).select("ticker", "date", "val_fold")


@query("month_block_roles", f"""{BARS}, m AS (SELECT month, row_number() OVER (ORDER BY month) - 1 AS i, count(*) OVER () // 5 AS size
    FROM (SELECT DISTINCT date_trunc('month', date) AS month FROM bars)),
  b AS (SELECT month, CASE WHEN size = 0 THEN 4 ELSE least(i // size, 4) END AS f FROM m)
  SELECT ticker, CASE WHEN f = 1 THEN 'val' ELSE 'train' END AS role, count(*) AS n
  FROM bars JOIN b ON date_trunc('month', bars.date) = b.month GROUP BY 1, 2""")
def month_block_roles(spark, folder):
    out = splits.month_fold_role(splits.month_blocks(datasets.bars_table(spark, folder)), 1)
    return out.groupBy("ticker", "role").agg(F.count("*").alias("n"))


@query("date_violations", """SELECT l_orderkey, l_linenumber, strftime(l_shipdate, '%Y-%m-%d %H:%M:%S') AS l_shipdate,
  strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS o_orderdate FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE l_shipdate > o_orderdate""")
def date_violations(spark, folder):
    lines = datasets.table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", "l_shipdate")
    orders = datasets.table(spark, folder, "orders").select("o_orderkey", "o_orderdate")
    dated = lines.join(orders, lines.l_orderkey == orders.o_orderkey).drop("o_orderkey")
    return splits.date_violations(dated, "l_shipdate", "o_orderdate")


# ---- leakage

LEAK_FEATURES = ["open", "high", "low", "volume", "returns", "next_close", "twice_close"]
LEAK_SQL = f"""lk AS (SELECT ticker, date, open, high, low, volume, close AS target, close / lag(close) OVER w - 1 AS returns,
  lead(close) OVER w AS next_close, 2 * close + sin(volume) AS twice_close FROM bars {WINDOW_SQL})"""


def _leak_frame(spark, folder):
    b = indicators.with_returns(datasets.bars(spark, folder))
    planted = targets.with_targets(b).withColumnRenamed("target_close", "next_close")
    return planted.withColumn("twice_close", 2 * F.col("close") + F.sin("volume")).select(
        "ticker", "date", F.col("close").alias("target"), *LEAK_FEATURES)


def _leak_table(spark, folder):
    return stored(_leak_frame(spark, folder), "leak")


def _corr(a: str, b: str) -> str:
    return rsql(f"corr({a}, {b})", 6)


def _per_feature(source: str, y: str) -> str:
    return " UNION ALL ".join(f"SELECT '{f}' AS feature, {_corr(f, y)} AS correlation, count(*) FILTER ({f} IS NOT NULL AND {y} IS NOT NULL) AS pairs FROM {source}" for f in LEAK_FEATURES)


@query("leak_lookahead", f"{BARS}, {LEAK_SQL}, led AS (SELECT *, lead(target) OVER w AS future FROM lk {WINDOW_SQL}) {_per_feature('led', 'future')}")
def leak_lookahead(spark, folder):
    return rounded(leakage.lookahead_correlations(_leak_frame(spark, folder), "target", LEAK_FEATURES), {"correlation": 6})


@query("leak_target", f"{BARS}, {LEAK_SQL} {_per_feature('lk', 'target')}")
def leak_target(spark, folder):
    return rounded(leakage.target_correlations(_leak_frame(spark, folder), "target", LEAK_FEATURES), {"correlation": 6})


PAIR_SQL = " UNION ALL ".join(
    f"SELECT '{a}' AS feature1, '{b}' AS feature2, {rsql(f'abs(corr({a}, {b}))', 6)} AS correlation FROM lk"
    for i, a in enumerate(LEAK_FEATURES) for b in LEAK_FEATURES[i + 1:])


@query("leak_pairs", f"{BARS}, {LEAK_SQL} {PAIR_SQL}")
def leak_pairs(spark, folder):
    return rounded(leakage.pair_correlations(_leak_frame(spark, folder), LEAK_FEATURES), {"correlation": 6})


TRAIN_BEFORE, VAL_FROM = date(1999, 1, 1), date(1998, 12, 1)
PERIODS_SQL = "tr AS (SELECT * FROM lk WHERE date < DATE '1999-01-01'), va AS (SELECT * FROM lk WHERE date >= DATE '1998-12-01')"


def _periods(spark, folder):
    df = _leak_table(spark, folder)
    return df.where(F.col("date") < TRAIN_BEFORE), df.where(F.col("date") >= VAL_FROM)


@query("leak_temporal", f"""{BARS}, {LEAK_SQL}, {PERIODS_SQL}, g AS (SELECT (SELECT max(date) FROM tr) AS t, (SELECT min(date) FROM va) AS v)
  SELECT 'CRITICAL' AS severity, CAST(v - t AS DOUBLE) AS gap_days FROM g WHERE v <= t UNION ALL SELECT 'HIGH', CAST(v - t AS DOUBLE) FROM g WHERE v - t < 1""")
def leak_temporal(spark, folder):
    return leakage.detect_temporal(*_periods(spark, folder)).select("severity", F.col("evidence")["gap_days"].alias("gap_days"))


def _count_pairs(source: str) -> str:
    parts = [f"SELECT abs(corr({a}, {b})) AS c FROM {source}" for i, a in enumerate(LEAK_FEATURES) for b in LEAK_FEATURES[i + 1:]]
    return " UNION ALL ".join(parts)


@query("leak_summary", f"""{BARS}, {LEAK_SQL}, {PERIODS_SQL}, led AS (SELECT *, lead(target) OVER w AS future FROM tr {WINDOW_SQL}),
  g AS (SELECT (SELECT max(date) FROM tr) AS t, (SELECT min(date) FROM va) AS v),
  iss AS (SELECT 'CRITICAL' AS s FROM ({_per_feature('led', 'future')}) WHERE abs(correlation) > 0.7
    UNION ALL SELECT CASE WHEN abs(correlation) > 0.9 THEN 'HIGH' ELSE 'MEDIUM' END FROM ({_per_feature('tr', 'target')}) WHERE abs(correlation) > 0.8
    UNION ALL SELECT 'CRITICAL' FROM g WHERE v <= t UNION ALL SELECT 'HIGH' FROM g WHERE v - t < 1
    UNION ALL SELECT 'MEDIUM' FROM ({_count_pairs('tr')}) WHERE c > 0.95 UNION ALL SELECT 'MEDIUM' FROM ({_count_pairs('va')}) WHERE c > 0.95)
  SELECT count(*) AS total_issues, count(*) FILTER (s = 'CRITICAL') AS critical, count(*) FILTER (s = 'HIGH') AS high,
  count(*) FILTER (s = 'MEDIUM') AS medium, count(*) FILTER (s = 'CRITICAL') > 0 AS has_critical_leakage,
  count(*) FILTER (s IN ('CRITICAL', 'HIGH')) = 0 AS is_safe FROM iss""")
def leak_summary(spark, folder):
    train, val = _periods(spark, folder)
    return leakage.summarize_issues(leakage.all_issues(train, val, "target", LEAK_FEATURES))


def _exact(source: str, y: str) -> str:
    return " UNION ALL ".join(f"SELECT '{f}' AS f, corr({f}, {y}) AS v FROM {source}" for f in LEAK_FEATURES)


def _exact_pairs(source: str) -> str:
    return " UNION ALL ".join(f"SELECT '{a}' AS a, '{b}' AS b, abs(corr({a}, {b})) AS v FROM {source}" for i, a in enumerate(LEAK_FEATURES) for b in LEAK_FEATURES[i + 1:])


def _line_sql(severity: str, kind: str, text: str, columns: str, advice: str) -> str:
    return f"SELECT {severity} AS severity, '] {kind}: ' || {text} || ' | affected: ' || {columns} || ' | action: ' || {advice} AS rest"


START_LATER = "'Start validation at least one day after training ends'"
REPORT_SQL = f"""{BARS}, {LEAK_SQL}, {PERIODS_SQL}, led AS (SELECT *, lead(target) OVER w AS future FROM tr {WINDOW_SQL}),
  g AS (SELECT CAST((SELECT min(date) FROM va) - (SELECT max(date) FROM tr) AS DOUBLE) AS v),
  found AS ({_line_sql("'CRITICAL'", leakage.LOOKAHEAD, "format('''{}'' correlates {:.3f} with the target 1 day(s) ahead', f, v)", "f", "format('Remove ''{}'' or lag it by 1 day(s)', f)")}
      FROM ({_exact('led', 'future')}) WHERE abs(v) > 0.7
    UNION ALL {_line_sql("CASE WHEN abs(v) > 0.9 THEN 'HIGH' ELSE 'MEDIUM' END", leakage.TARGET_DEPENDENT, "format('''{}'' correlates {:.3f} with the target', f, v)", "f",
                         "format('Check how ''{}'' is derived from the target', f)")} FROM ({_exact('tr', 'target')}) WHERE abs(v) > 0.8
    UNION ALL {_line_sql("'CRITICAL'", leakage.TEMPORAL, "format('Validation starts {:.0f} days before training ends', -v)", "'date'", START_LATER)} FROM g WHERE v <= 0
    UNION ALL {_line_sql("'HIGH'", leakage.TEMPORAL, "format('No gap between training and validation ({:.0f} days)', v)", "'date'", START_LATER)} FROM g WHERE v < 1
    UNION ALL {_line_sql("'MEDIUM'", leakage.MULTI_COLLINEARITY, "format('''{}'' and ''{}'' correlate {:.3f}', a, b, v)", "a || ', ' || b", "format('Keep one of ''{}'' and ''{}''', a, b)")}
      FROM ({_exact_pairs('tr')} UNION ALL {_exact_pairs('va')}) WHERE v > 0.95)
  SELECT CAST(list_position(['CRITICAL', 'HIGH', 'MEDIUM', 'LOW'], severity) AS BIGINT) AS rank, '[' || severity || rest AS line FROM found"""


@query("leak_report", REPORT_SQL)
def leak_report(spark, folder):
    train, val = _periods(spark, folder)
    return leakage.report_lines(leakage.all_issues(train, val, "target", LEAK_FEATURES))


# ---- backtest

FAST, SLOW = rolling_sql("avg", "close", 5), rolling_sql("avg", "close", 20)
RUNS_SQL = f"""sig AS (SELECT ticker, date, close AS price, CAST(coalesce(sign({FAST} - {SLOW}), 0) AS INTEGER) AS signal FROM bars),
  ch AS (SELECT *, CASE WHEN signal <> lag(signal, 1, 0) OVER w THEN 1 ELSE 0 END AS ch FROM sig {WINDOW_SQL}),
  rn AS (SELECT *, CAST(sum(ch) OVER w AS BIGINT) AS run FROM ch {WINDOW_SQL}),
  runs AS (SELECT *, CASE WHEN signal <> 0 THEN first_value(price) OVER r * 1.001::DOUBLE END AS entry_price,
    CASE WHEN signal <> 0 THEN first_value(date) OVER r END AS entry_date FROM rn WINDOW r AS (PARTITION BY ticker, run ORDER BY date))"""
TRADES_SQL = f"""{RUNS_SQL}, rt AS (SELECT ticker, run, any_value(signal) AS signal, any_value(entry_price) AS entry_price, min(date) AS date,
    arg_min(price, date) AS first_price FROM runs GROUP BY ticker, run),
  nx AS (SELECT *, lead(date) OVER (PARTITION BY ticker ORDER BY run) AS exit_date, lead(first_price) OVER (PARTITION BY ticker ORDER BY run) AS exit_price FROM rt),
  tr AS (SELECT ticker, CASE WHEN signal > 0 THEN 'long' ELSE 'short' END AS position, date AS entry_date, entry_price, exit_date, exit_price,
    CASE WHEN signal > 0 THEN exit_price - entry_price ELSE entry_price - exit_price END AS pnl FROM nx WHERE signal <> 0 AND entry_price > 0),
  trades AS (SELECT *, pnl / entry_price AS pnl_pct FROM tr WHERE exit_date IS NOT NULL)"""


def _runs(spark, folder):
    b = datasets.bars_table(spark, folder)
    return backtest.signal_runs(b, datasets.signals(b))


@query("signal_runs", f"""{BARS}, {RUNS_SQL} SELECT ticker, {day_sql('date')} AS date, price, signal, run,
  {rsql('entry_price', 5)} AS entry_price, {day_sql('entry_date')} AS entry_date FROM runs""")
def signal_runs(spark, folder):
    return rounded(_runs(spark, folder), {"entry_price": 5})


@query("trades", f"""{BARS}, {TRADES_SQL} SELECT ticker, position, {day_sql('entry_date')} AS entry_date, {rsql('entry_price', 5)} AS entry_price,
  {day_sql('exit_date')} AS exit_date, exit_price, {rsql('pnl', 5)} AS pnl, {rsql('pnl_pct', 6)} AS pnl_pct FROM trades""")
def trades(spark, folder):
    return rounded(backtest.closed_trades(_runs(spark, folder)), {"entry_price": 5, "pnl": 5, "pnl_pct": 6})


@query("open_positions", f"""{BARS}, {TRADES_SQL} SELECT ticker, position, {day_sql('entry_date')} AS entry_date, {rsql('entry_price', 5)} AS entry_price
  FROM tr WHERE exit_date IS NULL""")
def open_positions(spark, folder):
    return rounded(backtest.open_positions(_runs(spark, folder)), {"entry_price": 5})


EQUITY_SQL = f"""{RUNS_SQL}, eq AS (SELECT *, 10000 + sum(coalesce((price - entry_price) * signal, 0)) OVER w AS equity FROM runs {WINDOW_SQL}),
  er AS (SELECT *, equity / nullif(lag(equity) OVER w, 0) - 1 AS equity_return, first_value(equity) OVER w AS first_equity FROM eq {WINDOW_SQL}),
  cu AS (SELECT *, CASE WHEN equity_return IS NOT NULL THEN equity / first_equity END AS cumulative FROM er),
  pk AS (SELECT *, max(cumulative) OVER w AS peak FROM cu {WINDOW_SQL}),
  dd AS (SELECT *, (cumulative - peak) / nullif(peak, 0) AS drawdown FROM pk)"""


@query("equity_curve", f"{BARS}, {EQUITY_SQL} SELECT ticker, {day_sql('date')} AS date, signal, {rsql('equity', 5)} AS equity FROM er")
def equity_curve(spark, folder):
    return rounded(backtest.equity_curve(_runs(spark, folder)).select("ticker", "date", "signal", "equity"), {"equity": 5})


@query("equity_marked", f"""{BARS}, {RUNS_SQL}, st AS (SELECT *, coalesce((price - lag(price) OVER w) * lag(signal) OVER w, 0)
    + coalesce(CASE WHEN date = entry_date THEN (price - entry_price) * signal END, 0) AS step FROM runs {WINDOW_SQL})
  {INNER} (SELECT ticker, date, signal, {rsql('10000 + sum(step) OVER w', 5)} AS equity FROM st {WINDOW_SQL})""")
def equity_marked(spark, folder):
    out = backtest.equity_curve(_runs(spark, folder), backtest.BacktestConfig(equity_mode="mark_to_market"))
    return rounded(out.select("ticker", "date", "signal", "equity"), {"equity": 5})


@query("drawdown", f"{BARS}, {EQUITY_SQL} SELECT ticker, {day_sql('date')} AS date, {rsql('drawdown', 4)} AS drawdown FROM dd")
def drawdown(spark, folder):
    return keyed(backtest.drawdown(backtest.equity_curve(_runs(spark, folder))), {"drawdown": 4})


def _risk_sql(r: str) -> str:
    dev, down = f"stddev_samp({r})", f"stddev_samp(CASE WHEN {r} < 0 THEN {r} END) * sqrt(252)"
    excess = f"avg({r} - 0.02::DOUBLE / 252)"
    return f"""{rsql(f'{dev} * sqrt(252)', 4)} AS volatility,
    {rsql(f'CASE WHEN {dev} > 0 THEN {excess} / {dev} * sqrt(252) ELSE 0 END', 4)} AS sharpe_ratio,
    {rsql(f'CASE WHEN {down} > 0 THEN {excess} / ({down}) * sqrt(252) ELSE 0 END', 4)} AS sortino_ratio"""


METRICS_SQL = f"""{EQUITY_SQL}, tot AS (SELECT ticker, min(date) AS start_date, max(date) AS end_date, (arg_max(equity, date) - 10000) / 10000 AS total_return,
    {_risk_sql('equity_return')}, {rsql('min(drawdown)', 4)} AS max_drawdown FROM dd GROUP BY ticker),
  tc AS (SELECT ticker, count(*) AS total_trades, count(*) FILTER (pnl > 0) AS winning_trades, count(*) FILTER (pnl <= 0) AS losing_trades FROM trades GROUP BY ticker),
  res AS (SELECT tot.*, CASE WHEN end_date = start_date THEN 0 WHEN total_return >= -1 THEN pow(1 + total_return, 365.25::DOUBLE / (end_date - start_date)) - 1 END AS annual_return,
    coalesce(total_trades, 0) AS total_trades, coalesce(winning_trades, 0) AS winning_trades, coalesce(losing_trades, 0) AS losing_trades,
    coalesce(winning_trades / total_trades, 0) AS win_rate FROM tot LEFT JOIN tc ON tot.ticker = tc.ticker)"""
BACKTEST_SQL = f"{BARS}, {TRADES_SQL}, {METRICS_SQL.replace(RUNS_SQL + ', ', '')}"
METRIC_DIGITS = {"total_return": 9, "annual_return": 4, "volatility": 4, "sharpe_ratio": 4, "sortino_ratio": 4, "max_drawdown": 4, "win_rate": 6}


@query("backtest_metrics", f"""{BACKTEST_SQL} SELECT ticker, {day_sql('start_date')} AS start_date, {day_sql('end_date')} AS end_date,
  {rsql('total_return', 9)} AS total_return, {rsql('annual_return', 4)} AS annual_return, volatility, sharpe_ratio, sortino_ratio, max_drawdown,
  {rsql('win_rate', 6)} AS win_rate, total_trades, winning_trades, losing_trades FROM res""")
def backtest_metrics(spark, folder):
    return rounded(backtest.backtest_metrics(_runs(spark, folder)), METRIC_DIGITS)


@query("backtest_ranking", f"""{BACKTEST_SQL} SELECT ticker, {rsql('total_return', 9)} AS total_return, {rsql('annual_return', 4)} AS annual_return, volatility,
  sharpe_ratio, sortino_ratio, max_drawdown, {rsql('win_rate', 6)} AS win_rate, total_trades FROM res ORDER BY sharpe_ratio DESC, ticker""")
def backtest_ranking(spark, folder):
    return rounded(backtest.compare(backtest.backtest_metrics(_runs(spark, folder)), None), METRIC_DIGITS)


@query("trade_stats", f"""{BARS}, {TRADES_SQL} SELECT ticker, count(*) AS total_trades, count(*) FILTER (pnl > 0) AS profitable_trades,
  count(*) FILTER (pnl <= 0) AS losing_trades, {rsql('coalesce(avg(pnl) FILTER (pnl > 0), 0)', 3)} AS avg_win,
  {rsql('coalesce(avg(pnl) FILTER (pnl <= 0), 0)', 3)} AS avg_loss, {rsql('max(pnl)', 5)} AS max_win, {rsql('min(pnl)', 5)} AS max_loss,
  {rsql('avg(pnl_pct)', 6)} AS avg_return_per_trade, {rsql('stddev_pop(pnl_pct)', 6)} AS std_return_per_trade,
  {rsql('coalesce(coalesce(sum(pnl) FILTER (pnl > 0), 0) / nullif(abs(coalesce(sum(pnl) FILTER (pnl <= 0), 0)), 0), 0)', 6)} AS profit_factor
  FROM trades GROUP BY ticker""")
def trade_stats(spark, folder):
    digits = {"avg_win": 3, "avg_loss": 3, "max_win": 5, "max_loss": 5, "avg_return_per_trade": 6, "std_return_per_trade": 6, "profit_factor": 6}
    return rounded(backtest.trade_stats(backtest.closed_trades(_runs(spark, folder))), digits)


@query("missing_signals", f"""{BARS}, sig AS (SELECT ticker FROM bars WHERE volume >= 9) SELECT DISTINCT ticker FROM bars WHERE ticker NOT IN (SELECT ticker FROM sig)""")
def missing_signals(spark, folder):
    b = datasets.bars_table(spark, folder)
    return backtest.missing_signals(b, b.where(F.col("volume") >= 9))


@query("risk_metrics", f"""{BARS}, {RETURNS_SQL}, g AS (SELECT ticker, returns, exp(sum(ln(1 + returns)) OVER w) AS g, date FROM rets WHERE returns IS NOT NULL {WINDOW_SQL}),
  p AS (SELECT *, max(g) OVER w AS p FROM g {WINDOW_SQL}) SELECT ticker, {_risk_sql('returns')}, {rsql('min((g - p) / p)', 6)} AS max_drawdown FROM p GROUP BY ticker""")
def risk_metrics(spark, folder):
    r = indicators.with_returns(datasets.bars(spark, folder))
    return rounded(backtest.risk_metrics(r), {"volatility": 4, "sharpe_ratio": 4, "sortino_ratio": 4, "max_drawdown": 6})


SIMS = 1000
M = backtest.DRAW_MODULUS


def _draw_sql() -> str:
    steps = [f"d0 AS (SELECT ticker, sim, i, n, (sim * {backtest.DRAW_MULTIPLIER} + i * 69621 + 42) % {M} AS h FROM draws)"]
    for at, k in enumerate((40692, 16807, 39373)):
        steps.append(f"d{at + 1} AS (SELECT ticker, sim, i, n, (h * h + h * {k} + i + sim) % {M} AS h FROM d{at})")
    return ",\n  ".join(steps)


@query("monte_carlo", f"""{BARS}, {RETURNS_SQL}, r AS (SELECT ticker, row_number() OVER w - 1 AS i, returns AS r, count(*) OVER (PARTITION BY ticker) AS n FROM rets
    WHERE returns IS NOT NULL {WINDOW_SQL}),
  draws AS (SELECT ticker, sim, i, n FROM r, (SELECT unnest(range({SIMS})) AS sim)),
  {_draw_sql()},
  s AS (SELECT d3.ticker, sim, product(1 + r.r) - 1 AS x FROM d3 JOIN r ON d3.ticker = r.ticker AND d3.h % d3.n = r.i GROUP BY d3.ticker, sim),
  v AS (SELECT ticker, quantile_cont(x, 1 - 0.95::DOUBLE) AS var FROM s GROUP BY ticker)
  SELECT s.ticker, {rsql('ln(2 + avg(x))', 6)} AS log_mean, {rsql('ln(2 + stddev_pop(x))', 6)} AS log_std, {rsql('min(x)', 6)} AS min_return, {rsql('ln(2 + max(x))', 6)} AS log_max,
  {rsql('any_value(var)', 6)} AS var, {rsql('avg(x) FILTER (x <= var)', 6)} AS cvar FROM s JOIN v ON s.ticker = v.ticker GROUP BY s.ticker""")
def monte_carlo(spark, folder):
    # Returns of weekly prices swing by whole multiples: the compounded values are compared on a logarithmic scale.
    r = indicators.with_returns(datasets.bars(spark, folder)).select("ticker", "date", F.col("returns").alias("equity_return"))
    out = backtest.monte_carlo(stored(r, "returns"), SIMS)
    logs = {f"log_{c}": F.log(2 + F.col(f"{c}_return")) for c in ("mean", "std", "max")}
    return rounded(out.select("ticker", *[c.alias(n) for n, c in logs.items()], "min_return", "var", "cvar"), dict.fromkeys([*logs, "min_return", "var", "cvar"], 6))


# ---- features

SPINE_SQL = """spine AS (SELECT ticker, unnest(generate_series((SELECT min(date) FROM bars)::TIMESTAMP, (SELECT max(date) FROM bars)::TIMESTAMP, INTERVAL 1 DAY)) AS ts
  FROM (SELECT DISTINCT ticker FROM bars))"""


def _dates(b):
    """First and last date of the bars."""
    return tuple(b.agg(F.min("date"), F.max("date")).first())


KNOWN = "CAST(date + 1 AS TIMESTAMP) AS known"


@query("date_spine", f"{BARS}, {SPINE_SQL} SELECT ticker, {day_sql('CAST(ts AS DATE)')} AS event_timestamp FROM spine")
def date_spine(spark, folder):
    b = datasets.bars_table(spark, folder)
    return feature_store.date_spine(b, *_dates(b))


@query("asof_features", f"""{BARS}, {SPINE_SQL}, f AS (SELECT ticker, close, volume, {KNOWN} FROM bars)
  SELECT spine.ticker, {day_sql('CAST(ts AS DATE)')} AS event_timestamp, CASE WHEN ts - known <= INTERVAL 8 DAY THEN close END AS close,
  CASE WHEN ts - known <= INTERVAL 8 DAY THEN volume END AS volume
  FROM spine ASOF LEFT JOIN f ON spine.ticker = f.ticker AND spine.ts >= f.known""")
def asof_features(spark, folder):
    b = datasets.bars_table(spark, folder)
    view = feature_store.FeatureView("bar", datasets.known_next_day(b), ["close", "volume"], 8)
    return feature_store.point_in_time(feature_store.date_spine(b, *_dates(b)), [view])


TECH_SQL = f"""{RSI_B}, {ATR_SQL}, sma AS (SELECT ticker, date, {rolling_sql('avg', 'close', 20)} AS sma_20, {rolling_sql('avg', 'close', 50)} AS sma_50 FROM bars),
  tech AS (SELECT sma.ticker, sma.date, rsi_14, atr_14, sma_20, sma_50, CAST(sma.date + 1 AS TIMESTAMP) AS known
    FROM sma JOIN rsi ON sma.ticker = rsi.ticker AND sma.date = rsi.date JOIN atr ON sma.ticker = atr.ticker AND sma.date = atr.date)"""
TECH = ["rsi_14", "atr_14", "sma_20", "sma_50"]
TECH_DIGITS = {"rsi_14": 6, "atr_14": 4, "sma_20": 5, "sma_50": 5}


def _round_tech(cond: str = "") -> str:
    return ", ".join(f"{rsql(f'CASE WHEN {cond} THEN {c} END' if cond else c, TECH_DIGITS[c])} AS {c}" for c in TECH)


def _technical_view(b):
    return feature_store.FeatureView("technical_indicators", stored(datasets.technical_rows(b).select("ticker", "computed_at", *TECH), "technical"), TECH, 180)


@query("training_set", f"""{BARS}, {SPINE_SQL}, {TECH_SQL}, {RETURNS_SQL}, {TARGET_SQL},
  ctx AS (SELECT ticker, CAST(rets.date + 1 AS TIMESTAMP) AS known, m AS sector_momentum FROM rets JOIN (SELECT sector, date, avg(returns) AS m FROM rets GROUP BY sector, date) s
    ON rets.sector = s.sector AND rets.date = s.date),
  tgt AS (SELECT ticker, CAST(date + 1 AS TIMESTAMP) AS known, target_return FROM tg WHERE target_return IS NOT NULL),
  a AS (SELECT spine.ticker, ts, {_round_tech("ts - known <= INTERVAL 180 DAY")} FROM spine ASOF LEFT JOIN tech ON spine.ticker = tech.ticker AND ts >= known),
  b AS (SELECT a.*, CASE WHEN ts - known <= INTERVAL 365 DAY THEN sector_momentum END AS sector_momentum FROM a ASOF LEFT JOIN ctx ON a.ticker = ctx.ticker AND ts >= known),
  c AS (SELECT b.*, CASE WHEN ts - known <= INTERVAL 365 DAY THEN target_return END AS target_return FROM b ASOF LEFT JOIN tgt ON b.ticker = tgt.ticker AND ts >= known)
  SELECT ticker, {day_sql('CAST(ts AS DATE)')} AS event_timestamp, {', '.join(TECH)}, {rsql('sector_momentum', 6)} AS sector_momentum, {rsql('target_return', 6)} AS target_return FROM c""")
def training_set(spark, folder):
    b = datasets.bars_table(spark, folder)
    r = indicators.with_returns(b)
    ctx = datasets.known_next_day(r.select("ticker", "sector", "date").join(indicators.sector_context(r), ["sector", "date"], "left"))
    service = feature_store.FeatureService("training_features", [
        _technical_view(b), feature_store.FeatureView("market_context", ctx, ["sector_momentum"], 365),
        feature_store.FeatureView("target_next_day", datasets.target_rows(b), ["target_return"], 365)])
    out = feature_store.historical_features(feature_store.date_spine(b, *_dates(b)), service)
    return rounded(out, {**TECH_DIGITS, "sector_momentum": 6, "target_return": 6})


@query("inference_set", f"""{BARS}, {TECH_SQL}, sp AS (SELECT ticker, CAST(date AS TIMESTAMP) AS ts, close AS current_price FROM bars),
  j AS (SELECT sp.ticker, ts, current_price, CASE WHEN ts - known <= INTERVAL 180 DAY THEN sma_20 END AS s20, CASE WHEN ts - known <= INTERVAL 180 DAY THEN sma_50 END AS s50
    FROM sp ASOF LEFT JOIN tech ON sp.ticker = tech.ticker AND ts >= known)
  SELECT ticker, {day_sql('CAST(ts AS DATE)')} AS event_timestamp, current_price, {rsql('s20', 5)} AS sma_20, {rsql('s50', 5)} AS sma_50,
  {rsql('s20 / current_price - 1', 6)} AS momentum_5d, {rsql('s50 / current_price - 1', 6)} AS momentum_20d FROM j""")
def inference_set(spark, folder):
    b = datasets.bars_table(spark, folder)
    view = feature_store.FeatureView("technical_indicators", stored(datasets.technical_rows(b).select("ticker", "computed_at", "sma_20", "sma_50"), "technical"), ["sma_20", "sma_50"], 180)
    service = feature_store.FeatureService("inference_features", [view], [feature_store.OnDemandView("price_momentum", feature_store.price_momentum)])
    spine = b.select("ticker", F.col("date").alias("event_timestamp"), F.col("close").alias("current_price"))
    return rounded(feature_store.historical_features(spine, service), {"sma_20": 5, "sma_50": 5, "momentum_5d": 6, "momentum_20d": 6})


@query("latest_features", f"""{BARS}, {TECH_SQL}, req AS (SELECT n_name AS ticker FROM nation UNION SELECT r_name FROM region),
  l AS (SELECT DISTINCT ON (ticker) * FROM tech ORDER BY ticker, known DESC)
  SELECT req.ticker, {_round_tech()} FROM req LEFT JOIN l ON req.ticker = l.ticker""")
def latest_features(spark, folder):
    b = datasets.bars(spark, folder)
    asked = datasets.table(spark, folder, "nation").select(F.col("n_name").alias("ticker")).union(
        datasets.table(spark, folder, "region").select("r_name"))
    view = feature_store.FeatureView("technical_indicators", datasets.technical_rows(b), TECH, 180)
    service = feature_store.FeatureService("inference_features", [view])
    return rounded(feature_store.online_features(asked, service), TECH_DIGITS)


@query("flagship", f"""{BARS}, {RETURNS_SQL.replace('volume,', 'volume,')}, fl AS (SELECT ticker, date, close,
    close / lag(close) OVER w - 1 AS returns, {rolling_sql('avg', 'close', 20)} AS sma_20,
    {rolling_sql('avg', 'close', 20)} + 2 * {rolling_sql('stddev_samp', 'close', 20)} AS bb_upper,
    (close - lag(close) OVER w) / lag(close) OVER w AS last_target FROM bars {WINDOW_SQL})
  SELECT DISTINCT ON (ticker) ticker, {day_sql('date')} AS date, close, {rsql('returns', 6)} AS returns, {rsql('sma_20', 5)} AS sma_20,
  {rsql('bb_upper', 3)} AS bb_upper, CAST(NULL AS DOUBLE) AS target_return FROM fl ORDER BY ticker, fl.date DESC""")
def flagship(spark, folder):
    b = indicators.with_bollinger(indicators.with_sma(indicators.with_returns(datasets.bars(spark, folder)), (20,)))
    out = validate.latest_per_ticker(targets.with_targets(b), ["date", "close", "returns", "sma_20", "bb_upper", "target_return"])
    return rounded(out, {"returns": 6, "sma_20": 5, "bb_upper": 3, "target_return": 6})


# ---- vectors and scoring

VECTOR = 64
REQUESTS_SQL = """req AS (SELECT vec_id, CAST(label AS VARCHAR) AS ticker,
  list_transform(list_slice(embedding, 1, CASE WHEN label = 3 THEN len(embedding) - 1 ELSE len(embedding) END), lambda x: CAST(x AS DOUBLE) * CASE WHEN label = 5 THEN 10000000.0::DOUBLE WHEN label = 6 THEN 0.01::DOUBLE ELSE 1.0::DOUBLE END) AS f FROM embeddings)"""


def requests(spark, folder):
    """Whole vectors with defects by label: one group lacks its last entry, one is far out of range, one is flat."""
    e = datasets.table(spark, folder, "embeddings")
    size = F.when(F.col("label") == 3, F.size("embedding") - 1).otherwise(F.size("embedding"))
    scale = F.when(F.col("label") == 5, 10000000.0).when(F.col("label") == 6, 0.01).otherwise(1.0)
    values = F.slice("embedding", F.lit(1), size).cast("array<double>")
    return e.select("vec_id", F.col("label").cast("string").alias("ticker"), values.alias("v"), scale.alias("s")).select(
        "vec_id", "ticker", F.transform("v", lambda x: x * F.col("s")).alias("features"))


STD_SQL = "sqrt(list_avg(list_transform(f, lambda x: (x - list_avg(f)) * (x - list_avg(f)))))"


@query("request_check", f"""WITH {REQUESTS_SQL} SELECT vec_id, ticker, CASE WHEN len(f) <> 64 THEN 'Must provide exactly 64 features'
  WHEN len(list_filter(f, lambda x: NOT (x > -1e6 AND x < 1e6))) > 0 THEN 'Feature values out of acceptable range' END AS error FROM req""")
def request_check(spark, folder):
    return scoring.check_requests(requests(spark, folder), VECTOR).select("vec_id", "ticker", "error")


@query("vector_report", f"""WITH {REQUESTS_SQL} SELECT vec_id, len(f) = 64 AS valid, CASE WHEN len(f) <> 64 THEN 'Expected 64 features, got ' || len(f) ELSE '' END AS issues,
  concat_ws('; ', CASE WHEN len(list_filter(f, lambda x: abs(x) > 1e5)) > 0 THEN 'Some features are very large (>1e5)' END,
    CASE WHEN {STD_SQL} < 0.01 THEN 'Features have very low variance' END) AS warnings,
  {rsql('list_avg(f)', 5)} AS mean, {rsql(STD_SQL, 5)} AS std, {rsql('list_min(f)', 5)} AS min, {rsql('list_max(f)', 5)} AS max FROM req""")
def vector_report(spark, folder):
    r = scoring.vector_report(requests(spark, folder), size=VECTOR).select("vec_id", "report.*")
    text = {c: F.concat_ws("; ", c) for c in ("issues", "warnings")}
    return rounded(r.withColumns(text), dict.fromkeys(["mean", "std", "min", "max"], 5))


@query("vector_confidence", f"""WITH {REQUESTS_SQL}, p AS (SELECT *, list_sum(f) AS s FROM req) SELECT vec_id,
  {rsql(f'greatest(0.5::DOUBLE, least(0.95::DOUBLE, 0.85::DOUBLE - CASE WHEN {STD_SQL} < 0.1 THEN 0.10::DOUBLE ELSE 0 END - CASE WHEN abs(s) > 10000 THEN 0.05::DOUBLE ELSE 0 END))', 4)} AS confidence FROM p""")
def vector_confidence(spark, folder):
    r = requests(spark, folder)
    total = F.aggregate("features", F.lit(0.0), lambda s, x: s + x)
    return rounded(r.select("vec_id", scoring.confidence(F.col("features"), total).alias("confidence")), {"confidence": 4})


def rule_layers(sizes=(64, 64, 32, 1)):
    """Weights by rule: sin((i + 1)(j + 1)) and biases cos(j + 1) / 10."""
    return [
        (np.sin(np.outer(np.arange(1, a + 1), np.arange(1, b + 1))), np.cos(np.arange(1, b + 1)) / 10)
        for a, b in zip(sizes[:-1], sizes[1:])
    ]


def _layer_sql(x: str, a: int, b: int, relu: bool) -> str:
    inner = f"list_sum(list_transform(range({a}), lambda i: {x}[i + 1] * sin(CAST((i + 1) * (j + 1) AS DOUBLE)))) + cos(CAST(j + 1 AS DOUBLE)) / 10"
    return f"list_transform(range({b}), lambda j: {f'greatest(0, {inner})' if relu else inner})"


@query("score_batch", f"""WITH {REQUESTS_SQL}, c AS (SELECT vec_id, ticker, f AS raw, list_transform(f, lambda x: greatest(-1e5, least(1e5, x))) AS f FROM req),
  h1 AS (SELECT *, {_layer_sql('f', 64, 64, True)} AS a FROM c WHERE len(f) = 64), h2 AS (SELECT *, {_layer_sql('a', 64, 32, True)} AS b FROM h1),
  o AS (SELECT *, {_layer_sql('b', 32, 1, False)}[1] AS p FROM h2)
  SELECT vec_id, ticker, NULL AS error, {rsql('p', 3)} AS predicted_price,
  {rsql(f'greatest(0.5::DOUBLE, least(0.95::DOUBLE, 0.85::DOUBLE - CASE WHEN {STD_SQL} < 0.1 THEN 0.10::DOUBLE ELSE 0 END - CASE WHEN abs(p) > 10000 THEN 0.05::DOUBLE ELSE 0 END))', 4)} AS confidence FROM o
  UNION ALL SELECT vec_id, ticker, 'Expected 64 features, got ' || len(f), NULL, NULL FROM c WHERE len(f) <> 64""")
def score_batch(spark, folder):
    out = scoring.score_batch(requests(spark, folder), rule_layers())
    return rounded(out.select("vec_id", "ticker", "error", "predicted_price", "confidence"), {"predicted_price": 3, "confidence": 4})


@query("request_keys", f"""WITH {REQUESTS_SQL} SELECT upper(ticker) || '_' || md5(array_to_string(list_transform(f, lambda x: CAST(CAST(round(x * 10000) AS BIGINT) AS VARCHAR)), ',')) AS request_key,
  count(*) AS requests FROM req GROUP BY 1""")
def request_keys(spark, folder):
    """Rows per request key."""
    r = requests(spark, folder)
    return r.groupBy(scoring.request_key().alias("request_key")).agg(F.count("*").alias("requests"))


# ---- modelling

SCALED = ["open", "close", "volume"]


@query("scale_standard", f"""{BARS}, {SPLIT_SQL} {INNER} (SELECT ticker, date, {', '.join(
    f"{rsql(f'({c} - (SELECT avg({c}) FROM split WHERE split = {chr(39)}train{chr(39)})) / (SELECT stddev_pop({c}) FROM split WHERE split = {chr(39)}train{chr(39)})', 6)} AS {c}" for c in SCALED)} FROM bars)""")
def scale_standard(spark, folder):
    b = splits.positional_split(datasets.bars_table(spark, folder))
    scaler = modeling.Scaler(SCALED).fit(b.where(F.col("split") == "train"))
    return rounded(scaler.transform(b).select("ticker", "date", *SCALED), dict.fromkeys(SCALED, 6))


@query("scale_minmax", f"""{BARS}, {SPLIT_SQL}, p AS (SELECT {', '.join(f'min({c}) AS {c}_lo, max({c}) AS {c}_hi' for c in SCALED)} FROM split WHERE split = 'train')
  {INNER} (SELECT ticker, date, {', '.join(f"{rsql(f'({c} - {c}_lo) / ({c}_hi - {c}_lo)', 6)} AS {c}" for c in SCALED)} FROM bars, p)""")
def scale_minmax(spark, folder):
    b = splits.positional_split(datasets.bars_table(spark, folder))
    scaler = modeling.Scaler(SCALED, "minmax").fit(b.where(F.col("split") == "train"))
    return rounded(scaler.transform(b).select("ticker", "date", *SCALED), dict.fromkeys(SCALED, 6))


@query("sequences", f"""{BARS}, s AS (SELECT ticker, date, count(*) OVER f AS n, sum(volume) OVER f AS v, first_value(volume) OVER f AS a,
    close AS b, lead(close) OVER w AS y, sum(close) OVER f AS c FROM bars WINDOW f AS (PARTITION BY ticker ORDER BY date ROWS BETWEEN 9 PRECEDING AND CURRENT ROW), w AS (PARTITION BY ticker ORDER BY date))
  SELECT ticker, {day_sql('date')} AS date, CAST(a AS DOUBLE) AS x_first, b AS x_last, {rsql('v + c', 2)} AS x_sum, y FROM s WHERE n = 10 AND y IS NOT NULL""")
def sequences(spark, folder):
    s = targets.sequences(datasets.bars(spark, folder), ["volume", "close"], 10)
    total = F.aggregate(F.flatten("x"), F.lit(0.0), lambda a, v: a + v)
    out = s.select("ticker", "date", F.col("x")[0][0].alias("x_first"), F.col("x")[9][1].alias("x_last"), total.alias("x_sum"), "y")
    return rounded(out, {"x_sum": 2})


@query("regression_metrics", f"""{BARS}, {RETURNS_SQL}, f AS (SELECT ticker, returns AS y, lag(returns) OVER w AS h FROM rets {WINDOW_SQL}), e AS (SELECT *, y - h AS e FROM f WHERE y IS NOT NULL AND h IS NOT NULL)
  SELECT ticker, {rsql('sqrt(avg(e * e))', 6)} AS rmse, {rsql('avg(abs(e))', 6)} AS mae, {rsql('1 - sum(e * e) / (var_pop(y) * count(*))', 6)} AS r2,
  {rsql('avg(abs(e / y))', 4)} AS mape, {rsql('avg(CASE WHEN sign(y) = sign(h) THEN 1.0::DOUBLE ELSE 0 END)', 6)} AS direction_accuracy FROM e GROUP BY ticker""")
def regression_metrics(spark, folder):
    from tickloom.functions.rolling import bars_window

    r = indicators.with_returns(datasets.bars(spark, folder))
    naive = r.select("ticker", F.col("returns").alias("y"), F.lag("returns").over(bars_window()).alias("yhat"))
    return rounded(modeling.regression_metrics(naive, keys=["ticker"]), {"rmse": 6, "mae": 6, "r2": 6, "mape": 4, "direction_accuracy": 6})


@query("dataset_snapshot", f"""{BARS}, {SPLIT_SQL} SELECT substr(md5('weekly_1_' || CAST(min(date) AS VARCHAR) || '_' || CAST(max(date) AS VARCHAR)), 1, 16) AS dataset_id, 'weekly' AS dataset_name,
  1 AS version, {day_sql('min(date)')} AS start_date, {day_sql('max(date)')} AS end_date, (SELECT string_agg(ticker, ',' ORDER BY ticker) FROM (SELECT DISTINCT ticker FROM bars)) AS tickers,
  count(*) AS total_records, count(*) FILTER (split = 'train') AS train_records, count(*) FILTER (split = 'validation') AS validation_records,
  count(*) FILTER (split = 'test') AS test_records, 2 AS feature_count, 'close,volume' AS features_used, 'temporal' AS data_split_method FROM split""")
def dataset_snapshot(spark, folder):
    b = splits.positional_split(datasets.bars(spark, folder))
    out = modeling.dataset_snapshot(b, ["close", "volume"], "weekly")
    return out.withColumns({c: F.concat_ws(",", c) for c in ("tickers", "features_used")})


# ---- stored tables


@query("idempotent_append", f"""{BARS} SELECT ticker, {day_sql('date')} AS date, close FROM bars WHERE NOT (bars.date < DATE '1999-01-01' AND volume >= 2)""")
def idempotent_append(spark, folder):
    b = datasets.bars_table(spark, folder)
    stored = b.where((F.col("date") < date(1999, 1, 1)) & (F.col("volume") >= 2))
    twice = b.unionByName(b)
    return validate.insert_candidates(twice, stored, ("ticker", "date")).select("ticker", "date", "close")


@query("upsert_newest", f"""{BARS} SELECT ticker, {day_sql('date')} AS date, CASE WHEN bars.date >= DATE '1998-01-01' THEN close * 2 ELSE close END AS close,
  CASE WHEN bars.date >= DATE '1998-01-01' THEN 2 ELSE 1 END AS version FROM bars WHERE bars.date < DATE '1999-01-01' OR bars.date >= DATE '1998-01-01'""")
def upsert_newest(spark, folder):
    b = datasets.bars_table(spark, folder).select("ticker", "date", "close")
    stored = b.where(F.col("date") < date(1999, 1, 1)).withColumn("version", F.lit(1))
    new = b.where(F.col("date") >= date(1998, 1, 1)).withColumns({"close": F.col("close") * 2, "version": F.lit(2)})
    return validate.newest_wins(stored, new, ("ticker", "date"), "version")


@query("orphans", f"""{BARS}, {CALENDAR_SQL} SELECT ticker, {day_sql('date')} AS date FROM full_rows WHERE close IS NULL""")
def orphans(spark, folder):
    b = datasets.bars_table(spark, folder)
    return validate.orphans(clean.calendar(b, 7), b)


@query("cascade", f"""{BARS}, {CALENDAR_SQL} SELECT ticker, {day_sql('date')} AS date FROM full_rows WHERE close IS NOT NULL""")
def cascade(spark, folder):
    b = datasets.bars_table(spark, folder)
    return validate.cascade(clean.calendar(b, 7), b)


@query("retention", f"""{BARS} SELECT ticker, CAST(count(*) FILTER (bars.date >= DATE '2001-06-30' - 730) AS BIGINT) AS kept,
  CAST(count(*) FILTER (bars.date < DATE '2001-06-30' - 730) AS BIGINT) AS expired FROM bars GROUP BY ticker""")
def retention(spark, folder):
    kept, expired = sinks.split_by_age(datasets.bars_table(spark, folder), date(2001, 6, 30), sinks.RAW_KEEP_DAYS)
    both = kept.select("ticker", F.lit(True).alias("keep")).unionByName(expired.select("ticker", F.lit(False).alias("keep")))
    return both.groupBy("ticker").agg(F.count_if("keep").alias("kept"), F.count_if(~F.col("keep")).alias("expired"))


# ---- the file pipeline on derived bars

PROCESSED_DIGITS = {
    "returns": 6, "sma_20": 5, "ema_12": 3, "ema_26": 3, "macd_signal": 3, "rsi_14": 5, "bb_upper": 3, "volume_change": 6,
    "volatility_10": 5, "target_return": 6,
}
PROCESSED_SQL = f"""{EMA_SQL}, {RSI_A}, pr AS (SELECT *, close / lag(close) OVER w - 1 AS returns, volume / lag(volume) OVER w - 1 AS volume_change,
    (lead(close) OVER w - close) / close AS target_return FROM bars {WINDOW_SQL}),
  px AS (SELECT *, {rolling_sql('avg', 'close', 20)} AS sma_20, {rolling_sql('stddev_samp', 'close', 20)} AS dev, {rolling_sql('stddev_samp', 'returns', 10)} AS volatility_10 FROM pr),
  pc AS (SELECT px.ticker, px.date, returns, sma_20, ema_12, ema_26, macd_signal, rsi_14, sma_20 + 2 * dev AS bb_upper, volume_change, volatility_10, target_return
    FROM px JOIN macd ON px.ticker = macd.ticker AND px.date = macd.date JOIN rsi ON px.ticker = rsi.ticker AND px.date = rsi.date),
  po AS (SELECT * FROM pc WHERE COLUMNS(*) IS NOT NULL),
  pn AS (SELECT *, row_number() OVER w - 1 AS rn, count(*) OVER (PARTITION BY ticker) AS n FROM po {WINDOW_SQL})"""


@query("processed_dataset", f"""{BARS}, {PROCESSED_SQL} SELECT ticker, {day_sql('date')} AS date, {', '.join(f'{rsql(c, n)} AS {c}' for c, n in PROCESSED_DIGITS.items())},
  CASE WHEN rn < floor(n * 0.7::DOUBLE) THEN 'train' WHEN rn < floor(n * (0.7::DOUBLE + 0.15::DOUBLE)) THEN 'validation' ELSE 'test' END AS split FROM pn""")
def processed_dataset(spark, folder):
    from tickloom.plans.process import process_bars

    out = process_bars(datasets.bars(spark, folder))
    return rounded(out.select("ticker", "date", *PROCESSED_DIGITS, "split"), PROCESSED_DIGITS)
