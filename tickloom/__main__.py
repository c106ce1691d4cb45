"""``python -m tickloom --input bars.csv --output folder``: features, targets and splits from a bar file."""

from __future__ import annotations

import argparse

from tickloom.plans.process import ProcessConfig, process_file
from tickloom.session import build_session


def main() -> None:
    p = argparse.ArgumentParser(prog="tickloom", description="Turn a bar file into features, targets and time-ordered splits.")
    p.add_argument("--input", required=True)
    p.add_argument("--output", required=True)
    p.add_argument("--ticker", help="ticker of all rows; taken from the file name if omitted")
    p.add_argument("--prediction-horizon", type=int, default=1)
    p.add_argument("--train-ratio", type=float, default=0.7)
    p.add_argument("--val-ratio", type=float, default=0.15)
    p.add_argument("--format", choices=["csv", "parquet"], default="csv")
    p.add_argument("--master", help="Spark master, if not given by spark-submit")
    a = p.parse_args()
    spark = build_session("tickloom-process", a.master)
    config = ProcessConfig(a.ticker, a.prediction_horizon, a.train_ratio, a.val_ratio)
    for key, value in process_file(spark, a.input, a.output, config, a.format).items():
        print(f"{key}: {value}")


if __name__ == "__main__":
    main()
