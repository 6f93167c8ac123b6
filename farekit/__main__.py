"""Command line: ``python -m farekit report|train|multiplier|quote ...``."""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession

from farekit.plans import jobs, quoting
from farekit.session import build_session
from farekit.sources import inference, readers, schemas


def _arguments() -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="farekit")
    commands = parser.add_subparsers(dest="command", required=True)

    report = commands.add_parser("report", help="describe a flights CSV")
    report.add_argument("flights")
    report.add_argument("out")
    report.add_argument("--days", type=int, default=jobs.YEAR_DAYS, help="days the table covers")
    report.add_argument("--infer", action="store_true", help="columns in any order, with the types their values have")

    train = commands.add_parser("train", help="fit the fare model on a flights CSV")
    train.add_argument("flights")
    train.add_argument("out")
    train.add_argument("--date", required=True, help="training date to record")
    train.add_argument("--preset", choices=("gbt", "rf"), default="gbt")
    train.add_argument("--infer", action="store_true", help="columns in any order, with the types their values have")

    multiplier = commands.add_parser("multiplier", help="fit the price multiplier on a quotes CSV")
    multiplier.add_argument("quotes")
    multiplier.add_argument("out")
    multiplier.add_argument("--preset", choices=("notebook", "stored"), default="notebook")

    quote = commands.add_parser("quote", help="score JSON requests with a trained fare model")
    quote.add_argument("requests")
    quote.add_argument("trained", help="folder written by train")
    quote.add_argument("out")
    quote.add_argument("--as-of", required=True, help="date for requests without one")
    quote.add_argument("--quick", action="store_true", help="use the six-field form")
    quote.add_argument("--stream", action="store_true", help="read the folder as a stream")
    return parser.parse_args()


def _flights(spark: SparkSession, args: argparse.Namespace) -> DataFrame:
    if args.infer:
        return inference.read_inferred_csv(spark, args.flights)
    return readers.read_typed_csv(spark, args.flights, schemas.FLIGHTS)


def main() -> None:
    args = _arguments()
    spark = build_session()
    if args.command == "report":
        jobs.report(_flights(spark, args), args.out, args.days)
    elif args.command == "train":
        jobs.train_fares(_flights(spark, args), args.out, args.date, args.preset)
    elif args.command == "multiplier":
        quotes = readers.read_typed_csv(spark, args.quotes, schemas.QUOTES)
        jobs.fit_multiplier(quotes, args.out, args.preset)
    else:
        read = readers.stream_requests if args.stream else readers.read_json_requests
        requests = read(spark, args.requests)
        if args.quick:
            requests = quoting.quick_request(requests)
        jobs.quote_requests(requests, jobs.load_context(spark, args.trained, args.as_of), args.out)


if __name__ == "__main__":
    main()
