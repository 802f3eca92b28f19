"""Landing job: ``spark-submit --packages <kafka>,<s3a> run_landing.py --root <shared folder>``."""

from __future__ import annotations

import argparse

from wayfleet.config import JobConfig
from wayfleet.session import build_session
from wayfleet.streaming.land import land_supervised


def parse(argv: list[str] | None = None) -> tuple[JobConfig, bool]:
    parser = argparse.ArgumentParser(description="Land the five telemetry topics as Parquet")
    parser.add_argument("--root", required=True, help="folder for output and checkpoints")
    parser.add_argument("--brokers", help="Kafka bootstrap servers (default: KAFKA_BOOTSTRAP_SERVER)")
    parser.add_argument("--trigger-interval", help="time between batches, such as '1 minute'")
    parser.add_argument("--max-offsets-per-trigger", type=int)
    parser.add_argument("--min-partitions", type=int)
    parser.add_argument("--kafka-option", action="append", metavar="NAME=VALUE", help="further option of the Kafka source, more than once if needed")
    parser.add_argument("--partition-by-date", action="store_true", help="add event_date folders")
    parser.add_argument("--quarantine", action="store_true", help="keep undecodable text, in verdict=bad folders")
    parser.add_argument("--dedup", action="store_true", help="drop records re-delivered within an hour of their first arrival; later copies are kept")
    parser.add_argument("--account", action="store_true", help="keep the figures of every batch below <root>/accounts")
    parser.add_argument("--available-now", action="store_true", help="land what the topics hold and end")
    given = {k: v for k, v in vars(parser.parse_args(argv)).items() if v is not None}
    available_now = given.pop("available_now")
    options = given.pop("kafka_option", [])
    wrong = [o for o in options if "=" not in o]
    if wrong:
        parser.error(f"not NAME=VALUE: {wrong[0]}")
    given["kafka_options"] = dict(o.split("=", 1) for o in options)
    return JobConfig.from_env(**given), available_now


def main(argv: list[str] | None = None) -> None:
    config, available_now = parse(argv)
    spark = build_session()
    land_supervised(spark, config, available_now=available_now)
