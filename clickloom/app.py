"""The jobs as programs: ``spark-submit main.py session --params ... --output ...``."""

from __future__ import annotations

import argparse
import uuid

from pyspark.sql import DataFrame, SparkSession

from clickloom import TaskParams, build_session
from clickloom.operators.ads import BLACKLIST_THRESHOLD
from clickloom.plans import jobs
from clickloom.sources import adlog, storage, tables
from clickloom.streaming import clicks as streams
from clickloom.streaming.clicks import AdTables


def _parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="clickloom")
    commands = parser.add_subparsers(dest="job", required=True)
    for job in ("session", "page", "area"):
        command = commands.add_parser(job)
        command.add_argument("--params", required=True, help="task parameters, as JSON")
        command.add_argument("--task-id", default=None)
        command.add_argument("--output", required=True, help="folder of the result tables")
        command.add_argument("--actions", default=tables.ACTION_TABLE)
        if job == "session":
            command.add_argument("--users", default=tables.USER_TABLE)
        if job == "area":
            command.add_argument("--products", default=tables.PRODUCT_TABLE)
            command.add_argument("--cities", help="city table; default: the built-in cities")
    ingest = commands.add_parser("ingest", help="store delivered actions by day")
    ingest.add_argument("--input", default=tables.ACTION_TABLE, help="table with text times")
    ingest.add_argument("--output", required=True, help="folder for --actions of the jobs")
    ingest.add_argument("--delivery", help="id of the delivery; a second run of it changes nothing")
    compact = commands.add_parser("compact", help="compact the tables of a stopped ads service")
    compact.add_argument("--output", required=True, help="folder of tables and checkpoints")
    sweep = commands.add_parser("sweep", help="remove what killed batches of an ads service left")
    sweep.add_argument("--output", required=True, help="folder of tables and checkpoints")
    ads = commands.add_parser("ads")
    ads.add_argument("--servers", required=True, help="Kafka servers")
    ads.add_argument("--topic", required=True)
    ads.add_argument("--output", required=True, help="folder of tables and checkpoints")
    ads.add_argument("--threshold", type=int, default=BLACKLIST_THRESHOLD)
    ads.add_argument("--every", default="5 seconds", help="time between micro-batches")
    ads.add_argument("--starting", default="latest",
                     help="offsets of the first start: latest, earliest or JSON")
    return parser


def main(arguments: list[str] | None = None) -> None:
    args = _parser().parse_args(arguments)
    spark = build_session(f"clickloom-{args.job}")
    if args.job == "ads":
        lines = adlog.kafka_lines(spark, args.servers, args.topic, args.starting)
        streams.start_all(lines, AdTables.newest(spark, args.output), args.threshold,
                          {"processingTime": args.every})
        spark.streams.awaitAnyTermination()
        return
    if args.job == "compact":
        streams.compact(spark, AdTables.newest(spark, args.output))
        return
    if args.job == "sweep":
        swept = streams.sweep(spark, AdTables.newest(spark, args.output))
        print(f"{len(swept)} folders removed")
        return
    if args.job == "ingest":
        seen = tables.ingest_actions(spark.table(args.input), args.output, args.delivery)
        print(f"{seen['rows']} rows, {seen['rejected']} rejected")
        return
    with storage.staged_until_done(spark):
        jobs.write_results(_results(spark, args), args.output)


def _results(spark: SparkSession, args: argparse.Namespace) -> dict[str, DataFrame]:
    params = TaskParams.from_json(spark, args.params, args.task_id or str(uuid.uuid4()))
    actions = tables.action_table(spark, args.actions)
    if args.job == "session":
        return jobs.session_job(actions, tables.user_table(spark, args.users), params)
    if args.job == "page":
        return jobs.page_job(actions, params)
    cities = spark.table(args.cities) if args.cities else tables.city_dimension(spark)
    return jobs.area_job(actions, tables.product_table(spark, args.products), cities, params)
