"""Run a job: ``spark-submit -m sensorstream <job> ...`` or ``python -m sensorstream <job> ...``.

Jobs that read messages take them from Kafka (``--servers``) or a file log
(``--log``). Streaming jobs work off what is there and stop, or go on with
``--every "1 second"``.
"""

from __future__ import annotations

import argparse
from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from sensorstream.functions.eventtime import event_time_from_millis, with_event_time
from sensorstream.functions.keys import log_place
from sensorstream.operators.drift import drift, field_types, shapes
from sensorstream.operators.windows import window_counts
from sensorstream.plans.archive import start_archive
from sensorstream.plans.overheat import CLOCK, EVENT, LOG, TIMER, finish_overheat, overheat, start_overheat
from sensorstream.plans.publish import in_sending_order, publish_to_files
from sensorstream.plans.quarantine import start_quarantine
from sensorstream.plans.recompute import recompute
from sensorstream.schemas import (
    COLLECTIONS,
    CONSTANT_THRESHOLD,
    DATABASE,
    HUMIDITY_TOPIC,
    KEYED_MILLIS,
    MEAN_THRESHOLD,
    OUT_OF_ORDERNESS,
    TEMPERATURE_TOPIC,
    WINDOW_SIZE,
    WINDOW_SLIDE,
)
from sensorstream.session import session_builder
from sensorstream.sources.collections import QUARANTINE, create_collections, find
from sensorstream.sources.compaction import FILE_BYTES, compact, vacuum
from sensorstream.sources.files import read_file_log, read_messages, read_readings
from sensorstream.sources.kafka import publish_to_kafka, read_topics
from sensorstream.sources.rolling import write_rolled
from sensorstream.streaming.groups import Group
from sensorstream.streaming.runner import print_rows, start_console


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="sensorstream", description=__doc__)
    top.add_argument("--shuffle-bytes", type=int, help="expected shuffle volume, sizes the partitions")
    top.add_argument("--cores", type=int, default=8, help="cores of all executors")
    jobs = top.add_subparsers(dest="job", required=True)

    def job(name: str, help_text: str) -> argparse.ArgumentParser:
        return jobs.add_parser(name, help=help_text)

    def consumes(command: argparse.ArgumentParser, topics: Sequence[str]) -> None:
        source = command.add_mutually_exclusive_group(required=True)
        source.add_argument("--servers", help="Kafka bootstrap servers")
        source.add_argument("--log", help="folder of a file log")
        command.add_argument("--topics", nargs="+", default=list(topics))
        command.add_argument("--starting-offsets", default="earliest")
        command.add_argument("--group-id")
        command.add_argument("--max-per-trigger", type=int, help="Kafka offsets or files per batch")
        command.add_argument("--checkpoint")
        command.add_argument("--every", help="trigger interval")

    def computes_heat(command: argparse.ArgumentParser) -> None:
        command.add_argument("--size", default=WINDOW_SIZE)
        command.add_argument("--slide", default=WINDOW_SLIDE)
        command.add_argument("--mean-threshold", type=float, default=MEAN_THRESHOLD)
        command.add_argument("--constant-threshold", type=float, default=CONSTANT_THRESHOLD)
        command.add_argument("--min-count", type=int, default=1)
        command.add_argument("--decimals", type=int, help="decimal places of the values")

    heat = job("overheat", "heat statistics or alerts per sensor and sliding window")
    consumes(heat, [TEMPERATURE_TOPIC])
    computes_heat(heat)
    heat.add_argument("--delay", default=OUT_OF_ORDERNESS, help="of the watermark")
    heat.add_argument("--source-tz", help="zone of the readings' timestamps, UTC without it")
    heat.add_argument("--output", help="folder of the result table; prints every row without it")
    heat.add_argument("--time", choices=[EVENT, LOG, CLOCK, TIMER], default=EVENT)
    heat.add_argument("--mode", choices=["append", "update"], default="append")
    heat.add_argument("--files-per-batch", type=int)
    heat.add_argument("--alerts-only", action="store_true")
    heat.add_argument(
        "--arrival-order", action="store_true", help="first and last reading as the log has them"
    )
    heat.add_argument("--strict", action="store_true", help="drop late rows at once")
    heat.add_argument("--ledger", help="folder for each batch's watermark, to tell late rows by")
    heat.add_argument("--finish", action="store_true", help="at the end store the open windows as well")

    store = job("archive", "messages into their collections")
    consumes(store, [TEMPERATURE_TOPIC, HUMIDITY_TOPIC])
    store.add_argument("--store", required=True)
    store.add_argument("--files-per-batch", type=int)
    store.add_argument("--offsets", help="folder of committed offsets of --group-id; a new checkpoint goes on there")
    store.add_argument(
        "--topic-partitions", type=int, default=1, help="partitions of each Kafka topic, to start at committed offsets"
    )
    store.add_argument("--tables", action="store_true", help="declare and fill catalog tables as well")

    fields = job("drift", "fields and types of stored messages, and where they leave the reading's schema")
    fields.add_argument("--store", required=True)
    fields.add_argument("--collections", nargs="+", default=[*COLLECTIONS, QUARANTINE])
    fields.add_argument("--output", help="folder of the result table; prints every row without it")

    pack = job("compact", "stored collections into files of a given size")
    pack.add_argument("--store", required=True)
    pack.add_argument("--collections", nargs="+", default=[*COLLECTIONS, QUARANTINE])
    pack.add_argument("--file-bytes", type=int, default=FILE_BYTES)
    pack.add_argument("--vacuum", action="store_true", help="delete what is no longer read; no reader may be at work")

    aside = job("quarantine", "messages that are no complete readings")
    consumes(aside, [TEMPERATURE_TOPIC, HUMIDITY_TOPIC])
    aside.add_argument("--output", required=True)
    aside.add_argument("--files-per-batch", type=int)

    send = job("publish", "reading files into the message log")
    send.add_argument("input")
    send.add_argument("--lines", action="store_true", help="input has one reading per line")
    send.add_argument("--as-sent", action="store_true", help="send the texts as they are, all of their fields")
    send.add_argument("--topic", help="topic of all messages, by sensor type without it")
    target = send.add_mutually_exclusive_group(required=True)
    target.add_argument("--servers", help="Kafka bootstrap servers")
    target.add_argument("--log", help="folder of a file log")
    send.add_argument("--partitions", type=int, default=1, help="partitions of a file log")
    send.add_argument("--acks", default="1")

    again = job("recompute", "heat statistics of a stored collection")
    again.add_argument("--store", required=True)
    again.add_argument("--collection", default="temperature")
    again.add_argument("--output", required=True)
    again.add_argument("--from-day", help="first day read, as 2010-01-31")
    again.add_argument("--to-day", help="last day read")
    computes_heat(again)

    count = job("count", "rows per key and sliding window of a CSV of key and milliseconds")
    count.add_argument("input")
    count.add_argument("--size", default="5 milliseconds")
    count.add_argument("--slide", default="2 milliseconds")
    count.add_argument("--output", help="folder for CSV files; prints without it")
    count.add_argument("--file-bytes", type=int, help="roll the files at this size, in order of key and window")
    return top


def _messages(spark: SparkSession, args: argparse.Namespace, group: Group | None = None) -> DataFrame:
    if args.log:
        return read_file_log(
            spark,
            args.log,
            args.topics,
            streaming=True,
            max_files_per_trigger=args.max_per_trigger,
            splits=group is not None,
        )
    starting_offsets = args.starting_offsets
    if group is not None:
        partitions = dict.fromkeys(args.topics, args.topic_partitions)
        starting_offsets = group.starting_offsets(spark, partitions)
    return read_topics(
        spark,
        args.servers,
        args.topics,
        starting_offsets=starting_offsets,
        group_id=args.group_id,
        max_offsets_per_trigger=args.max_per_trigger,
    )


def _heat_options(args: argparse.Namespace) -> dict:
    names = ("size", "slide", "mean_threshold", "constant_threshold", "min_count", "decimals")
    return {name: getattr(args, name) for name in names}


def _overheat(spark: SparkSession, args: argparse.Namespace) -> StreamingQuery:
    messages = _messages(spark, args)
    options = {
        "time": args.time,
        "alerts_only": args.alerts_only,
        "delay": args.delay,
        "source_tz": args.source_tz,
        **_heat_options(args),
    }
    if args.arrival_order:
        place = log_place(F.col("partition"), F.col("offset"))
        messages, options["arrival"] = messages.withColumn("place", place), "place"
    if not args.output:
        return start_console(
            overheat(messages, **options),
            name="overheat",
            checkpoint=args.checkpoint,
            mode=args.mode,
            every=args.every,
            strict=args.strict,
        )
    checkpoint = args.checkpoint or f"{args.output}.checkpoint"
    query = start_overheat(
        messages,
        args.output,
        name="overheat",
        checkpoint=checkpoint,
        mode=args.mode,
        every=args.every,
        strict=args.strict,
        files_per_batch=args.files_per_batch,
        ledger=args.ledger,
        **options,
    )
    if args.finish:
        query.awaitTermination()
        finish_overheat(messages, args.output, checkpoint=checkpoint, **options)
    return query


def _archive(spark: SparkSession, args: argparse.Namespace) -> StreamingQuery:
    if args.tables:
        create_collections(spark, args.store)
    group = Group(args.offsets, args.group_id) if args.offsets else None
    return start_archive(
        _messages(spark, args, group),
        args.store,
        checkpoint=args.checkpoint or f"{args.store}.checkpoint",
        every=args.every,
        files_per_batch=args.files_per_batch,
        database=DATABASE if args.tables else None,
        group=group,
    )


def _compact(spark: SparkSession, args: argparse.Namespace) -> None:
    for collection in args.collections:
        compact(spark, args.store, collection, file_bytes=args.file_bytes)
        if args.vacuum:
            vacuum(spark, args.store, collection)


def _drift(spark: SparkSession, args: argparse.Namespace) -> None:
    stored = [find(spark, args.store, name).select("topic", "raw") for name in args.collections]
    every = reduce(DataFrame.unionByName, stored)
    found = drift(field_types(shapes(every, ["topic"], text="raw"), ["topic"]), ["topic"])
    if args.output:
        found.write.mode("overwrite").parquet(args.output)
    else:
        print_rows(found.orderBy("topic", "path", "type"))


def _quarantine(spark: SparkSession, args: argparse.Namespace) -> StreamingQuery:
    return start_quarantine(
        _messages(spark, args),
        args.output,
        checkpoint=args.checkpoint or f"{args.output}.checkpoint",
        every=args.every,
        files_per_batch=args.files_per_batch,
    )


def _publish(spark: SparkSession, args: argparse.Namespace) -> None:
    read = read_messages if args.as_sent else read_readings
    frame = read(spark, args.input, lines=args.lines)
    if args.log:
        publish_to_files(frame, args.log, partitions=args.partitions, topic=args.topic)
    else:
        publish_to_kafka(in_sending_order(frame, topic=args.topic), args.servers, acks=args.acks)


def _recompute(spark: SparkSession, args: argparse.Namespace) -> None:
    days = [F.col("day") >= F.lit(args.from_day).cast("date")] if args.from_day else []
    days += [F.col("day") <= F.lit(args.to_day).cast("date")] if args.to_day else []
    where = reduce(and_, days) if days else None
    stats = recompute(spark, args.store, args.collection, where, **_heat_options(args))
    stats.write.mode("overwrite").parquet(args.output)


def _count(spark: SparkSession, args: argparse.Namespace) -> None:
    rows = spark.read.schema(KEYED_MILLIS).csv(args.input)
    timed = with_event_time(rows, event_time_from_millis(F.col("ms")), delay=None)
    counts = window_counts(timed, size=args.size, slide=args.slide)
    if args.output and args.file_bytes:
        line = F.to_csv(F.struct(*counts.columns))
        order = ["k", "window_start_ms"]
        write_rolled(counts, args.output, line, order, file_bytes=args.file_bytes, mode="overwrite")
    elif args.output:
        counts.write.mode("overwrite").option("header", True).csv(args.output)
    else:
        print_rows(counts.orderBy("k", "window_start_ms"))


JOBS = {
    "overheat": _overheat,
    "archive": _archive,
    "compact": _compact,
    "drift": _drift,
    "publish": _publish,
    "quarantine": _quarantine,
    "recompute": _recompute,
    "count": _count,
}


def main(argv: Sequence[str] | None = None) -> None:
    args = parser().parse_args(argv)
    if args.job == "overheat" and args.files_per_batch and not args.output:
        raise SystemExit("--files-per-batch needs --output")
    if args.job == "overheat" and not args.output and (args.finish or args.ledger):
        raise SystemExit("--finish and --ledger need --output")
    if args.job == "overheat" and args.time == TIMER and (args.mode != "append" or not args.every):
        raise SystemExit("windows by the timer need --every, in append mode")
    if args.job == "overheat" and args.finish and (args.every or args.mode != "append"):
        raise SystemExit("--finish is for a bounded run in append mode")
    if args.job == "count" and args.file_bytes and not args.output:
        raise SystemExit("--file-bytes needs --output")
    if args.job == "archive" and args.offsets and not args.group_id:
        raise SystemExit("--offsets needs --group-id")
    spark = session_builder(
        f"sensorstream-{args.job}", shuffle_bytes=args.shuffle_bytes, cores=args.cores
    ).getOrCreate()
    query = JOBS[args.job](spark, args)
    if query is not None:
        query.awaitTermination()


if __name__ == "__main__":
    main()
