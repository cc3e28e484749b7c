"""Command line: run an application as a stream, or its KPIs as a batch report.

    python -m chargepulse.cli app notify  --source kafka:broker:9092:recharge --dim provinces.txt \
        --out hdfs:///kpi/notify --checkpoint hdfs:///ckpt/notify [--trigger "2 seconds"]
    python -m chargepulse.cli app topup   --source files:/logs/topup --out ... --checkpoint ...
    python -m chargepulse.cli report notify --input /logs/recharge --dim provinces.txt --out /kpi/day1

``app`` starts one streaming query (see :mod:`chargepulse.streaming.apps`) and waits until it ends or
``stop --out <its output>``, from any machine, asks it to stop after its running batch;
``report`` reads a folder of JSON lines, writes every KPI of the application
as a Parquet table under ``--out`` plus the quarantined messages.
"""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession

from chargepulse.operators import clean as C
from chargepulse.plans import notify as N, request as R, topup as T
from chargepulse.session import get_session
from chargepulse.sources.dimension import province_dim, read_province_text
from chargepulse.sources.files import read_lines_stream
from chargepulse.sources.kafka import kafka_source_options, read_kafka
from chargepulse.streaming import apps as A
from chargepulse.streaming.control import ask_to_stop, run_until_stopped
from chargepulse.streaming.jobs import run_to_end

KINDS = ("notify", "request", "topup")


def _source(spark: SparkSession, spec: str, max_files: int | None, kafka: dict | None = None) -> DataFrame:
    kind, _, rest = spec.partition(":")
    if kind == "files":
        return read_lines_stream(spark, rest, max_files)
    if kind == "kafka":
        brokers, _, topic = rest.rpartition(":")
        return read_kafka(spark, kafka_source_options(brokers, topic, **(kafka or {})))
    raise ValueError(f"--source must be files:<path> or kafka:<brokers>:<topic>, not {spec!r}")


def run_app(spark: SparkSession, kind: str, source: str, out: str, checkpoint: str,
            dim_path: str | None = None, trigger: str | None = "2 seconds",
            gate: str = "interface", max_files: int | None = None, mode: str = "quarantine",
            kafka: dict | None = None, spread_to: int | None = None):
    stream = _source(spark, source, max_files, kafka)
    if kind == "topup":
        return A.topup_app(stream, out, checkpoint, trigger=trigger, mode=mode, spread_to=spread_to)
    dim = province_dim(read_province_text(spark, dim_path))
    if kind == "notify":
        return A.notify_app(stream, dim, out, checkpoint, trigger=trigger, gate=gate, mode=mode,
                            spread_to=spread_to)
    return A.request_app(stream, dim, out, checkpoint, trigger=trigger, mode=mode, spread_to=spread_to)


def run_report(spark: SparkSession, kind: str, input_path: str, out: str,
               dim_path: str | None = None, gate: str = "interface") -> dict[str, str]:
    """Batch: every KPI of ``kind`` over the JSON lines under ``input_path``."""
    log = spark.read.text(input_path)
    out = out.rstrip("/")
    # The messages are parsed once: clean and bad rows are a table, which the KPIs read.
    if kind == "topup":
        rows = _written(C.topup_rows(log), f"{out}/rows")
        kpis = T.topup_report(C.good(rows))
    else:
        dim = C.province_lookup(province_dim(read_province_text(spark, dim_path)))
        if kind == "notify":
            rows = _written(C.notify_rows(log, dim, gate), f"{out}/rows")
            kpis = N.notify_report(C.good(rows))
        else:
            rows = _written(C.request_rows(log, dim), f"{out}/rows")
            kpis = R.request_report(C.good(rows))
    written = {}
    for name, df in {**kpis, "quarantine": C.quarantined(rows)}.items():
        df.write.mode("overwrite").parquet(f"{out}/{name}")
        written[name] = f"{out}/{name}"
    return written


def _written(rows: DataFrame, path: str) -> DataFrame:
    rows.write.mode("overwrite").parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def main(argv: list[str] | None = None, spark: SparkSession | None = None):
    ap = argparse.ArgumentParser(prog="chargepulse")
    sub = ap.add_subparsers(dest="command", required=True)
    a = sub.add_parser("app", help="run an application as one streaming query")
    a.add_argument("kind", choices=KINDS)
    a.add_argument("--source", required=True, help="files:<path> or kafka:<brokers>:<topic>")
    a.add_argument("--out", required=True)
    a.add_argument("--checkpoint", required=True)
    a.add_argument("--dim", help="province file, 'code name' per line")
    a.add_argument("--trigger", default="2 seconds", help='"2 seconds" or "availableNow"')
    a.add_argument("--gate", default="interface", choices=("interface", "business"))
    a.add_argument("--max-files-per-trigger", type=int)
    a.add_argument("--starting-offsets", help="earliest, latest, or the JSON of stored positions (Kafka, first run)")
    a.add_argument("--max-offsets-per-trigger", type=int, help="rate cap of a batch (Kafka)")
    a.add_argument("--min-partitions", type=int, help="split large topic-partitions over so many tasks (Kafka)")
    a.add_argument("--spread-to", type=int, help="deal every micro-batch to so many partitions before parsing")
    a.add_argument("--mode", default="quarantine", choices=("quarantine", "strict"))
    x = sub.add_parser("stop", help="ask a running application to stop after its running batch")
    x.add_argument("--out", required=True, help="the application's output folder")
    r = sub.add_parser("report", help="batch KPIs of a folder of messages")
    r.add_argument("kind", choices=KINDS)
    r.add_argument("--input", required=True)
    r.add_argument("--out", required=True)
    r.add_argument("--dim")
    r.add_argument("--gate", default="interface", choices=("interface", "business"))
    args = ap.parse_args(argv)
    if args.command != "stop" and args.kind != "topup" and not args.dim:
        ap.error("--dim is required for notify and request")
    spark = spark or get_session()
    if args.command == "stop":
        return ask_to_stop(spark, args.out)
    if args.command == "report":
        return run_report(spark, args.kind, args.input, args.out, args.dim, args.gate)
    q = run_app(spark, args.kind, args.source, args.out, args.checkpoint, args.dim,
                args.trigger, args.gate, args.max_files_per_trigger, args.mode,
                {"starting_offsets": args.starting_offsets, "min_partitions": args.min_partitions,
                 "max_offsets_per_trigger": args.max_offsets_per_trigger}, args.spread_to)
    if args.trigger == "availableNow":
        run_to_end(q)
    else:
        run_until_stopped(spark, q, args.out)
    return q


if __name__ == "__main__":
    main()
