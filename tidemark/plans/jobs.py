"""Stages as spark-submit jobs: python -m tidemark.plans.jobs <stage> --source ... --state ..."""

from __future__ import annotations

import argparse
import json
from datetime import UTC, datetime
from pathlib import Path

from tidemark import schemas
from tidemark.operators import comparison, content, contracts
from tidemark.plans import lakehouse
from tidemark.session import build_session
from tidemark.sources import files, fixtures, tables


def parser() -> argparse.ArgumentParser:
    arguments = argparse.ArgumentParser(description=__doc__)
    arguments.add_argument("stage", choices=sorted(STAGES))
    arguments.add_argument("--source", default="", help="folder of the source files")
    arguments.add_argument("--state", default="", help="folder of messages, checkpoints and receipts")
    arguments.add_argument("--run-id", default="unknown-run")
    arguments.add_argument("--format", default="parquet")
    arguments.add_argument("--incident-mode", choices=("true", "false"), default="false")
    arguments.add_argument("--messages", type=int, default=20_000)
    arguments.add_argument("--servers", default="", help="Kafka brokers; without them messages are files below --state")
    arguments.add_argument("--topic", default="quality-telemetry")
    arguments.add_argument("--jaas-file", default="", help="file with the SASL JAAS configuration of the brokers")
    arguments.add_argument("--rate", type=int, default=None, help="messages (of a broker) or files of a micro-batch")
    arguments.add_argument("--expected-files", type=int, default=6)
    arguments.add_argument("--expected-rows", type=int, default=30_000)
    arguments.add_argument("--row-count", type=int, default=5_000_000)
    arguments.add_argument("--partition-count", type=int, default=64)
    return arguments


def _fixture(run, args):
    fixtures.write_fixture(run.spark, run.source)


def _layers(run, args):
    tables.create_layers(run.spark)


def _preflight(run, args):
    contracts.preflight(run.spark, schemas.LAYERS)


def _verify(run, args):
    landed = run.spark.read.schema(schemas.QUALITY_SOURCE).json(f"{run.source}/quality")
    print(json.dumps(files.verify_landing(landed, args.expected_files, args.expected_rows)))


def _replay(run, args):
    receipt = lakehouse.replay_messages(run, args.messages, args.topic, args.servers or None)
    print(json.dumps(receipt.first().asDict()))


def _stream(run, args):
    jaas = Path(args.jaas_file).read_text().strip() if args.jaas_file else None
    stream = lakehouse.message_stream(run, args.topic, args.servers or None, jaas, args.rate)
    lakehouse.bronze_stream(run, stream, f"eventhubs://{args.topic}")


def _gate(run, args):
    for row in lakehouse.quality_gate(run).collect():  # one row per expectation
        print(json.dumps(row.asDict()))


def _receipt(run, args):
    document = content.receipt_document(lakehouse.receipt(run), run_id=run.run_id, validation="PASS")
    tables.write_receipt(document, f"{run.state}/receipts/{run.run_id}")


def _benchmark(run, args):
    facts = fixtures.skewed_facts(run.spark, args.row_count, partitions=args.partition_count).cache()
    lines = fixtures.product_lines(run.spark)

    def plan(name):
        return lambda: comparison.skewed_join_plans(facts, lines, args.partition_count, args.partition_count)[name]

    names = ("shuffle_hash", "broadcast", "aggregate_first")
    print(json.dumps(comparison.compare_plans(run.spark, {n: plan(n) for n in names}, "shuffle_hash")))
    facts.unpersist()


STAGES = {
    "generate-fixture": _fixture,
    "create-layers": _layers,
    "preflight": _preflight,
    "verify-landing": _verify,
    "bronze-batch": lambda run, args: lakehouse.bronze_batch(run, args.incident_mode == "true"),
    "replay-messages": _replay,
    "bronze-stream": _stream,
    "silver": lambda run, args: lakehouse.silver_batches(run),
    "quality-gate": _gate,
    "gold": lambda run, args: lakehouse.publish_gold(run),
    "validation": lambda run, args: lakehouse.validate(run),
    "receipt": _receipt,
    "benchmark": _benchmark,
}


def main(argv: list[str] | None = None) -> None:
    args = parser().parse_args(argv)
    now = datetime.now(UTC).isoformat().replace("+00:00", "Z")
    run = lakehouse.Run(build_session(f"tidemark-{args.stage}"), args.source, args.state, args.run_id, now, args.format)
    STAGES[args.stage](run, args)


if __name__ == "__main__":
    main()
