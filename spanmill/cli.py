"""Command line: de-identify a text file, or run lenses over span files.

python -m spanmill.cli deidentify FILE [--policy YAML] [--strategy S] [--score-threshold X] [--format text|json] [--output FILE] [--audit FILE]
python -m spanmill.cli worker --lens NAME|all (--csv FILE | --stream DIR --checkpoint DIR) --out DIR [--once]
"""

from __future__ import annotations

import argparse
import dataclasses
import json
import sys
from datetime import datetime, timezone

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from spanmill.operators import pii
from spanmill.operators.derive import derive
from spanmill.plans.registry import LENSES
from spanmill.sources.pricing import static_pricing
from spanmill.sources.spans import read_spans_csv, write_csv
from spanmill.streaming.worker import Worker, read_stream, start_all


def _arguments(argv: list[str] | None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="spanmill")
    commands = parser.add_subparsers(dest="command", required=True)
    text = commands.add_parser("deidentify", help="replace personal data in a text file")
    text.add_argument("file")
    for name in ("--policy", "--output", "--audit"):
        text.add_argument(name)
    text.add_argument("--strategy", choices=pii.STRATEGIES)
    text.add_argument("--score-threshold", type=float)
    text.add_argument("--format", choices=("text", "json"), default="text")
    worker = commands.add_parser("worker", help="derive metric rows from spans")
    worker.add_argument("--lens", choices=[*sorted(LENSES), "all"], required=True)
    source = worker.add_mutually_exclusive_group(required=True)
    source.add_argument("--csv")
    source.add_argument("--stream")
    worker.add_argument("--checkpoint")
    worker.add_argument("--out", required=True)
    worker.add_argument("--once", action="store_true")
    return parser.parse_args(argv)


def policy_of(path: str | None, strategy: str | None, threshold: float | None) -> pii.Policy:
    """The policy of a file or the default one, with one strategy for all types or another threshold if given."""
    own = pii.Policy.from_yaml(path) if path else pii.STRICT
    if strategy:
        own = dataclasses.replace(own, default_strategy=strategy, strategies={})
    return own if threshold is None else dataclasses.replace(own, score_threshold=threshold)


def deidentify(text: str, name: str, policy: pii.Policy, now: str) -> tuple[str, dict]:
    """The text without personal data, and its audit record."""
    found, at, parts, entries = pii.resolve(pii.detect_text(text, policy)), 0, [], []
    for entity, a, b, part, score, _ in found:
        strategy = policy.strategy(entity)
        parts += [text[at:a], pii.replacement(entity, part, strategy)]
        entries.append({"entity_type": entity, "strategy": strategy, "start": a, "end": b, "original_length": b - a, "score": score, "timestamp": now})
        at = b
    return "".join(parts) + text[at:], {"document_id": name, "entities_found": len(found), "entities_processed": len(entries), "timestamp": now, "entries": entries}


def _run_text(args: argparse.Namespace) -> int:
    try:
        with open(args.file, encoding="utf-8") as file:
            text = file.read()
    except OSError as error:
        print(f"cannot read {args.file}: {error.strerror}", file=sys.stderr)
        return 1
    done, record = deidentify(text, args.file.rpartition("/")[2], policy_of(args.policy, args.strategy, args.score_threshold), datetime.now(timezone.utc).isoformat())
    out = done if args.format == "text" else json.dumps({**record, "deidentified_text": done}, indent=2)
    if args.output:
        with open(args.output, "w", encoding="utf-8") as file:
            file.write(out)
    else:
        print(out)
    if args.audit:
        with open(args.audit, "a", encoding="utf-8") as file:
            file.write(json.dumps(record) + "\n")
    return 0


def _run_worker(args: argparse.Namespace) -> int:
    spark = SparkSession.builder.getOrCreate()
    lenses = sorted(LENSES) if args.lens == "all" else [args.lens]
    if args.csv:
        for lens in lenses:
            spans = read_spans_csv(spark, args.csv)
            write_csv(derive(spans, lens, static_pricing(spark) if lens == "cost" else None), f"{args.out.rstrip('/')}/{lens}")
        return 0
    if not args.checkpoint:
        print("--stream needs --checkpoint", file=sys.stderr)
        return 2
    workers = [Worker(lens, args.out, args.checkpoint, pricing=static_pricing if lens == "cost" else None) for lens in lenses]
    for q in start_all(read_stream(spark, args.stream), workers, once=args.once):
        q.awaitTermination()
    return 0


def main(argv: list[str] | None = None) -> int:
    args = _arguments(argv)
    return _run_text(args) if args.command == "deidentify" else _run_worker(args)


if __name__ == "__main__":
    sys.exit(main())
