"""Command line: ``python -m strata <job> ...`` (also works under spark-submit).

    pipeline  --input CSV --output-dir DIR --ref-state-codes CSV [--run-id ID]
              [--types COL=TYPE,...] [--null-value NA] [--safe-cast]
    bronze    --input CSV | --topic-dir DIR | --bootstrap-servers S --topic T  --output-dir DIR
              [--run-id ID] [--types COL=TYPE,...] [--null-value NA] [--quarantine DIR]
    silver    --bronze DIR --output-dir DIR [--run-id ID] [--safe-cast]
    gold      --silver DIR --output-dir DIR --ref-state-codes CSV [--run-id ID]
    publish   --input CSV --topic-dir DIR | --bootstrap-servers S --topic T [--max-records N]
              [--null-value NA]
    consume   --topic-dir DIR | --bootstrap-servers S --topic T --output-dir DIR
              --ref-state-codes CSV [--incremental --checkpoint DIR] [--schema-from CSV]
              [--null-value NA] [--safe-cast] [--max-per-batch N] [--quarantine DIR]
              [--state-partitions N]

With ``--types`` the CSV is read once, as text, and the named columns are cast.
Each job prints its result (layer paths and row counts) as one JSON line.
The session is whatever ``spark-submit`` or the environment provides.
"""

from __future__ import annotations

import argparse
import json
import sys

from strata.plans.jobs import (run_bronze, run_bronze_messages, run_gold, run_message_path, run_pipeline,
                               run_silver)
from strata.session import get_session
from strata.sources.files import read_csv
from strata.sources.messages import FileTopic, KafkaTopic, publish_csv
from strata.streaming.layers import GOLD_STATE_PARTITIONS


def _topic(args):
    if args.topic_dir:
        return FileTopic(args.topic_dir)
    if not (args.bootstrap_servers and args.topic):
        raise SystemExit("give --topic-dir, or --bootstrap-servers and --topic")
    return KafkaTopic(args.bootstrap_servers, args.topic)


def _types(text: str | None) -> dict[str, str] | None:
    return dict(pair.split("=", 1) for pair in text.split(",")) if text else None


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="strata")
    sub = parser.add_subparsers(dest="job", required=True)
    p = sub.add_parser("pipeline")
    p.add_argument("--input", required=True)
    p.add_argument("--output-dir", required=True)
    p.add_argument("--ref-state-codes", required=True)
    p.add_argument("--run-id")
    p.add_argument("--null-value", help="missing-value token in the CSV, e.g. NA")
    p.add_argument("--safe-cast", action="store_true",
                   help="out-of-range measures become NULL instead of failing the run")
    p.add_argument("--types", help="column types, COL=TYPE,...; the CSV is then read once")
    p.add_argument("--audited", action="store_true",
                   help="publish each layer as a version, only if its audit holds")
    for name, needs in (("bronze", ()), ("silver", ("--bronze",)), ("gold", ("--silver", "--ref-state-codes"))):
        q = sub.add_parser(name)
        for flag in (*needs, "--output-dir"):
            q.add_argument(flag, required=True)
        q.add_argument("--run-id")
    q = sub.choices["bronze"]
    q.add_argument("--input")
    q.add_argument("--types")
    q.add_argument("--null-value")
    q.add_argument("--quarantine")
    sub.choices["silver"].add_argument("--safe-cast", action="store_true")
    for name in ("publish", "consume"):
        sub.add_parser(name)
    for name in ("bronze", "publish", "consume"):
        q = sub.choices[name]
        q.add_argument("--topic-dir")
        q.add_argument("--bootstrap-servers")
        q.add_argument("--topic")
    sub.choices["publish"].add_argument("--input", required=True)
    sub.choices["publish"].add_argument("--max-records", type=int)
    sub.choices["publish"].add_argument("--null-value", help="missing-value token in the CSV")
    c = sub.choices["consume"]
    c.add_argument("--output-dir", required=True)
    c.add_argument("--ref-state-codes", required=True)
    c.add_argument("--run-id")
    c.add_argument("--incremental", action="store_true")
    c.add_argument("--checkpoint")
    c.add_argument("--schema-from", help="CSV whose inferred schema decodes the messages "
                                         "(default: inferred from the messages)")
    c.add_argument("--null-value", help="missing-value token in the --schema-from CSV")
    c.add_argument("--safe-cast", action="store_true",
                   help="out-of-range measures become NULL instead of failing the run")
    c.add_argument("--max-per-batch", type=int,
                   help="bound each incremental micro-batch (offsets or files)")
    c.add_argument("--quarantine", help="folder for malformed messages, which else stop the run")
    c.add_argument("--state-partitions", type=int, default=GOLD_STATE_PARTITIONS,
                   help="partitions of Gold's streaming state, fixed at the first incremental run")
    args = parser.parse_args(argv)
    if args.job == "consume" and args.incremental != bool(args.checkpoint):
        parser.error("--incremental and --checkpoint go together")

    spark = get_session("strata-" + args.job)
    if args.job == "pipeline":
        types = _types(args.types)
        layers = run_pipeline(spark, args.input, args.output_dir, args.ref_state_codes, args.run_id,
                              null_value=args.null_value, safe_cast=args.safe_cast, infer=types is None,
                              types=types, audited=args.audited)
        out = {k: {"path": v.path, "rows": v.rows} for k, v in layers.items()}
    elif args.job in ("bronze", "silver", "gold"):
        if args.job == "silver":
            layer = run_silver(spark, args.bronze, args.output_dir, run_id=args.run_id, safe_cast=args.safe_cast)
        elif args.job == "gold":
            layer = run_gold(spark, args.silver, args.output_dir, args.ref_state_codes, run_id=args.run_id)
        elif args.input:
            types = _types(args.types)
            layer = run_bronze(spark, args.input, args.output_dir, args.run_id, types is None, types, args.null_value)
        else:
            layer = run_bronze_messages(spark, _topic(args), args.output_dir, run_id=args.run_id,
                                        quarantine_path=args.quarantine)
        out = {args.job: {"path": layer.path, "rows": layer.rows}}
    elif args.job == "publish":
        out = publish_csv(spark, args.input, _topic(args), max_records=args.max_records,
                          null_value=args.null_value)
    else:
        schema = read_csv(spark, args.schema_from, null_value=args.null_value).schema \
            if args.schema_from else None
        layers = run_message_path(spark, _topic(args), args.output_dir, args.ref_state_codes,
                                  schema=schema, incremental=args.incremental,
                                  checkpoint=args.checkpoint, run_id=args.run_id,
                                  safe_cast=args.safe_cast, max_per_batch=args.max_per_batch,
                                  quarantine_path=args.quarantine, state_partitions=args.state_partitions)
        out = {k: {"path": v.path, "rows": v.rows} for k, v in layers.items()}
    print(json.dumps(out))
    return 0


if __name__ == "__main__":
    sys.exit(main())
