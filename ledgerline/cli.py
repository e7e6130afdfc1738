"""Command-line job runner: each stage as its own Spark job, result dict as JSON.

The stages can run in separate processes (a scheduler task each): all state is in the
storage root and the ledger, none in the process.

    python -m ledgerline.cli extract  --root R --run-id ID --source-path P [--source-format parquet]
    python -m ledgerline.cli validate --root R --run-id ID
    python -m ledgerline.cli load     --root R --run-id ID
    python -m ledgerline.cli report   --root R --run-id ID
    python -m ledgerline.cli finalize --root R --run-id ID [--dlq-count N]
    python -m ledgerline.cli pipeline --root R --run-id ID --source-path P
    python -m ledgerline.cli smoke    --root R --source-path P [--limit 1000]
    python -m ledgerline.cli compact  --root R

Source options for JDBC and other formats: ``--source-format jdbc --option url=... --option
dbtable=...``. ``--now`` fixes the run time (ISO text); default is the current UTC time.
"""

from __future__ import annotations

import argparse
import datetime as _dt
import json
import sys

from pyspark.sql import SparkSession

from .plans.pipeline import LedgerPipeline, PipelineConfig
from .sources.tables import read_source


def _parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="ledgerline")
    p.add_argument("stage", choices=["extract", "validate", "load", "report", "finalize", "pipeline", "smoke", "compact"])
    p.add_argument("--root", required=True, help="storage root in the shared filesystem")
    p.add_argument("--run-id")
    p.add_argument("--source-path")
    p.add_argument("--source-format", default="parquet")
    p.add_argument("--option", action="append", default=[], help="source option key=value (repeatable)")
    p.add_argument("--chunk-size", type=int, default=5000)
    p.add_argument("--overlap-minutes", type=float, default=5)
    p.add_argument("--range-width", type=int, help="keys per partition of the table; default: as stored, else the usual one")
    p.add_argument("--on-malformed", choices=["stop", "dead_letter"], default="stop")
    p.add_argument("--on-duplicate", choices=["latest", "fail"], default="latest")
    p.add_argument("--guard", help="column: a change older in it than the stored row is skipped")
    p.add_argument("--limit", type=int, default=1000)
    p.add_argument("--dlq-count", type=int, default=0)
    p.add_argument("--now", help="run time, ISO text; default now (UTC)")
    return p


def _jsonable(v):
    if isinstance(v, _dt.datetime):
        return v.isoformat()
    if isinstance(v, list):
        return [_jsonable(x) for x in v]
    if isinstance(v, dict):
        return {k: _jsonable(x) for k, x in v.items()}
    return v


def run(argv: list[str], spark: SparkSession | None = None) -> dict:
    args = _parser().parse_args(argv)
    spark = spark or (
        SparkSession.builder.appName(f"ledgerline-{args.stage}").config("spark.ui.enabled", "false").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    )
    now = _dt.datetime.fromisoformat(args.now) if args.now else _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None)
    config = PipelineConfig(chunk_size=args.chunk_size, overlap_minutes=args.overlap_minutes, range_width=args.range_width,
                            on_malformed=args.on_malformed,
                            on_duplicate=args.on_duplicate, guard=args.guard)
    pipe = LedgerPipeline(spark, args.root, config)
    options = dict(o.split("=", 1) for o in args.option)

    def source():
        if not args.source_path and args.source_format != "jdbc":
            raise SystemExit("--source-path is needed for this stage")
        return read_source(spark, args.source_format, args.source_path, **options)

    if args.stage == "compact":
        return {"ledger_seq": pipe.ledger.compact()}
    if args.stage == "smoke":
        return pipe.run_smoke_transfer(source(), now, args.limit)
    if not args.run_id:
        raise SystemExit("--run-id is needed for this stage")
    if args.stage == "extract":
        return pipe.run_extraction(args.run_id, source(), now)
    if args.stage == "validate":
        return pipe.run_validation(args.run_id, now)
    if args.stage == "load":
        return pipe.run_load(args.run_id, now)
    if args.stage == "report":
        return pipe.run_metrics([args.run_id]).first().asDict()
    if args.stage == "finalize":
        return pipe.run_finalize(args.run_id, now, {"dlq_count": args.dlq_count})
    return pipe.run_pipeline(args.run_id, source(), now)


def main() -> None:
    print(json.dumps(_jsonable(run(sys.argv[1:]))))


if __name__ == "__main__":
    main()
