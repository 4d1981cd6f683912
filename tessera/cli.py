"""Command line: demo, run, report."""

from __future__ import annotations

import argparse
import shutil
import sys
from datetime import datetime
from pathlib import Path

from pyspark.sql import functions as F

from tessera.plans.enrich import ModelProvider
from tessera.plans.model_client import ModelClient
from tessera.plans.profile import load_profile
from tessera.plans.report import build_report
from tessera.plans.run import run
from tessera.plans.store import Store
from tessera.session import local_session
from tessera.sources.live import live_payloads, load_settings
from tessera.sources.payloads import read_boards, read_payloads

DEMO_DAYS = ((1, datetime(2026, 9, 29, 12)), (2, datetime(2026, 9, 30, 12)))


def _run(args, samples: str | None, boards: str | None, now: datetime | None) -> None:
    spark = local_session()
    output = Path(args.output)
    root = args.db or str(output / "store")
    if samples:
        payloads, mode = read_payloads(spark, samples, read_boards(spark, boards) if boards else {}), "samples"
    else:
        next_run = (Store(spark, root).read("runs").agg(F.max("run_id")).first()[0] or 0) + 1
        payloads, landed = live_payloads(spark, load_settings(args.config), str(output / "raw" / f"run-{next_run}"))
        mode = "live"
        for source, key, why in landed.errors:
            print(f"{source} {key}: {why}", file=sys.stderr)
    profile = load_profile(args.profile) if args.profile else None
    model = ModelProvider(ModelClient(args.model_url, args.model), args.model) if args.model_url else None
    done = run(spark, payloads, root, profile, now, mode, args.ai if profile else "off", model, limit=args.enrich_limit)
    (output / f"report-run-{done.run_id}.md").write_text(done.report, encoding="utf-8")
    print(done.report)


def _demo(args) -> int:
    output = Path(args.output)
    shutil.rmtree(output, ignore_errors=True)
    output.mkdir(parents=True)
    for day, now in DEMO_DAYS:
        _run(args, f"{args.samples}/day{day}", f"{args.samples}/boards.toml", now)
    return 0


def _run_once(args) -> int:
    Path(args.output).mkdir(parents=True, exist_ok=True)
    boards = Path(args.samples).parent / "boards.toml" if args.samples else None
    _run(args, args.samples, str(boards) if boards and boards.exists() else None, None)
    return 0


def _report(args) -> int:
    spark = local_session()
    store = Store(spark, args.db)
    run_id = args.run or store.read("runs").agg(F.max("run_id")).first()[0]
    if not run_id:
        print("No runs yet.")
        return 1
    print(build_report(store, run_id))
    return 0


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="tessera")
    commands = parser.add_subparsers(required=True)

    def command(name, action):
        sub = commands.add_parser(name)
        sub.set_defaults(action=action)
        return sub

    for name, action in (("demo", _demo), ("run", _run_once)):
        sub = command(name, action)
        sub.add_argument("--output", default="output")
        sub.add_argument("--db")
        sub.add_argument("--profile")
        sub.add_argument("--ai", choices=("off", "simulated", "model", "auto"))
        sub.add_argument("--model-url", help="address of a language model; its key is in TESSERA_MODEL_KEY")
        sub.add_argument("--model", default="default")
        sub.add_argument("--enrich-limit", type=int)
        if name == "demo":
            sub.add_argument("--samples", required=True, help="folder with day1, day2 and boards.toml")
        else:
            which = sub.add_mutually_exclusive_group(required=True)
            which.add_argument("--live", action="store_true")
            which.add_argument("--samples")
            sub.add_argument("--config", default="live.toml")
    sub = command("report", _report)
    sub.add_argument("--db", required=True)
    sub.add_argument("--run", type=int)
    args = parser.parse_args(argv)
    return args.action(args)


if __name__ == "__main__":
    sys.exit(main())
