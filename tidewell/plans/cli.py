"""Command line: python -m tidewell.plans.cli --mode full --stage full --report out.json"""

from __future__ import annotations

import argparse
import json
import sys
from collections.abc import Callable
from pathlib import Path

from tidewell.plans.contracts import Status
from tidewell.plans.logs import configure
from tidewell.plans.runner import MODES, STAGES, Runner, render
from tidewell.plans.settings import Settings

#: Exit codes by status.
EXIT_CODES = {Status.SUCCESS: 0, Status.SUCCESS_WITH_REJECTIONS: 0, Status.PARTIAL_SUCCESS: 2, Status.FAILED: 1}


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(description="Runs the sales pipeline: Bronze, Silver, Gold.")
    p.add_argument("--mode", choices=MODES, default="full")
    p.add_argument("--stage", choices=STAGES, default="full")
    p.add_argument("--log-level", choices=("DEBUG", "INFO", "WARNING", "ERROR", "CRITICAL"), default="INFO")
    p.add_argument("--recovery-snapshot", type=Path, help="JSON with snapshot_id and load_ids of the run to take up")
    p.add_argument("--source-snapshot-id")
    p.add_argument("--report", type=Path)
    p.add_argument("--report-format", choices=("json", "markdown"), default="json")
    return p


def _runner() -> Runner:
    from pyspark.sql import SparkSession

    return Runner(SparkSession.builder.appName("tidewell").getOrCreate(), Settings.from_environment())


def main(argv: list[str] | None = None, runner: Callable[[], Runner] = _runner) -> int:
    args = parser().parse_args(argv)
    configure(args.log_level)
    recovery = None
    if args.recovery_snapshot:
        try:
            recovery = json.loads(args.recovery_snapshot.read_text())
        except (OSError, ValueError) as error:
            print(f"recovery snapshot can't be read: {type(error).__name__}", file=sys.stderr)
            return EXIT_CODES[Status.FAILED]
    result = runner().run(args.mode, args.stage, args.source_snapshot_id, recovery)
    code = EXIT_CODES.get(result["status"], 1)
    if args.report:
        try:
            args.report.write_text(render(result, args.report_format))
        except OSError as error:
            print(f"report can't be written: {type(error).__name__}", file=sys.stderr)
            return code or EXIT_CODES[Status.PARTIAL_SUCCESS]
    return code


if __name__ == "__main__":
    sys.exit(main())
