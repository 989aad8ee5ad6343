"""Commands to submit: the first load, a daily load, a pipeline run, the contract checks.

    spark-submit tallyhouse/jobs.py bootstrap WAREHOUSE FOLDER
    spark-submit tallyhouse/jobs.py load-daily WAREHOUSE ORDERS_CSV PAYMENTS_CSV
    spark-submit tallyhouse/jobs.py run WAREHOUSE
    spark-submit tallyhouse/jobs.py checks WAREHOUSE [--file CONTRACTS_SQL]

``run`` takes its window from --window-days, else from the environment's WINDOW_DAYS, else 7. The exit status is 0 if all went
well and 1 if a contract, the quality gate or a key check failed; any other error ends the command as it is.
"""

from __future__ import annotations

import argparse
import os
import sys
from collections.abc import Sequence
from datetime import date

if __name__ == "__main__":
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession  # noqa: E402

from tallyhouse.operators.contracts import ContractsFailed  # noqa: E402
from tallyhouse.operators.keys import KeyViolation  # noqa: E402
from tallyhouse.operators.quality import QualityGateBreached  # noqa: E402
from tallyhouse.plans.loads import bootstrap, load_daily  # noqa: E402
from tallyhouse.plans.pipeline import Settings, check_warehouse, run_pipeline  # noqa: E402
from tallyhouse.plans.runs import RunOvertaken  # noqa: E402
from tallyhouse.sources.warehouse import Warehouse  # noqa: E402


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="tallyhouse", description=__doc__, formatter_class=argparse.RawDescriptionHelpFormatter)
    commands = top.add_subparsers(dest="command", required=True)

    def command(name: str, *paths: str) -> argparse.ArgumentParser:
        added = commands.add_parser(name)
        for path in ("warehouse", *paths):
            added.add_argument(path)
        return added

    for added in (command("bootstrap", "folder"), command("load-daily", "orders_csv", "payments_csv")):
        added.add_argument("--set-aside", action="store_true", help="keep lines that do not parse in a table of their own")
        added.add_argument("--single-line", action="store_true", help="no line breaks in cells, so that large files are split")
    run = command("run")
    run.add_argument("--window-days", type=int, default=int(os.environ.get("WINDOW_DAYS", "7")))
    run.add_argument("--as-of", type=date.fromisoformat, default=None)
    run.add_argument("--max-errors", type=int, default=Settings.max_errors)
    run.add_argument("--on-duplicate", choices=["drop_all", "keep_first"], default=Settings.on_duplicate)
    command("checks").add_argument("--file", default=None, help="Spark SQL statements to run in place of the library's checks")
    return top


def show(results: Sequence[tuple[str, str, int]]) -> None:
    for name, status, rows in results:
        print(f"{status}  {name}  {rows}")


def main(arguments: Sequence[str] | None = None, spark: SparkSession | None = None) -> int:
    asked = parser().parse_args(arguments)
    spark = spark or SparkSession.builder.appName(f"tallyhouse {asked.command}").getOrCreate()
    warehouse = Warehouse(spark, asked.warehouse)
    try:
        if asked.command == "bootstrap":
            print("loaded:", ", ".join(bootstrap(warehouse, asked.folder, multiline=not asked.single_line, set_aside=asked.set_aside)) or "nothing")
        elif asked.command == "load-daily":
            load_daily(warehouse, asked.orders_csv, asked.payments_csv, multiline=not asked.single_line, set_aside=asked.set_aside)
        elif asked.command == "run":
            settings = Settings(window_days=asked.window_days, max_errors=asked.max_errors, on_duplicate=asked.on_duplicate)
            print("run:", run_pipeline(warehouse, asked.as_of, settings))
        else:
            show(check_warehouse(warehouse, asked.file))
    except ContractsFailed as failed:
        show(failed.results)
        return 1
    except (QualityGateBreached, KeyViolation, RunOvertaken) as failed:
        print(failed)
        return 1
    return 0


if __name__ == "__main__":
    sys.exit(main())
