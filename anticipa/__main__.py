"""Command line: refresh dashboards or sync the users table, under `spark-submit` or `python -m`.

The tables file is JSON, name to `{"path": ..., "format": ..., "options": {...}, "columns": {...}}`.
"""

import argparse
import json
import sys
from collections.abc import Sequence
from datetime import date, datetime, timezone
from pathlib import Path

from pyspark.sql import Observation, SparkSession

from . import operators as op
from . import sources
from .plans import JOBS, refresh, refresh_all
from .sources import Table

def _arguments(argv: Sequence[str] | None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="anticipa", description=__doc__)
    parser.add_argument("--tables", required=True, help="JSON file that says where the tables lie")
    commands = parser.add_subparsers(dest="command", required=True)
    run = commands.add_parser("refresh", help="run jobs and merge their results into the day's snapshot")
    run.add_argument("jobs", nargs="+", choices=["all", *sorted(JOBS)], metavar="job", help="job names, or all")
    run.add_argument("--dashboards", required=True, help="folder of the dashboard tables")
    run.add_argument("--as-of", type=date.fromisoformat, help="day of the snapshot, today (UTC) if left out")
    run.add_argument("--versioned", action="store_true", help="keep versions of each dashboard and switch the day in one step")
    run.add_argument("--preview", action="store_true", help="show some random rows that each job has read")
    run.add_argument("--strict", action="store_true", help="fail on the first row that breaks the input contract")
    run.add_argument("--rejects", help="also write the rows left out, as JSON with the reason, to this new folder")
    sync = commands.add_parser("sync", help="write a new copy of the users target that equals the source")
    sync.add_argument("--out", required=True, help="folder for the synced table; must not exist")
    sync.add_argument("--rejects", help="also write the ids left alone, as JSON with the reason, to this new folder")
    sync.add_argument("--dead-letters", help="new folder for the raw text of target rows that cannot be read")
    return parser.parse_args(argv)


def main(argv: Sequence[str] | None = None) -> dict[str, dict[str, int]]:
    args = _arguments(argv)
    spark = SparkSession.builder.appName("anticipa").getOrCreate()
    tables = {name: Table(**where) for name, where in json.loads(Path(args.tables).read_text()).items()}
    if args.command == "sync":
        # A row without a readable id could belong to any target row, so nothing may be deleted on its account.
        users = op.enforce_contract(sources.users(spark, tables["users"]), ("id",))
        target = sources.users_target(spark, tables["users_target"])
        if args.rejects:
            op.rejected_users(users, target).write.json(args.rejects)
        done = {"sync": op.apply_sync(users, target, args.out, args.dead_letters)}
        return done
    as_of = args.as_of or datetime.now(timezone.utc).date()
    inputs = sources.read_all(spark, tables)
    if "all" in args.jobs:
        left_out = args.rejects and f"{args.rejects}/all"
        return refresh_all(spark, inputs, args.dashboards, as_of, args.strict, args.versioned, left_out)
    done = {}
    for job in args.jobs:
        seen = Observation() if args.preview else None
        left_out = args.rejects and f"{args.rejects}/{job}"
        done[job] = refresh(spark, job, inputs, args.dashboards, as_of, args.strict, args.versioned, left_out, seen)
        if seen:
            print(f"{job}: some rows of its input", *op.preview_of(seen), sep="\n  ", file=sys.stderr)
    return done


if __name__ == "__main__":
    print(json.dumps(main()))
