"""Command line: list the bound queries, run one over a folder of tables, or write the report of an observations table.

    python -m fieldspark.cli list
    python -m fieldspark.cli run a_04_weekly_counts /root/testdata/sf0.01 /tmp/out
    python -m fieldspark.cli report observations.parquet report.json
"""

from __future__ import annotations

import argparse
import sys

from fieldspark.plans import registry, report
from fieldspark.session import build_session
from fieldspark.sources.readers import read_table
from fieldspark.sources.sinks import write_json


def main(args: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="fieldspark")
    commands = parser.add_subparsers(dest="command", required=True)
    commands.add_parser("list", help="names of the bound queries")
    run = commands.add_parser("run", help="run a query and write its rows")
    run.add_argument("query", choices=sorted(registry.queries()))
    run.add_argument("tables")
    run.add_argument("output")
    run.add_argument("--format", choices=("parquet", "csv", "json"), default="parquet")
    summary = commands.add_parser("report", help="write the report of observations as JSON")
    summary.add_argument("observations")
    summary.add_argument("output")
    given = parser.parse_args(args)
    if given.command == "list":
        print(*sorted(registry.queries()), sep="\n")
        return 0
    spark = build_session("fieldspark")
    if given.command == "run":
        writer = registry.queries()[given.query](spark, given.tables).write.mode("overwrite").format(given.format)
        (writer.option("header", True) if given.format == "csv" else writer).save(given.output)
    else:
        write_json(given.output, report.build(read_table(spark, given.observations)))
    return 0


if __name__ == "__main__":
    sys.exit(main())
