"""Runs queries by name: python -m annoforge list, or python -m annoforge run NAME TABLES OUTPUT [--format csv|json|parquet]."""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import SparkSession

from annoforge.plans import catalog


def main(arguments: list[str] | None = None) -> int:
    """0 if all went well, 2 for a name that is no query or an output that is there already."""
    parser = argparse.ArgumentParser(prog="annoforge")
    commands = parser.add_subparsers(dest="command", required=True)
    commands.add_parser("list", help="names of all queries")
    sql = commands.add_parser("sql", help="a query as SQL")
    run = commands.add_parser("run", help="write a query's rows")
    for command in (sql, run):
        command.add_argument("name")
    run.add_argument("tables", help="folder of the input tables")
    run.add_argument("output", help="folder to write; it must not be there")
    run.add_argument("--format", choices=("csv", "json", "parquet"), default="parquet")
    chosen = parser.parse_args(arguments)
    if chosen.command == "list":
        print("\n".join(sorted(catalog.QUERIES)))
        return 0
    if chosen.name not in catalog.QUERIES:
        print(f"no query {chosen.name}", file=sys.stderr)
        return 2
    if chosen.command == "sql":
        print(catalog.ORACLES[chosen.name])
        return 0
    spark = SparkSession.builder.config("spark.sql.session.timeZone", "UTC").getOrCreate()
    writer = catalog.QUERIES[chosen.name](spark, chosen.tables).write.mode("errorifexists")
    try:
        (writer.option("header", True) if chosen.format == "csv" else writer).format(chosen.format).save(chosen.output)
    except Exception as bad:
        if "PATH_ALREADY_EXISTS" not in str(bad):
            raise
        print(f"{chosen.output} is there already", file=sys.stderr)
        return 2
    return 0


if __name__ == "__main__":
    sys.exit(main())
