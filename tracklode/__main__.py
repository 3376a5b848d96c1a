"""``python -m tracklode QUERY TABLES OUT``: runs a registered query over a folder of tables and writes its rows as Parquet.

``python -m tracklode --list`` names the queries. Settings of the session come from the launcher (``spark-submit``).
"""

from __future__ import annotations

import argparse

from tracklode import queries


def main(argv: list[str] | None = None) -> int:
    found = queries.queries()
    args = argparse.ArgumentParser(prog="tracklode", description="Runs a registered query.")
    args.add_argument("query", nargs="?", choices=sorted(found), metavar="QUERY")
    args.add_argument("tables", nargs="?")
    args.add_argument("out", nargs="?")
    args.add_argument("--list", action="store_true")
    got = args.parse_args(argv)
    if got.list or not got.query:
        print("\n".join(sorted(found)))
        return 0
    if not got.tables or not got.out:
        args.error("TABLES and OUT are needed")
    from pyspark.sql import SparkSession

    spark = SparkSession.builder.appName(f"tracklode {got.query}").getOrCreate()
    found[got.query](spark, got.tables.rstrip("/")).write.mode("overwrite").parquet(got.out)
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
