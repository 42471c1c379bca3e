"""Run the batch from a shell: python -m keelstone --help"""

from __future__ import annotations

import argparse

from keelstone import Settings, get_session, run_all, scratch


def main(arguments: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="keelstone", description="Build the star schema.")
    for name in ("arrivals", "cities", "airports", "temperatures", "labels", "output"):
        parser.add_argument(f"--{name}", required=True)
    parser.add_argument("--arrivals-format", default="parquet")
    parser.add_argument("--arrivals-limit", type=int, help="read only the first N files")
    parser.add_argument("--arrivals-glob", help="read only files of the folder with such a name")
    parser.add_argument("--infer-types", action="store_true", help="infer types of delimited files")
    parser.add_argument("--match-state", action="store_true", help="match ports by city and state")
    parser.add_argument("--show-missing", action="store_true", help="profile missing values")
    settings = Settings(**vars(parser.parse_args(arguments)))
    spark = get_session()
    try:
        run = run_all(spark, settings)
        for name, counts in run.report.missing.items():
            print(f"Missing values in {name}:")
            counts.show(truncate=False)
        run.report.to_frame().show(truncate=False)
        run.report.cleaning_frame().show(truncate=False)
        run.arrivals_by_foreign_born(with_key=True).show(50)
    finally:
        scratch.release(spark)


if __name__ == "__main__":
    main()
