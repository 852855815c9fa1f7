"""Command line of the job: ``spark-submit ... -m resultlake`` or ``python -m resultlake``."""

from __future__ import annotations

import argparse
import json

from pyspark.sql import SparkSession

from resultlake.plans.job import run_job
from resultlake.session import clear_stage


def arguments(argv: list[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="resultlake", description="Captured result pages to CSV tables.")
    parser.add_argument("--keywords-file", required=True, help="text file, one keyword per line")
    parser.add_argument("--captures", required=True, help="Parquet table of captured result pages")
    parser.add_argument("--articles", help="Parquet table of captured article pages")
    parser.add_argument("--platforms", nargs="*", default=[], help="platforms to read; all if none is named")
    parser.add_argument("--output-dir", help="folder of the three CSV files")
    parser.add_argument("--base-dir", help="folder a relative keyword file belongs to")
    parser.add_argument("--max-rows", type=int, help="rows per keyword and surface")
    parser.add_argument("--on-bad-card", choices=["page", "card"], default="page")
    parser.add_argument("--single-file", action="store_true", help="one file per table instead of ordered parts")
    parser.add_argument("--sort-order", help="sort order of the search requests")
    parser.add_argument("--rejected-to", help="folder for the pages that could not be read")
    parser.add_argument("--missing-to", help="folder for the requests no page answers")
    return parser.parse_args(argv)


def main(argv: list[str] | None = None) -> None:
    options = arguments(argv)
    spark = SparkSession.builder.appName("resultlake").getOrCreate()
    try:
        run = run_job(
            spark,
            options.keywords_file,
            options.captures,
            options.articles,
            options.platforms,
            options.output_dir,
            options.max_rows,
            options.on_bad_card,
            options.base_dir,
            single_file=options.single_file,
            sort_order=options.sort_order,
        )
        print(json.dumps(run.summary.first().asDict(), ensure_ascii=False))
        for found, path in ((run.rejected, options.rejected_to), (run.missing, options.missing_to)):
            if path:
                found.write.mode("overwrite").parquet(path)
    finally:
        clear_stage(spark)


if __name__ == "__main__":
    main()
