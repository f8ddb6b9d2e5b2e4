"""Run the jobs from a shell: build, profile, ask, embed, nearest.

    python -m stallbook build --csv RAW --root SHOP
    python -m stallbook ask monthly_revenue --root SHOP

``build`` expects the published snapshot; ``--expect`` names a JSON file with
other numbers, as fields of ``retail.Expectations``.
"""

from __future__ import annotations

import argparse
import json
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from stallbook.operators.embedding import SAMPLE_SIZE
from stallbook.plans import embed_reviews, profile, questions, retail
from stallbook.session import SETTINGS
from stallbook.sources import tables

PREVIEW = 100     # rows printed


def _arguments(words: Sequence[str] | None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="stallbook")
    jobs = parser.add_subparsers(dest="job", required=True)

    def job(name: str, *options: str) -> argparse.ArgumentParser:
        sub = jobs.add_parser(name)
        for option in options:
            sub.add_argument(f"--{option}", required=True)
        return sub

    build = job("build", "csv", "root")
    build.add_argument("--expect")
    for sub in (build, job("profile", "csv")):
        sub.add_argument("--pattern", default="{table}.csv")
    ask = job("ask", "root")
    ask.add_argument("question", choices=sorted(questions.QUESTIONS))
    for sub in (ask, jobs.choices["profile"]):
        sub.add_argument("--out", help="a folder for all rows, as Parquet; what is printed is a preview")
    job("embed", "root", "vectors").add_argument("--limit", type=lambda word: None if word == "all" else int(word),
                                                 default=SAMPLE_SIZE)
    job("nearest", "root", "vectors").add_argument("seed_order")
    return parser.parse_args(words)


def _expectations(path: str | None) -> retail.Expectations:
    if path is None:
        return retail.Expectations()
    with open(path, encoding="utf-8") as file:
        return retail.Expectations(**json.load(file))


def _report(name: str, report: DataFrame, out: str | None) -> None:
    """Write every row where asked to, and print the first ones with how many there are."""
    if out:
        report.write.mode("overwrite").parquet(f"{out}/{name}")
        report = report.sparkSession.read.parquet(f"{out}/{name}")
    rows = report.count()
    report.show(PREVIEW, truncate=False)
    if rows > PREVIEW:
        print(f"{PREVIEW} of {rows} rows; " + (f"all are in {out}/{name}" if out else "--out writes all of them"))


def main(words: Sequence[str] | None = None) -> None:
    args = _arguments(words)
    builder = SparkSession.builder.appName(f"stallbook {args.job}")
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    if args.job == "build":
        retail.build_from_csv(spark, args.csv, args.root, _expectations(args.expect), args.pattern)
    elif args.job == "profile":
        for name, report in profile.profile(retail.land_once(spark, args.csv, args.pattern)).items():
            print(name)
            _report(name, report, args.out)
    else:
        typed = tables.read_published(spark, args.root, retail.TABLES)
        if args.job == "ask":
            _report(args.question, questions.QUESTIONS[args.question](typed), args.out)
        elif args.job == "embed":
            print(embed_reviews.embed_reviews(typed["order_reviews"], args.vectors, limit=args.limit))
        else:
            vectors = embed_reviews.read_vectors(spark, args.vectors)
            questions.nearest_reviews(typed["order_reviews"], vectors, args.seed_order).show(truncate=False)


if __name__ == "__main__":
    main()
