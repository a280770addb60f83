"""Command line of the jobs, for spark-submit.

    python -m facetrank load      --input DIR --database NAME
    python -m facetrank rank      --database NAME
    python -m facetrank report    --input DIR --output DIR
    python -m facetrank countries --responses FILE --output DIR

``load`` replaces the five input tables, ``rank`` the three result tables;
``report`` goes from text to text. ``countries`` adds to the countries that ``load``
and ``report`` read, from landed responses (JSON lines with titleId and body): titles
that are not there yet, once each. Its outputs (countries, values, single values, and
``rejects``: bodies that are no JSON object and values that would tear a line, as JSON
lines) become valid together when a run is complete; a run that died is started over
when it is given again, and one that is complete adds nothing. A run is named by its
input files, or by ``--run``.
"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import functions as F

from facetrank import plans
from facetrank.operators import new_rows, one_row_per_key
from facetrank.session import build_session
from facetrank.sinks import (
    commit_run,
    committed_runs,
    input_fingerprint,
    is_writable,
    part_paths,
    run_path,
    write_delimited,
)
from facetrank.sinks.tables import hadoop_path
from facetrank.sources import (
    countries_from_responses,
    country_values,
    load_titles,
    open_titles,
    read_delimited,
    read_titles,
)

RULES = {"staged": plans.STAGED, "exact": plans.EXACT}

# The names of the published files.
FILES = {
    "basics": "title.basics.tsv",
    "ratings": "title.ratings.tsv",
    "crew": "title.crew.tsv",
    "names": "name.basics.tsv",
    "countries": "title.country.tsv",
}


def input_paths(spark, folder: str) -> tuple[dict[str, str | list[str]], bool]:
    """Paths of the inputs, and whether the countries come from complete runs alone.

    Runs hold a title once; a country file from elsewhere may repeat titles.
    """
    paths = {name: f"{folder.rstrip('/')}/{file}" for name, file in FILES.items()}
    runs = part_paths(spark, folder, "countries")
    file, files = hadoop_path(spark, paths["countries"])
    if not runs:
        return paths, False
    alone = not files.exists(file)
    return paths | {"countries": runs if alone else [paths["countries"], *runs]}, alone


def read_inputs(spark, args):
    paths, distinct = input_paths(spark, args.input)
    tables = read_titles(spark, paths, {"countries": args.country_header}, quoted=args.quoted)
    if distinct:
        return tables
    return tables._replace(
        countries=one_row_per_key(tables.countries, ["titleId"], [F.col("country").asc_nulls_last()])
    )


def load(spark, args) -> None:
    load_titles(read_inputs(spark, args), args.database, buckets=args.buckets)


def rank(spark, args) -> None:
    plans.store_rankings(open_titles(spark, args.database), args.database, rules=RULES[args.rules])


def report(spark, args) -> None:
    ranked = plans.top_genres_with_directors(read_inputs(spark, args), RULES[args.rules])
    write_delimited(ranked.orderBy("country", F.desc("weightedAveRating"), "genre"), args.output)


def stored_texts(spark, root: str, part: str, schema: str):
    """Rows of a text part of all complete runs."""
    names = spark.createDataFrame([], schema).schema
    paths = part_paths(spark, root, part)
    if not paths:
        return spark.createDataFrame([], names)
    return read_delimited(spark, paths, names, header=False)


def countries(spark, args) -> None:
    root = args.output.rstrip("/")
    run = args.run or input_fingerprint(spark, [args.responses])
    if run in committed_runs(spark, root):
        print(f"run {run} is complete already")
        return
    responses = spark.read.schema("titleId string, body string").json(args.responses)
    rows = countries_from_responses(responses).drop("country")
    whole = is_writable(rows.select("titleId", "countryText"))
    rows = rows.withColumn("rejected", F.col("rejected") | ~whole)
    # One pass over the bodies; the outputs come from what it stored.
    held = run_path(root, run, "rows")
    rows.write.mode("overwrite").partitionBy("rejected").parquet(held)
    stored = spark.read.schema(rows.schema).parquet(held)
    kind = "titleId string, countryText string"
    good = stored.where("not rejected").select("titleId", "countryText")
    once = one_row_per_key(good, ["titleId"], [F.col("countryText").asc_nulls_last()])
    fresh = new_rows(once, stored_texts(spark, root, "countries", kind), ["titleId"])
    own = run_path(root, run, "countries")
    write_delimited(fresh, own, mode="overwrite")
    bad = stored.where("rejected").select("titleId", "countryText", "body")
    bad.write.mode("overwrite").json(run_path(root, run, "rejects"))
    # What this run adds to the values of the runs before.
    added = read_delimited(spark, own, spark.createDataFrame([], kind).schema, header=False)
    for part, exploded in (("values", False), ("single_values", True)):
        values = country_values(added, exploded=exploded)
        known = stored_texts(spark, root, part, "country string")
        write_delimited(new_rows(values, known, ["country"]), run_path(root, run, part), mode="overwrite")
    commit_run(spark, root, run)
    print(f"run {run}, rejected: {bad.count()}")


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="facetrank")
    jobs = parser.add_subparsers(dest="job", required=True)

    def add(name: str, run, *, reads: bool = False, ranks: str | None = None):
        job = jobs.add_parser(name)
        job.set_defaults(run_job=run)
        if reads:
            job.add_argument("--input", required=True)
            job.add_argument("--quoted", action="store_true")
            job.add_argument("--country-header", action="store_true")
        if ranks:
            job.add_argument("--rules", choices=sorted(RULES), default=ranks)
        return job

    job = add("load", load, reads=True)
    job.add_argument("--database", required=True)
    job.add_argument("--buckets", type=int)
    job = add("rank", rank, ranks="staged")
    job.add_argument("--database", required=True)
    job = add("report", report, reads=True, ranks="exact")
    job.add_argument("--output", required=True)
    job = add("countries", countries)
    job.add_argument("--responses", required=True)
    job.add_argument("--output", required=True)
    job.add_argument("--run", help="name of the run; by default its input files name it")
    args = parser.parse_args(argv)
    args.run_job(build_session(), args)


if __name__ == "__main__":
    main(sys.argv[1:])
