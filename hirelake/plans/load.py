"""The batch load: raw adverts to the clean table, the star schema and the daily snapshot.

    spark-submit hirelake/plans/load.py --raw /data/raw_jobs --root /data/warehouse --gazetteer /data/cities
"""

from __future__ import annotations

import argparse
import datetime as dt
import json
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hirelake import schemas
from hirelake.functions.dates import UNKNOWN_DATE
from hirelake.functions.keys import WHOLE_KEYS, KeyLengths
from hirelake.operators import dims, enrich, facts, keyed, landing, text_ml
from hirelake.operators.writing import reload_table, write_merged
from hirelake.session import build_session, path_exists


def load_batch(
    spark: SparkSession,
    raw: DataFrame,
    root: str,
    as_of: dt.date | str,
    gazetteer: DataFrame | None = None,
    rules: Sequence[tuple[str, str]] = enrich.TITLE_RULES,
    tools: Sequence[str] = enrich.DEFAULT_TOOLS,
    lengths: KeyLengths = WHOLE_KEYS,
    role_model=None,
) -> None:
    """Load one batch. Running it again, after a failure or not, gives the same tables.

    Without a gazetteer no city is found, only countries by their codes. A fitted classifier may name
    the roles instead of the rules. The tables of the session's catalog show the loaded rows afterwards.
    """
    path = {table.name: schemas.table_path(root, table) for table in schemas.TABLES}

    def read(table: schemas.Table) -> DataFrame:
        return spark.read.parquet(path[table.name])

    def upsert(table: schemas.Table, rows: DataFrame, partition: str | None = None) -> None:
        write_merged(spark, path[table.name], rows, lambda old, new: keyed.upsert(old, new, table.key), partition)

    def merge_dimension(table: schemas.Table, rows: DataFrame) -> None:
        write_merged(spark, path[table.name], rows, lambda old, new: dims.merged_dimension(old, new, table.key[0]))

    enrich.clean_postings(raw, gazetteer, rules, tools, lengths, role_model).write.mode("overwrite").parquet(
        path[schemas.CLEAN_JOBS.name]
    )
    clean = read(schemas.CLEAN_JOBS)
    merge_dimension(schemas.ROLE_DIM, dims.role_dim(clean))
    merge_dimension(schemas.EMPLOYMENT_TYPE_DIM, dims.employment_type_dim(clean))
    merge_dimension(schemas.COMPANY_DIM, dims.company_dim(clean))
    merge_dimension(schemas.LOCATION_DIM, dims.location_dim(clean))

    candidates = facts.fact_candidates(
        clean,
        read(schemas.ROLE_DIM),
        read(schemas.COMPANY_DIM),
        read(schemas.EMPLOYMENT_TYPE_DIM),
        read(schemas.LOCATION_DIM),
    )
    month = F.date_format("date_posted_fk", "yyyy-MM")
    upsert(schemas.FACT, facts.fact_rows(candidates).withColumn("posted_month", month), "posted_month")
    upsert(schemas.DAILY_SNAPSHOT, facts.daily_snapshot(read(schemas.FACT), as_of))
    schemas.refresh_tables(spark, root)


def load_landing(
    spark: SparkSession, pages: DataFrame, root: str, fetched_at: Column, source: str, **elements
) -> None:
    """Empty the landing tables and load the raw one from pages (page_id, url, html)."""
    rows = landing.raw_jobs(pages, fetched_at, source, **elements)
    reload_table(spark, rows, schemas.table_path(root, schemas.RAW_JOBS), "id")
    spark.createDataFrame([], schemas.CLEAN_JOBS.schema).write.mode("overwrite").parquet(
        schemas.table_path(root, schemas.CLEAN_JOBS)
    )
    schemas.refresh_tables(spark, root)


def load_calendar(spark: SparkSession, root: str, first: str | None = None, last: str | None = None) -> None:
    """Write the calendar dimension: between two days, or else over the days of the stored facts.

    The day that stands for unreadable dates doesn't stretch it. Without facts it is the default range.
    """
    path, facts_path = (schemas.table_path(root, t) for t in (schemas.DATE_DIM, schemas.FACT))
    if path_exists(spark, facts_path) and not (first and last):
        days = spark.read.parquet(facts_path).where(F.col("date_posted_fk") != F.lit(UNKNOWN_DATE).cast("date"))
        bounds = days.agg(F.min("date_posted_fk"), F.max("date_posted_fk")).first()
        first, last = first or (bounds[0] and str(bounds[0])), last or (bounds[1] and str(bounds[1]))
    calendar = dims.date_dim(spark, first or schemas.CALENDAR_START, last or schemas.CALENDAR_END)
    calendar.write.mode("overwrite").parquet(path)
    schemas.refresh_tables(spark, root)


def role_model(spark: SparkSession, path: str, examples: str | None = None) -> text_ml.NaiveBayes:
    """The stored title classifier at ``path``; with ``examples`` it is learnt from them and stored first."""
    if examples:
        text_ml.fit_naive_bayes(spark.read.parquet(examples), "title", "role").save(path)
    return text_ml.NaiveBayes.load(spark, path)


def main() -> None:
    parser = argparse.ArgumentParser(description=__doc__.splitlines()[0])
    given = parser.add_mutually_exclusive_group(required=True)
    given.add_argument("--raw", help="folder of the raw adverts (Parquet)")
    given.add_argument("--pages", help="folder of stored pages: page_id, url, html (Parquet)")
    parser.add_argument("--source", default="pages", help="name of the source of the pages")
    parser.add_argument("--fetched-at", default=None, help="when the pages were fetched, by default now")
    parser.add_argument("--root", required=True, help="folder of the warehouse")
    parser.add_argument("--as-of", default=None, help="day of the snapshot, by default today")
    parser.add_argument("--gazetteer", required=True, help="table of country, city and perhaps rank (Parquet), or 'none'")
    parser.add_argument("--tools", default=None, help="file with one tool name per line")
    parser.add_argument("--rules", default=None, help="JSON file with a list of [pattern, role]")
    parser.add_argument("--role-model", default=None, help="folder of a stored title classifier, instead of rules")
    parser.add_argument("--learn-roles", default=None, help="table of title and role (Parquet) to learn the role model from first")
    parser.add_argument("--calendar-from", default=None, help="first day of the calendar, by default of the facts")
    parser.add_argument("--calendar-to", default=None, help="last day of the calendar, by default of the facts")
    args = parser.parse_args()
    spark = build_session("hirelake-load")
    schemas.create_tables(spark, args.root)
    if args.pages:
        now = args.fetched_at or dt.datetime.now(dt.UTC).strftime("%Y-%m-%d %H:%M:%S")
        load_landing(spark, spark.read.parquet(args.pages), args.root, F.lit(now).cast("timestamp_ntz"), args.source)
    raw = spark.read.parquet(args.raw or schemas.table_path(args.root, schemas.RAW_JOBS))
    gazetteer = None if args.gazetteer == "none" else spark.read.parquet(args.gazetteer)
    options = {}
    if args.tools:
        with open(args.tools, encoding="utf-8") as lines:
            options["tools"] = [line.strip() for line in lines if line.strip()]
    if args.rules:
        with open(args.rules, encoding="utf-8") as rules:
            options["rules"] = [tuple(rule) for rule in json.load(rules)]
    if args.role_model:
        options["role_model"] = role_model(spark, args.role_model, args.learn_roles)
    load_batch(spark, raw, args.root, args.as_of or dt.date.today(), gazetteer, **options)
    load_calendar(spark, args.root, args.calendar_from, args.calendar_to)


if __name__ == "__main__":
    main()
