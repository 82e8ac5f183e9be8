"""Keyed operators, dimensions, facts, quality reports and the batch load."""

import datetime as dt
import re

import pytest
from pyspark.sql import functions as F

from hirelake import schemas
from hirelake.functions.keys import SHORT_KEYS, KeyLengths
from hirelake.operators import analytics, dims, enrich, facts, keyed, landing, quality, text_ml, writing
from hirelake.plans import load, queries
from hirelake.session import delete_path, path_exists, scratch_path
from hirelake.sources import fixtures
from hirelake.sources.pages import ADVERT_HEADER, element_html, extract_fields, visible_text
from hirelake.sources.tables import jdbc_options

FOLDER = "/root/testdata/sf0.001"


def as_set(df, *columns):
    return {tuple(r) for r in (df.select(*columns) if columns else df).collect()}


def test_first_wins_and_insert_if_absent(rows):
    stored = rows("id long, k string, v string", (1, "a", "x"))
    incoming = rows(
        "id long, k string, v string", (5, "b", "late"), (4, "b", "early"), (3, "a", "no"), (2, None, "no")
    )
    assert as_set(keyed.first_wins(incoming, ["k"], "id")) == {(4, "b", "early"), (3, "a", "no")}
    assert as_set(keyed.insert_if_absent(stored, incoming, ["k"], "id")) == {(4, "b", "early")}


def test_upsert_replaces_and_is_idempotent(rows):
    target = rows("k string, v int", ("a", 1), ("b", 2))
    batch = rows("k string, v int, id int", ("b", 3, 1), ("b", 4, 2), ("c", 5, 3), (None, 6, 4))
    once = keyed.upsert(target, batch, ["k"], [F.desc("id")])
    assert as_set(once) == {("a", 1), ("b", 4), ("c", 5)}
    assert as_set(keyed.upsert(once, batch, ["k"], [F.desc("id")])) == as_set(once)


def test_two_batches_equal_one_shot(spark):
    adverts = queries.keyed_adverts(spark, FOLDER)
    candidates = facts.batch_candidates(adverts)
    first = facts.fact_rows(candidates.where("id % 2 = 0"))
    second = keyed.upsert(first, candidates.where("id % 2 = 1"), schemas.FACT.key, facts.newest_first())
    order = [F.desc(F.col("id") % 2), *facts.newest_first()]
    once = schemas.conform(keyed.one_per_key(candidates, schemas.FACT.key, order), schemas.FACT)
    assert as_set(second) == as_set(once)
    assert second.count() == candidates.select(*schemas.FACT.key).distinct().count()


def test_joined_facts_equal_facts_of_the_batch(spark):
    adverts = queries.keyed_adverts(spark, FOLDER)
    joined = facts.fact_candidates(
        adverts,
        dims.role_dim(adverts),
        dims.company_dim(adverts),
        dims.employment_type_dim(adverts),
        dims.location_dim(queries.places(spark, FOLDER)),
    )
    assert as_set(facts.fact_rows(joined)) == as_set(facts.fact_rows(facts.batch_candidates(adverts)))


@pytest.mark.parametrize("lengths", [SHORT_KEYS, KeyLengths(role=8, employment_type=8, company=16, location=16)])
def test_other_key_lengths_give_the_same_rollup(spark, lengths):
    raw = fixtures.postings(spark, FOLDER)
    adverts = enrich.keyed_postings(raw, fixtures.SEGMENT_ROLES, fixtures.PROSE_TOOLS, lengths)
    locations = dims.location_dim(enrich.keyed_locations(raw, fixtures.gazetteer(spark, FOLDER), lengths))
    roles, companies, types = dims.role_dim(adverts), dims.company_dim(adverts), dims.employment_type_dim(adverts)
    assert {len(r[0]) for r in companies.select("company_pk").collect()} == {lengths.company}
    fact = facts.fact_rows(facts.fact_candidates(adverts, roles, companies, types, locations))
    assert as_set(fact) == as_set(facts.fact_rows(facts.batch_candidates(adverts)))
    calendar = queries.calendar_of(adverts)
    found = analytics.star_rollup(fact, calendar, roles, companies, locations)
    assert as_set(found) == as_set(queries.QUERIES["star_rollup"](spark, FOLDER))


@pytest.mark.parametrize("step", [1, 7, 40_000, 3 << 40])
def test_rank_by_id(spark, step):
    ids = spark.range(-500, 1000).select(
        (F.col("id") * step).alias("id"), F.when(F.col("id") % 3 != 0, F.col("id") % 2).alias("g")
    )
    expected, counts = set(), {}
    for row in sorted(ids.collect(), key=lambda r: r["id"]):
        counts[row["g"]] = counts.get(row["g"], 0) + 1
        expected.add((row["id"], row["g"], counts[row["g"]]))
    assert as_set(keyed.rank_by_id(ids, "id", ["g"])) == expected
    assert {r["rank"] for r in keyed.rank_by_id(ids, "id").collect()} == set(range(1, 1501))


def test_every_second_row_keeps_rows_without_group(rows):
    df = rows("id long, g string", *[(i, None if i < 5 else "x") for i in range(9)])
    assert as_set(keyed.every_second_row(df, "id", ["g"]), "id") == {(0,), (2,), (4,), (5,), (7,)}


def test_dimension_keeps_the_smallest_label_and_no_null_key(rows):
    clean = rows("company_key string, company string", ("k", "b"), ("k", "a"), ("k", "b"), ("m", "c"), (None, None))
    assert as_set(dims.company_dim(clean)) == {("k", "a"), ("m", "c")}


def test_default_calendar(spark):
    calendar = dims.date_dim(spark)
    found = {r["date_iso_format_pk"]: r for r in calendar.collect()}
    assert len(found) == 273 and min(found) == dt.date(2023, 6, 1) and max(found) == dt.date(2024, 2, 28)
    assert {d for d, r in found.items() if r["is_holiday_us"]} == {
        dt.date(2023, 7, 4),
        dt.date(2023, 12, 25),
        dt.date(2024, 1, 1),
    }
    assert all(r["num_day_in_week"] == d.isoweekday() for d, r in found.items())
    assert all((r["name_month_en"], r["name_day_en"]) == (d.strftime("%B"), d.strftime("%A")) for d, r in found.items())
    assert dict(calendar.dtypes) == {c: t.lower() for c, t in schemas.DATE_DIM.column_types.items()}


def test_snapshot_of_a_day_without_facts_is_one_row(rows):
    fact = rows("last_updated timestamp_ntz", (dt.datetime(2024, 1, 1, 23, 59),), (dt.datetime(2024, 1, 2),))
    assert as_set(facts.daily_snapshot(fact, "2024-01-01")) == {(dt.date(2024, 1, 1), 1)}
    assert as_set(facts.daily_snapshot(fact, "2024-01-03")) == {(dt.date(2024, 1, 3), 0)}
    assert facts.daily_snapshot(fact).count() == 1


def test_lookup_update_keeps_rows_and_unmatched_keys(rows):
    target = rows("id int, role string, role_key string", (1, "A", None), (2, "B", "old"), (3, None, None))
    dim = rows("role_pk string, role string", ("k2", "A"), ("k1", "A"))
    assert as_set(facts.lookup_update(target, "role_key", dim, "role_pk", "role")) == {
        (1, "A", "k1"),
        (2, "B", "old"),
        (3, None, None),
    }


def test_quality_reports_find_injected_rows(spark, rows):
    dim = rows("role_pk string, role string", ("a", "x" * 31), ("a", "y"), (None, "z"), ("b", "y"))
    assert as_set(quality.pk_violations(dim, schemas.ROLE_DIM)) == {
        ("role_dim", "a", "duplicate key", 2),
        ("role_dim", "NULL", "null key", 1),
    }
    assert as_set(quality.unique_violations(dim, "role_dim", ["role"], "role_pk")) == {("role_dim", "y", 2)}
    assert as_set(quality.varchar_overflow(dim, schemas.ROLE_DIM)) == {
        ("role_dim", "role_pk", 32, 0, 1),
        ("role_dim", "role", 30, 1, 31),
    }
    assert as_set(quality.null_counts(dim, "role_dim", ["role_pk", "role"])) == {
        ("role_dim", "role_pk", 1, 4),
        ("role_dim", "role", 0, 4),
    }
    fact = rows("role_fk string, date_posted_fk date", ("a", dt.date(2024, 1, 1)), ("c", dt.date(9999, 12, 30)), (None, None))
    calendar = dims.date_dim(spark)
    references = {"role_fk": (dim, "role_pk"), "date_posted_fk": (calendar, "date_iso_format_pk")}
    assert as_set(quality.fk_orphans(fact, references)) == {("role_fk", "c", 1), ("date_posted_fk", "9999-12-30", 1)}
    assert as_set(quality.date_coverage(fact.where("role_fk = 'c'"), calendar)) == {(dt.date(9999, 12, 30), 1)}
    labels = spark.range(300).select(F.col("id").cast("string").alias("label"))
    found = quality.key_collisions(labels, "n", "label", 1)
    assert found.count() == 16 and found.agg(F.sum("n_labels")).first()[0] == 300


def test_analytics_on_literal_rows(rows):
    adverts = rows(
        "role string, country string, city string, toolset_list string, date_posted date",
        ("r", "A", "a", "SQL, Spark", dt.date(2024, 1, 1)),
        ("r", "A", "b", "SQL", dt.date(2024, 1, 7)),
        ("r", "B", None, "", dt.date(2024, 1, 8)),
        ("s", "B", "b", None, dt.date(2024, 2, 1)),
    )
    assert as_set(analytics.top_skills(adverts, "role", "toolset_list", 1)) == {("r", "SQL", 2, 1)}
    spelled = rows("role string, t string", ("r", "python, Python, Spark"), ("s", "python"))
    assert as_set(analytics.top_skills(spelled, "role", "t", 1)) == {("r", "Python", 2, 1), ("s", "Python", 1, 1)}
    trend = analytics.trend_by_role(adverts).where("role = 'r' AND grain <> 'day'")
    assert as_set(trend) == {
        ("week", dt.date(2024, 1, 1), "r", 2),
        ("week", dt.date(2024, 1, 8), "r", 1),
        ("month", dt.date(2024, 1, 1), "r", 3),
    }
    assert as_set(analytics.postings_by_location(adverts)) == {
        ("A", "a", 2, 1),
        ("A", "b", 2, 1),
        ("B", None, 2, 1),
        ("B", "b", 2, 1),
        ("A", None, 1, 2),
        ("B", None, 1, 2),
        (None, None, 0, 4),
    }


def test_scores(rows):
    scored = rows("gold string, p string", ("a", "a"), ("a", "b"), ("b", "b"), ("b", None))
    found = {r["label"]: tuple(r)[1:] for r in text_ml.macro_f1(scored, "gold", "p", ["a", "b"]).collect()}
    assert found["a"] == (1, 0, 1, 1.0, 0.5, 0.666667)
    assert found["b"] == (1, 1, 1, 0.5, 0.5, 0.5)
    assert found["macro"] == (2, 1, 2, 0.75, 0.5, 0.583334)
    span = "id int, start int, n_words int, term string"
    gold = rows(span, (1, 0, 1, "x"), (1, 5, 2, "y z"))
    predicted = rows(span, (1, 0, 1, "x"), (1, 5, 1, "y"))
    entities = text_ml.entity_prf(gold, predicted, "id")
    score = text_ml.training_score(entities, text_ml.macro_f1(scored, "gold", "p", ["a", "b"]))
    assert score.first()["score"] == round(0.5 * 0.5 + 0.5 * 0.583334, 6)
    found = {r["term"]: tuple(r)[1:4] for r in entities.collect()}
    assert found == {"x": (1, 0, 0), "y": (0, 1, 0), "y z": (0, 0, 1), "ALL": (1, 1, 1)}


HEADER = """<nav><a href="/">Home</a></nav><h2>Welcome</h2><strong>this first</strong>
<div class="x jobOverview--1"><div><a class="l" href="/c">Acme &amp; Co</a><h2 class="t"><span>x</span> <strong>Data
 Engineer</strong></h2><span data-ui="overview-location">Berlin, DE</span>
 <span class="q" data-ui="overview-date-posted">Posted 2 days ago</span></div></div>
<div class="jobBreakdown_2"><script>if (a < b) { "" }</script><p>Use&nbsp;<b>Spa</b>rk<br>daily<!-- no --></p></div>
<footer>foot</footer>"""


def test_advert_header(rows):
    page = rows("html string", (HEADER,))
    found = page.select(*extract_fields(element_html("html", "div", "jobOverview"), ADVERT_HEADER)).first()
    assert (found["company"], found["location"]) == ("Acme & Co", "Berlin, DE")
    assert found["title"] == "Data\n Engineer" and found["employment_type"] is None
    assert page.select(visible_text("html").alias("t")).first()["t"] == (
        "Home Welcome this first Acme & Co x Data Engineer Berlin, DE Posted 2 days ago Use Spark daily foot"
    )


def test_elements_are_balanced(value):
    def inner(html, tag, css_class=None):
        return value(element_html("x", tag, css_class), "x string", html)

    assert inner("<article>ad one</article><article>two</article>", "article") == "ad one"
    assert inner('<p><div class="a"><div>in</div>x</div>y</p>', "div", "a") == "<div>in</div>x"
    assert inner('<div class="aa b"><divider></divider>1</div><div class="b">2</div>', "div", "b") == "<divider></divider>1"
    assert inner('<div class="nob">1</div>', "div", "b") is None
    assert inner("<div>open <b>end", "div") == "open <b>end"
    assert inner("no element", "div") is None and inner(None, "div") is None


def test_raw_jobs_from_pages(rows):
    other = HEADER.replace("Berlin", "Bonn")
    pages = rows("page_id long, url string, html string", (7, "u7", HEADER), (8, "u8", HEADER), (9, None, other))
    fetched = F.lit("2024-02-01 10:11:12").cast("timestamp_ntz")
    found = landing.raw_jobs(pages, fetched, "board").orderBy("id").collect()
    assert [(r["id"], r["location"], r["metadata_application_link"]) for r in found] == [
        (1, "Berlin, DE", "u7"),
        (2, "Bonn, DE", "None"),
    ]
    assert found[0]["title"] == "Data Engineer" and found[0]["employment_type"] == "None"
    assert (found[0]["company"], found[0]["job_description"]) == ("Acme & Co", "Use Spark daily")
    assert found[0]["date_posted"] == dt.date(2024, 1, 30)
    assert found[0]["metadata_lastupdated"] == dt.datetime(2024, 2, 1, 10, 11)


def test_pages_to_clean_adverts(spark, rows):
    root = scratch_path(spark, "landing")
    pages = rows("page_id long, url string, html string", (7, "u7", HEADER), (9, "u9", HEADER.replace("Berlin", "Bonn")))
    fetched = F.lit("2024-02-01 10:11:12").cast("timestamp_ntz")
    for _ in range(2):
        load.load_landing(spark, pages, root, fetched, "board")
    raw = spark.read.parquet(schemas.table_path(root, schemas.RAW_JOBS))
    assert as_set(raw, "id", "location") == {(3, "Berlin, DE"), (4, "Bonn, DE")}
    assert spark.read.parquet(schemas.table_path(root, schemas.CLEAN_JOBS)).count() == 0
    clean = enrich.clean_postings(raw)
    assert as_set(clean, "role", "country", "toolset_list") == {("Data Engineer", "Germany", "Spark")}


def test_reload_goes_on_counting(spark, rows):
    path = scratch_path(spark, "reload")
    writing.reload_table(spark, rows("id long, v string", (10, "a"), (20, "b")), path, "id", "id")
    assert as_set(spark.read.parquet(path)) == {(1, "a"), (2, "b")}
    writing.reload_table(spark, rows("id long, v string"), path, "id", "id")
    assert spark.read.parquet(path).count() == 0
    writing.reload_table(spark, rows("id long, v string", (5, "c")), path, "id", "id")
    assert as_set(spark.read.parquet(path)) == {(3, "c")}


def test_merge_rewrites_touched_partitions_only_and_can_be_repeated(spark, rows):
    path = scratch_path(spark, "merged")

    def merge(old, new):
        return keyed.upsert(old, new, ["k"])

    schema = "k int, v string, m string"
    writing.write_merged(spark, path, rows(schema, (1, "a", "x"), (2, "b", "y"), (3, "c", "y")), merge, "m")
    untouched = {f for f in spark.read.parquet(path).inputFiles() if "m=x" in f}
    for _ in range(2):
        writing.write_merged(spark, path, rows(schema, (3, "d", "y"), (4, "e", "z")), merge, "m")
        assert as_set(spark.read.parquet(path), "k", "v", "m") == {
            (1, "a", "x"),
            (2, "b", "y"),
            (3, "d", "y"),
            (4, "e", "z"),
        }
    assert untouched <= set(spark.read.parquet(path).inputFiles())
    # The same batch with other rows is merged anew.
    writing.write_merged(spark, path, rows(schema, (4, "f", "z")), merge, "m")
    assert as_set(spark.read.parquet(path).where("m = 'z'"), "k", "v") == {(4, "f")}
    touched = writing.stored_rows(spark, path, rows(schema, (9, "g", "y")), "m")
    pruned = re.search(r"PartitionFilters: \[.*m#\d+ = y", touched._jdf.queryExecution().executedPlan().toString())
    assert pruned
    assert {f.split("m=")[1][0] for f in touched.inputFiles()} >= {"y"}


def test_a_merge_that_was_lost_is_finished_by_the_next_batch(spark, rows):
    path = scratch_path(spark, "lost")

    def merge(old, new):
        return keyed.upsert(old, new, ["k"])

    writing.write_merged(spark, path, rows("k int, v string", (1, "a")), merge)
    # The state after a crash: everything is staged, the table is gone, and half a stage lies about.
    rows("k int, v string", (1, "a"), (2, "b")).write.mode("overwrite").parquet(f"{path}_stage")
    rows("k int, v string", (9, "z")).write.mode("overwrite").parquet(f"{path}_staging")
    delete_path(spark, path)
    writing.write_merged(spark, path, rows("k int, v string", (3, "c")), merge)
    assert as_set(spark.read.parquet(path)) == {(1, "a"), (2, "b"), (3, "c")}
    assert not any(path_exists(spark, f"{path}_{name}") for name in ("stage", "staging", "incoming"))


def test_dimensions_do_not_depend_on_batches(rows):
    first, second = rows("k string, v string", ("a", "Beta")), rows("k string, v string", ("a", "Alpha"), ("b", "x"))
    assert as_set(dims.merged_dimension(first, second, "k")) == {("a", "Alpha"), ("b", "x")}
    assert as_set(dims.merged_dimension(second, first, "k")) == {("a", "Alpha"), ("b", "x")}


def test_batch_load_twice_and_in_two_batches(spark):
    raw = schemas.conform(fixtures.postings(spark, FOLDER, descriptions=True), schemas.RAW_JOBS)
    places = fixtures.gazetteer(spark, FOLDER)
    root = scratch_path(spark, "warehouse")
    schemas.create_tables(spark, root)
    load.load_calendar(spark, root, "1995-01-01", "2001-08-01")

    def run(rows):
        load.load_batch(
            spark, rows, root, queries.SNAPSHOT_DAY, places, fixtures.SEGMENT_ROLES, fixtures.PROSE_TOOLS
        )

    def table(t):
        return spark.read.parquet(schemas.table_path(root, t))

    run(raw.where("id % 2 = 0"))
    run(raw.where("id % 2 = 0"))
    run(raw.where("id % 2 = 1"))
    candidates = facts.batch_candidates(enrich.keyed_postings(raw, fixtures.SEGMENT_ROLES, fixtures.PROSE_TOOLS))
    order = [F.desc(F.col("id") % 2), *facts.newest_first()]
    expected = schemas.conform(keyed.one_per_key(candidates, schemas.FACT.key, order), schemas.FACT)
    fact = table(schemas.FACT)
    assert as_set(fact, *schemas.FACT.column_names) == as_set(expected)
    references = {
        "date_posted_fk": (table(schemas.DATE_DIM), "date_iso_format_pk"),
        "role_fk": (table(schemas.ROLE_DIM), "role_pk"),
        "company_fk": (table(schemas.COMPANY_DIM), "company_pk"),
        "employment_type_fk": (table(schemas.EMPLOYMENT_TYPE_DIM), "employment_type_pk"),
        "location_fk": (table(schemas.LOCATION_DIM), "location_pk"),
    }
    assert quality.fk_orphans(fact, references).count() == 0
    day = dt.date.fromisoformat(queries.SNAPSHOT_DAY)
    on_day = expected.where(F.col("last_updated").cast("date") == F.lit(day)).count()
    assert as_set(table(schemas.DAILY_SNAPSHOT)) == {(day, on_day)}
    assert spark.table("presentation.fact_less_table").count() == expected.count()
    assert spark.table("presentation.company_dim").count() == table(schemas.COMPANY_DIM).count() > 0
    load.load_calendar(spark, root)
    days = expected.agg(F.min("date_posted_fk"), F.max("date_posted_fk")).first()
    found = spark.table("presentation.date_dim").agg(F.min("date_iso_format_pk"), F.max("date_iso_format_pk")).first()
    assert tuple(found) == tuple(days)
    assert spark.table("presentation.seniority_dim").count() == 0


def test_jdbc_options():
    options = jdbc_options(
        "jdbc:postgresql://h/db", "raw", "u", "p", partition_column="id", lower=1, upper=100, partitions=8
    )
    assert (options["numPartitions"], options["partitionColumn"]) == ("8", "id")
    assert "partitionColumn" not in jdbc_options("jdbc:x", "raw", "u", "p")
    with pytest.raises(ValueError):
        jdbc_options("jdbc:x", "raw", "u", "p", partition_column="id")
