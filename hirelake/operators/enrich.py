"""Enrichment of raw adverts: role, tools, place, surrogate keys."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from hirelake import schemas
from hirelake.functions.keys import WHOLE_KEYS, KeyLengths, surrogate_key
from hirelake.functions.text import MISSING_TEXT, any_of, fold_accents
from hirelake.session import scratch_path
from hirelake.sources.iso import iso_names, iso_pattern, iso_table

# The roles, in label order.
ROLES = (
    "Data Scientist",
    "Data Analyst",
    "Machine Learning Engineer",
    "Data Engineer",
    "Other",
)
OTHER_ROLE = "Other"

# Pattern in the lower-case title, role. The first rule that matches decides.
TITLE_RULES = (
    (r"machine learning|deep learning|\bml\b|mlops|\bai (?:engineer|developer)|computer vision|\bnlp\b", "Machine Learning Engineer"),
    (r"data scien|research scientist|applied scientist", "Data Scientist"),
    (r"data (?:platform |warehouse |pipeline )?engineer|\betl\b|analytics engineer|big data|data architect", "Data Engineer"),
    (r"analyst|analytics|business intelligence|\bbi\b", "Data Analyst"),
)

# Tool names looked for in descriptions, in any letter case, unless a job passes its own list.
DEFAULT_TOOLS = (
    "Airflow", "AWS", "Azure", "BigQuery", "C++", "C#", "Cassandra", "Databricks", "dbt", "Docker",
    "Elasticsearch", "GCP", "Git", "Google Cloud", "Hadoop", "Java", "JavaScript", "Jenkins", "Jupyter",
    "Kafka", "Keras", "Kubernetes", "Linux", "Looker", "Matplotlib", "MongoDB", "MySQL", "NumPy",
    "Pandas", "PostgreSQL", "Power BI", "PySpark", "Python", "PyTorch", "Redshift", "Scala",
    "scikit-learn", "Snowflake", "SQL", "SQL Server", "Tableau", "TensorFlow", "Terraform",
)
# Tool names that are words or letters too: looked for as they are spelled here.
EXACT_TOOLS = ("Excel", "Go", "Hive", "Oracle", "R", "SAS", "Spark")

# What stands for a place that was not found.
NOT_DEFINED = "Not Defined"

WORD_SIGNS = r"\p{L}\p{N}_+#"
WORD = f"[{WORD_SIGNS}]+"
# Up to so many phrases are looked for inside the array of words, before rows are made; more are joined.
LOOKED_UP = 4096
_PLACE_WORD = r"[\p{L}\p{N}_'.\-]+"


def role_from_title(title: Column | str, rules: Sequence[tuple[str, str]] = TITLE_RULES) -> Column:
    """The role a title names: 'Other' when no rule matches, 'None' without a title."""
    lowered = F.lower(title)
    role = F.when(F.isnull(title) | (F.trim(lowered) == ""), F.lit(MISSING_TEXT))
    for pattern, name in rules:
        role = role.when(F.rlike(lowered, F.lit(pattern)), F.lit(name))
    return role.otherwise(F.lit(OTHER_ROLE))


def tools_in(
    text: Column | str, tools: Sequence[str] = DEFAULT_TOOLS, exact: Sequence[str] | None = None
) -> Column:
    """The tools a text names, in order, repeats kept, as they are spelled there.

    Where several tools begin at one place the longest wins. One regular expression does all of it
    inside the scan's stage: no row is added and nothing is shuffled. Tools in ``exact`` have to be
    spelled as they are there; without it these are EXACT_TOOLS next to the default list, else none.
    """
    if exact is None:
        exact = EXACT_TOOLS if tools is DEFAULT_TOOLS else ()
    return F.regexp_extract_all(text, F.lit(any_of(tools, exact)), F.lit(0))


def list_of_tools(
    text: Column | str, tools: Sequence[str] = DEFAULT_TOOLS, exact: Sequence[str] | None = None
) -> Column:
    """The tools as one text; empty when there are none, NULL without a text."""
    return F.array_join(tools_in(text, tools, exact), ", ")


def tool_spans(docs: DataFrame, id_col: str, text: Column | str, lexicon: DataFrame) -> DataFrame:
    """Where a text names tools: id, first word, number of words, tool.

    For a lexicon table (column ``term``) of any size: words are looked up among the first words of
    the terms, and only hits go on. Where hits overlap the earlier wins, then the longer one.
    """
    terms = _phrases(lexicon, "term", WORD)
    hits = _phrase_hits(docs, [id_col], F.lower(text), WORD, terms)
    hits = hits.select(id_col, "start", "n_words", F.col("phrase").alias("term"))
    # Hits that touch no earlier one begin a new group: what overlaps is decided within groups only.
    before = W.partitionBy(id_col).orderBy("start", F.desc("n_words"), "term")
    reached = F.max(F.col("start") + F.col("n_words")).over(before.rowsBetween(W.unboundedPreceding, -1))
    apart = F.coalesce((F.col("start") >= reached).cast("int"), F.lit(1))
    grouped = hits.withColumn("_apart", apart).withColumn("_group", F.sum("_apart").over(before))
    ordered = F.sort_array(F.collect_list(F.struct("start", (-F.col("n_words")).alias("shorter"), "n_words", "term")))
    return (
        grouped.groupBy(id_col, "_group")
        .agg(ordered.alias("hits"))
        .select(id_col, F.explode(_without_overlaps(F.col("hits"))).alias("hit"))
        .select(id_col, F.col("hit.start").alias("start"), F.col("hit.n_words").alias("n_words"), F.col("hit.term").alias("term"))
    )


def tagged_spans(
    docs: DataFrame,
    id_col: str,
    text: str,
    tools: Sequence[str] = DEFAULT_TOOLS,
    exact: Sequence[str] | None = None,
    blank: str = " ",
) -> DataFrame:
    """The tools that a regular expression like that of ``tools_in`` finds, as spans like those of ``tool_spans``.

    A tool consists of whole words in the sense of ``tool_spans``, to which + and # belong: "sql###" doesn't
    name SQL. ``blank`` is the expression for what may stand between the words of a tool; it matches no word.
    One expression cuts a text into tools and other words, so the place in that list tells the start, but
    for the further words of the tools before.
    """
    if exact is None:
        exact = EXACT_TOOLS if tools is DEFAULT_TOOLS else ()
    pattern = any_of(tools, exact, WORD_SIGNS, blank)
    # Most texts may name nothing. Parts of what is looked for as it is spelled are found faster than the expression.
    named = docs.where(reduce(or_, [F.contains(F.col(text), F.lit(t.split(" ")[0])) for t in exact]) if exact and not tools else F.rlike(F.col(text), F.lit(pattern)))
    # The group is empty where a word is no tool.
    cut = named.select(id_col, F.regexp_extract_all(text, F.lit(f"({pattern})|{WORD}"), F.lit(1)).alias("_hits"))
    places = F.transform("_hits", lambda hit, i: F.when(hit != "", F.struct(i.alias("place"), hit.alias("hit"))))
    each = cut.select(id_col, F.inline(F.filter(places, lambda p: p.isNotNull()))).select(
        id_col, "place", F.regexp_count("hit", F.lit(WORD)).alias("n_words"), F.lower(F.regexp_replace("hit", blank, " ")).alias("term")
    )
    before = W.partitionBy(id_col).orderBy("place").rowsBetween(W.unboundedPreceding, -1)
    start = F.col("place") + F.coalesce(F.sum(F.col("n_words") - 1).over(before), F.lit(0))
    return each.select(id_col, start.cast("int").alias("start"), F.col("n_words").cast("int").alias("n_words"), "term")


def _phrases(terms: DataFrame, column: str, word: str) -> DataFrame:
    """Distinct phrases of a lexicon: first word, number of words, all words joined by blanks."""
    words = F.regexp_extract_all(F.lower(column), F.lit(word), F.lit(0))
    return (
        terms.select(words.alias("words"))
        .where(F.size("words") > 0)
        .select(
            F.get("words", F.lit(0)).alias("first"),
            F.size("words").alias("n_words"),
            F.array_join("words", " ").alias("phrase"),
        )
        .distinct()
    )


def _phrase_hits(rows: DataFrame, keep: Sequence[str], text: Column, word: str, phrases: DataFrame) -> DataFrame:
    """One row per place of a text and phrase that begins there: ``keep``, start and the phrase's columns.

    How many words a phrase may have and, up to LOOKED_UP phrases, what they begin with is asked of the
    phrases, which are few next to the texts: then only words that begin one become rows, and these meet the
    phrases without being shuffled. Beyond, all words are joined; their rows are never the side sent around,
    whatever Spark takes their size for.
    """
    longest = phrases.agg(F.max("n_words")).first()[0] or 1
    some = phrases.select("first").limit(LOOKED_UP + 1).collect()
    few, firsts = len(some) <= LOOKED_UP, sorted({r["first"] for r in some})
    words = F.regexp_extract_all(text, F.lit(word), F.lit(0))
    places = F.transform("_words", lambda w, i: F.struct(i.alias("start"), w.alias("first")))
    if few:
        places = F.filter(places, lambda p: p["first"].isin(firsts)) if firsts else F.slice(places, 1, 0)
    ahead = lambda p: F.slice("_words", p["start"] + 1, F.lit(longest))
    begun = F.transform(places, lambda p: F.struct(p["start"].alias("start"), p["first"].alias("first"), ahead(p).alias("ahead")))
    each = rows.select(*keep, words.alias("_words")).select(*keep, F.inline(begun))
    named = each.join(F.broadcast(phrases), "first") if few else each.hint("merge").join(phrases, "first")
    return named.where(F.array_join(F.slice("ahead", F.lit(1), F.col("n_words")), " ") == F.col("phrase")).drop("ahead")


def _without_overlaps(hits: Column) -> Column:
    """Of hits sorted by start, those that begin after the last kept one ended."""
    none = F.filter(hits, lambda _: F.lit(False))
    state = F.struct(F.lit(0).alias("end"), none.alias("kept"))

    def step(acc: Column, hit: Column) -> Column:
        free = hit["start"] >= acc["end"]
        return F.struct(
            F.when(free, hit["start"] + hit["n_words"]).otherwise(acc["end"]).alias("end"),
            F.when(free, F.concat(acc["kept"], F.array(hit))).otherwise(acc["kept"]).alias("kept"),
        )

    return F.aggregate(hits, state, step, lambda acc: acc["kept"])


def distinct_locations(df: DataFrame) -> DataFrame:
    return df.select("location").where("location IS NOT NULL").distinct()


def resolve_locations(locations: DataFrame, gazetteer: DataFrame | None = None) -> DataFrame:
    """Country and city of each distinct location text: location, geo(country, city).

    First the gazetteer (country, city and, where it has one, a rank): the earliest and longest city
    named, preferring one whose country is named too; of cities with one name the lowest rank, then the
    first country. Then the first upper-case ISO country code. Else 'Not Defined'.
    Texts repeat a lot, so only distinct ones are looked up.
    """
    spark = locations.sparkSession
    distinct = distinct_locations(locations)
    not_defined = F.lit(NOT_DEFINED)
    place = F.lit(None).cast("struct<country:string,city:string>")
    found = distinct
    if gazetteer is not None:
        found = _gazetteer_hits(distinct, gazetteer)
        place = F.when(F.col("hit").isNotNull(), F.struct("hit.country", "hit.city"))
    coded = found.withColumn(
        "iso_code", F.regexp_extract(fold_accents("location"), iso_pattern(list(iso_names(spark))), 0)
    )
    # The ISO table has about 250 rows whatever the data.
    named = coded.join(F.broadcast(iso_table(spark)), "iso_code", "left")
    by_code = F.struct(
        F.coalesce("iso_country", not_defined).alias("country"), not_defined.alias("city")
    )
    return named.select("location", F.coalesce(place, by_code).alias("geo"))


def _gazetteer_hits(distinct: DataFrame, gazetteer: DataFrame) -> DataFrame:
    def normal(text: Column | str) -> Column:
        return F.lower(fold_accents(text))

    rank = F.col("rank").cast("double") if "rank" in gazetteer.columns else F.lit(0.0)
    cities = gazetteer.select("country", "city", normal("city").alias("_name"), normal("country").alias("_country"), rank.alias("_rank"))
    names = F.regexp_extract_all("_name", F.lit(_PLACE_WORD), F.lit(0))
    places = cities.withColumn("_words", names).where(F.size("_words") > 0).select(
        "country", "city", "_country", "_rank", F.col("_words")[0].alias("first"), F.size("_words").alias("n_words"),
        F.array_join("_words", " ").alias("phrase"),
    )
    texts = distinct.withColumn("_text", normal("location"))
    named = _phrase_hits(texts, ["location", "_text"], F.col("_text"), _PLACE_WORD, places)
    hit = F.struct(
        (~F.contains(F.col("_text"), F.col("_country"))).alias("elsewhere"),
        "start",
        (-F.col("n_words")).alias("shorter"),
        F.coalesce("_rank", F.lit(float("inf"))).alias("rank"),
        "country",
        "city",
    )
    best = named.groupBy("location").agg(F.min(hit).alias("hit"))
    return distinct.join(best, "location", "left")


def with_geo(df: DataFrame, gazetteer: DataFrame | None = None) -> DataFrame:
    """Rows and the struct column ``geo``; NULL without a location.

    Only distinct locations are looked up; their places are stored first, so that the size of the files
    tells whether they may be broadcast. Then the rows are not shuffled; beyond the session's threshold
    they are, and a location that holds a third of them is split by AQE.
    """
    spark, path = df.sparkSession, scratch_path(df.sparkSession, "places")
    places = resolve_locations(df, gazetteer)
    places.write.parquet(path)
    return df.join(spark.read.schema(places.schema).parquet(path), "location", "left")


def keyed_locations(
    df: DataFrame, gazetteer: DataFrame | None = None, lengths: KeyLengths = WHOLE_KEYS
) -> DataFrame:
    """The distinct locations with key, country and city: all that the location dimension needs."""
    return resolve_locations(df, gazetteer).select(
        surrogate_key("location", lengths.location).alias("location_key"), "geo.country", "geo.city"
    )


def with_keys(df: DataFrame, lengths: KeyLengths = WHOLE_KEYS) -> DataFrame:
    """Rows with the surrogate keys of role, company, location and employment type."""
    return df.withColumns(
        {
            "role_key": surrogate_key("role", lengths.role),
            "company_key": surrogate_key("company", lengths.company),
            "location_key": surrogate_key("location", lengths.location),
            "employment_type_key": surrogate_key("employment_type", lengths.employment_type),
        }
    )


def roles_of(raw: DataFrame, model) -> DataFrame:
    """Rows with the role a fitted classifier gives their title (see ``text_ml.NaiveBayes``).

    Only distinct titles are classified. 'None' without a title, 'Other' where no word is known.
    """
    predicted = model.predict(raw.select("title").where("title IS NOT NULL").distinct(), "title", "title", "_role")
    joined = raw.join(predicted.select("title", "_role"), "title", "left")
    missing = F.isnull("title") | (F.trim("title") == "")
    role = F.when(missing, F.lit(MISSING_TEXT)).otherwise(F.coalesce("_role", F.lit(OTHER_ROLE)))
    return joined.select(*raw.columns, role.alias("role"))


def keyed_postings(
    raw: DataFrame,
    rules: Sequence[tuple[str, str]] = TITLE_RULES,
    tools: Sequence[str] = DEFAULT_TOOLS,
    lengths: KeyLengths = WHOLE_KEYS,
    role_model=None,
) -> DataFrame:
    """Raw adverts with role, tools and keys. With rules every row is handled by itself; nothing is shuffled."""
    named = raw.withColumn("role", role_from_title("title", rules)) if role_model is None else roles_of(raw, role_model)
    return with_keys(named.withColumn("toolset_list", list_of_tools("job_description", tools)), lengths)


def clean_postings(
    raw: DataFrame,
    gazetteer: DataFrame | None = None,
    rules: Sequence[tuple[str, str]] = TITLE_RULES,
    tools: Sequence[str] = DEFAULT_TOOLS,
    lengths: KeyLengths = WHOLE_KEYS,
    role_model=None,
) -> DataFrame:
    """Raw adverts with role, tools, place and keys, as columns of the clean table.

    Roles come from rules on the title, or from a fitted classifier where one is given.
    """
    placed = with_geo(keyed_postings(raw, rules, tools, lengths, role_model), gazetteer)
    return schemas.conform(
        placed.withColumns({"country": F.col("geo.country"), "city": F.col("geo.city")}), schemas.CLEAN_JOBS
    )
