"""Advert views over the given tables, which stand in for a crawled job board."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hirelake.functions.text import squeeze_whitespace
from hirelake.sources.pages import extract_fields
from hirelake.sources.tables import read_table

# Role rules for the titles of these views: pattern in the lower-case title, role.
SEGMENT_ROLES = (
    ("furniture", "Data Scientist"),
    ("building", "Data Analyst"),
    ("machinery", "Machine Learning Engineer"),
    ("automobile", "Data Engineer"),
)

# Tool names for the invented prose of the documents; two of them have two words.
PROSE_TOOLS = (
    "thtion",
    "attion",
    "ertion",
    "thanea",
    "eriner",
    "thanedble",
    "ontion",
    "antion",
    "retion",
    "edtion",
    "eriner thanea",
    "thanedble the",
)

# The same names as they begin with a capital, which a tagger of lower-cased words has to guess.
NAMED_TOOLS = tuple(t.capitalize() for t in PROSE_TOOLS)

# Marker words per language, in label order.
LANGUAGE_MARKERS = {
    "en": ("the", "of", "and", "to", "is", "that"),
    "de": ("der", "die", "und", "den", "von", "zu"),
    "fr": ("le", "et", "les", "du", "une", "pour"),
    "es": ("el", "los", "las", "del", "por", "con"),
}

PAGE_FIELDS = {"title": r"<h1>([^<]*)</h1>"}
# Where the stored pages have something like an advert's fields, inside their article.
PAGE_ADVERT = {
    "title": r"(?is)<h1\b[^>]*>([^<]*)",
    "company": r"(?is)<a\b[^>]*>([^<]+)",
    "location": r"(?is)<p\b[^>]*>([^<]+)",
    "date_posted": r"(?is)<time\b[^>]*>([^<]+)",
}


def postings(
    spark: SparkSession, folder: str, descriptions: bool = False, orders: DataFrame | None = None
) -> DataFrame:
    """Adverts: one per order, posted by its customer from the customer's nation.

    With ``descriptions`` the document of the same number is the description, where there is one.
    ``orders`` may be a stream of that table.
    """
    orders = read_table(spark, folder, "orders") if orders is None else orders
    customer = read_table(spark, folder, "customer")
    nation = read_table(spark, folder, "nation")
    region = read_table(spark, folder, "region")
    # Places and companies meet first, so the orders are joined once. Nations and regions are few;
    # one company may have posted a third of all adverts.
    places = nation.join(F.broadcast(region), F.col("n_regionkey") == F.col("r_regionkey"))
    companies = customer.join(F.broadcast(places), F.col("c_nationkey") == F.col("n_nationkey"))
    adverts = orders.join(companies.withColumnRenamed("c_custkey", "o_custkey"), "o_custkey")
    description = F.lit(None).cast("string")
    if descriptions:
        texts = read_table(spark, folder, "documents").select("doc_id", "text")
        adverts = adverts.join(texts, F.col("o_orderkey") == F.col("doc_id"), "left")
        description = squeeze_whitespace("text")
    return adverts.select(
        F.col("o_orderkey").alias("id"),
        F.initcap("c_mktsegment").alias("title"),
        F.col("c_name").alias("company"),
        F.concat("n_name", F.lit(", "), "r_name").alias("location"),
        F.col("o_orderpriority").alias("employment_type"),
        F.col("o_orderdate").cast("date").alias("date_posted"),
        description.alias("job_description"),
        F.col("o_orderdate").alias("metadata_lastupdated"),
        F.lit(None).cast("string").alias("metadata_application_link"),
        F.lit("orders").alias("metadata_source"),
    )


def gazetteer(spark: SparkSession, folder: str) -> DataFrame:
    """Places for the locations of the postings: nations as cities, regions as countries."""
    nation = read_table(spark, folder, "nation")
    region = read_table(spark, folder, "region")
    return nation.join(region, F.col("n_regionkey") == F.col("r_regionkey")).select(
        F.col("r_name").alias("country"), F.col("n_name").alias("city")
    )


def pages(spark: SparkSession, folder: str) -> DataFrame:
    return read_table(spark, folder, "pages")


def documents(spark: SparkSession, folder: str) -> DataFrame:
    return read_table(spark, folder, "documents")


def page_postings(spark: SparkSession, folder: str) -> DataFrame:
    """Adverts from stored pages: heading, host and language segment of the address."""
    lang = F.upper(F.regexp_extract("url", r"^[a-z]+://[^/]+/([a-z]{2})/", 1))
    columns = [
        F.col("page_id").alias("id"),
        *extract_fields("html", PAGE_FIELDS),
        F.try_parse_url("url", F.lit("HOST")).alias("company"),
        lang.alias("lang_code"),
        F.col("url").alias("metadata_application_link"),
    ]
    return read_table(spark, folder, "pages").select(*columns).withColumn("location", F.concat("company", F.lit(" "), "lang_code"))


def descriptions(spark: SparkSession, folder: str) -> DataFrame:
    """Descriptions: the documents, blanks squeezed."""
    return documents(spark, folder).select(
        F.col("doc_id").alias("id"),
        squeeze_whitespace("text").alias("job_description"),
        "lang",
        "source",
    )


def raw_descriptions(spark: SparkSession, folder: str) -> DataFrame:
    """Descriptions as they come, for jobs that read words and don't mind the blanks."""
    return documents(spark, folder).select(F.col("doc_id").alias("id"), F.col("text").alias("job_description"))


def arrivals(spark: SparkSession, folder: str) -> DataFrame:
    """Arriving records: the events."""
    return read_table(spark, folder, "events")
